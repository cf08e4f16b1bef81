"""Run a registered query and its SQL and compare the rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def differences(df, con, sql: str) -> str | None:
    names = sorted(df.columns)
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    if sorted(theirs_names) != names:
        return f"columns {names} against {sorted(theirs_names)}"
    at = [theirs_names.index(n) for n in names]
    theirs = Counter(tuple(row[i] for i in at) for row in result.fetchall())
    ours = Counter(tuple(r) for r in df.select(*names).collect())
    if not ours:
        return "no rows"
    if ours != theirs:
        return (
            f"{sum(ours.values())} rows against {sum(theirs.values())}; only ours "
            f"{list((ours - theirs).items())[:3]}, only theirs {list((theirs - ours).items())[:3]}"
        )
    return None
