"""Keyed state of ``foreachBatch`` operators: a table that each micro-batch adds its changes to.

A batch writes only what it changed, as one more *run* of rows. ``merge`` turns the rows of several
runs into as few that mean the same (sums added up, the latest row of a key), and every ``FAN``
runs of about one size are merged into one of the next size. So what is written follows the batches:
each change is written again once per size, not once per batch.

A batch is there once its commit record is: the record names the runs and holds a few values, and is written
after the batch's rows and its run. Results and state of a batch without one are not read, and are written
over when the batch is run again. Runs that no record of the last ``KEPT`` batches names are removed.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN = 4
# Batches whose state is kept: a batch can be run again as long as the one before it is there.
KEPT = 2

# Rows, and whether they are all there are (so that what only hides older rows can go).
Merge = Callable[[DataFrame, bool], DataFrame]


class Files:
    """The few file operations that DataFrames lack, on any file system Spark knows."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark._jvm
        self.path = path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.system = self._at("").getFileSystem(conf)

    def _at(self, name: str) -> object:
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        if not self.system.exists(self._at(folder)):
            return []
        return [status.getPath().getName() for status in self.system.listStatus(self._at(folder))]

    def read(self, name: str) -> str:
        stream = self.system.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Whole or not at all: written beside its place and then moved there."""
        aside = self._at(f"{name}.part")
        stream = self.system.create(aside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.system.delete(self._at(name), False)
        if not self.system.rename(aside, self._at(name)):
            raise OSError(f"could not write {self.path}/{name}")

    def remove(self, name: str) -> None:
        self.system.delete(self._at(name), True)


def last_commit(spark: SparkSession, path: str) -> int | None:
    """Number of the last batch that is there as a whole."""
    numbers = [int(name) for name in Files(spark, f"{path}/commits").names("") if name.isdigit()]
    return max(numbers, default=None)


class StateTable:
    """The state of one operator, in ``path``, as the batches before ``batch_id`` left it."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int, merge: Merge | None = None) -> None:
        self.spark, self.path, self.batch_id, self.merge = spark, path, batch_id, merge
        self.files = Files(spark, path)
        before = self._record(batch_id - 1) if batch_id else {"runs": [], "values": {}}
        if before is None:
            raise ValueError(f"{path} has no state of batch {batch_id - 1}")
        self.before: dict = before
        self.values: dict = before["values"]

    def begin(self) -> None:
        """Hide what an earlier run of this batch has left."""
        self.files.remove(f"commits/{self.batch_id}")

    def _record(self, batch_id: int) -> dict | None:
        if str(batch_id) not in self.files.names("commits"):
            return None
        return json.loads(self.files.read(f"commits/{batch_id}"))

    def _run(self, run: list[int]) -> str:
        return f"state/run={run[0]}-{run[1]}"

    def rows(self) -> DataFrame | None:
        """The rows of all runs, not yet merged; None if there are none."""
        return self._rows(self.before["runs"])

    def _rows(self, runs: list[list[int]]) -> DataFrame | None:
        if not runs:
            return None
        schema = T.StructType.fromJson(self.before["schema"])
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{self._run(run)}" for run in runs])

    def since(self, name: str, value: object) -> object:
        """A value of this batch that stays when the batch is run again, such as its time."""
        kept = f"kept/{self.batch_id}-{name}"
        if f"{self.batch_id}-{name}" not in self.files.names("kept"):
            self.files.write(kept, json.dumps(value))
        return json.loads(self.files.read(kept))

    def commit(self, changed: DataFrame | None, **values: object) -> None:
        """Add the batch's changes, and make the batch visible."""
        runs = [list(run) for run in self.before["runs"]]
        if changed is not None:
            new = [self.batch_id, self.batch_id]
            # All runs have the columns of the first, so that no file need be asked for them.
            self.before.setdefault("schema", changed.schema.jsonValue())
            types = {f["name"]: f["type"] for f in self.before["schema"]["fields"]}
            if types != {f["name"]: f["type"] for f in changed.schema.jsonValue()["fields"]}:
                raise TypeError(f"state of {self.path} has other columns than {changed.schema.simpleString()}")
            changed.write.mode("overwrite").parquet(f"{self.path}/{self._run(new)}")
            runs.append(new)
        # Runs of one size stand together, the largest first.
        size = 1
        while len(runs) >= FAN and all(end - start < size for start, end in runs[-FAN:]):
            merged = [runs[-FAN][0], runs[-1][1]]
            self.merge(self._rows(runs[-FAN:]), len(runs) == FAN).write.mode("overwrite").parquet(f"{self.path}/{self._run(merged)}")
            runs[-FAN:] = [merged]
            size *= FAN
        self.files.write(f"commits/{self.batch_id}", json.dumps({**self.before, "runs": runs, "values": values}))
        self._clean(runs)

    def _clean(self, runs: list[list[int]]) -> None:
        kept = {self._run(run) for run in runs}
        for batch in range(self.batch_id - KEPT + 1, self.batch_id):
            kept |= {self._run(run) for run in (self._record(batch) or {"runs": []})["runs"]}
        for name in self.files.names("state"):
            if f"state/{name}" not in kept:
                self.files.remove(f"state/{name}")
        for name in self.files.names("commits"):
            if name.isdigit() and int(name) <= self.batch_id - KEPT:
                self.files.remove(f"commits/{name}")
        for name in self.files.names("kept"):
            if int(name.split("-")[0]) <= self.batch_id - KEPT:
                self.files.remove(f"kept/{name}")


def latest(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """The latest row of each key, by ``number``."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), number).alias("_last")).select(*keys, "_last.*")
