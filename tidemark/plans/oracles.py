"""The same results in plain SQL, for DuckDB over the same tables."""

from __future__ import annotations

_EVENTS = """
e AS (SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts_ms, user_id, event_type,
             CAST(round(value * 100) AS BIGINT) AS cents FROM events)"""

_TUMBLED = f"{_EVENTS}, t AS (SELECT *, ts_ms // 21600000 * 21600000 AS start_ms FROM e)"

_WORDS = """
l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
s AS (SELECT line, regexp_replace(line, '[\\s\\x0B]+$', '') AS cut FROM l),
w AS (SELECT unnest(regexp_split_to_array(cut, '[\\s\\x0B]')) AS word FROM s
      WHERE line = '' OR cut <> '')"""


def _late(lateness_ms: int) -> str:
    late = "allowed_late" if lateness_ms else "too_late"
    return f"""
j AS (SELECT event_id AS seq, event_type AS word,
             epoch_us(ts) // 1000 - (event_id * 7919) % 97 * 300000 AS ts_ms FROM events),
a AS (SELECT *, ts_ms // 21600000 * 21600000 + 21600000 AS end_ms,
             max(ts_ms) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               - 7200001 AS wm FROM j),
c AS (SELECT *, CASE WHEN wm IS NULL OR end_ms - 1 > wm THEN 'on_time'
             WHEN end_ms - 1 + {lateness_ms} > wm THEN '{late}' ELSE 'too_late' END AS late_class
      FROM a),
f AS (SELECT word, end_ms, max(CASE WHEN late_class = 'on_time' THEN 1 ELSE 0 END)
               + count(*) FILTER (late_class = 'allowed_late') AS firings, min(seq) AS first_seq
      FROM c WHERE late_class <> 'too_late' GROUP BY word, end_ms)"""


def _emit(key: str, horizon_ms: int, where: str) -> str:
    return f"""
r AS (SELECT seq, ts_ms, user_id, event_type,
  count(*) OVER (PARTITION BY {key} ORDER BY ts_ms RANGE BETWEEN {horizon_ms - 1} PRECEDING
                 AND CURRENT ROW)
  - (count(*) OVER (PARTITION BY {key}, ts_ms)
     - row_number() OVER (PARTITION BY {key}, ts_ms ORDER BY seq)) AS cnt,
  row_number() OVER (PARTITION BY {key} ORDER BY seq) AS rn FROM e),
m AS (SELECT * FROM r WHERE rn >= 2 AND {where})"""


_EMIT_ERRORS = f"""WITH {_EVENTS}, {_emit("event_type", 21600000, "event_type = 'error'")}
    SELECT seq, ts_ms, event_type, cnt FROM m"""

_ALARMS = f"""WITH {_EVENTS},
    o AS (SELECT *, CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS state FROM e),
    p AS (SELECT *, lag(state) OVER w AS ps, lag(ts_ms) OVER w AS pt FROM o
          WINDOW w AS (PARTITION BY user_id ORDER BY seq)),
    b AS (SELECT *, CASE WHEN state = 2 AND ps = 2 AND ts_ms < pt + 86400000 THEN 0 ELSE 1 END
          AS brk FROM p),
    i AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY seq ROWS UNBOUNDED PRECEDING)
          AS isl FROM b),
    k AS (SELECT *, row_number() OVER (PARTITION BY user_id, isl ORDER BY seq) AS rn FROM i)
    SELECT seq, user_id, ts_ms FROM k WHERE state = 2 AND rn % 2 = 0"""

_RUNNING_SUM = f"""WITH {_EVENTS}
    SELECT seq AS event_id, user_id, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY seq
      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM e"""

_GROUP_SUM = """SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT)
    AS total FROM orders GROUP BY o_custkey"""


def _changelog(amount: str, orders: str = "orders") -> str:
    return f"""WITH x AS (SELECT o_orderkey AS seq, {amount} AS amount FROM {orders}),
    r AS (SELECT seq, row_number() OVER (ORDER BY seq) AS n,
          sum(amount) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING) AS total FROM x),
    d AS (SELECT seq, n, total, lag(total) OVER (ORDER BY seq) AS old FROM r)
    SELECT seq, CAST(0 AS INTEGER) AS ord, '+I' AS op, CAST(total AS BIGINT) AS total
      FROM d WHERE n = 1
    UNION ALL SELECT seq, 0, '-U', CAST(old AS BIGINT) FROM d
      WHERE n > 1 AND old IS DISTINCT FROM total
    UNION ALL SELECT seq, 1, '+U', CAST(total AS BIGINT) FROM d
      WHERE n > 1 AND old IS DISTINCT FROM total"""


_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"

_LATE_STREAM = """
        j AS (SELECT event_id * 3 - 1000 AS seq, event_type AS word,
               epoch_us(ts) // 1000 - (event_id * 7919) % 97 * 300000 AS ts_ms FROM events),
        p AS (SELECT j.*, (seq - (SELECT min(seq) FROM j)) * 4
               // (SELECT max(seq) - min(seq) + 1 FROM j) AS slice FROM j),
        m AS (SELECT slice, max(ts_ms) AS latest FROM p GROUP BY slice),
        b AS (SELECT p.*, ts_ms // 21600000 * 21600000 + 21600000 AS end_ms,
               (SELECT max(latest) FROM m WHERE m.slice < p.slice) - 7200000 AS wm FROM p)"""

_TOP_AMOUNTS = f"""WITH {_TUMBLED},
    r AS (SELECT *, row_number() OVER (PARTITION BY event_type, start_ms ORDER BY cents DESC) AS place FROM t)
    SELECT event_type, start_ms, start_ms + 21600000 AS end_ms, count(*) AS n,
      CAST(sum(cents) FILTER (place <= 3) AS BIGINT) AS top_cents FROM r GROUP BY event_type, start_ms"""

ORACLES: dict[str, str] = {
    "word_count": f"WITH {_WORDS} SELECT word, count(*) AS cnt FROM w GROUP BY word",
    "csv_token_count": """
        WITH l AS (SELECT event_type || ',' || user_id || ',,x'
                     || CASE WHEN event_id % 5 = 0 THEN ',,' ELSE '' END AS line FROM events),
        w AS (SELECT unnest(string_split(rtrim(line, ','), ',')) AS word FROM l)
        SELECT word, count(*) AS cnt FROM w GROUP BY word""",
    "running_count": """
        SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY event_id
          ROWS UNBOUNDED PRECEDING) AS cnt FROM events""",
    "running_sum": _RUNNING_SUM,
    "tumbling_count": f"""WITH {_TUMBLED}
        SELECT event_type, start_ms, start_ms + 21600000 AS end_ms, count(*) AS cnt
        FROM t GROUP BY event_type, start_ms""",
    "tumbling_sum": f"""WITH {_TUMBLED}
        SELECT user_id, start_ms, start_ms + 21600000 AS end_ms,
          CAST(sum(cents) AS BIGINT) AS total FROM t GROUP BY user_id, start_ms""",
    "window_apply": f"""WITH {_TUMBLED}
        SELECT event_type, start_ms, start_ms + 21600000 AS end_ms, count(*) AS n,
          CAST(sum(cents) AS BIGINT) AS total, max(cents) AS most
        FROM t GROUP BY event_type, start_ms""",
    "window_first": f"""WITH {_TUMBLED}
        SELECT event_type, start_ms, start_ms + 21600000 AS end_ms, min(seq) AS event_id,
          arg_min(cents, seq) AS cents FROM t GROUP BY event_type, start_ms""",
    "window_relabel_double": f"""WITH {_TUMBLED}
        SELECT '合计' AS word, start_ms, 2 * count(*) AS cnt FROM t GROUP BY event_type, start_ms""",
    "sliding_count": f"""WITH {_EVENTS},
        t AS (SELECT event_type, ts_ms // 3600000 * 3600000 - k.range * 3600000 AS start_ms
              FROM e, range(6) k)
        SELECT event_type, start_ms, start_ms + 21600000 AS end_ms, count(*) AS cnt
        FROM t GROUP BY event_type, start_ms""",
    "late_classify": f"WITH {_late(7200000)} SELECT seq, word, ts_ms, end_ms, late_class FROM c",
    "late_side_output": f"""WITH {_late(7200000)}
        SELECT seq, word, CAST(1 AS BIGINT) AS cnt FROM c WHERE late_class = 'too_late'""",
    "late_firings": f"WITH {_late(7200000)} SELECT word, end_ms, firings, first_seq FROM f",
    "late_main_output": f"""WITH {_late(7200000)},
        g AS (SELECT word, end_ms, unnest(range(firings)) FROM f)
        SELECT word, end_ms, CAST(1 AS BIGINT) AS cnt FROM g""",
    "late_drop_count": f"""WITH {_late(0)}
        SELECT word, end_ms, count(*) AS cnt FROM c WHERE late_class <> 'too_late'
        GROUP BY word, end_ms""",
    "conditional_emit": _EMIT_ERRORS,
    "conditional_emit_by_user": f"""
        WITH {_EVENTS}, {_emit("user_id", 86400000, "event_type = 'error'")}
        SELECT seq, ts_ms, user_id, cnt FROM m""",
    "rolling_max": f"""WITH {_EVENTS}
        SELECT a.seq, a.ts_ms, a.user_id, max(b.cents) AS most, min(b.cents) AS least
        FROM e AS a JOIN e AS b ON a.user_id = b.user_id AND b.ts_ms > a.ts_ms - 86400000
          AND (b.ts_ms < a.ts_ms OR (b.ts_ms = a.ts_ms AND b.seq <= a.seq))
        GROUP BY a.seq, a.ts_ms, a.user_id""",
    "clean_orders": """
        SELECT CAST(o_orderkey AS INTEGER) AS id, o_orderpriority AS title,
          CAST(floor(o_totalprice) AS INTEGER) AS amount,
          CAST(o_orderkey % 2 + 1 AS INTEGER) AS state, 'user' || o_custkey AS user_id
        FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0""",
    "refund_alarm": _ALARMS,
    "sql_group_sum": _GROUP_SUM,
    "csv_sink_totals": _GROUP_SUM,
    "union_sum": f"SELECT CAST(sum({_CENTS}) AS BIGINT) AS total FROM orders",
    "sum_changelog": _changelog(
        f"CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN 0 ELSE {_CENTS} END"
    ),
    "json_rows": r"""
        SELECT CAST(regexp_extract(props, '"k": *(-?\d+)', 1) AS BIGINT) AS k, count(*) AS cnt
        FROM events GROUP BY 1""",
    "stream_word_count": f"WITH {_WORDS} SELECT word, count(*) AS cnt FROM w GROUP BY word",
    "stream_tumbling_count": f"""WITH {_TUMBLED}
        SELECT event_type, start_ms, start_ms + 21600000 AS end_ms, count(*) AS cnt
        FROM t GROUP BY event_type, start_ms""",
    "timed_line_counts": f"""WITH {_EVENTS}
        SELECT event_type AS word, ts_ms // 86400000 * 86400000 AS day_ms, count(*) AS cnt FROM e GROUP BY 1, 2""",
    "sql_insert_totals": _GROUP_SUM,
    "stream_sql_union_total": f"SELECT CAST(sum({_CENTS}) AS BIGINT) AS total FROM orders",
    "text_line_words": f"WITH {_WORDS} SELECT word, count(*) AS cnt FROM w GROUP BY word",
    "stream_running_count": """
        SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY event_id
          ROWS UNBOUNDED PRECEDING) AS cnt FROM events""",
    "stream_conditional_emit_by_user": f"""
        WITH {_EVENTS}, {_emit("user_id", 86400000, "event_type = 'error'")}
        SELECT seq, ts_ms, user_id, cnt FROM m""",
    "stream_running_sum": _RUNNING_SUM,
    "stream_conditional_emit": _EMIT_ERRORS,
    "stream_refund_alarm": _ALARMS,
    "stream_late_side_output": f"""WITH {_LATE_STREAM}
        SELECT word, end_ms, CAST(1 AS BIGINT) AS cnt FROM b WHERE end_ms + 7200000 <= wm""",
    # A window fires once when the watermark passes it, and for each record in its lateness.
    "stream_late_main_output": f"""WITH {_LATE_STREAM},
        f AS (SELECT word, end_ms,
               count(*) FILTER (end_ms <= wm AND end_ms + 7200000 > wm)
               + CASE WHEN bool_or(wm IS NULL OR end_ms > wm) AND end_ms <= (SELECT max(ts_ms) - 7200000 FROM j)
                 THEN 1 ELSE 0 END AS n FROM b GROUP BY word, end_ms),
        g AS (SELECT word, end_ms, unnest(range(n)) FROM f)
        SELECT word, end_ms, CAST(1 AS BIGINT) AS cnt FROM g""",
    "stream_sum_changelog": _changelog(_CENTS),
    "text_running_words": """
        WITH l AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS seq, event_type, user_id::VARCHAR AS user FROM events),
        w AS (SELECT seq, 0 AS pos, event_type AS word FROM l UNION ALL SELECT seq, 1, user FROM l)
        SELECT seq, pos::INTEGER AS pos, word, row_number() OVER (PARTITION BY word ORDER BY seq, pos) AS total FROM w""",
    # The rows of the first table, then those of the second.
    "csv_unified_changelog": _changelog(
        _CENTS, "(SELECT row_number() OVER (ORDER BY o_orderkey % 2, o_orderkey) - 1 AS o_orderkey, o_totalprice FROM orders)"
    ),
    # The rows of the bounded forms: the watermark moves with every record here too.
    "stream_late_records_side": f"""WITH {_late(7200000)}
        SELECT word, end_ms, CAST(1 AS BIGINT) AS cnt FROM c WHERE late_class = 'too_late'""",
    "stream_late_records_main": f"""WITH {_late(7200000)},
        g AS (SELECT word, end_ms, unnest(range(firings)) FROM f)
        SELECT word, end_ms, CAST(1 AS BIGINT) AS cnt FROM g""",
    "window_top_amounts": _TOP_AMOUNTS,
    "stream_window_apply": _TOP_AMOUNTS,
    "stream_sliding_count": f"""WITH {_EVENTS},
        t AS (SELECT event_type, ts_ms // 3600000 * 3600000 - k.range * 3600000 AS start_ms
              FROM e, range(6) k)
        SELECT event_type, start_ms, start_ms + 21600000 AS end_ms, count(*) AS cnt
        FROM t GROUP BY event_type, start_ms""",
    "stream_group_changelog": f"""
        WITH r AS (SELECT o_custkey, o_orderkey AS seq, row_number() OVER w AS n,
              CAST(sum({_CENTS}) OVER w AS BIGINT) AS total, {_CENTS} AS amount
            FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING))
        SELECT o_custkey, seq, CAST(0 AS INTEGER) AS ord, '+I' AS op, total FROM r WHERE n = 1
        UNION ALL SELECT o_custkey, seq, 0, '-U', total - amount FROM r WHERE n > 1 AND amount <> 0
        UNION ALL SELECT o_custkey, seq, 1, '+U', total FROM r WHERE n > 1 AND amount <> 0""",
    "stream_latest_totals": _GROUP_SUM,
    "stream_refund_waits": _ALARMS,
    # Whole 2**20ths add up exactly, as bigint and as doubles.
    "double_changelog": f"""SELECT seq, ord, op, total::DOUBLE / 1048576 AS total FROM ({_changelog(_CENTS)})""",
}
