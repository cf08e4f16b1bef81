"""Repair of the role order of conversations, by Four-Russians block tables.

A conversation should read as nothing, or as an optional system turn and then pairs of a user and
an assistant turn. The cheapest edits to get there are a shortest path over four states (nothing
yet, after the system turn, after a user, after an assistant). Seen from the end, the costs
to go from the four states differ by little, so less their minimum only a few dozen *cost vectors*
occur. Each turn is one of nine symbols, and for every block of three symbols and every cost
vector the vector before the block, the cost, and the state in which each state leaves it are worked
out once. A conversation is then walked from its end block by block, by lookup alone. To name the
edits each block is expanded backward once more from the vector at its right end, and the cheapest edit whose
letter comes first is taken: what a letter leads to is settled by the costs to go, so ties can not go wrong.

Turns are dealt into shards by range of conversation and turn, so a conversation of any length
is cut where a shard or a piece ends; tasks hold a piece (``PIECE`` turns) at a time, and a hash
of 16 bytes for each turn of the conversation in the shard. Pieces of a cut conversation are
reduced to what they do to every cost vector and state, one short row each; these are put
together, and each piece is then traced by itself. A turn that repeats one of an earlier shard
is found by a window over hashes of cut conversations only.

Defined results: turns are ordered by turn (missing first), role and text; a missing role or text is
one space, a role's initial its first character; repeated rows are turns; a missing conversation id is a
conversation like any other; a conversation without turns has no edits; an empty table gives an
empty table; other columns do not take part.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES
from tidemark.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
STOPS = ".!?"
# Faults of a turn.
FINE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
# States, and where a turn of each initial leads from them.
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
STATES = 4
NEXT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
# The only role that may be put in at a state, and the state after it.
WANTED = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))
# Symbols: a turn that must go, then the four kinds of initial, fine and truncated.
KINDS = "sua?"
SYMBOLS = 1 + 2 * len(KINDS)
BLOCK = 3
CODES = SYMBOLS**BLOCK
# Turns and characters of a piece of a conversation; it has less where a shard ends.
PIECE, PIECE_CHARS = 4_096, 4 << 20
BATCH_CHARS = 4 << 20

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
SAID = "array<struct<role: string, text: string>>"
TURNS = "array<struct<turn: bigint, role: string, text: string, fault: int>>"
DONE = f"conv_id bigint, shard int, piece int, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string, repaired {SAID}"
_SAID = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_TURNS = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("fault", pa.int32())]))


class Tables(NamedTuple):
    vectors: list  # cost vectors; number 0 is that at the end of a conversation
    step: np.ndarray  # vector before a turn, by the vector after it and its symbol
    step_cost: np.ndarray
    edits: list  # by vector after, symbol and state: (letters with roles put in, state after)
    block: np.ndarray  # as ``step``, for the symbols of a block
    block_cost: np.ndarray
    block_exit: np.ndarray  # state after a block, by vector after, block and state


def _to_go(after: tuple, symbol: int) -> tuple[list, list]:
    """Costs to go before a turn, and for each state its best edits of the turn."""
    choices = []
    for state in range(STATES):
        open_ = [(DELETE + after[state], "D", None, state)]
        if symbol:
            extra = TRUNCATED if symbol > len(KINDS) else 0
            to = NEXT.get(KINDS[(symbol - 1) % len(KINDS)], (None,) * STATES)[state]
            if to is not None:
                open_.append((KEEP + extra + after[to], "K", None, to))
            role, to = WANTED[state]
            open_.append((REROLE + extra + after[to], "R", role, to))
        choices.append(open_)
    cost = [min(c[0] for c in open_) for open_ in choices]
    for _ in range(STATES):
        cost = [min(cost[s], INSERT + cost[WANTED[s][1]]) for s in range(STATES)]
    edits = []
    for state in range(STATES):
        made, at = [], state
        while True:
            role, to = WANTED[at]
            best = [c for c in choices[at] if c[0] == cost[at]]
            if INSERT + cost[to] == cost[at]:
                best.append((cost[at], "I", role, None))
            _, letter, role, end = min(best, key=lambda c: c[1])
            made.append((letter, role))
            if letter != "I":
                break
            at = to
        edits.append((tuple(made), end))
    return cost, edits


def tail(state: int) -> tuple[list, int]:
    """Edits and cost after the last turn."""
    made = []
    while state not in (START, ASSISTANT):
        role, state = WANTED[state]
        made.append(("I", role))
    return made, INSERT * len(made)


@cache
def tables() -> Tables:
    end = tuple(tail(state)[1] for state in range(STATES))
    vectors, number = [end], {end: 0}
    step, cost, edits = [], [], []
    for vector in vectors:
        rows: tuple[list, list, list] = ([], [], [])
        for symbol in range(SYMBOLS):
            before, made = _to_go(vector, symbol)
            least = min(before)
            normal = tuple(c - least for c in before)
            if normal not in number:
                number[normal] = len(vectors)
                vectors.append(normal)
            for row, value in zip(rows, (number[normal], least, made), strict=True):
                row.append(value)
        step.append(rows[0])
        cost.append(rows[1])
        edits.append(rows[2])
    step_, cost_ = np.array(step), np.array(cost)
    leave = np.array([[[to for _, to in states] for states in symbols] for symbols in edits])
    n = len(vectors)
    at, total = np.arange(n)[:, None].repeat(CODES, 1), np.zeros((n, CODES), np.int64)
    exits = np.arange(STATES)[None, None, :].repeat(n, 0).repeat(CODES, 1)
    right = []
    for place in reversed(range(BLOCK)):
        symbol = np.arange(CODES)[None, :] // SYMBOLS ** (BLOCK - 1 - place) % SYMBOLS
        right.append((at, symbol))
        total = total + cost_[at, symbol]
        at = step_[at, symbol]
    for after, symbol in reversed(right):
        exits = leave[after[:, :, None], symbol[:, :, None], exits]
    return Tables(vectors, step_, cost_, edits, at, total, exits)


def codes(symbols: bytes) -> tuple[list[int], bytes]:
    """The full blocks of a conversation, from its front, and the symbols left over."""
    full = len(symbols) // BLOCK * BLOCK
    places = np.frombuffer(symbols[:full], np.uint8).astype(np.int64).reshape(-1, BLOCK)
    return (places @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist(), symbols[full:]


@cache
def _expand(code: int, right: int, state: int) -> tuple[tuple, int]:
    """Edits of a block whose turns are expanded backward from the vector at its right end."""
    t = tables()
    symbols = [code // SYMBOLS ** (BLOCK - 1 - place) % SYMBOLS for place in range(BLOCK)]
    after = [right]
    for symbol in symbols[:0:-1]:
        after.append(int(t.step[after[-1], symbol]))
    made: tuple = ()
    for symbol, vector in zip(symbols, reversed(after), strict=True):
        edits, state = t.edits[vector][symbol][state]
        made += edits
    return made, state


def trace(symbols: bytes, vector: int = 0, state: int = START, last: bool = True) -> tuple[list, int, int]:
    """Edits of a piece, their cost and the state after it; ``vector`` is that at its right end."""
    t = tables()
    blocks, rest = codes(symbols)
    start, rests = vector, []
    total = 0
    for symbol in reversed(rest):
        rests.append((vector, symbol))
        total += int(t.step_cost[vector, symbol])
        vector = int(t.step[vector, symbol])
    rights = []
    for code in reversed(blocks):
        rights.append(vector)
        total += int(t.block_cost[vector, code])
        vector = int(t.block[vector, code])
    cost = total + t.vectors[vector][state]
    made: list = []
    for code, right in zip(blocks, reversed(rights), strict=True):
        edits, state = _expand(code, right, state)
        made += edits
    for right, symbol in reversed(rests):
        edits, state = t.edits[right][symbol][state]
        made += edits
    if last:
        made += tail(state)[0]
    else:
        cost -= t.vectors[start][state]
    return made, cost, state


def transition(symbols: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a piece does to every cost vector: vector before it, cost, state after it by state."""
    t = tables()
    blocks, rest = codes(symbols)
    vector = np.arange(len(t.vectors))
    cost, exits = np.zeros(len(vector), np.int64), np.arange(STATES)[None, :].repeat(len(vector), 0)
    leave = np.array([[[to for _, to in states] for states in by_symbol] for by_symbol in t.edits])
    passed = []
    for symbol in reversed(rest):
        passed.append(leave[vector, symbol])
        cost, vector = cost + t.step_cost[vector, symbol], t.step[vector, symbol]
    for code in reversed(blocks):
        passed.append(t.block_exit[vector, code])
        cost, vector = cost + t.block_cost[vector, code], t.block[vector, code]
    for move in reversed(passed):
        exits = np.take_along_axis(move, exits, 1)
    return vector, cost, exits


def fault_of(role: str, text: str, seen: set) -> int:
    said = text.strip(SPACES)
    key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
    repeated = key in seen
    seen.add(key)
    if not said:
        return BLANK
    if repeated:
        return DUPLICATE
    return FINE if said[-1] in STOPS else CUT


def symbol_of(role: str, fault: int) -> int:
    if fault in (BLANK, DUPLICATE):
        return 0
    kind = KINDS.find(role[:1]) if role[:1] in "sua" and role else len(KINDS) - 1
    return 1 + kind + (len(KINDS) if fault == CUT else 0)


def apply(turns: list, edits: list) -> tuple[str, list]:
    """The letters of the edits and the repaired turns."""
    repaired, at = [], 0
    for letter, role in edits:
        if letter == "I":
            repaired.append({"role": role, "text": ""})
            continue
        turn = turns[at]
        at += 1
        if letter != "D":
            repaired.append({"role": role or turn["role"], "text": turn["text"]})
    return "".join(letter for letter, _ in edits), repaired


class Measures(NamedTuple):
    """What is counted in a piece; pieces that follow each other add up."""

    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: str | None
    last: str | None
    low: int | None
    high: int | None
    turns: int

    @classmethod
    def of(cls, turns: list) -> Measures:
        faults = [t["fault"] for t in turns]
        initials = [t["role"][:1] for t in turns]
        numbers = {t["turn"] for t in turns} - {None}
        return cls(
            faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            initials[0] if turns else None, initials[-1] if turns else None,
            min(numbers, default=None), max(numbers, default=None), len(numbers),
        )

    def then(self, other: Measures) -> Measures:
        met = self.last is not None and other.first is not None and self.last + other.first not in ("su", "ua", "au")
        shared = self.high is not None and self.high == other.low
        return Measures(
            self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated,
            self.illegal + other.illegal + met,
            other.first if self.first is None else self.first, self.last if other.last is None else other.last,
            other.low if self.low is None else self.low, self.high if other.high is None else other.high,
            self.turns + other.turns - shared,
        )

    def counts(self, cost: int) -> dict[str, int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return dict(zip(COUNTS, (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost), strict=True))


def _rows(made: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(made, schema=schema)


_KEYS = [("conv_id", pa.int64()), ("shard", pa.int32()), ("piece", pa.int32())]
_DONE = pa.schema([*_KEYS, *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired", _SAID)])
_SCANNED = pa.schema([*_DONE, ("cut", pa.bool_()), ("turns", _TURNS)])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repair the conversations that lie inside a sorted shard; the others are cut in pieces.

    The first and the last conversation of a shard may go on in its neighbours.
    """
    shard, piece = TaskContext.get().partitionId(), 0
    made: list[dict] = []
    turns: list[dict] = []
    chars = held = 0
    conv, begun, cut, seen = None, False, True, set()

    def close(cut: bool) -> dict:
        row: dict = {"conv_id": conv, "shard": shard, "piece": piece, "cut": cut}
        if cut:
            return {**row, "turns": turns}
        edits, cost, _ = trace(bytes([symbol_of(t["role"], t["fault"]) for t in turns]))
        audit, repaired = apply(turns, edits)
        return {**row, **Measures.of(turns).counts(cost), "audit": audit, "repaired": repaired}

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies")]
        for conv_id, turn, role, text, copies in zip(*columns, strict=True):
            if not begun or conv_id != conv:
                if begun:
                    made.append(close(cut))
                    cut = False
                    piece += 1
                conv, begun, turns, chars, seen = conv_id, True, [], 0, set()
            for _ in range(copies):
                if len(turns) >= PIECE or chars >= PIECE_CHARS:
                    made.append(close(True))
                    piece, turns, chars, cut = piece + 1, [], 0, True
                turns.append({"turn": turn, "role": role, "text": text, "fault": fault_of(role, text, seen)})
                chars += len(text)
                held += len(text) + 100
            if held >= BATCH_CHARS and made:
                yield _rows(made, _SCANNED)
                made, held = [], 0
    if begun:
        made.append(close(True))
    if made:
        yield _rows(made, _SCANNED)


_PARTS = Measures._fields
_PIECE = pa.schema([
    *_KEYS, ("symbols", pa.binary()), ("vector", pa.list_(pa.int32())), ("spent", pa.list_(pa.int64())), ("leaves", pa.list_(pa.int32())),
    *[(p, pa.string() if p in ("first", "last") else pa.int64()) for p in _PARTS],
])
_PIECE_DDL = "conv_id bigint, shard int, piece int, symbols binary, vector array<int>, spent array<bigint>, leaves array<int>, " + ", ".join(
    f"{p} {'string' if p in ('first', 'last') else 'bigint'}" for p in _PARTS
)
_PLAN = pa.schema([*_KEYS, ("after", pa.int32()), ("state", pa.int32()), ("ends", pa.bool_()), *[(c, pa.int64()) for c in COUNTS]])
_PLAN_DDL = "conv_id bigint, shard int, piece int, after int, state int, ends boolean, " + ", ".join(f"{c} bigint" for c in COUNTS)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of cut conversations, without their texts: symbols, counts and what they do."""
    for batch in batches:
        made = []
        for row in batch.to_pylist():
            for at in row["repeats"] or ():
                row["turns"][at]["fault"] = DUPLICATE
            turns = row["turns"]
            symbols = bytes([symbol_of(t["role"], t["fault"]) for t in turns])
            vector, cost, exits = transition(symbols)
            made.append({
                **{k: row[k] for k in ("conv_id", "shard", "piece")}, "symbols": symbols, "vector": vector, "spent": cost,
                "leaves": exits.ravel(), **Measures.of(turns)._asdict(),
            })
        yield _rows(made, _PIECE)


def _stitch(table: pa.Table) -> pa.Table:
    """Of all pieces of a conversation the vector after each and the state before it; the counts on the first."""
    pieces = table.sort_by([("shard", "ascending"), ("piece", "ascending")]).to_pylist()
    vector = total = 0
    for row in reversed(pieces):
        row["after"] = vector
        total += row["spent"][vector]
        vector = row["vector"][vector]
    total += tables().vectors[vector][START]
    state, measures = START, None
    for row in pieces:
        row["state"], row["ends"] = state, row is pieces[-1]
        state = row["leaves"][row["after"] * STATES + state]
        own = Measures(*[row[p] for p in _PARTS])
        measures = own if measures is None else measures.then(own)
    pieces[0].update(measures.counts(total))
    return pa.Table.from_pylist([{k: row.get(k) for k in _PLAN.names} for row in pieces], schema=_PLAN)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for row in batch.to_pylist():
            edits, _, _ = trace(row["symbols"], row["after"], row["state"], row["ends"])
            audit, repaired = apply(row["turns"], edits)
            made.append({**{k: row[k] for k in (*COUNTS, "conv_id", "shard", "piece")}, "audit": audit, "repaired": repaired})
        yield _rows(made, _DONE)


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: turns damaged by a hash of their place.

    One in twenty each is dropped (no copies), emptied, bereft of its full stops, repeated, or made a user's.
    """
    def known(c: str) -> object:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        known("role").alias("role"), known("text").alias("text"), kind.alias("kind"),
    )
    text = F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )


def repair(turns: DataFrame) -> DataFrame:
    """Repaired conversations: ``conv_id, shard, piece, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired, cut``.

    A conversation is one row, or several pieces in order of ``shard, piece`` where ``cut``; then the
    first has the counts. ``turns`` has ``conv_id, turn, role, text, copies``, all but the first two set; a
    row of no copies only names its conversation.
    """
    spark = turns.sparkSession
    folder = f"{shared_dir(spark)}/repair-{uuid.uuid4().hex}"
    order = ["conv_id", "turn", "role", "text"]
    shards = turns.select(*order, "copies").repartitionByRange(*order).sortWithinPartitions(*order)
    shards.mapInArrow(_scan, f"{DONE}, cut boolean, turns {TURNS}").write.parquet(f"{folder}/shards")
    scanned = spark.read.parquet(f"{folder}/shards")
    pieces = scanned.filter("cut").select("conv_id", "shard", "piece", "turns")
    # Each shard has marked its own repeats, so a turn comes here once for every shard it is in.
    place = ["shard", "piece", "at"]
    said = F.sha2(F.concat(F.length("t.role").cast("string"), F.lit(":"), F.col("t.role"), F.col("t.text")), 256)
    firsts = pieces.select("conv_id", "shard", "piece", F.posexplode("turns").alias("at", "t")).filter(F.col("t.fault").isin(FINE, CUT))
    again = firsts.select("conv_id", *place, said.alias("said")).withColumn(
        "time", F.row_number().over(Window.partitionBy("conv_id", "said").orderBy(*place))
    )
    repeats = again.filter("time > 1").groupBy("shard", "piece").agg(F.collect_list("at").alias("repeats"))
    pieces.join(repeats, ["shard", "piece"], "left").select("conv_id", "shard", "piece", "turns", "repeats").mapInArrow(
        _measure, _PIECE_DDL
    ).write.parquet(f"{folder}/pieces")
    measured = spark.read.parquet(f"{folder}/pieces")
    plan = measured.drop("symbols").groupBy("conv_id").applyInArrow(_stitch, _PLAN_DDL)
    traced = (
        pieces.join(measured.select("shard", "piece", "symbols"), ["shard", "piece"]).join(plan.drop("conv_id"), ["shard", "piece"])
        .select("conv_id", "shard", "piece", "turns", "symbols", "after", "state", "ends", *COUNTS)
        .mapInArrow(_finish, DONE)
    )
    whole = scanned.filter("NOT cut").drop("turns", "cut")
    return whole.withColumn("cut", F.lit(False)).unionByName(traced.withColumn("cut", F.lit(True)))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of cut conversations, whose pieces pass by in order; none is kept."""
    row, audit, digest, begun = None, [], hashlib.sha256(), False

    def close() -> dict:
        return {**row, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    for batch in batches:
        made = []
        for piece in batch.to_pylist():
            if row is None or piece["conv_id"] != row["conv_id"]:
                if row is not None:
                    made.append(close())
                row = {c: piece[c] for c in ("conv_id", *COUNTS)}
                audit, digest, begun = [], hashlib.sha256(), False
            audit.append(piece["audit"])
            for turn in piece["repaired"]:
                digest.update(f"{chr(10) if begun else ''}{turn['role']}:{turn['text']}".encode())
                begun = True
        if made:
            yield _rows(made, schema)
    if row is not None:
        yield _rows([close()], schema)


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation: the counts, its edits and the digest of its repaired turns."""
    said = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    whole = repaired.filter("NOT cut").select(
        "conv_id", *COUNTS, "audit", F.sha2(F.array_join(said, "\n"), 256).alias("repaired_sha256")
    )
    pieces = repaired.filter("cut").repartition("conv_id").sortWithinPartitions("conv_id", "shard", "piece")
    schema = f"conv_id bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string, repaired_sha256 string"
    return whole.unionByName(pieces.select("conv_id", *COUNTS, "audit", "repaired").mapInArrow(_digest, schema))
