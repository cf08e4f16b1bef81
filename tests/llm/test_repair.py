"""Structure repair against a search over all edits, whole and cut into pieces."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import repair

# The search over all edits is a recursion along the conversation.
sys.setrecursionlimit(20_000)

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def best(turns):
    """Least cost and then least letters, by trying every edit; turns are (must go, initial, truncated)."""
    known = {}

    def after(at, state, put_in):
        if (at, state, put_in) in known:
            return known[at, state, put_in]
        wanted = "a" if state == "u" else "u"
        found = [(0, "", ())] if at == len(turns) and state in ("", "a") else []

        def take(cost, letter, role, at, state, put_in=0):
            rest = after(at, state, put_in)
            found.append((cost + rest[0], letter + rest[1], ((letter, role), *rest[2])))

        if put_in < 3:
            take(5, "I", wanted, at, wanted, put_in + 1)
        if at < len(turns):
            must_go, initial, truncated = turns[at]
            take(2, "D", None, at + 1, state)
            if not must_go:
                if initial in {"": "su", "s": "u", "u": "a", "a": "u"}[state] and initial:
                    take(5 * truncated, "K", None, at + 1, initial)
                take(5 * truncated + 1, "R", wanted, at + 1, wanted)
        known[at, state, put_in] = min(found, default=(10**9, "", ()))
        return known[at, state, put_in]

    return after(0, "", 0)


def model(rows):
    talks = {}
    for conv, turn, role, text in rows:
        talk = talks.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        talk += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    made = Counter()
    for conv, talk in talks.items():
        talk.sort()
        seen, faults = set(), []
        for _, _, role, text in talk:
            said = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not said else "d" if (role, text) in seen else "" if said[-1] in ".!?" else "t")
            seen.add((role, text))
        numbers = {t[1] for t in talk if t[0]}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(talk, talk[1:]))
        cost, audit, edits = best([(f in ("b", "d"), t[2][:1], f == "t") for f, t in zip(faults, talk)])
        said, left = [], iter(talk)
        for letter, role in edits:
            role = {"u": "user", "a": "assistant", None: None}[role]
            if letter == "I":
                said.append(f"{role}:")
                continue
            _, _, own, text = next(left)
            if letter != "D":
                said.append(f"{role or own}:{text}")
        counts = [faults.count(f) for f in "bdt"]
        made[conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()] += 1
    return made


def test_traces_are_the_best():
    rng = random.Random(1)
    for _ in range(1500):
        symbols = bytes(rng.randrange(repair.SYMBOLS) for _ in range(rng.randint(0, 9)))
        turns = [(s == 0, repair.KINDS[(s - 1) % 4] if s else "u", s > 4) for s in symbols]
        edits, cost, _ = repair.trace(symbols)
        assert (cost, "".join(letter for letter, _ in edits)) == best(turns)[:2]


def test_pieces_of_a_trace_fit():
    rng = random.Random(2)
    for _ in range(300):
        symbols = bytes(rng.randrange(repair.SYMBOLS) for _ in range(40))
        cut = rng.randint(0, 40)
        vector, spent, leaves = repair.transition(symbols[cut:])
        head, cost, state = repair.trace(symbols[:cut], int(vector[0]), last=False)
        tail, rest, end = repair.trace(symbols[cut:], 0, state)
        whole, total, _ = repair.trace(symbols)
        assert head + tail == whole and cost + rest == total
        assert leaves[0][state] == end


def test_few_cost_vectors():
    assert len(repair.tables().vectors) < 50


def talks():
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "unknown", "tool"]
    starts, ends = ["a b.", "c d e!", "", "?  ", "hm", "no way.", "\xa0"], ["", " x.", " y?", "\n"]
    rows = [
        (conv, rng.choice([None, turn, turn, turn, turn + 1]), rng.choice(roles), rng.choice(starts) + rng.choice(ends))
        for conv in [*range(-15, 60), None]
        for turn in range(rng.choice([0, 1, 1, 2, 3, 5, 8, 12]))
    ]
    # One conversation as long as all others together, in which turns come again far apart.
    rows += [(1000, t, rng.choice(["user", "assistant"]), f"w{rng.randrange(300)}{rng.choice(['.', ''])}") for t in range(400)]
    return [*rows, *rows[:10], (7, 3, "user", None), (8, 1, None, None), (2000, 1, "user", "word " * 100_000 + ".")]


@pytest.fixture
def shards(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def set_number(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    yield set_number
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize(("number", "piece"), [(1, 4096), (12, 4096), (3, 16)])
def test_repair(spark, shards, monkeypatch, number, piece):
    shards(number)
    monkeypatch.setattr(repair, "PIECE", piece)
    rows = talks()
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({"copies": F.lit(5), "shard": F.lit("x"), "cut": F.lit(None)})
    made = repair.repair(repair.damaged(turns))
    assert Counter(tuple(r) for r in repair.digests(made).collect()) == model(rows)
    if number > 1:
        assert made.filter("cut AND conv_id = 1000").count() > 1


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "a.", 1), (1, 1, "user", "b.", 1), (1, 1, "user", "b.", 1), (1, 2, "assistant", "c.", 1), (2, 0, "", "", 0)]
    made = {r.conv_id: r for r in repair.repair(spark.createDataFrame(rows, f"{SCHEMA}, copies int")).collect()}
    assert made[1].audit == "DKDK" and made[1].cost == 4 and made[1].duplicate == 1
    assert [tuple(t) for t in made[1].repaired] == [("user", "b."), ("assistant", "c.")]
    assert made[2].audit == "" and made[2].repaired == []


def test_empty(spark):
    made = repair.digests(repair.repair(repair.damaged(spark.createDataFrame([], SCHEMA))))
    assert made.count() == 0
    assert made.columns == ["conv_id", *repair.COUNTS, "audit", "repaired_sha256"]
