"""The prefix trie against a dictionary of all beginnings."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def model(rows):
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            talks.setdefault(conv, []).append((turn is not None, turn or 0, role, key, text))
    talks = {conv: [(t[2], t[4]) for t in sorted(talk)] for conv, talk in talks.items()}
    rebuilt = {}
    for conv, talk in talks.items():
        taken = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = tuple(talks.get(conv - int(math.fmod(conv, 20)), [])[:taken] + talk[taken:])
    members = {}
    for conv, path in rebuilt.items():
        for depth in range(len(path) + 1):
            members.setdefault(path[:depth], []).append(conv)
    children = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        own = (len(convs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for depth in range(len(path) + 1):
            saved[path[:depth]] += own
            leaves[path[:depth]] += not children[path]
    return Counter(
        (min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path], leaves[path], saved[path],
         hashlib.sha256(",".join(str(c) for c in sorted(convs) if rebuilt[c] == path).encode()).hexdigest())
        for path, convs in members.items()
    )


def talks():
    rng = random.Random(5)
    rows = [
        (conv, rng.choice([None, turn, turn, turn]), rng.choice(["user", "assistant", None]), rng.choice(["a b", "c d e", None, "", " x "]))
        for conv in [*range(-25, 80), None]
        for turn in range(rng.choice([0, 1, 1, 2, 3, 5, 8]))
    ]
    # Many equal conversations, a long one, and a long text.
    rows += [(conv, turn, "user", f"same {turn}") for conv in range(2_000, 2_060) for turn in range(6)]
    rows += [(1_000, turn, "u", "w w") for turn in range(300)]
    return [*rows, *rows[:10], (5_000, 0, "user", "word " * 100_000)]


@pytest.mark.parametrize("number", [1, 4, 30])
def test_nodes(spark, number):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", number)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = talks()
        turns = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit(1), "path": F.lit("x"), "family": F.lit(None)})
        made = trie.prefix_nodes(trie.rebuilt(turns)).collect()
        assert Counter(tuple(r) for r in made) == model(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_joined_names(spark, monkeypatch):
    monkeypatch.setattr(trie, "SMALL", 0)
    rows = talks()[:200]
    made = trie.prefix_nodes(trie.rebuilt(spark.createDataFrame(rows, SCHEMA))).collect()
    assert Counter(tuple(r) for r in made) == model(rows)


def test_empty(spark):
    assert trie.prefix_nodes(trie.rebuilt(spark.createDataFrame([], SCHEMA))).count() == 0
    assert trie.prefix_nodes(trie.rebuilt(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA))).count() == 0


def test_turnless(spark):
    # Conversation 2 takes over its one turn from a base that is not there.
    rows = [(conv, 0, "user", "a b") for conv in range(1, 20)]
    made = trie.prefix_nodes(trie.rebuilt(spark.createDataFrame(rows, SCHEMA))).collect()
    assert Counter(tuple(r) for r in made) == model(rows)


def test_medians_balance_the_tree():
    assert sorted(trie.medians(1_000)) == list(range(1_000))
    tree = trie.Tree()
    for value in trie.medians(1_000):
        tree.insert([value])
    depth = {0: 0}
    for node in range(1, len(tree.value)):
        for link in (tree.less[node], tree.more[node]):
            if link:
                depth[link] = depth.get(node, 0) + 1
    assert max(depth.values()) <= 10
