"""Components, near-duplicates, fuzzy lines and decontamination against brute force."""

import math
import random
import re
import string
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
import regex
from pyspark.sql import functions as F

from tidemark.llm import decontam, groups, icws, lines
from tidemark.llm.groups import components, group, shared_buckets


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)] + [(7, 7)]
    union = Union()
    for a, b in links:
        union.join(a, b)
    made = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert made == {x: union.find(x) for x in linked}


def test_group_is_exact_without_all_pairs(spark):
    """A large bucket of one chain: stars alone find few links, the rest is settled exactly."""
    rows = [(0, i) for i in range(60)] + [(1, i) for i in range(50, 64)] + [(2, 100)]
    members = shared_buckets(spark.createDataFrame(rows, "bucket bigint, node bigint")).checkpoint()
    tested = []

    def verify(pairs):
        tested.append(pairs.count())
        return pairs.filter("abs(a - b) <= 2 and a % 20 <> 19")

    made = dict(map(tuple, group(members, verify).collect()))
    union = Union()
    together = defaultdict(set)
    for bucket, node in rows:
        together[bucket].add(node)
    for nodes in together.values():
        for a in nodes:
            for b in nodes:
                if a < b and b - a <= 2 and a % 20 != 19:
                    union.join(a, b)
    assert {n: made.get(n, n) for _, n in rows} == {n: union.find(n) for _, n in rows}


def test_groups_of_copies_need_few_pairs(spark):
    members = spark.createDataFrame([(b, n) for b in range(3) for n in range(400)], "bucket bigint, node bigint").checkpoint()
    tested = []

    def verify(pairs):
        tested.append(pairs.count())
        return pairs

    assert group(members, verify).select("root").distinct().count() == 1
    assert sum(tested) < 2 * 400


def test_few_unlike_pairs_are_settled_at_once(spark):
    """Small buckets of unlike nodes need no further turns: each turn is many jobs of the driver's."""
    rows = [(b, 3 * b + n) for b in range(50) for n in range(3)]
    members = spark.createDataFrame(rows, "bucket bigint, node bigint").checkpoint()
    tested = []

    def verify(pairs):
        tested.append(pairs.count())
        return pairs.filter("a % 3 = 1 and b % 3 = 2 and a % 2 = 0")

    spark.sparkContext.setJobGroup("few", "few")
    made = dict(map(tuple, group(members, verify).collect()))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert made == {x: 3 * b + 1 for b in range(1, 50, 2) for x in (3 * b + 1, 3 * b + 2)}
    assert tested == [100, 50]
    assert jobs < 60


@pytest.mark.parametrize("size", [150])
def test_later_turns_work_on_roots_only(spark, monkeypatch, size):
    """A link in ten pairs: what the components are made from grows with the items, not with all links found."""
    given = []
    made_of = groups.components
    monkeypatch.setattr(groups, "components", lambda links: (given.append(links.count()), made_of(links))[1])
    members = spark.createDataFrame([(0, n) for n in range(size)], "bucket bigint, node bigint").checkpoint()
    made = dict(map(tuple, group(members, lambda pairs: pairs.filter("(a * 31 + b * 17) % 10 = 0")).collect()))
    union = Union()
    for b in range(size):
        for a in range(b):
            if (a * 31 + b * 17) % 10 == 0:
                union.join(a, b)
    assert {n: made.get(n, n) for n in range(size)} == {n: union.find(n) for n in range(size)}
    assert sum(given) < 8 * size


@pytest.mark.parametrize("size", [150])
def test_unlike_lines_and_chains_need_few_pairs(spark, size):
    """One bucket of unlike lines, or of a chain in which only neighbours are alike: links are those of brute
    force, and pairs grow with the lines."""
    rng = random.Random(size)
    unlike = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randrange(9, 80))) for _ in range(size)]
    chain = ["".join(rng.choice("abcdefghij") for _ in range(60))]
    while len(chain) < size:
        last = chain[-1]
        at = len(chain) * 5 % 60
        chain.append(last[:at] + "".join(rng.choice("klmnopqrst") for _ in range(5)) + last[at + 5 :])
    for known in (unlike, chain):
        lines_frame = pd.DataFrame({"node": range(size), "norm": known})  # noqa: F841 (read by the SQL below)
        texts = spark.createDataFrame(list(enumerate(known)), "node bigint, norm string").checkpoint()
        members = texts.select(F.lit(0).cast("bigint").alias("bucket"), "node").checkpoint()
        tested = []

        def verify(pairs, texts=texts, tested=tested):
            tested.append(pairs.count())
            both = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b")
            return both.filter("levenshtein(x, y) <= floor(greatest(length(x), length(y)) / 10)").select("a", "b")

        keys = lambda rows, texts=texts: lines.rare_grams(rows.join(texts, "node"))
        made = dict(map(tuple, group(members, verify, keys=keys).collect()))
        union = Union()
        pairs = duckdb.sql(
            "select a.node, b.node from lines_frame a join lines_frame b on a.node < b.node "
            "where levenshtein(a.norm, b.norm) <= greatest(length(a.norm), length(b.norm)) // 10"
        )
        for x, y in pairs.fetchall():
            union.join(x, y)
        assert {n: made.get(n, n) for n in range(size)} == {n: union.find(n) for n in range(size)}
        assert sum(tested) < 50 * size


def test_lines_within_the_limit_share_a_rare_gram(spark):
    rng = random.Random(8)
    known = []
    for size in [9, 10, 11, 12, 13, 20, 31, 60, 99] * 6:
        line = "".join(rng.choice("ab ") for _ in range(size))
        edits = list(line)
        for _ in range(len(line) // 10):
            at = rng.randrange(len(edits))
            edits[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "zz"[:1]])
        known += [line, "".join(edits)]
    rows = spark.createDataFrame([(0, n, t) for n, t in enumerate(known)], "bucket bigint, node bigint, norm string")
    held = defaultdict(set)
    for r in lines.rare_grams(rows).collect():
        held[r.node].add(r.key)
    for b in range(len(known)):
        for a in range(b):
            x, y = known[a], known[b]
            if x != y and min(len(x), len(y)) >= 9 and distance(x, y) <= max(len(x), len(y)) // 10:
                assert held[a] & held[b], (x, y)


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", text.lower())


def shingle_weights(texts):
    counts = []
    for text in texts:
        w = words(text)
        counts.append(Counter(zip(*[w[i:] for i in range(5)], strict=False)) if len(w) >= 5 else Counter([tuple(w)] if w else []))
    holders = Counter(s for c in counts for s in c)
    return [{s: n * (1 + math.log(min(len(texts) / holders[s], 10))) for s, n in c.items()} for c in counts]


def near_texts():
    rng = random.Random(4)

    def prose(n):
        return [f"w{rng.randrange(3000)}" for _ in range(n)]

    texts = [" ".join(prose(rng.randrange(30, 120))) for _ in range(60)]
    base = prose(200)
    for edits in (0, 1, 2, 3, 8, 20):
        for _ in range(8):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(200)] = f"x{rng.randrange(3000)}"
            texts.append(" ".join(copy))
    return texts + ["a b c", "A, b c!", "", None, "?!", "a b c d"]


def test_near_duplicates(spark):
    texts = near_texts()
    docs = spark.createDataFrame([(i, t, 3, "r") for i, t in enumerate(texts)], "doc_id bigint, text string, class_id int, root string")
    made = {r.doc_id: r.class_id for r in icws.near_duplicates(docs).collect()}
    weights = shingle_weights([t or "" for t in texts])
    union = Union()
    for i, a in enumerate(weights):
        for j in range(i):
            b = weights[j]
            common = sum(min(v, b[s]) for s, v in a.items() if s in b)
            if (not a and not b) or (common and common >= 0.8 * (sum(a.values()) + sum(b.values()) - common) - 1e-9):
                union.join(i, j)
    assert made == {i: union.find(i) for i in range(len(texts))}
    kept = icws.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({union.find(i) for i in range(len(texts))})


def test_texts_that_share_too_little_are_not_grouped(spark, monkeypatch):
    """Copies with more edits of their own than the limit allows have no link: they are no members of buckets."""
    given = []
    made_of = icws.group
    monkeypatch.setattr(icws, "group", lambda members, *args, **more: (given.append(members.select("node").distinct().count()), made_of(members, *args, **more))[1])
    rng = random.Random(6)
    base = [f"w{k}" for k in range(300)]
    texts = [" ".join(base), " ".join(base[:299] + ["end"])]
    for _ in range(30):
        copy = list(base)
        for at in rng.sample(range(0, 300, 5), 16):
            copy[at] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    made = Counter(r.class_id for r in icws.near_duplicates(docs).collect())
    assert made[0] == 2 and len(made) == 31
    assert given == [2]


def test_copies_in_a_large_group_are_found(spark):
    """The same four edits of 200 words leave a copy in a group of 60 as in a group of two, though there the frequencies
    of what the copies share are higher."""
    rng = random.Random(16)

    def copy(base):
        out = list(base)
        for at in range(rng.randrange(10, 40), 200, 45)[:4]:
            out[at] = f"x{rng.randrange(10**9)}"
        return out

    large, small = ([f"{kind}{rng.randrange(10**9)}" for _ in range(200)] for kind in "ls")
    texts = [" ".join(t) for t in [large, *(copy(large) for _ in range(60)), small, copy(small)]]
    texts += [" ".join(f"u{rng.randrange(10**9)}" for _ in range(40)) for _ in range(240)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    made = {r.doc_id: r.class_id for r in icws.near_duplicates(docs).collect()}
    assert made == {i: 0 if i <= 60 else 61 if i == 62 else i for i in range(len(texts))}
    # By weights alone, no copy in the large group is similar to another or to what it is a copy of.
    counts = [Counter(zip(*[t.split()[k:] for k in range(5)], strict=False)) for t in texts]
    held = Counter(s for c in counts for s in c)
    weights = [{s: n * (1 + math.log10((len(texts) + 1) / (held[s] + 1))) for s, n in c.items()} for c in counts[:61]]
    for i, a in enumerate(weights):
        for b in weights[:i]:
            common = sum(min(v, b[s]) for s, v in a.items() if s in b)
            assert common < 0.8 * (sum(a.values()) + sum(b.values()) - common)


def test_bounds_by_class_lose_no_link(spark, monkeypatch):
    """A group of copies without their original: all similar pairs stay, and few others are compared."""
    bounds = []
    monkeypatch.setattr(icws, "group", lambda members, verify, bound: (bounds.append(members.select("node", "info").distinct()), group(members, verify, bound=bound))[1])
    rng = random.Random(18)
    base = [f"b{rng.randrange(10**9)}" for _ in range(150)]
    texts = []
    for _ in range(60):
        copy = list(base)
        for at in rng.sample(range(150), rng.randrange(1, 5)):
            copy[at] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(copy * rng.randrange(1, 3)))
    nodes = dict(zip(icws._nodes(texts).astype(np.int64).tolist(), texts, strict=True))
    icws.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    x, y = (bounds[0].toDF(name, f"{name}_info") for name in "ab")
    can = {tuple(r) for r in x.join(y, F.col("a") < F.col("b")).filter(icws._can_be_similar(F.col("a_info"), F.col("b_info"))).select("a", "b").collect()}
    held = {n: set(zip(*[t.split()[k:] for k in range(5)], strict=False)) for n, t in nodes.items()}
    similar = {(a, b) for a in nodes for b in nodes if a < b and len(held[a] & held[b]) >= 0.8 * len(held[a] | held[b])}
    assert similar and similar <= can and len(can) < 0.75 * len(nodes) * (len(nodes) - 1) / 2


def test_a_repeated_common_line_makes_no_copies(spark):
    """Unlike texts that end in the same line, many times."""
    rng = random.Random(19)
    texts = [" ".join([*[f"u{rng.randrange(10**9)}" for _ in range(60)], *["is so"] * 400]) for _ in range(8)]
    texts += [" ".join(f"u{rng.randrange(10**9)}" for _ in range(60)) for _ in range(8)]
    words_of = {i: icws.shingles([t]) for i, t in enumerate(texts)}
    assert max(len(np.intersect1d(words_of[0][0], words_of[i][0])) for i in range(1, 8)) == 2
    bands = icws.plain_bands(*[np.concatenate(x) for x in ([words_of[0][0], words_of[1][0]], [[0], [len(words_of[0][0])]])])
    assert not (bands[0] == bands[1]).any()
    docs = spark.createDataFrame(list(enumerate(texts[8:] + [t + " " + " ".join(["is so"] * 20) for t in texts[8:]])), "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in icws.near_duplicates(docs).collect()} == {i: i % 8 for i in range(16)}


def test_buckets_of_sets_meet_the_jaccard_similarity():
    rng = random.Random(17)
    same = expected = 0
    for size, repeats, edits in [(300, 1, 6), (60, 9, 25), (4, 1, 1), (2, 30, 3)] * 25:
        a = [f"w{rng.randrange(10**6)}" for _ in range(size)] * repeats
        b = list(a)
        for _ in range(edits):
            b[rng.randrange(len(b))] = f"x{rng.randrange(10**6)}"
        x, y = (set(zip(*[t[k:] for k in range(5)], strict=False)) if len(t) >= 5 else {tuple(t)} for t in (a, b))
        ids, _, starts, _ = icws.shingles([" ".join(a), " ".join(b), "other words"])
        bands = icws.plain_bands(ids, starts)
        assert bands.shape == (3, icws.BANDS) and not (bands[:2] == bands[2]).any()
        same += (bands[0] == bands[1]).sum()
        expected += icws.BANDS * (len(x & y) / len(x | y)) ** icws.ROWS
    assert abs(same - expected) < 4 * math.sqrt(expected)


def test_near_duplicates_defined_results(spark):
    schema = "doc_id bigint, text string"
    assert icws.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "other words are here today")]
    made = icws.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.class_id is None, r.class_size) for r in made) == [(False, 4)] * 4 + [(True, 1)]
    kept = icws.keep_one(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, kept), key=str) == [(4, "a b c d e f"), (None, "other words are here today")]


def test_sampling_meets_the_weighted_jaccard_similarity():
    rng = random.Random(1)
    sampler = icws.Sampler(1000, np.empty(0, np.uint64), np.empty(0))
    same = expected = 0
    for _ in range(60):
        a = [f"w{rng.randrange(10**6)}" for _ in range(300)] * 2
        b = list(a)
        for _ in range(6):
            b[rng.randrange(600)] = f"x{rng.randrange(10**6)}"
        x, y = (Counter(zip(*[t[k:] for k in range(5)], strict=False)) for t in (a, b))
        common = sum(min(v, y[s]) for s, v in x.items() if s in y)
        similarity = common / (sum(x.values()) + sum(y.values()) - common)
        ids, counts, starts, _ = icws.shingles([" ".join(a), " ".join(b)])
        bands = sampler.bands(ids, sampler.weights(ids, counts), starts)
        same += (bands[0] == bands[1]).sum()
        expected += icws.BANDS * similarity**icws.ROWS
    assert abs(same - expected) < 4 * math.sqrt(expected)


def test_few_shingles_are_drawn(monkeypatch):
    """Buckets equal those from all ranks, but of shingles below the usual weight only the lowest bounds are drawn."""
    rng = np.random.default_rng(14)
    sampler = icws.Sampler(100_000, np.empty(0, np.uint64), np.empty(0))
    sizes = [1, 2, 3000, 40, 700, 1]
    ids = np.concatenate([np.sort(rng.choice(1 << 40, n, replace=False)).astype(np.uint64) for n in sizes])
    starts = np.cumsum([0, *sizes[:-1]])
    held = rng.choice([1, 2, 3, 50, 900, 60_000], len(ids), p=[0.05, 0.25, 0.2, 0.2, 0.2, 0.1]).astype(float)
    weights = sampler.weights(ids, 1 + (rng.random(len(ids)) < 0.02), held)
    expected = np.zeros((len(sizes), icws.BANDS), np.uint64)
    logs = np.log(weights).astype(np.float32)
    with np.errstate(over="ignore"):
        for k, (factor, r, log_c, beta, _, _) in enumerate(sampler._tables()):
            at = (icws._mix(ids) * factor) >> np.uint64(64 - icws.TABLE_BITS)
            rank, level = sampler._draw(r[at], log_c[at], beta[at], logs)
            chosen = [start + int(np.argmin(rank[start : start + n])) for start, n in zip(starts, sizes, strict=True)]
            sample = icws._mix(ids[chosen] * np.uint64(31) + level[chosen].astype(np.int64).astype(np.uint64))
            band = k // icws.ROWS
            expected[:, band] = icws._mix(expected[:, band] * np.uint64(0x9E3779B97F4A7C15) + sample + np.uint64(band + 1))
    drawn, draw = [], icws.Sampler._draw
    monkeypatch.setattr(icws.Sampler, "_draw", lambda self, r, *rest: (drawn.append(len(r)), draw(self, r, *rest))[1])
    assert (sampler.bands(ids, weights, starts) == expected).all()
    assert sum(drawn) < 0.2 * icws.BANDS * icws.ROWS * len(ids)


def test_frequent_shingles_are_counted_exactly(spark):
    texts = [f"one two three four five six {i}" if i % 4 == 0 else f"u{i} v{i} w{i} x{i} y{i} z{i}" for i in range(400)]
    total, frequent, holders = icws.frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(7))
    assert (total, len(frequent), holders.tolist()) == (400, 2, [100.0, 100.0])


def test_a_text_counts_once_for_a_frequent_shingle(spark):
    texts = [" ".join(["a b c d e f"] * (1 + i % 5)) if i % 2 else f"u{i} v{i} w{i} x{i} y{i}" for i in range(100)] + [None, "a b"]
    total, frequent, holders = icws.frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    true = Counter(s for t in texts for s in icws.shingles([t or ""])[0].tolist())
    assert total == 102 and dict(zip(frequent.tolist(), holders.tolist(), strict=True)) == {s: n for s, n in true.items() if n * 10 >= 102}
    assert sorted(holders)[-2:] == [50, 50]


def test_candidates_do_not_grow_with_partitions_or_order(spark):
    """Few texts in many partitions, and copies side by side, send no more shingles to the driver."""
    rng = random.Random(5)
    texts = []
    for i in range(120):
        texts += [" ".join(["one two three four five"] * (i % 2) + [f"u{rng.randrange(10**6)}" for _ in range(30)])] * 4
    made = spark.createDataFrame([(t,) for t in texts], "text string").repartition(97)
    total, found = icws.candidates(made)
    assert (total, found.count()) == (480, 1)
    in_order = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    assert icws.candidates(in_order)[1].count() == 1
    for table in (made, in_order):
        assert (icws.frequencies(table)[0], icws.frequencies(table)[2].tolist()) == (480, [240.0])


def test_summaries_keep_what_is_frequent():
    """Bounded counts: never too high, and too low by no more than all over the size."""
    rng = np.random.default_rng(3)
    import pyarrow as pa

    texts = [" ".join(["a b c d e"] * int(rng.random() < 0.2) + [f"x{k}" for k in rng.integers(0, 10**6, 40)]) for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    true = Counter(s for t in texts for s in icws.shingles([t])[0].tolist())
    for size in (50, 1000):
        made = {s: n for b in icws._summary(size)(iter([batch])) for s, n in zip(b["shingle"].to_pylist(), b["least"].to_pylist(), strict=True)}
        assert len(made) <= size and all(n <= true[s] for s, n in made.items())
        low = sum(true.values()) / (size + 1) + len(texts) / 40
        assert all(made.get(s, 0) >= n - low for s, n in true.items())
    assert icws.shingles(["a b c d e"])[0].tolist()[0] in made


def test_all_shingles_have_their_document_frequency(spark, monkeypatch):
    """Over several portions and shards, every shingle of every text has the number of documents that hold it."""
    monkeypatch.setattr(icws, "PORTION", 500)
    monkeypatch.setattr(icws, "SHARD_CHARS", 1_000)
    rng = random.Random(12)
    phrases = [" ".join(f"p{k}x{j}" for j in range(7)) for k in range(30)]
    texts = ["", "a b", "a b", None]
    for _ in range(300):
        texts.append(" ".join([rng.choice(phrases[: rng.randrange(1, 31)]), *[f"u{rng.randrange(10**6)}" for _ in range(8)], rng.choice(phrases)]))
    docs = spark.createDataFrame([(i, t or "", i) for i, t in enumerate(texts)], "doc_id bigint, text string, text_hash bigint").repartition(5)
    sampler = icws.Sampler(*icws.frequencies(docs))
    ids = {i: icws.shingles([t or ""])[0].tolist() for i, t in enumerate(texts)}
    true = Counter(s for own in ids.values() for s in own)
    assert 0 < len(sampler.frequent) < sum(n > 1 for n in true.values())
    rows = icws._sketches(docs, sampler).collect()
    assert {r.doc_id: icws._unpacked(r.held).tolist() for r in rows} == {i: [true[s] for s in own] for i, own in ids.items()}
    assert [len(r.bands) for r in sorted(rows)[:4]] == [0, 16, 16, 0] and len(rows) == len(texts)
    # A tenth of the documents and above is not the only difference: two and thirty of 304 weigh apart too.
    assert np.allclose(sampler.weights(np.arange(3), np.ones(3), np.array([1, 2, 30])), [1 + math.log10(305 / (n + 1)) for n in (1, 2, 30)])


def test_rare_shingles_decide(spark):
    """Two texts that differ in phrases which a thirteenth of all documents hold: similar by TF-IDF only."""
    rng = random.Random(13)
    phrases = [" ".join(f"p{k}x{j}" for j in range(16)) for k in range(2)]
    base = " ".join(f"b{k}" for k in range(124))
    texts = [f"{base} {phrase}" for phrase in phrases]
    texts += [" ".join([*[f"u{rng.randrange(10**6)}" for _ in range(60)], phrase]) for phrase in phrases for _ in range(29)]
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(340)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in icws.near_duplicates(docs).collect() if r.doc_id < 2} == {0: 0, 1: 0}
    x, y = (set(zip(*[t.split()[k:] for k in range(5)], strict=False)) for t in texts[:2])
    assert len(x & y) < 0.8 * len(x | y)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def line_docs():
    rng = random.Random(9)
    common = [" ".join(f"word{rng.randrange(400)}" for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    out = []
    for i in range(60):
        own = [" ".join(f"own{rng.randrange(5000)}" for _ in range(8)) for _ in range(3)]
        for line in rng.sample(common, 3):
            own.append(rng.choice([line, line.upper() + " .", line + "s", line.replace("word1", "wort1", 1)]))
        rng.shuffle(own)
        out.append((i, "\n".join(own)))
    return out + [(70, None), (71, ""), (72, "short\nshort\nshort"), (73, out[0][1]), (74, "\n".join([common[0]] * 2000))]


def test_a_line_is_summed_by_itself(spark):
    """Sixteen sums give the bits that 64 give, for few and for the most features, however often a line is there."""
    rng = random.Random(15)
    sizes = [1, 2, 3, 7, 64, 255, 256, 1000, lines.LANE - 1, lines.LANE]
    rows = [(n, n, [rng.randrange(-(1 << 63), 1 << 63) | (n % 7) for _ in range(n)]) for n in sizes] + [(-k, -k, [k] * lines.LANE) for k in (1, 2)]
    words = spark.createDataFrame(rows + rows[:4] * 50, "raw bigint, node bigint, features array<bigint>").repartition(3)
    made = lines.line_simhash(words)
    expected = lines.simhash(words.select("raw", F.explode("features").alias("feature")), "raw", "feature")
    assert {(r.raw, r.node): r.bits for r in made.collect()} == {(r.raw, r.raw): r.bits for r in expected.collect()}
    assert made.count() == len(rows) and {r.raw: r.bits for r in made.collect() if r.raw < 0} == {-1: 1, -2: 2}


def test_longest_lines_and_rows_moved_once(spark):
    long, dotted = " ".join(f"w{k}" for k in range(lines.LANE + 50)), "\u0130" * (lines.LANE + 50)
    rows = [(1, f"{long}\n{dotted}"), (2, f"one line of five words\n{long}"), (3, f"{dotted}\nsome other line of six words")]
    made = lines.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    kept = {r.row.doc_id: r.kept_text for r in made.collect()}
    assert kept == {1: rows[0][1], 2: "one line of five words", 3: "some other line of six words"}
    # The text is shuffled in its row only.
    beside = re.findall(r"AS row#\d+(, .*)", made._jdf.queryExecution().optimizedPlan().toString())
    assert beside and all("text#" not in re.sub(r"xxhash64\([^)]*\)", "", b) for b in beside)


def test_fuzzy_lines(spark):
    rows = line_docs()
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id bigint, text string, places int, row string")
    made = {r.row.doc_id: (r.kept_text, r.n_dropped) for r in lines.dedup_lines(docs).collect()}
    norm = lambda line: regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip(" ")
    at = defaultdict(list)
    for i, text in rows:
        for place, line in enumerate((text or "").split("\n")):
            if len(norm(line).split(" ")) >= 5:
                at[norm(line)].append((i, place))
    known = list(at)
    split = spark.createDataFrame(list(enumerate(known)), "n bigint, line string")
    made_of = split.select("n", F.explode(lines.features(F.split("line", " "))).alias("feature"))
    bits = {r.n: r.bits & (1 << 64) - 1 for r in lines.simhash(made_of, "n", "feature").collect()}

    def blocks(value):
        return [value >> (k * 64 // 6) & (1 << ((k + 1) * 64 // 6 - k * 64 // 6)) - 1 for k in range(6)]

    union = Union()
    for i, a in enumerate(known):
        for j in range(i):
            alike = sum(x == y for x, y in zip(blocks(bits[i]), blocks(bits[j]), strict=True))
            if alike >= 3 and distance(a, known[j]) <= max(len(a), len(known[j])) // 10:
                union.join(i, j)
    everywhere = defaultdict(list)
    for n, line in enumerate(known):
        everywhere[union.find(n)] += at[line]
    drop = {place for places in everywhere.values() for place in sorted(places)[1:]}
    for i, text in rows:
        kept = None if text is None else "\n".join(x for p, x in enumerate(text.split("\n")) if (i, p) not in drop)
        assert made[i] == (kept, sum(1 for d, _ in drop if d == i)), i
    kept = lines.without_repeats(docs)
    assert kept.columns == docs.columns
    gone = {r[0] for r in rows} - {r.doc_id for r in kept.collect()}
    assert 73 in gone and not gone & {70, 71, 72}


def test_lines_defined_results(spark):
    schema = "doc_id bigint, text string, n_chars bigint"
    assert lines.without_repeats(spark.createDataFrame([], schema)).count() == 0
    line = "five words are in here"
    rows = [(None, line, 22), (2, f"{line}\nx", 24), (2, f"{line}\nx", 24), (3, f"{line}!\nlast", 29)]
    made = sorted(map(tuple, lines.without_repeats(spark.createDataFrame(rows, schema)).collect()))
    assert made == [(2, f"{line}\nx", 24), (2, f"{line}\nx", 24), (3, "last", 4)]


def edited(rng, text, rate):
    out = []
    for c in text:
        r = rng.random()
        if r < rate / 3:
            out.append(rng.choice(string.ascii_lowercase))
        elif r >= 2 * rate / 3:
            out.append(c + (rng.choice(string.ascii_lowercase) if r < rate else ""))
    return "".join(out)


@pytest.fixture(scope="module")
def benchmark_rows(spark):
    folder = "/root/testdata/sf0.1"
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    return items, texts


@pytest.mark.parametrize(("rate", "least"), [(0, 1.0), (0.05, 0.97), (0.1, 0.9)])
def test_recall_of_edited_passages(benchmark_rows, rate, least):
    items, texts = benchmark_rows
    rng = random.Random(3)
    items = [(i, t) for i, t in items if len(t) >= 150]
    searcher = decontam.Searcher(decontam.Items(items))
    planted = [f"{texts[n][:700]} {edited(rng, t, rate)} {texts[n + 1][:700]}" for n, (_, t) in enumerate(items)]
    found = searcher.search(planted)
    assert sum(n in f for n, f in enumerate(found)) / len(items) >= least


def test_every_exact_passage_and_no_clean_document(benchmark_rows):
    items, texts = benchmark_rows
    norm = lambda t: " ".join(words(t))
    found = decontam.Searcher(decontam.Items(items)).search(texts)
    for text, hits in zip(texts, found, strict=True):
        assert {n for n, (_, t) in enumerate(items) if norm(t) in norm(text)} == set(hits)


def test_distance_to_a_part():
    rng = random.Random(6)
    for _ in range(200):
        item, text = ("".join(rng.choice("abc") for _ in range(n)) for n in (rng.randrange(1, 12), rng.randrange(0, 20)))
        expected = min(distance(item, text[i:j]) for i in range(len(text) + 1) for j in range(i, len(text) + 1))
        got = decontam.smallest_distance(decontam._letters(item.encode()), len(item), text.encode())
        assert got == expected, (item, text)


def test_decontamination_defined_results(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 100)
    long = "the quick brown fox jumps over the lazy dog while seven wizards quietly box up the heavy jugs of liquor"
    items = spark.createDataFrame([(1, long), (2, "tiny item"), (3, ""), (4, None), (5, long)], "item_id bigint, text string")
    schema = "doc_id bigint, text string, found string, item_id int"
    rows = [(1, f"x {long.upper()}!", "f", 1), (1, f"x {long.upper()}!", "f", 1), (2, "a tiny, item", "f", 1),
            (3, "tiny items", "f", 1), (4, None, "f", 1), (None, "", "f", 1)]
    docs = spark.createDataFrame(rows, schema)
    made = Counter((r.doc_id, r.item_id, r.edits) for r in decontam.contaminations(docs, items).collect())
    assert made == {(1, 1, 0): 2, (1, 5, 0): 2, (2, 2, 0): 1}
    kept = decontam.without_benchmark(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {3, 4, None}
    assert decontam.contaminations(docs, items.limit(0)).count() == 0
    assert decontam.without_benchmark(docs.limit(0), items).count() == 0
