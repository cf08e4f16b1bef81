"""The context tree, page extraction and the pipeline."""

import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import ctw, wrapper


def brute_tree(texts, depth):
    """Context-tree weighting by the book: nodes as dictionaries, without expansion limits."""
    counts = Counter()
    for text in texts:
        data = bytes(depth) + text + b"\0"
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                node = 1
                for bit in range(7, -1, -1):
                    b = data[i] >> bit & 1
                    counts[data[i - d : i], node, b] += 1
                    node = 2 * node + b
    contexts = {c for c, _, _ in counts}

    def block(c, node):
        zeros, ones = counts[c, node, 0], counts[c, node, 1]
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    def weighted(c, node):
        if len(c) == depth:
            return block(c, node)
        longer = sum(weighted(bytes([b]) + c, node) for b in range(256) if bytes([b]) + c in contexts)
        return np.logaddexp(block(c, node), longer) - math.log(2)

    def one(past, node, d=0):
        c = past[len(past) - d :]
        zeros, ones = counts[c, node, 0], counts[c, node, 1]
        estimate = (ones + 0.5) / (zeros + ones + 1)
        if d == depth or past[len(past) - d - 1 :] not in contexts:
            return estimate if d == depth or c not in contexts else own(c, node, estimate, 0.5)
        share = math.exp(block(c, node) - math.log(2) - weighted(c, node))
        return share * estimate + (1 - share) * one(past, node, d + 1)

    def own(c, node, estimate, below):
        share = math.exp(block(c, node) - math.log(2) - weighted(c, node))
        return share * estimate + (1 - share) * below

    def score(text):
        data, total = bytes(depth) + text + b"\0", 0.0
        for i in range(depth, len(data)):
            node = 1
            for bit in range(7, -1, -1):
                p = one(data[i - depth : i], node)
                b = data[i] >> bit & 1
                total += math.log10(p if b else 1 - p)
                node = 2 * node + b
        return total

    return score


def test_against_the_definition(monkeypatch):
    monkeypatch.setattr(ctw, "DEPTH", 2)
    train, test = [b"abab", b"abc", b""], [b"abab", b"ca", b"", b"bz"]
    keys = np.concatenate([ctw._sequences([t]) for t in train])
    counts = []
    for d in range(3):
        seen = {}
        for key in keys.tolist():
            seen.setdefault((key >> 8) & ((1 << 8 * d) - 1), np.zeros(256))[key & 255] += 1
        counts.append(seen)
    tree = ctw.build_tree(counts)
    assert np.allclose(np.exp(tree.log10.astype(float) * math.log(10)).sum(axis=1), 1, atol=1e-5)
    score = brute_tree(train, 2)
    assert np.allclose(ctw.log10_probability(test, tree), [score(t) for t in test], atol=1e-4)


def documents(spark):
    rng = random.Random(8)
    syllables = ["th", "er", "on", "an", "re", "ing", "tion", "ble"]
    rows = [(i, " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(60))) for i in range(200)]
    rows += [(200, None), (201, ""), (None, "the the"), (5, rows[5][1])]
    return rows, spark.createDataFrame([(*r, 1.0, True) for r in rows], "doc_id bigint, text string, score double, held_out boolean")


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(ctw, "FREQUENT_WORDS", 100)
    rows, docs = documents(spark)
    made = ctw.score(docs).collect()
    assert len(made) == len(rows)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter()
    for i, text in rows:
        if not held(i):
            counts.update([*(text or "").encode().lower().split(), b""])
    n, v = sum(counts.values()), len(counts)
    texts = {i: t for i, t in rows}
    for r in made:
        tokens = [*(texts[r.doc_id] or "").encode().lower().split(), b""]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(r.doc_id), len(tokens), n)
        assert r.n_known == sum(t in counts for t in tokens)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))
    better = [r for r in made if r.held_out and r.n_tokens > 10]
    assert np.mean([r.bits_per_byte for r in better]) < 2.6


def test_rare_contexts_have_nodes(spark, monkeypatch):
    """Contexts seen once in more than 2**16 bytes; a tree in many shards, asked by many portions."""
    monkeypatch.setattr(ctw, "PORTION", 20_000)
    monkeypatch.setattr(ctw, "SHARD_BYTES", 10_000)
    rows = [(i, "abAb " * 50) for i in range(400)] + [(1000 + i, f"abab zürich {i % 7} quartz") for i in range(40)] + [(None, "ab")]
    rows += [(1100 + i, f"{i * i * 7919} kept {chr(97 + i)}{chr(122 - i)}") for i in range(20)]
    train = [t.encode().lower() for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    counts = [{} for _ in range(ctw.DEPTH + 1)]
    for key, n in Counter(ctw._sequences(train).tolist()).items():
        for d, seen in enumerate(counts):
            seen.setdefault((key >> 8) & ((1 << 8 * d) - 1), np.zeros(256))[key & 255] += n
    tree = ctw.build_tree(counts)
    rows += [(i, "nowhere 0 quarts \0 zü") for i in range(2000, 2020)]
    # Texts that no training text is like are held out.
    rows = [(i, t) for i, t in rows if i is None or not 2000 <= i < 2020 or zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(map(len, train)) > 1 << 16 and any(i and 2000 <= i < 2020 for i, _ in rows)
    made = {r.doc_id: r.score for r in ctw.score(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()}
    expected = ctw.log10_probability([t.encode().lower() for _, t in rows], tree)
    assert np.allclose([made[i] for i, _ in rows], expected, rtol=1e-5, atol=1e-4)


def test_score_of_nothing(spark):
    schema = "doc_id bigint, text string"
    assert ctw.score(spark.createDataFrame([], schema)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = ctw.score(spark.createDataFrame([(held, "ab")], schema)).first()
    assert (row.train_tokens, row.n_known, row.base_score) == (0, 0, 0.0)
    assert math.isclose(row.bits_per_byte, 8, rel_tol=1e-6)


PAGE = (
    "<html><head><title>t</title></head><body><header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a></ul></nav>"
    "<div id='cookie-notice'>We use cookies</div><div class='page has-sidebar'><article><header><h1>A &amp; b</h1></header>"
    "<p>One <b>tw</b>o&nbsp;<p>three<br>four<aside>aside</aside><div class='ad-slot'>buy</div><form>f<input></form>"
    "<ul><li>x<li>y</ul><section id=comments><article class=comment><p>first!</p></article></section></article></div>"
    "<script>var x = '<p>no</p>'</script><!-- no --><div class=sidebar>side</div><footer>foot</footer></body></html>"
)


def test_named_parts():
    assert wrapper.main_text(wrapper.parse(PAGE), set()) == "A & b One two three four x y"
    for text in ("", "<", "<p", "a < b", "<!--", "<p class='x", "</p></p>", "<b><p>x</b>y", "&amp &am; &#65;&#x42;"):
        wrapper.parse(text)
    assert wrapper.main_text(wrapper.parse("a < b &amp &#65;"), set()) == "a < b & A"
    assert wrapper.main_text(wrapper.parse("<p>x" * 3000 + "<div>" * 3000), set()) == " ".join(["x"] * 3000)


def matching(a, b):
    """Simple tree matching as published, for trees as nested (label, children)."""
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + matching(x, y))
    return m[-1][-1] + 1


def test_tree_matching():
    rng = random.Random(3)

    def tree(d):
        return (rng.choice("ab"), [tree(d - 1) for _ in range(rng.randrange(4))] if d else [])

    def flat(t):
        return [(t[0], len(t[1]), 0), *[x for c in t[1] for x in flat(c)]]

    for _ in range(150):
        a, b = ("r", [tree(3)]), ("r", [tree(3)])
        assert len(wrapper.align(flat(a), flat(b))) == matching(a, b)


def test_deep_pages():
    """Pages nested far deeper than calls may be, differing at the bottom, in the middle and at the top."""
    def nested(depth, *odd):
        tags = ["div" if k not in odd else "section" for k in range(depth)]
        return "".join(f"<{t}>" for t in tags) + "<p>x" + "".join(f"</{t}>" for t in reversed(tags))

    flat = [wrapper.skeleton(wrapper.parse(nested(10_000, *odd))) for odd in ([], [9_999], [5_000], [0])]
    # One chain each: all nodes above the first that differs pair up, and the page itself.
    assert [len(wrapper.align(flat[0], other)) for other in flat] == [10_002, 10_000, 5_001, 1]
    assert len(wrapper.merged(flat[0], flat[1])) == 10_004
    a, b = [wrapper.skeleton(wrapper.parse("<body>" + "<div>a" * n + "</div>" * n + "<p>b")) for n in (2_000, 2_300)]
    assert len(wrapper.align(a, b)) == 2_003


def test_parsing_takes_linear_time():
    def seconds(source):
        began = time.process_time()
        wrapper.parse(source)
        return time.process_time() - began

    for piece in ("<span>x", "<span>x</b>", "<div>x</section>", "<p><span>y", "<span><p>z</p>"):
        closing = "</b></section>" if piece.startswith("<div") else "</b>"
        least = min(seconds(piece * 2_000 + closing * 2_000) for _ in range(3))
        assert min(seconds(piece * 16_000 + closing * 16_000) for _ in range(2)) < 24 * least + 0.2, piece


def test_hot_hosts_are_dealt_over_tasks(spark, monkeypatch):
    rows = [(i, f"http://hot/{i}", f"<body><div>Menu of all</div><div><p>story {i}</p></div></body>") for i in range(60)]
    rows += [(100 + i, f"http://h{i}/", f"<body><p>tale {i}") for i in range(9)] + [(200 + i, None, None) for i in range(15)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    whole = sorted(map(tuple, wrapper.extract(pages).collect()))
    monkeypatch.setattr(wrapper, "PAGES_PER_TASK", 10)
    assert sorted(map(tuple, wrapper._hot(pages.select(wrapper.host_of("url").alias("host"))).collect())) == [("", 2), ("hot", 6)]
    assert sorted(map(tuple, wrapper.extract(pages).collect())) == whole
    assert [r[2] for r in whole] == [f"story {i}" for i in range(60)] + [f"tale {i}" for i in range(9)] + [""] * 15


def test_template_of_unnamed_parts(spark):
    """Pages without any naming mark-up: what every page of the host says is template."""
    rows = [(i, f"http://h/{i}", f"<body><div>Menu of all</div><div><p>story {i} of many</p></div><div>Terms</div></body>") for i in range(12)]
    rows += [(20, None, None), (21, "x", ""), (22, "http://other/", "<body><div>Menu of all</div>"), (3, "http://h/3", rows[3][2])]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id bigint, url string, html string, text string, place int")
    made = sorted((r.page_id, r.text) for r in wrapper.extract(pages).collect())
    expected = [(i, f"story {i} of many") for i in range(12)] + [(3, "story 3 of many"), (20, ""), (21, ""), (22, "Menu of all")]
    assert made == sorted(expected)
    assert wrapper.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("empty", [None, "", "<body></body>", "<body><div>Menu of all"])
def test_template_that_some_pages_lack(spark, empty):
    """Empty and truncated pages, pages without the notice, and two layouts of one host."""
    rows = []
    for i in range(24):
        notice = "" if i % 4 == 0 else "<section><div>We changed our terms</div></section>"
        rows.append((i, "http://h/", f"<body><div>Menu of all</div>{notice}<div><p>story {i}</p></div><div>Terms</div></body>"))
        old = f"<body><table><tr><td>Old menu</td></tr></table><center><p>tale {i}</p></center><pre>Old terms</pre></body>"
        rows.append((100 + i, "http://h/", old))
    rows += [(200 + i, "http://h/", empty) for i in range(3)]
    made = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all((made[i], made[100 + i]) == (f"story {i}", f"tale {i}") for i in range(24))


@pytest.mark.parametrize("shapes", [3, 64])
def test_every_layout_of_a_host_has_its_model(spark, monkeypatch, shapes):
    """A host of twelve layouts that are not alike: the rarest one's menu is template as well."""
    monkeypatch.setattr(wrapper, "SHAPES", shapes)
    rows = [
        (100 * k + i, "http://h/", f"<body><x{k}><p>Menu {k}</p></x{k}><y{k}><p>tale {k} {i}</p></y{k}></body>")
        for k in range(12) for i in range(30 - 2 * k)
    ]
    made = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert {i: t for i, t in made.items() if t != f"tale {i // 100} {i % 100}"} == {}


def test_copies_of_an_article_keep_it(spark):
    html = "<body><nav>menu</nav><article><p>the same story</p></article></body>"
    pages = spark.createDataFrame([(i, "http://h/", html) for i in range(20)], "page_id bigint, url string, html string")
    assert {r.text for r in wrapper.extract(pages).collect()} == {"the same story"}


def test_template_inside_the_named_article(spark):
    """Words that all pages of a host repeat go from the article too; parts that vary stay, whatever they are called."""
    def page(i, story):
        return (
            f"<body><nav>menu</nav><article><h1>Title {story}</h1><p>story {story} goes on</p><p>Read us every day!</p>"
            f"<div class='legal-analysis'><p>verdict {story} explained</p></div><div class='share-box'>Tell a friend</div></article></body>"
        )

    rows = [(i, "http://h/", page(i, i)) for i in range(12)] + [(20 + i, "http://copies/", page(i, 5)) for i in range(30)]
    made = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(made[i] == f"Title {i} story {i} goes on verdict {i} explained" for i in range(12))
    # Copies of one article are one vote: none of it is template.
    assert {made[20 + i] for i in range(30)} == {"Title 5 story 5 goes on Read us every day!"}


def test_pipeline(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    made = pipeline.run(spark, small).collect()
    assert len(pipeline.STAGES) == 5 and 0 < len(made) < docs.count()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in made)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(set(r.text.split("\n")) <= set(texts[r.doc_id].split("\n")) for r in made)
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert not any(item in " ".join(r.text.lower().split()) for r in made for item in items)


@pytest.mark.parametrize("rows", [[], [(None, None, None), (1, "", "s"), (1, "x", "s"), (1, "x", "s")]])
def test_stages_keep_columns(spark, rows):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.createDataFrame([(*r, "k", 2) for r in rows], "doc_id bigint, text string, source string, kept string, found int")
    for _, stage in pipeline.STAGES[:-1]:
        made = stage(spark, docs, "/root/testdata/sf0.001")
        assert made.columns == docs.columns
        made.collect()
