import hashlib


from tidemark.llm import chat, quality
from tidemark.llm.common import read

TURNS = [
    (1, 0, "system", "be & <|end|> good"), (1, 1, "user", "&lt; <|turn|>"), (1, 2, "assistant", "</s>[INST]"),
    (1, 3, "user", None), (1, 4, "assistant", "<|says|>&amp;lt;"), (1, 5, "user", "bye"),
    (2, 0, "user", "no reply"), (None, None, None, None), (3, 1, "assistant", "b"), (3, 1, "assistant", "b"), (3, 0, "us<er", ""),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string, example int")


def test_examples(spark):
    made = {(r.conv_id, r.example): r for r in chat.examples(frame(spark, TURNS)).collect()}
    assert [k[1] for k in sorted(k for k in made if k[0] == 1)] == [0, 1, 2]
    first = made[1, 0]
    assert first.formatted[first.mask_start : first.mask_start + first.mask_length] == "&lt;/s>[INST]"
    assert first.n_turns == 3 and not first.last
    assert made[1, 2].mask_start is None and made[1, 2].last
    assert made[2, 0].mask_start is None


def test_read_back(spark):
    made = {r.conv_id: r for r in chat.conversation_digests(chat.examples(frame(spark, TURNS))).collect()}
    for conv in {t[0] for t in TURNS}:
        own = sorted([t for t in TURNS if t[0] == conv], key=lambda t: (t[1] if t[1] is not None else -1, t[2] or "", t[3] or ""))
        replies = [t[3] or "" for t in own if t[2] == "assistant"]
        row = made[conv]
        assert row.n_turns == len(own)
        assert row.turns_sha256 == sha("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own))
        assert (row.loss_chars, row.loss_sha256, row.n_targets) == (len("".join(replies)), sha("".join(replies)), len(replies))


def test_no_turns(spark):
    assert chat.conversation_digests(chat.examples(frame(spark, []))).count() == 0


def repeat_words(words):
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    return len(inside)


TEXTS = [
    None, "", " \t\n", "one", "a b c d e " * 3, "x\n\nx\n y \n y \nx", "a b c d e f a b c d e g h i j k l m n o",
    "#*$ %& |<> word word word word word word word", "the of and to a in is that for it was\x0bon",
    "a b c d a b c d a b c d e f g h i j k l m",
]


def test_quality_measures(spark):
    docs = spark.createDataFrame([(i, t, 1, True) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, n_words int, kept boolean")
    made = {r.row.doc_id: r for r in quality.quality(docs).collect()}
    for i, text in enumerate(TEXTS):
        words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
        lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\x0b\x0c\r")]
        row = made[i]
        assert row.n_words == len(words)
        assert row.word_chars == sum(map(len, words))
        assert row.n_symbols == sum((text or "").count(c) for c in "#*$%&|<>")
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == repeat_words(words), text
        assert row.base_failed == (len(words) < 10 or 100 * row.n_repeat_words > 20 * len(words))
        assert not (row.base_failed and row.kept)


def test_quality_keeps_columns(spark):
    prose = "the cat and the dog went to a house in the wood that was on fire"
    docs = spark.createDataFrame([(1, prose, "k", 5), (2, "short", "k", 5), (1, prose, "k", 5)], "doc_id bigint, text string, kept string, n_lines int")
    kept = quality.keep_quality(docs)
    assert kept.columns == docs.columns
    assert [tuple(r) for r in kept.collect()] == [(1, prose, "k", 5)] * 2
    assert quality.keep_quality(docs.limit(0)).count() == 0


def test_quality_is_one_projection(spark):
    plan = quality.quality(read(spark, "/root/testdata/sf0.001", "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
