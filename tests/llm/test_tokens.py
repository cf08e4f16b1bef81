"""Counts, encoding and decoding against the tokenizers library, also on hostile texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, tokencount

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "\n\n  \n x " * 90, "a<|endoftext|>b <|startoftext|>", "<|endoftext|>", "Σίσυφος ΟΔΟΣ", "İstanbul ǅ",
    "日本語 テスト १२३ ½²" * 40, "'s don't I'LL x'" * 50, "a" * 3000, "İx́é é ŉ", "ab\x1ccd\x85e\xa0f",
    "ﬁ K Å \x00\x7f a ×÷ªº¹", " " * 5000, "🙂👩‍👩‍👧 ok",
]


def random_texts(n, length):
    rng = random.Random(7)
    pools = [
        lambda: rng.choice("ab  '1.\n s"),
        lambda: chr(rng.choice([32, 32, 10, 39, rng.randrange(32, 0x250), rng.randrange(97, 100), rng.randrange(0x250, 0x3000)])),
    ]
    return ["".join(rng.choice(pools)() if False else pools[i % 2]() for _ in range(length)) for i in range(n)]


def test_counts():
    library, count = Tokenizer.from_file(WORDS), tokencount.make_counter(WORDS)
    for text in TEXTS + random_texts(150, 200):
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids), text[:80]


def test_merges_of_a_long_word_take_linear_logarithmic_time():
    assert tokencount.make_counter(WORDS)("ab" * 100_000) > 0


def test_encoding_and_decoding():
    library, codec = Tokenizer.from_file(BYTES), bpe.Codec(BYTES)
    texts = TEXTS + random_texts(100, 5000)
    for made, text in zip(codec.encode(texts), texts, strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert made.tolist() == ids, text[:80]
        assert bpe.decoded_text(codec.decode(made)) == library.decode(ids, skip_special_tokens=False) == text


def test_chunks_follow_content():
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdefg hijk lmno") for _ in range(20_000)).encode()
    pieces = []
    for head in (b"x" * 17, b"some other beginning "):
        data = head + shared
        at = [0, *bpe.cuts(data), len(data)]
        pieces.append({data[a:b] for a, b in zip(at, at[1:], strict=False)})
    assert len(pieces[0] & pieces[1]) > 0.8 * len(pieces[0])


@pytest.mark.parametrize("rows", [[], [(None, None), (1, ""), (1, ""), (2, "a b")]])
def test_defined_results(spark, rows):
    docs = spark.createDataFrame([(i, t, 9, "z") for i, t in rows], "doc_id bigint, text string, n_tokens int, Ids string")
    counted = tokencount.token_counts(docs, WORDS).select("n_tokens", "n_bytes").collect()
    assert sorted(map(tuple, counted)) == sorted((len((t or "").split()), len(t or "")) for _, t in rows)
    made = bpe.with_tokens(docs, BYTES)
    assert made.columns == ["doc_id", "text", "n_tokens", "ids", "round_trip"]
    assert sorted(r.n_tokens for r in made.collect()) == sorted(len((t or "").split()) for _, t in rows)
    assert all(r.round_trip for r in made.collect())
    assert bpe.digests_by_id(docs, BYTES).count() == len(rows)
