import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CASES = [
    ("", []),
    ("mail a.b@x.example.com now", ["email:5:22"]),
    ("@x.com a@b a@b.c@d.e", ["email:11:16"]),
    ("10.0.0.1 and 256.1.1.1 and 1.2.3.4.5", ["ip:0:8", "ip:27:34"]),
    ("4111 1111 1111 1111 or 4111111111111112", ["card:0:19"]),
    ("+1 (555) 123-4567, +12", ["phone:0:17"]),
]


def base(text):
    return [f"{k}:{s}:{e}" for k, s, e, ok in sorted(pii.base_matches(text), key=lambda x: (pii.BASE.index(x[0]), x[1])) if ok]


def model(text):
    """The contract's rule, word for word."""
    out = []
    for kind, pattern in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            luhn = sum(d if i % 2 == 0 else (2 * d) // 10 + (2 * d) % 10 for i, d in enumerate(reversed(digits))) % 10 == 0
            holds = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if holds:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


@pytest.mark.parametrize(("text", "spans"), CASES)
def test_base(text, spans):
    assert base(text) == spans == model(text)


def test_base_on_random_texts():
    rng = random.Random(5)
    for alphabet in ("a.@-1 b@", "12..3 ", "4 1-4411 ", "+1()- .2", "a1@.+ -é"):
        for _ in range(2000):
            text = "".join(rng.choice(alphabet) for _ in range(60))
            assert base(text) == model(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1 " * 100_000, "4 " * 150_000):
        list(pii.base_matches(text))


def test_em_finds_the_unreliable_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(5000) < 0.4
    right = [0.95, 0.9, 0.9, 0.85, 0.8, 0.5]
    cast = np.stack([np.where(rng.random(5000) < p, truth, ~truth) for p in right], axis=1)
    codes = (np.where(cast, 2, 0) * 3 ** np.arange(6)).sum(axis=1)
    votes, n = np.unique(codes, return_counts=True)
    table, likely = pii.reliabilities(votes, n.astype(float))
    found = (table[1, :, 2] + table[0, :, 0]) / 2
    assert np.abs(found - right).max() < 0.05
    assert ((likely[np.searchsorted(votes, codes)] > 0.5) == truth).mean() > 0.95


def test_classifier_adds_spans_and_keeps_base(spark):
    texts = [f"please call me: phone 555-{i:03d}-4567 today" for i in range(100, 160)]
    texts += [f"see isbn 555-{i:03d}-4567x and section 1.2" for i in range(40)]
    texts += [f"user{i}@mail.example.com wrote from 10.0.0.{i}" for i in range(40)] + [None, ""]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string")
    found = {r.doc_id: [(s.kind, s.base) for s in r.spans] for r in pii.personal_data(docs).collect()}
    assert all(found[i] == [("phone", False)] for i in range(60))
    assert all(found[i] == [] for i in range(60, 100))
    assert all(found[i] == [("email", True), ("ip", True)] for i in range(100, 140))
    assert found[140] == found[141] == []


def test_empty_table_and_repeated_rows(spark):
    schema = "doc_id bigint, text string"
    assert pii.personal_data(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a@b.c"), (None, "a@b.c"), (1, None)]
    made = [len(r.spans) for r in pii.personal_data(spark.createDataFrame(rows, schema)).orderBy("doc_id").collect()]
    assert made == [1, 1, 0]


def test_digest():
    assert pii.digest([("ip", 1, 9), ("card", 2, 20)]) == hashlib.sha256(b"ip:1:9,card:2:20").hexdigest()
