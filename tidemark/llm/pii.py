"""Personal data by weak supervision.

1. Candidate spans of every kind are found in each whole text: the exact base patterns,
   spans that look like them, and wider forms (national phone numbers, spelled-out mail
   addresses, names, social security and account numbers).
2. Six labelers vote on each candidate: +1, -1, or 0 to abstain. Pattern and checksum,
   gazetteer, words before it that speak for it, words that speak against it, shape, and
   whether it stands alone.
3. Candidates are counted by (kind, votes, features). Expectation-maximisation over these
   counts estimates how reliable each labeler is and how likely each candidate is
   personal data. The counts are the sufficient statistics, so this is exact over the
   whole corpus, and there are at most 8 kinds * 3**6 votes * 2**7 features of them.
4. A logistic classifier of spans is trained on those likelihoods and decides over the
   candidates that are no base match. Base matches always stay.

Defined results: a missing text counts as empty and has no spans; repeated rows are judged
alike; without candidates nothing is trained and nothing added; an empty table gives an
empty table; other columns of the input do not take part.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone", "name", "ssn", "iban")
BASE = KINDS[:4]
LABELERS = ("pattern", "gazetteer", "context", "counter_context", "shape", "alone")
FEATURES = 7

# Gazetteers and context words.
TOP_DOMAINS = frozenset("com net org edu gov mil int info biz name io ai co dev app de fr es uk us it nl eu ch at be ca au jp cn in br mx".split())
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Madame Monsieur Señor Señora".split()
GIVEN_NAMES = (
    "James John Robert Michael William David Richard Joseph Thomas Charles Mary Patricia Jennifer Linda Elizabeth "
    "Barbara Susan Jessica Sarah Karen Hans Peter Klaus Jürgen Stefan Ursula Monika Petra Sabine Anna Jean Pierre "
    "Michel Jacques François Marie Nathalie Isabelle Sylvie Catherine José Antonio Juan Manuel Francisco Carmen "
    "María Josefa Isabel Dolores"
).split()
FOR_WORDS = {
    "email": ("mail", "contact", "write", "correo", "courriel", "kontakt"),
    "ip": ("ip", "address", "host", "server", "adresse", "login"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono", "whatsapp"),
    "name": ("name", "dear", "contact", "by", "sincerely", "signed"),
    "ssn": ("ssn", "social security", "security number"),
    "iban": ("iban", "account", "konto", "compte", "cuenta"),
}
AGAINST_WORDS = ("version", "isbn", "issn", "doi", "section", "figure", "chapter", "order no", "serial", "build", "lot ")

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]++")
# A start inside a run of digits is never tried: what it could match, the run's start
# matches. (Looking back from behind the first character keeps the scan fast.)
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WIDE = {
    "email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,63})+"
    ),
    "phone": re.compile(r"[(0-9](?<![0-9A-Za-z+.-][(0-9])[0-9]{1,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z]|[.-][0-9])"),
    "name": re.compile(
        rf"(?:{'|'.join(TITLES + GIVEN_NAMES)})\.? [A-ZÀ-Ý][A-Za-zÀ-ÿ'’-]{{1,40}}(?: [A-ZÀ-Ý][A-Za-zÀ-ÿ'’-]{{1,40}})?"
    ),
    "ssn": re.compile(r"[0-9](?<![0-9A-Za-z-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    "iban": re.compile(r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
}


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Base matches, leftmost first, in time linear in the text: each holds exactly one @."""
    free, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain and at > free:
            # The local part reaches back as far as its characters go.
            back = text[free:at][::-1]
            local = LOCAL.match(back)
            if local:
                yield at - local.end(), domain.end()
                free = domain.end()
        at = text.find("@", max(at + 1, free))


def _is_base(kind: str, value: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 and int(p.lstrip("0") or 0) <= 255 for p in value.split("."))
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """``kind, start, end, holds`` of every match of the base patterns."""
    for start, end in _emails(text):
        yield "email", start, end, True
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end(), _is_base(kind, m.group())


def _valid_iban(value: str) -> bool:
    compact = value.replace(" ", "")
    moved = compact[4:] + compact[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _pattern_vote(kind: str, value: str, digits: str, base: bool) -> int:
    if base:
        return 1
    if kind == "ssn":
        return 1 if value[:3] not in ("000", "666") and value[0] != "9" and value[4:6] != "00" and value[7:] != "0000" else -1
    if kind == "iban":
        return 1 if _valid_iban(value) else -1
    if kind == "card":
        return 1 if len(digits) == 15 and value[:2] in ("34", "37") and luhn(digits) else -1
    return -1 if kind in ("ip", "email") and not base and kind == "ip" else 0


def _gazetteer_vote(kind: str, value: str, digits: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[^A-Za-z]+", value)[-1].lower() in TOP_DOMAINS else -1
    if kind == "card":
        return 1 if digits[:1] in ("3", "4", "5", "6") else -1
    if kind == "name":
        return 1 if any(w.strip(".") in _NAMES for w in value.split()) else 0
    return 0


_NAMES = frozenset(GIVEN_NAMES)


def _shape_vote(kind: str, value: str, digits: str) -> int:
    if kind == "phone":
        return 1 if 9 <= len(digits) <= 13 else -1
    if kind == "card":
        return 1 if re.fullmatch(r"[0-9]{16}|(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}", value) else -1
    if kind == "ip":
        return 1 if re.fullmatch(r"(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}", value) else -1
    if kind == "name":
        return 1 if value.count(" ") == 2 else 0
    return 1


def candidates(text: str) -> list[tuple[int, int, int, bool, int, int]]:
    """``kind, start, end, base, votes, features``; votes in base 3, kinds by their number."""
    spans = [(k, s, e, ok) for k, s, e, ok in base_matches(text) if ok or e - s >= 7]
    for kind, pattern in WIDE.items():
        # A wide form must hold a mark that plain prose seldom has; tested first, for speed.
        if kind == "email" and "at]" not in text and "at)" not in text and "at ]" not in text and "at )" not in text:
            continue
        spans += [
            (kind, m.start(), m.end(), False)
            for m in pattern.finditer(text)
            if kind != "name" or not text[m.start() - 1 : m.start()].isalnum()
        ]
    out = []
    for kind, start, end, base in spans:
        value, before = text[start:end], text[max(0, start - 40) : start].lower()
        digits = re.sub(r"[^0-9]", "", value)
        around = text[max(0, start - 1) : start] + text[end : end + 1]
        context = any(w in before for w in FOR_WORDS[kind])
        against = any(w in before for w in AGAINST_WORDS)
        alone = not re.search(r"[\w=/_-]", around)
        votes = (
            _pattern_vote(kind, value, digits, base),
            _gazetteer_vote(kind, value, digits),
            int(context),
            -int(against),
            _shape_vote(kind, value, digits),
            1 if alone else -1,
        )
        features = (votes[0] > 0, votes[1] > 0, context, against, votes[4] > 0, alone, len(digits) >= 9)
        code = sum((v + 1) * 3**i for i, v in enumerate(votes))
        out.append((KINDS.index(kind), start, end, base, code, sum(f << i for i, f in enumerate(features))))
    return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update((k, v, f) for k, _, _, _, v, f in candidates(text or ""))
    if counts:
        kind, votes, features = zip(*counts, strict=True)
        yield pa.RecordBatch.from_pydict(
            {"kind": pa.array(kind, pa.int32()), "votes": pa.array(votes, pa.int32()),
             "features": pa.array(features, pa.int32()), "n": pa.array(counts.values(), pa.int64())}
        )


def _vote_matrix(votes: np.ndarray) -> np.ndarray:
    return (votes[:, None] // 3 ** np.arange(len(LABELERS))) % 3


def reliabilities(votes: np.ndarray, weights: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """EM: ``table[class, labeler, vote]`` and the likelihood of each pattern of votes."""
    cast = _vote_matrix(votes)
    likely = np.clip(0.5 + 0.15 * (cast - 1).sum(axis=1), 0.05, 0.95)
    table = np.zeros((2, len(LABELERS), 3))
    for _ in range(rounds):
        for c, share in enumerate((1 - likely, likely)):
            for labeler in range(len(LABELERS)):
                table[c, labeler] = 1 + np.bincount(cast[:, labeler], weights * share, 3)
        table /= table.sum(axis=2, keepdims=True)
        prior = (1 + (weights * likely).sum()) / (2 + weights.sum())
        score = [np.log(p) + np.log(table[c][np.arange(len(LABELERS)), cast]).sum(axis=1) for c, p in ((0, 1 - prior), (1, prior))]
        before, likely = likely, 1 / (1 + np.exp(np.clip(score[0] - score[1], -700, 700)))
        if np.abs(likely - before).max() < 1e-9:
            break
    return table, likely


def _design(kind: np.ndarray, features: np.ndarray) -> np.ndarray:
    bits = (features[:, None] >> np.arange(FEATURES)) & 1
    return np.hstack([np.ones((len(kind), 1)), bits, np.eye(len(KINDS))[kind]])


def train_classifier(kind, features, likely, weights, rounds: int = 25) -> np.ndarray:
    """Logistic regression on probabilistic labels, by Newton steps with a small penalty."""
    x = _design(kind, features)
    coef = np.zeros(x.shape[1])
    weights = weights / weights.sum() * len(weights)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        gradient = x.T @ (weights * (p - likely)) + 0.1 * coef
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(coef))
        coef -= np.linalg.solve(hessian, gradient)
    return coef


def train(docs: DataFrame) -> np.ndarray | None:
    """The span classifier's coefficients, learned from all candidates of ``docs.text``."""
    counted = (
        docs.select("text")
        .mapInArrow(_count_batches, "kind int, votes int, features int, n bigint")
        .groupBy("kind", "votes", "features")
        .sum("n")
        .orderBy("kind", "votes", "features")
        .toPandas()
    )
    if counted.empty:
        return None
    kind, votes, features, n = (counted[c].to_numpy() for c in counted.columns)
    _, likely = reliabilities(votes, n.astype(float))
    return train_classifier(kind, features, likely, n.astype(float))


def find_spans(text: str, coef: np.ndarray | None) -> list[tuple[str, int, int, bool]]:
    """``kind, start, end, base`` of a text: base matches, and what the classifier adds."""
    found = candidates(text)
    spans = [(k, s, e, True) for k, s, e, base, _, _ in found if base]
    rest = [c for c in found if not c[3]]
    if rest and coef is not None:
        score = _design(np.array([c[0] for c in rest]), np.array([c[5] for c in rest])) @ coef
        taken = sorted((s, e) for _, s, e, _ in spans)
        for (k, s, e, *_), value in sorted(zip(rest, score, strict=True), key=lambda x: (-x[1], x[0])):
            if value > 0 and not any(s < b and a < e for a, b in taken):
                spans.append((k, s, e, False))
                taken.append((s, e))
    return [(KINDS[k], s, e, base) for k, s, e, base in sorted(spans)]


def personal_data(docs: DataFrame, coef: np.ndarray | None = None) -> DataFrame:
    """``doc_id, spans array<struct<kind, start, end, base>>``; trains on ``docs`` if no ``coef`` is given.

    Positions are code points, ends exclusive; spans are ordered by kind and start.
    """
    coef = train(docs) if coef is None else coef
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in find_spans(text or "", coef)]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(span))], names=["doc_id", "spans"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, spans array<struct<kind: string, start: int, end: int, base: boolean>>"
    )


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
