"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

Words are runs of ASCII letters and digits and of characters beyond ASCII, in lower case.
A shingle is five consecutive words (a text of one to four words is one shingle); its
weight is its count in the text times ``1 + log10((documents + 1) / (documents with it + 1))``, for every
shingle, however rare or frequent. All counts are exact:

- those that a tenth of all documents hold (at most ten times an average document's shingles) are
  counted apart, and every task knows them: each task keeps summaries of counts that are too low by a known
  bound, Spark adds them up, and the shingles whose sums say that a twentieth of all documents may hold them (at
  most twenty times an average document's words, whatever the partitions and the order) are counted again;
- the documents of a task are cut into portions of about ``PORTION`` shingles, and each portion asks the shards
  of all shingles, by the first bits of their hashes, for those it holds, each once. A shard adds up what all portions
  have and answers each; portions meet their answers and are sampled. A question is the gap to the shingle
  before, about four bytes, and a text is moved only as the places of its shingles in its portion.

Sampling: for each of 80 hashes, ICWS draws one (shingle, level) of a text; two texts draw the
same with a probability equal to their weighted Jaccard similarity. 16 bands of 5 samples
make the buckets: texts of similarity 0.8 share one with probability 0.998. The random numbers of a shingle
come from fixed tables of 65,536 entries for each hash.

The more copies a text has, the more documents hold its shingles and the less these weigh against the edits of
a copy: by weights alone, the same edit takes a copy out of a large group and not out of a small one, the more so the
more documents there are. So 16 bands of 5 samples without weights (minwise hashes) make buckets too, and candidates are
verified by both exact similarities: two texts are similar if the weighted Jaccard similarity, or that of the sets of their
shingles, is 0.8. Sets, so that a line that many texts repeat makes no copies of them.

Texts with the same words are one node from the start. Nodes are 64-bit hashes.

Defined results: a missing text counts as empty; texts without a word are copies of one
another; a missing id takes part, and a class's id is the smallest that is there; repeated rows
are copies; an empty table gives an empty table; other columns do not take part.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_row, groups, text_of
from tidemark.llm.groups import group, shared_buckets

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE, THRESHOLD = 5, 0.8
BANDS, ROWS = 16, 5
FREQUENT = 10
TABLE_BITS = 16
# Shingles of a portion of texts, and characters of all texts for each shard of their shingles.
PORTION, SHARD_CHARS = 1 << 20, 1 << 23
# Characters of texts that a task samples.
TASK_CHARS = 1 << 24
# Classes of shingles, by the last bits of their hashes, whose counts bound what two texts can have in common.
CLASSES = 16
# Nodes whose texts may be looked up by a broadcast of their hashes (16 bytes each).
BROADCAST_NODES = 500_000
# Powers that a task keeps: bytes of a usual group of texts.
KEPT_POWERS = 1 << 20
# How far above a text's lowest bound a rank is looked at first.
SLACK = np.float32(0.25)
_P = np.uint64(0x100000001B3)
_ID_BITS = 54


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of ``_P`` and of its inverse; those for a usual group of texts are made once. They don't travel."""

    def __init__(self) -> None:
        self.kept: tuple[np.ndarray, np.ndarray] | None = None

    def __reduce__(self) -> tuple:
        return _Powers, ()

    def made(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        return tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, p)])) for p in (_P, inverse))

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """``n`` at least."""
        if n > KEPT_POWERS:
            return self.made(n)
        if self.kept is None:
            self.kept = self.made(KEPT_POWERS)
        return self.kept


_POWERS = _Powers()
_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word of the texts, and the number of its text."""
    parts = [t.lower().encode() + b"\n" for t in texts]
    raw = np.frombuffer(b"".join(parts), np.uint8)
    # Texts end in a line feed, so a byte that is in no word is before the first and after the last.
    inside = np.concatenate([[False], _WORD[raw]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edge[::2], edge[1::2]
    powers, inverses = _POWERS.first(len(raw))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        scaled = raw.astype(np.uint64)
        scaled += np.uint64(1)
        scaled *= powers[: len(raw)]
        np.cumsum(scaled, out=sums[1:])
        hashes = _mix((sums[last] - sums[first]) * inverses[first] + (last - first).astype(np.uint64))
    ends = np.cumsum([len(p) for p in parts])
    return hashes, np.searchsorted(ends, first, side="right")


def _cut(texts: list[str], hashed: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of the texts, repeated ones too, and the numbers of their texts."""
    words, owner = hashed or word_hashes(texts)
    scale = [_mix(np.array([k + 1], np.uint64))[0] | np.uint64(1) for k in range(SIZE)]
    ids, of = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    with np.errstate(over="ignore"):
        if len(words) >= SIZE:
            n = len(words) - SIZE + 1
            value = np.zeros(n, np.uint64)
            for k in range(SIZE):
                value += words[k : k + n] * scale[k]
            whole = owner[:n] == owner[SIZE - 1 :]
            ids.append(_mix(value[whole]))
            of.append(owner[:n][whole])
        # Texts of fewer words than a shingle are one shingle.
        n_words = np.bincount(owner, minlength=len(texts))
        for text in np.flatnonzero((n_words > 0) & (n_words < SIZE)):
            own = words[np.searchsorted(owner, text) :][: n_words[text]]
            ids.append(_mix(np.array([sum(int(w) * int(s) for w, s in zip(own, scale, strict=False)) + len(own) & (1 << 64) - 1], np.uint64)))
            of.append(np.array([text]))
    return np.concatenate(ids) >> np.uint64(64 - _ID_BITS), np.concatenate(of).astype(np.uint64)


def shingles(texts: list[str], hashed: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``ids, counts`` of the distinct shingles, ascending within each text; ``starts`` of the
    texts in them (of texts with a word, ``present``). ``hashed``: the texts' ``word_hashes``."""
    ids, of = _cut(texts, hashed)
    keys = np.sort((of << np.uint64(_ID_BITS)) | ids)
    if not len(keys):
        return keys, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.concatenate([new, [len(keys)]]))
    keys = keys[new]
    of_key = (keys >> np.uint64(_ID_BITS)).astype(np.int64)
    present, starts = np.unique(of_key, return_index=True)
    return keys & np.uint64((1 << _ID_BITS) - 1), counts, starts, present


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Groups of rows whose texts are worked on together: about 512 KB and at most 500."""
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            few = batch.slice(first, 500)
            texts = [t or "" for t in few.column("text").to_pylist()]
            for at, part in groups(texts, 1 << 19):
                yield few.slice(at, len(part)), part


def _least(ids: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The counts less the ``size + 1``-th largest, where anything remains (Misra and Gries)."""
    if len(ids) <= size:
        return ids, n
    n = n - np.partition(n, len(n) - size - 1)[len(n) - size - 1]
    return ids[n > 0], n[n > 0]


def _summary(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For a task's texts, lower bounds of how many hold a shingle.

    At most ``size`` are kept. Each subtraction takes as much from ``size + 1`` counts at
    least, so a bound is too low by the task's shingles over ``size + 1`` at most; and by a
    fortieth of its texts for those left out at the end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (np.empty(0, np.uint64), np.empty(0, np.int64))
        held, rows, n_texts = [], 0, 0

        def add() -> tuple[np.ndarray, np.ndarray]:
            unique, n = np.unique(np.concatenate([np.empty(0, np.uint64), *held]), return_counts=True)
            both, at = np.unique(np.concatenate([kept[0], unique]), return_inverse=True)
            return _least(both, np.bincount(at, np.concatenate([kept[1], n]), len(both)).astype(np.int64), size)

        for _, texts in _texts(batches):
            held.append(shingles(texts)[0])
            rows += len(held[-1])
            n_texts += len(texts)
            if rows > max(size, 1 << 20):
                kept = add()
                held, rows = [], 0
        ids, n = add()
        few = n * 4 * FREQUENT > n_texts
        ids, n = ids[few].astype(np.int64), n[few]
        for at in range(0, len(ids), 100_000):
            yield pa.RecordBatch.from_pydict({"shingle": ids[at : at + 100_000], "least": n[at : at + 100_000]})

    return run


def candidates(texts: DataFrame) -> tuple[int, DataFrame]:
    """The number of texts, and as ``shingle`` all that a tenth of them hold, with some others.

    Bounds are too low by a fortieth of the texts twice, so sums of at least a twentieth are
    enough; and sums of that size have at most twenty times an average text's shingles.
    """
    # A text has a word in every two characters at most, and no more shingles than words.
    total, most = texts.agg(F.count("*"), F.sum((F.coalesce(F.length("text"), F.lit(0)) + 1) / 2)).first()
    size = int(4 * FREQUENT * (most or 0) / max(total, 1)) + 1
    bounds = texts.mapInArrow(_summary(size), "shingle bigint, least bigint")
    found = bounds.groupBy("shingle").agg(F.sum("least").alias("least")).filter(F.col("least") * 2 * FREQUENT >= total)
    return total, found.select("shingle")


def frequencies(docs: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of documents; and the shingles that a tenth of them hold, with theirs."""
    texts = docs.select("text")
    total, found = candidates(texts)
    wanted = np.array(sorted(r[0] for r in found.toLocalIterator()), np.uint64)
    if not len(wanted):
        return total, wanted, np.empty(0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(wanted), np.int64)
        # Most shingles are none of these, as their lowest bits tell; only the others are looked up.
        low = np.uint64((1 << TABLE_BITS) - 1)
        ends = np.zeros(1 << TABLE_BITS, bool)
        ends[(wanted & low).astype(np.int64)] = True
        for _, part in _texts(batches):
            ids, of = _cut(part)
            can = ends[(ids & low).view(np.int64)]
            ids, of = ids[can], of[can].astype(np.int64)
            at = np.minimum(np.searchsorted(wanted, ids), len(wanted) - 1)
            hit = wanted[at] == ids
            # A text counts once, however often it has the shingle.
            n += np.bincount(np.unique(of[hit] * len(wanted) + at[hit]) % len(wanted), minlength=len(wanted))
        yield pa.RecordBatch.from_pydict({"shingle": wanted.astype(np.int64), "n": n})

    counted = texts.mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = sorted(map(tuple, counted.filter(F.col("n") * FREQUENT >= total).collect()))
    return total, np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], float)


class Sampler:
    """Weights and consistent weighted samples of shingles."""

    def __init__(self, total: int, frequent: np.ndarray, holders: np.ndarray) -> None:
        self.total, self.frequent, self.holders = total, frequent, holders
        # The weight of most shingles: once in its text, and in no other.
        self.usual = float(self.idf(np.ones(1))[0])
        self.tables: list[tuple] = []

    def idf(self, held: np.ndarray) -> np.ndarray:
        return 1 + np.log10((self.total + 1) / (held + 1))

    def known(self, ids: np.ndarray) -> np.ndarray:
        """How many documents hold each shingle, of those that a tenth hold; 0 for others."""
        held = np.zeros(len(ids))
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, ids), len(self.frequent) - 1)
            hit = self.frequent[at] == ids
            held[hit] = self.holders[at[hit]]
        return held

    def weights(self, ids: np.ndarray, counts: np.ndarray, held: np.ndarray | None = None) -> np.ndarray:
        """Weights of shingles that ``held`` documents hold; without it, the frequent ones differ from the usual."""
        return counts * self.idf(np.maximum(self.known(ids), 1) if held is None else held)

    def _draw(self, r: np.ndarray, log_c: np.ndarray, beta: np.ndarray, log_weight: np.ndarray | float):
        level = np.floor(log_weight / r + beta)
        return log_c - r * (level - beta) - r, level

    def _tables(self) -> list[tuple]:
        """For each hash: a multiplier, the drawn r, log c, beta, and what the usual weight draws."""
        if not self.tables:
            random = np.random.Generator(np.random.PCG64(20240607))
            n = 1 << TABLE_BITS
            for _ in range(BANDS * ROWS):
                factor = np.uint64(int(random.integers(1 << 62)) * 2 + 1)
                r, c, beta = (x.astype(np.float32) for x in (random.gamma(2, 1, n), random.gamma(2, 1, n), random.random(n)))
                rank, level = self._draw(r, np.log(c), beta, np.float32(np.log(self.usual)))
                self.tables.append((factor, r, np.log(c), beta, rank, level.astype(np.int16)))
        return self.tables

    def bands(self, ids: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """``[texts, BANDS]`` bucket keys.

        A rank does not rise with the weight. So for shingles below the usual weight the usual rank, which is in a
        table, is a lower bound; only those whose bound is near the lowest of their text are drawn. The lowest
        rank is exact: a text where it is above what was looked at is looked at again, up to there.
        """
        sizes = np.diff(np.concatenate([starts, [len(ids)]]))
        heavy = np.flatnonzero(weights > self.usual)
        log_heavy = np.log(weights[heavy]).astype(np.float32)
        slack = SLACK if (weights < self.usual).any() else np.float32(0)
        out = np.zeros((len(starts), BANDS), np.uint64)
        with np.errstate(over="ignore"):
            mixed = _mix(ids)
            place, bound = np.empty_like(mixed), np.empty(len(ids), np.float32)
            for k, (factor, r, log_c, beta, usual_rank, usual_level) in enumerate(self._tables()):

                def drawn(chosen: np.ndarray, at: np.ndarray, usual: np.ndarray, which: int) -> np.ndarray:
                    odd = np.flatnonzero(weights[chosen] != self.usual)
                    if len(odd):
                        a = at[odd]
                        usual[odd] = self._draw(r[a], log_c[a], beta[a], np.log(weights[chosen[odd]]).astype(np.float32))[which]
                    return usual

                np.multiply(mixed, factor, out=place)
                np.right_shift(place, np.uint64(64 - TABLE_BITS), out=place)
                at = place.view(np.int64)
                np.take(usual_rank, at, out=bound, mode="clip")
                if len(heavy):
                    a = at[heavy]
                    bound[heavy] = self._draw(r[a], log_c[a], beta[a], log_heavy)[0]
                top = np.minimum.reduceat(bound, starts) + slack
                near = np.flatnonzero(bound <= np.repeat(top, sizes))
                rank = drawn(near, at[near], bound[near], 0)
                first = np.searchsorted(near, starts)
                low = np.minimum.reduceat(rank, first)
                high = np.flatnonzero(low > top)
                if len(high):
                    again = [np.flatnonzero(bound[starts[t] : starts[t] + sizes[t]] <= low[t]) + starts[t] for t in high]
                    # A place that comes twice changes nothing.
                    near = np.sort(np.concatenate([near, *again]))
                    rank = drawn(near, at[near], bound[near], 0)
                    first = np.searchsorted(near, starts)
                    low = np.minimum.reduceat(rank, first)
                # The smallest shingle among those of the lowest rank.
                lowest = near[rank == np.repeat(low, np.diff(np.concatenate([first, [len(near)]])))]
                chosen = lowest[np.searchsorted(lowest, starts)]
                level = drawn(chosen, at[chosen], usual_level[at[chosen]].astype(np.int64), 1)
                sample = _mix(ids[chosen] * np.uint64(31) + level.astype(np.uint64))
                band = k // ROWS
                out[:, band] = _mix(out[:, band] * np.uint64(0x9E3779B97F4A7C15) + sample + np.uint64(band + 1))
        return out


def plain_bands(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``[texts, BANDS]`` bucket keys without weights: two texts have the same lowest shingle with a probability
    equal to the Jaccard similarity of their sets of shingles."""
    random = np.random.Generator(np.random.PCG64(20240608))
    factors = random.integers(1 << 31, size=BANDS * ROWS).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    out = np.zeros((len(starts), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        mixed = (_mix(ids) >> np.uint64(32)).astype(np.uint32)
        hashes = np.empty_like(mixed)
        for k, factor in enumerate(factors):
            np.multiply(mixed, factor, out=hashes)
            low = np.minimum.reduceat(hashes, starts).astype(np.uint64)
            band = k // ROWS
            out[:, band] = _mix(out[:, band] * np.uint64(0x9E3779B97F4A7C15) + low + np.uint64(BANDS + band + 1))
    return out


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, their low bytes first and compressed: small numbers cost what they need."""
    return zlib.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def _nodes(texts: list[str], hashed: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """The hash of each text's words in order; 0 without a word. ``hashed``: the texts' ``word_hashes``."""
    words, owner = hashed or word_hashes(texts)
    node = np.zeros(len(texts), np.uint64)
    if len(words):
        with np.errstate(over="ignore"):
            place = np.arange(len(words), dtype=np.uint64) - np.searchsorted(owner, owner).astype(np.uint64)
            parts = _mix(words + _mix(place + np.uint64(1)))
            holders, starts = np.unique(owner, return_index=True)
            node[holders] = _mix(np.add.reduceat(parts, starts))
    return node


def _asked(sampler: Sampler, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each portion a row for each shard that it asks (``key`` is below 0), and one with its documents
    (``key`` is its number)."""
    names = ("key", "portion", "shard", "ids", "n", "doc_id", "text_hash", "length", "texts")

    def portion(number: int, docs: list[tuple], ids: np.ndarray) -> Iterator[tuple]:
        doc_id, text_hash, texts = zip(*docs, strict=True)
        raw = [t.encode() for t in texts]
        data = _codec().compress(b"".join(raw), asbytes=True)
        yield (number, number, None, None, None, list(doc_id), list(text_hash), [len(r) for r in raw], data)
        ids, n = np.unique(ids, return_counts=True)
        rare = sampler.known(ids) == 0
        ids, n = ids[rare], n[rare]
        shard = (ids >> np.uint64(_ID_BITS - bits)).astype(np.int64)
        edges = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(ids)] if len(ids) else []
        for start, end in zip(edges, edges[1:], strict=False):
            of = int(shard[start])
            gaps = np.diff(ids[start:end], prepend=np.uint64(of << (_ID_BITS - bits)))
            yield (-1 - of, number, of, _packed(gaps), _packed(n[start:end]), None, None, None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        docs: list[tuple] = []
        held: list[np.ndarray] = []

        def flush(id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(id_type), *[pa.list_(pa.int64())] * 2, pa.binary())
            rows = list(portion(number, docs, np.concatenate(held)))
            for few in (rows[at : at + 64] for at in range(0, len(rows), 64)):
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*few, strict=True), types, strict=True)], names=names)

        for rows, texts in _texts(batches):
            docs += zip(rows.column("doc_id").to_pylist(), rows.column("text_hash").to_pylist(), texts, strict=True)
            held.append(shingles(texts)[0])
            if sum(map(len, held)) >= PORTION or len(docs) >= PORTION:
                yield from flush(rows.column("doc_id").type)
                docs, held, number = [], [], number + 1
        if docs:
            yield from flush(rows.column("doc_id").type)

    return run


def _answers(asked: pa.Table) -> pa.Table:
    """A shard's answers: for each portion, how many documents hold each shingle it asked for."""
    asks = asked.filter(asked.column("shard").is_valid())
    # Places within the shard, which tell its shingles apart.
    ids = [np.cumsum(_unpacked(data)) for data in asks.column("ids").to_pylist()]
    answers = []
    if ids:
        known, at = np.unique(np.concatenate(ids), return_inverse=True)
        n = np.concatenate([_unpacked(data) for data in asks.column("n").to_pylist()])
        held = np.bincount(at, n, len(known)).astype(np.uint64)[at]
        answers = [_packed(part) for part in np.split(held, np.cumsum([len(x) for x in ids])[:-1])]
    return pa.table([asks.column("portion"), asks.column("shard"), pa.array(answers, pa.binary())], names=["key", "shard", "held"])


def _sampled(sampler: Sampler) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A portion's documents with their bands of both kinds and, packed, how many documents hold each of their shingles."""

    def run(asked: pa.Table, answers: pa.Table) -> pa.Table:
        own = asked.filter(asked.column("shard").is_null())
        doc_id, text_hash, node, bands, plain, held = [], [], [], [], [], []
        for row in own.to_pylist():
            doc_id, text_hash = row["doc_id"], row["text_hash"]
            ends = np.cumsum([0, *row["length"]]).tolist()
            raw = _codec().decompress(row["texts"], ends[-1], asbytes=True)
            texts = [raw[start:end].decode() for start, end in zip(ends, ends[1:], strict=False)]
            parts = [part for first in range(0, len(texts), 500) for _, part in groups(texts[first : first + 500], 1 << 19)]
            hashed = [word_hashes(part) for part in parts]
            cut = [shingles(part, words) for part, words in zip(parts, hashed, strict=True)]
            # The place of each shingle among all; looking them up one by one takes ten times as long.
            ids, places = np.unique(np.concatenate([c[0] for c in cut]), return_inverse=True)
            holders = sampler.known(ids)
            told = [_unpacked(data) for data in answers.sort_by("shard").column("held").to_pylist()]
            told = np.concatenate([np.empty(0, np.uint64), *told])
            if len(told) != np.count_nonzero(holders == 0):
                raise ValueError("a portion of texts was not the same when it was read again")
            holders[holders == 0] = told
            ends = np.cumsum([len(c[0]) for c in cut])[:-1]
            for part, words, (own_ids, counts, starts, present), own_held in zip(parts, hashed, cut, np.split(holders[places], ends), strict=True):
                node += _nodes(part, words).astype(np.int64).tolist()
                keys: list = [[] for _ in part]
                plain_keys: list = [[] for _ in part]
                packed = [_packed(told[:0])] * len(part)
                if len(own_ids):
                    made = sampler.bands(own_ids, sampler.weights(own_ids, counts, own_held), starts).astype(np.int64)
                    other = plain_bands(own_ids, starts).astype(np.int64)
                    for text, of_text, of_set, row_held in zip(present.tolist(), made.tolist(), other.tolist(), np.split(own_held, starts[1:]), strict=True):
                        keys[text], plain_keys[text], packed[text] = of_text, of_set, _packed(row_held)
                bands += keys
                plain += plain_keys
                held += packed
        return pa.table(
            [pa.array(doc_id, asked.schema.field("doc_id").type.value_type), pa.array(text_hash, pa.int64()), pa.array(node, pa.int64()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(plain, pa.list_(pa.int64())), pa.array(held, pa.binary())],
            names=["doc_id", "text_hash", "node", "bands", "plain", "held"],
        )

    return run


def _sketches(docs: DataFrame, sampler: Sampler) -> DataFrame:
    """``doc_id, text_hash, node, bands, plain, held`` of every document; empty bands without a word. ``plain`` are the
    bands without weights; ``held`` is how many documents hold each of its shingles, in their order, packed."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = (chars // SHARD_CHARS).bit_length()
    asked = docs.mapInArrow(
        _asked(sampler, bits),
        "key bigint, portion bigint, shard int, ids binary, n binary, "
        f"doc_id array<{id_type}>, text_hash array<bigint>, length array<bigint>, texts binary",
    )
    # Sampling takes far longer than reading its few bytes: tasks follow the characters.
    asked = asked.repartition(1 + chars // TASK_CHARS, "key")
    # One shuffle by key serves both: shards get what they are asked, portions wait there for the answers.
    answered = asked.groupBy("key").applyInArrow(_answers, "key bigint, shard int, held binary")
    both = asked.groupBy("key").cogroup(answered.groupBy("key"))
    return both.applyInArrow(_sampled(sampler), f"doc_id {id_type}, text_hash bigint, node bigint, bands array<bigint>, plain array<bigint>, held binary")


def _weights(texts: DataFrame, sampler: Sampler) -> DataFrame:
    """``node, info``: each text's weight, and that of its shingles that another text here has too; ``n, n_shared``: the
    numbers of these; ``parts``: the latter by classes of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, part in _texts(batches):
            ids, counts, starts, present = shingles(part)
            if len(ids):
                held = np.concatenate([_unpacked(h) for h in rows.column("held").to_pylist()]).astype(float)
                sizes = np.diff(np.concatenate([starts, [len(ids)]]))
                nodes = np.repeat(rows.column("node").to_numpy()[present], sizes)
                weights = sampler.weights(ids, counts, held)
                yield pa.RecordBatch.from_pydict({"shingle": ids.astype(np.int64), "node": nodes, "weight": weights})

    rows = texts.select("node", "text", "held").mapInArrow(run, "shingle bigint, node bigint, weight double")

    def by_class(name: str) -> list[Column]:
        of = F.col("shingle").bitwiseAND(CLASSES - 1)
        return [F.count_if(of == k).alias(f"{name}_{k}") for k in range(CLASSES)]

    whole = rows.groupBy("node").agg(F.sum("weight").alias("weight"), F.count("*").alias("n"), *by_class("all"))
    single = rows.groupBy("shingle").agg(F.count("*").alias("holders"), F.min("node").alias("node"), F.max("weight").alias("weight"))
    own = single.filter("holders = 1").groupBy("node").agg(F.sum("weight").alias("own"), F.count("*").alias("n_own"), *by_class("own"))
    shared = F.col("weight") - F.coalesce("own", F.lit(0.0))
    n_shared = F.col("n") - F.coalesce("n_own", F.lit(0))
    parts = F.array(*[F.col(f"all_{k}") - F.coalesce(f"own_{k}", F.lit(0)) for k in range(CLASSES)])
    info = F.struct("weight", shared.alias("shared"), "n", n_shared.alias("n_shared"), parts.alias("parts"))
    return whole.join(own, "node", "left").select("node", info.alias("info"))


def _can_be_similar(x: Column, y: Column) -> Column:
    """Two texts have no more in common than either shares with any text at all, by weight or by number, and that in each
    class of shingles. So copies with too many edits of their own need no comparison, and no link is lost."""

    def enough(common: Column, whole: str) -> Column:
        return common >= THRESHOLD / (1 + THRESHOLD) * (x[whole] + y[whole]) * (1 - 1e-9)

    by_weight = enough(F.least(x["shared"], y["shared"]), "weight")
    by_class = F.aggregate(F.zip_with(x["parts"], y["parts"], lambda p, q: F.least(p, q)), F.lit(0).cast("bigint"), lambda total, least: total + least)
    return by_weight | (enough(F.least(x["n_shared"], y["n_shared"]), "n") & enough(by_class, "n"))


def _has_similar(x: Column) -> Column:
    """Whether a text can be similar to any at all: what two similar texts have in common is at least
    ``THRESHOLD`` of either, by weight or by number. A text of which less is shared keeps buckets open for no link."""
    return (x["shared"] >= THRESHOLD * x["weight"] * (1 - 1e-9)) | (x["n_shared"] >= THRESHOLD * x["n"] * (1 - 1e-9))


def _verifier(texts: DataFrame, sampler: Sampler):
    """Keeps the pairs whose texts have a Jaccard similarity of ``THRESHOLD``, by weights or as sets of shingles."""

    def alike(common: float, both: float) -> bool:
        return common >= THRESHOLD * (both - common) - 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple] = {}
        held = 0

        def vector(node: int, text: str, holders: bytes) -> tuple:
            nonlocal held
            if node not in known:
                if held > 1_000_000:
                    known.clear()
                    held = 0
                ids, counts, _, _ = shingles([text])
                held += len(ids)
                weights = sampler.weights(ids, counts, _unpacked(holders).astype(float))
                known[node] = ids, weights, weights.sum()
            return known[node]

        for batch in (b.slice(at, 200) for b in batches for at in range(0, b.num_rows, 200)):
            similar = []
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b", "held_a", "held_b")]
            for a, b, text_a, text_b, held_a, held_b in zip(*columns, strict=True):
                (ids, w, total), (other, v, rest) = vector(a, text_a, held_a), vector(b, text_b, held_b)
                _, i, j = np.intersect1d(ids, other, assume_unique=True, return_indices=True)
                similar.append(alike(np.minimum(w[i], v[j]).sum(), total + rest) or alike(len(i), len(ids) + len(other)))
            yield batch.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

    def verify(pairs: DataFrame) -> DataFrame:
        # Later turns compare few texts: the others are not shuffled again.
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        few = nodes.count() <= BROADCAST_NODES
        wanted = texts.join(F.broadcast(nodes), "node", "left_semi") if few else texts
        first = wanted.select(F.col("node").alias("a"), F.col("text").alias("text_a"), F.col("held").alias("held_a"))
        second = wanted.select(F.col("node").alias("b"), F.col("text").alias("text_b"), F.col("held").alias("held_b"))
        return pairs.join(first, "a").join(second, "b").mapInArrow(run, "a bigint, b bigint")

    return verify


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, class_id, class_size``, one row per document.

    ``class_id`` is the smallest ``doc_id`` of the documents connected by similarity.
    """
    docs = docs.select("doc_id", text_of().alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    sampler = Sampler(*frequencies(docs))
    sketches = _sketches(docs, sampler).checkpoint()
    members = shared_buckets(
        sketches.groupBy("node").agg(F.first(F.concat("bands", "plain")).alias("bands")).select("node", F.explode(F.array_distinct("bands")).alias("bucket"))
    ).checkpoint()
    # One text for each node in a shared bucket, looked up by its hash.
    wanted = members.select("node").distinct().join(sketches.groupBy("node").agg(F.min("text_hash").alias("text_hash")), "node")
    wanted = wanted.checkpoint()
    if wanted.count() <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)
    held = sketches.join(wanted.select("node"), "node").groupBy("node").agg(F.first("held").alias("held"))
    texts = docs.select("text", "text_hash").join(wanted, "text_hash").groupBy("node").agg(F.min("text").alias("text"))
    texts = texts.join(held, "node").checkpoint()
    members = members.join(_weights(texts, sampler), "node").filter(_has_similar(F.col("info"))).checkpoint()
    roots = group(members, _verifier(texts, sampler), bound=_can_be_similar)
    labelled = sketches.select("doc_id", "text_hash", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = labelled.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")
    )
    return labelled.join(classes, "root").select("doc_id", "text_hash", "class_id", "class_size", "root")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, the one of the smallest id, with all its columns."""
    classes = near_duplicates(docs)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = classes.groupBy("root").agg(F.min(key).alias("k")).select(F.col("k.doc_id").alias("id"), F.col("k.text_hash").alias("hash"))
    rows = as_row(docs, doc_id=F.col("doc_id"), text_hash=F.xxhash64(text_of()))
    found = rows.join(kept, rows["doc_id"].eqNullSafe(kept["id"]) & (rows["text_hash"] == kept["hash"]))
    # Repeated rows of the kept document: one of them.
    return found.dropDuplicates(["id", "hash"]).select("row.*")
