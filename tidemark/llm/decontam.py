"""Benchmark decontamination by the CGK embedding and bit-sampling LSH.

Texts are normalised to lower-case words between single spaces. Windows of 40 bytes are
taken from every word of each benchmark item, and from a word in every 24 bytes of each document,
so a passage of 75 bytes or more holds a whole window at a word the item has too.

CGK: a walk reads a window byte by byte; after each step a random bit, fixed for the step and
the byte read, says whether it moves on. Two windows a few edits apart fall into step again, so
their walks differ in few places: edit distance becomes Hamming distance. Of each of 2 walks, 4
samples of 14 steps are hashed; windows that agree in a sample are candidates. Each candidate is verified
exactly: the item's smallest edit distance to any part of the document around the window is
at most 15 % of the item.

A passage has several windows, so with one byte in ten edited more than nine of ten
passages of 150 bytes or more are found (measured in the tests); unedited ones always are.
Items shorter than 75 bytes are searched for exactly, as whole words; items without a word match nothing.

The benchmark is the stated query set: it goes to all tasks in blocks of bounded size, and
all documents are read against each block. Nothing of the documents is shuffled.

Defined results: a missing text counts as empty and matches nothing; repeated rows are
judged alike; equal items each match; an empty table of documents or items gives no match;
operators that return documents return all their columns, whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import as_row, groups, text_of
from tidemark.llm.icws import _WORD

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, STRIDE, STEPS = 40, 24, 80
WALKS, SAMPLES, PLACES = 2, 4, 14
SHORTEST = 75
MAX_EDITS = 0.15
# Bytes of benchmark text that are searched for in one pass over the documents.
BLOCK_BYTES = 4 << 20
FILTER_BITS = 22


def normalise(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words between single spaces, one text after the other, each ended by a
    space; and where each text begins, with the end of all."""
    parts = [b" " + t.lower().encode() + b" " for t in texts]
    raw = np.frombuffer(b"".join(parts), np.uint8)
    inside = _WORD[raw]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    place = np.concatenate([[0], np.cumsum(keep)])
    ends = np.cumsum([0] + [len(p) for p in parts])
    return np.where(inside, raw, 32)[keep].astype(np.uint8), place[ends]


def _word_starts(text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    starts = np.flatnonzero(text[:-1] == 32) + 1 if len(text) else np.empty(0, np.int64)
    first = bounds[:-1][np.diff(bounds) > 0]
    return np.unique(np.concatenate([first, starts[starts < len(text)]])).astype(np.int64)


class Embedding:
    """The random bits and sampled steps, the same everywhere."""

    def __init__(self) -> None:
        random = np.random.Generator(np.random.PCG64(31415926))
        self.moves = random.integers(0, 2, (WALKS, STEPS, 256)).astype(np.int64)
        self.sampled = [
            [frozenset(random.choice(STEPS, PLACES, replace=False).tolist()) for _ in range(SAMPLES)] for _ in range(WALKS)
        ]

    def hashes(self, text: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """For each sample, a 64-bit hash of the sampled steps of the walk from each start."""
        padded = np.concatenate([text, np.zeros(STEPS + 1, np.uint8)])
        ends = starts + WINDOW
        out = []
        with np.errstate(over="ignore"):
            for walk in range(WALKS):
                at = starts.copy()
                sums = [np.full(len(starts), walk * SAMPLES + s + 1, np.uint64) for s in range(SAMPLES)]
                for step in range(STEPS):
                    seen = padded[at]
                    seen[at >= ends] = 0
                    for s in range(SAMPLES):
                        if step in self.sampled[walk][s]:
                            sums[s] = sums[s] * np.uint64(0x9E3779B97F4A7C15) + seen
                    at += self.moves[walk, step][seen]
                out += [s ^ (s >> np.uint64(29)) for s in sums]
        return out


class Items:
    """A block of benchmark items, ready to be searched for."""

    def __init__(self, items: list[tuple[object, str]]) -> None:
        text, bounds = normalise([t or "" for _, t in items])
        # Without the space that ends each.
        self.texts = [text[a : max(a, b - 1)].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
        self.ids = [number for number, _ in items]
        self.short = [i for i, t in enumerate(self.texts) if 0 < len(t) < SHORTEST]
        owner, offset, starts = [], [], []
        for i, (a, t) in enumerate(zip(bounds, self.texts, strict=False)):
            if len(t) >= SHORTEST:
                own = _word_starts(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
                own = own[own + WINDOW <= len(t)]
                owner += [i] * len(own)
                offset += own.tolist()
                starts += (own + a).tolist()
        self.owner, self.offset = np.array(owner, np.int64), np.array(offset, np.int64)
        keys = Embedding().hashes(text, np.array(starts, np.int64))
        self.order = [np.argsort(k, kind="stable") for k in keys]
        self.keys = [k[o] for k, o in zip(keys, self.order, strict=True)]


def _letters(item: bytes) -> dict[int, int]:
    masks: dict[int, int] = {}
    for at, byte in enumerate(item):
        masks[byte] = masks.get(byte, 0) | 1 << at
    return masks


def smallest_distance(masks: dict[int, int], length: int, text: bytes) -> int:
    """The item's smallest edit distance to any part of ``text``, bit-parallel over the item."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best = length
    for byte in text:
        equal = masks.get(byte, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | (~(across | plus) & full), plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best = score
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | (~(vertical | up) & full), up & vertical
    return best


class Searcher:
    """Finds items of a block in texts."""

    def __init__(self, items: Items) -> None:
        self.items, self.embedding = items, Embedding()
        self.masks = [_letters(t) for t in items.texts]
        mask = np.uint64((1 << FILTER_BITS) - 1)
        self.filters = []
        for keys in items.keys:
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[(keys & mask).astype(np.int64)] = True
            self.filters.append(seen)
        self.mask = mask
        self.exact = None
        if items.short:
            import ahocorasick

            self.exact = ahocorasick.Automaton()
            by_text: dict[str, list[int]] = {}
            for i in items.short:
                by_text.setdefault(f" {items.texts[i].decode('latin-1')} ", []).append(i)
            for text, own in by_text.items():
                self.exact.add_word(text, own)
            self.exact.make_automaton()

    def search(self, texts: list[str]) -> list[dict[int, int]]:
        """For each text, the items found in it with their edit distances."""
        text, bounds = normalise(texts)
        found: list[dict[int, int]] = [{} for _ in texts]
        if self.exact is not None:
            for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                for _, own in self.exact.iter(" " + text[a:b].tobytes().decode("latin-1")):
                    found[i].update(dict.fromkeys(own, 0))
        if not len(self.items.owner) or not len(text):
            return found
        starts = _word_starts(text, bounds)
        of = np.searchsorted(bounds, starts, side="right") - 1
        slot = (starts - bounds[of]) // STRIDE
        first = np.concatenate([[True], (of[1:] != of[:-1]) | (slot[1:] != slot[:-1])])
        usable = first & (starts + WINDOW <= bounds[of + 1])
        starts, of = starts[usable], of[usable]
        candidates: set[tuple[int, int, int]] = set()
        for keys, order, seen, own in zip(self.embedding.hashes(text, starts), self.items.order, self.filters, self.items.keys, strict=True):
            hits = np.flatnonzero(seen[(keys & self.mask).astype(np.int64)])
            low, high = np.searchsorted(own, keys[hits], side="left"), np.searchsorted(own, keys[hits], side="right")
            for hit, a, b in zip(hits[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist(), strict=True):
                windows = order[a:b]
                begin = starts[hit] - bounds[of[hit]] - self.items.offset[windows]
                # Alignments a few bytes apart are verified as one.
                candidates.update(zip([int(of[hit])] * len(windows), self.items.owner[windows].tolist(), (begin // 16).tolist(), strict=True))
        for i, item, place in sorted(candidates):
            length = len(self.items.texts[item])
            allowed = int(length * MAX_EDITS)
            begin = place * 16 - allowed
            part = text[bounds[i] + max(0, begin) : min(bounds[i + 1], bounds[i] + max(0, begin + length + 3 * allowed + 16))]
            distance = smallest_distance(self.masks[item], length, part.tobytes())
            if distance <= allowed:
                found[i][item] = min(distance, found[i].get(item, distance))
        return found


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of at most ``BLOCK_BYTES`` of text (one longer item is a block)."""
    held, size = [], 0
    for row in benchmark.select("item_id", text_of().alias("text")).orderBy("item_id", "text").toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1].encode())
        if size >= BLOCK_BYTES:
            yield Items(held)
            held, size = [], 0
    if held:
        yield Items(held)


def _search_rows(docs: DataFrame, column: str, items: Items) -> DataFrame:
    """``docs`` (``column``, ``text``) with ``found``, an array of items and distances."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    schema = T.StructType(
        [docs.schema[column], T.StructField("found", T.ArrayType(T.StructType([T.StructField("item", T.IntegerType()), T.StructField("edits", T.IntegerType())])))]
    )
    kind = pa.list_(pa.struct([("item", pa.int32()), ("edits", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(shared.value)
        for batch in batches:
            for at, texts in groups(batch.column("text").to_pylist()):
                found = [[{"item": i, "edits": e} for i, e in sorted(f.items())] for f in searcher.search(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(column).slice(at, len(texts)), pa.array(found, kind)], names=[column, "found"])

    return docs.select(column, "text").mapInArrow(run, schema)


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, edits`` for every document and item found in it."""
    plain = docs.select("doc_id", text_of().alias("text"))
    out = None
    for items in item_blocks(benchmark):
        found = _search_rows(plain, "doc_id", items).select("doc_id", F.inline("found"))
        names = docs.sparkSession.createDataFrame(list(enumerate(items.ids)), T.StructType([T.StructField("item", T.IntegerType()), benchmark.schema["item_id"]]))
        found = found.join(F.broadcast(names), "item").select("doc_id", "item_id", F.col("edits").cast("bigint").alias("edits"))
        out = found if out is None else out.union(found)
    if out is None:
        schema = T.StructType([docs.schema["doc_id"], benchmark.schema["item_id"], T.StructField("edits", T.LongType())])
        out = docs.sparkSession.createDataFrame([], schema)
    return out


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    for items in item_blocks(benchmark):
        rows = as_row(docs, text=text_of())
        docs = _search_rows(rows, "row", items).filter(F.size("found") == 0).select("row.*")
    return docs
