"""Byte-pair encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes cuts texts into chunks where their content says so, so
passages that documents share give the same chunks wherever they stand. Each distinct
chunk of a batch is encoded once and kept for later documents of the task. Chunks are
cut anywhere between characters, so tokens near a cut can be wrong: each join is
repaired by encoding anew the text between the nearest *firm* places around the cut,
and the repair is taken only if both neighbours have a token boundary exactly there; else
it is widened to the next firm place. A place is firm where a letter, digit or mark is followed by a
space and another such character: the vocabulary's own splitting always cuts there,
whatever stands further away.

Reuse is per task: exchanging chunks and identifiers between tasks would move more bytes
than the whole input has, and encoding a chunk twice costs less than that.

Defined results: a missing text counts as empty, has no tokens and decodes to the empty
text; whole texts of any length; special strings inside texts become their own token, as
the library has it; repeated rows are encoded alike; an empty table gives an empty table;
operators that return the input's columns keep them whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import as_row, groups, text_of
from tidemark.llm.tokencount import byte_letters

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A chunk has 1,024 bytes on average; the hash sees the last 16 of them.
CHUNK_BITS, WINDOW = 10, 16
# Bytes of text and tokens a task keeps for reuse before it starts afresh.
CACHE_BYTES = 32 << 20
# A firm place lies before the space: neither side is white space, and the first is one byte long.
FIRM = re.compile(rb"(?<=[!-&(-~])\x20(?=[!-&(-~])")


# How this kind of vocabulary splits a text into words, and the characters
# for which every table of letters says the same.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
COMMON = r"[\t-\r\x20-\x7e¡-¬®-ſ‐-‧‰-⁞€]*+"
CACHED_WORDS = 500_000


def _gear() -> np.ndarray:
    """One fixed 32-bit number per byte value, from a mixing rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def cuts(data: bytes) -> list[int]:
    """Content-defined places to cut at, between characters, first and last excluded."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) <= WINDOW:
        return []
    gear = _gear()[raw]
    rolled = gear.copy()
    for back in range(1, WINDOW):
        rolled[back:] += gear[:-back] << np.uint32(2 * back)
    # The cut comes after the byte that completes the window, before the next character's first byte.
    hit = np.flatnonzero(rolled[WINDOW - 1 : -1] >> np.uint32(32 - CHUNK_BITS) == 0) + WINDOW
    return hit[(raw[hit] & 0xC0) != 0x80].tolist()


def _firm_from_end(data: bytes, start: int, end: int) -> Iterator[int]:
    """The firm places of a stretch, the last first, looking no further back than asked for."""
    seen = end
    while start < end:
        low = max(start, end - 200)
        yield from reversed([m.start() for m in FIRM.finditer(data, low, seen)])
        # The next place must show the character after its space, which may be at ``low``.
        end, seen = low, low + 1


class Words(dict):
    """The identifiers of single words as bytes, each encoded by the library's model when first met."""

    def __init__(self, library) -> None:
        super().__init__()
        self.model = library.model
        self.letters = dict(enumerate(byte_letters()))

    def __missing__(self, word: str) -> bytes:
        tokens = self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))
        ids = self[word] = array("i", [t.id for t in tokens]).tobytes()
        return ids


class Codec:
    """Encodes and decodes with one vocabulary, reusing chunks."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        letters = {letter: byte for byte, letter in enumerate(byte_letters())}
        size = max([*spec["model"]["vocab"].values(), *self.special.values()]) + 1
        self.pieces = [b""] * size
        for piece, number in spec["model"]["vocab"].items():
            self.pieces[number] = bytes(letters[c] for c in piece)
        for piece, number in self.special.items():
            self.pieces[number] = piece.encode()
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.decimal = [str(n) for n in range(size)]
        self.split, self.common = regex.compile(WORDS), regex.compile(COMMON)
        self.words = Words(self.library)
        self.cache: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        self.held = 0

    def _encode_plain(self, parts: list[bytes]) -> list[np.ndarray]:
        """Chunks that are encoded for the first time: by the vocabulary's own splitting into
        words, each distinct word by the library. Chunks with characters beyond the Latin and
        common punctuation blocks go to the library whole, since tables of letters differ."""
        made: list[np.ndarray] = []
        for _, few in groups(parts, 1 << 19):
            texts = [p.decode() for p in few]
            if len(self.words) > CACHED_WORDS:
                self.words.clear()
            for text in texts:
                if self.common.fullmatch(text):
                    joined = b"".join(map(self.words.__getitem__, self.split.findall(text)))
                    made.append(np.frombuffer(joined, np.int32))
                else:
                    made.append(np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32))
        return made

    def _learn(self, chunks: set[bytes]) -> None:
        """Encode the chunks not yet known; keep identifiers and where each token ends."""
        new = [c for c in chunks if c not in self.cache]
        for chunk, ids in zip(new, self._encode_plain(new), strict=True):
            self.cache[chunk] = (ids, np.cumsum(self.lengths[ids]))
            self.held += len(chunk) + 12 * len(ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The identifiers of every text."""
        if self.held > CACHE_BYTES:
            self.cache.clear()
            self.held = 0
        # Special strings are tokens of their own; what lies between them is cut into chunks.
        layout: list[list[int | tuple[bytes, list[int]]]] = []
        for text in texts:
            parts = self.special_pattern.split(text) if self.special_pattern else [text]
            row: list = []
            for at, part in enumerate(parts):
                if at % 2:
                    row.append(self.special[part])
                elif part:
                    data = part.encode()
                    row.append((data, [0, *cuts(data), len(data)]))
            layout.append(row)
        spans = [part for row in layout for part in row if isinstance(part, tuple)]
        self._learn({data[a:b] for data, at in spans for a, b in zip(at, at[1:], strict=False)})
        plans = [self._plan(data, at) for data, at in spans]
        windows = list(dict.fromkeys(w for plan in plans for w in plan if isinstance(w, bytes)))
        repaired = dict(zip(windows, self._encode_plain(windows), strict=True))
        joined = iter(
            np.concatenate([repaired[p] if isinstance(p, bytes) else p for p in plan] or [np.empty(0, np.int32)])
            for plan in plans
        )
        return [
            np.concatenate([next(joined) if isinstance(p, tuple) else np.array([p], np.int32) for p in row])
            if row
            else np.empty(0, np.int32)
            for row in layout
        ]

    def _plan(self, data: bytes, at: list[int]) -> list[np.ndarray | bytes]:
        """Stretches of chunk tokens and, for each join, the bytes to encode anew.

        A stretch runs from where the repair before it ends to where the next one begins,
        and is kept only if the chunk has token boundaries at both.
        """
        plan: list[np.ndarray | bytes] = []
        open_from = 0  # where the text not yet planned begins
        for a, b in zip(at, at[1:], strict=False):
            ids, ends = self.cache[data[a:b]]
            starts = chain([a] if a == 0 else [], (m.start() for m in FIRM.finditer(data, a + 1, b)))
            stops = chain([b] if b == len(data) else [], _firm_from_end(data, a + 1, b))
            first = next((p for p in starts if self._boundary(ends, p - a)), None)
            last = next((p for p in stops if self._boundary(ends, p - a)), None)
            if first is None or last is None or first >= last:
                continue
            if first > open_from:
                plan.append(data[open_from:first])
            i = 0 if first == a else int(np.searchsorted(ends, first - a)) + 1
            plan.append(ids[i : int(np.searchsorted(ends, last - a)) + 1])
            open_from = last
        if open_from < len(data):
            plan.append(data[open_from:])
        return plan

    @staticmethod
    def _boundary(ends: np.ndarray, place: int) -> bool:
        if place == 0:
            return True
        at = int(np.searchsorted(ends, place))
        return at < len(ends) and ends[at] == place

    def decode(self, ids: np.ndarray) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in ids.tolist()])

    def join(self, ids: np.ndarray) -> str:
        decimal = self.decimal
        return ",".join([decimal[i] for i in ids.tolist()])


def decoded_text(data: bytes) -> str:
    """Bytes as text; a broken character becomes U+FFFD, as the library's decoder has it."""
    return data.decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, digests: bool = True) -> DataFrame:
    """``row`` (the input's columns), ``n_tokens``, and digests or ``ids`` and ``decoded``.

    ``ids_sha256`` is over the decimal identifiers joined by commas, ``decoded_sha256`` over
    the text decoded from them. With ``digests=False`` the identifiers and the decoded text
    themselves.
    """
    rows = as_row(docs, text=text_of())
    extra = (
        [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
        if digests
        else [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    )
    schema = T.StructType([rows.schema["row"], T.StructField("n_tokens", T.LongType()), *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            for at, group in groups(batch.column("text").to_pylist()):
                tokens = codec.encode(group)
                texts = [decoded_text(codec.decode(ids)) for ids in tokens]
                if digests:
                    first = pa.array([hashlib.sha256(codec.join(ids).encode()).hexdigest() for ids in tokens], pa.string())
                    second = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())
                else:
                    first, second = pa.array(tokens, pa.list_(pa.int32())), pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(at, len(group)), pa.array([len(ids) for ids in tokens], pa.int64()), first, second],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)


def digests_by_id(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``; no other column reaches the tasks."""
    return encode(docs.select("doc_id", "text").withColumn("text", text_of()), path).select(
        F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256"
    )


def with_tokens(docs: DataFrame, path: str) -> DataFrame:
    """The documents with ``n_tokens``, ``ids`` and ``round_trip``; columns of these names are replaced."""
    made = encode(docs, path, digests=False)
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in ("n_tokens", "ids", "round_trip")]
    return made.select(*own, "n_tokens", "ids", (F.col("decoded") == F.coalesce("row.text", F.lit(""))).alias("round_trip"))
