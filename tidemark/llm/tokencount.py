"""Token counts of a byte-pair vocabulary with word ends, without making identifiers.

A text is normalised and cut into words as the tokenizer file says. Each word starts as a
linked list of its bytes (the last one marked as the word's end); a heap holds the ranks
of adjacent pairs, and the pair of the lowest rank is merged again and again. A word
counts its initial symbols less its merges, and no token is ever looked up.

Defined results: a missing text counts as empty and has 0 tokens; texts are never cut, and
a word of any length costs n log n; repeated rows count alike; an empty table gives an
empty table; other columns of the input do not take part.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CACHED_WORDS = 400_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary files of this kind."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class MergeCounter:
    """Counts the tokens of one word by its merges."""

    def __init__(self, merges: list[tuple[str, str]], word_end: str) -> None:
        names: dict[str, int] = {}

        def number(name: str) -> int:
            return names.setdefault(name, len(names))

        letters = byte_letters()
        self.inner = [number(c) for c in letters]
        self.final = [number(c + word_end) for c in letters]
        self.ranks = {(number(a), number(b)): (rank, number(a + b)) for rank, (a, b) in enumerate(merges)}

    def count(self, word: bytes) -> int:
        symbols = [self.inner[b] for b in word]
        symbols[-1] = self.final[word[-1]]
        n = len(symbols)
        ranks = self.ranks
        heap = []
        for at in range(n - 1):
            found = ranks.get((symbols[at], symbols[at + 1]))
            if found:
                heap.append((found[0], at, found[1]))
        if not heap:
            return n
        heapq.heapify(heap)
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            rank, left, merged = heapq.heappop(heap)
            # An entry is stale if either symbol has changed since.
            right = following[left]
            if symbols[left] < 0 or right >= n or ranks.get((symbols[left], symbols[right])) != (rank, merged):
                continue
            merges += 1
            symbols[left], symbols[right] = merged, -1
            after = following[left] = following[right]
            if after < n:
                previous[after] = left
                found = ranks.get((merged, symbols[after]))
                if found:
                    heapq.heappush(heap, (found[0], left, found[1]))
            before = previous[left]
            if before >= 0:
                found = ranks.get((symbols[before], merged))
                if found:
                    heapq.heappush(heap, (found[0], before, found[1]))
        return n - merges


def make_counter(path: str) -> Callable[[str], int]:
    """``count(text)`` for a vocabulary file with word ends, as its library counts.

    Text outside the Latin and common punctuation blocks is normalised and cut by the
    library's own parts, since tables of letters differ between versions of Unicode.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    counter = MergeCounter(merges, model["end_of_word_suffix"] or "")
    library = Tokenizer.from_file(path)
    letters = {letter: byte for byte, letter in enumerate(byte_letters())}
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    pattern = regex.compile(split["pattern"]["Regex"])
    special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
    common = regex.compile(r"[\t-\r\x20-\x7e¡-¬®-ſ‐-‧‰-⁞€]*+")
    cache: dict[str, int] = {}

    def of_word(word: str) -> int:
        n = cache[word] = counter.count(word.encode())
        return n

    def pieces(text: str) -> Iterator[int]:
        if common.fullmatch(text):
            text = unicodedata.normalize("NFC", text).lower()
            for word in pattern.findall(text):
                yield cache.get(word) or of_word(word)
        else:
            text = library.normalizer.normalize_str(text)
            for word, _ in library.pre_tokenizer.pre_tokenize_str(text):
                word = bytes(letters[c] for c in word).decode()
                yield cache.get(word) or of_word(word)

    def count(text: str) -> int:
        if len(cache) > CACHED_WORDS:
            cache.clear()
        marks = len(special.findall(text)) if "<|" in text else 0
        parts = special.split(text) if marks else [text]
        return marks + sum(sum(pieces(part)) for part in parts if part)

    return count


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = make_counter(path)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            tokens = [count(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(text.encode()) for text in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
