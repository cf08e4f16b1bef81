"""A language model by context-tree weighting over bytes, beside an add-one word baseline.

Model. Each byte is eight binary decisions, and the bytes before it are its context. For
each context of 0 to ``DEPTH`` bytes and each decision there is a Krichevsky-Trofimov
estimate; a node's probability is half its own estimate and half the product over the
contexts one byte longer. From these follow, in closed form, the weights with which all
depths are mixed. Every context that was seen is a node, however rare it is.

Work. The probability of a byte depends on its *path* alone: itself and the ``DEPTH`` bytes
before it. Texts are taken in *portions* of ``PORTION`` bytes. A portion's distinct paths with
their training counts go, packed, to the *shards* of the tree: all that follows a context of
``SPLIT`` bytes is in one shard. Nodes of shorter contexts are added up by Spark. A shard
works out its nodes upwards, then (with the weights left by the shorter contexts) downwards, and
sends each portion the probabilities of its paths, where they meet its texts again.
No task and not the driver holds the tree.

Words are counted by tasks and added up by Spark. The frequent words (at least one of 2**20
training words, so at most 2**20 of them) go to all tasks; the counts of all other words are joined
by the word. No such word has more than one of 2**20 training words, so that join has no hot key.

Defined results: a missing text counts as empty and still has its end; a missing id is
hashed as the empty text; repeated rows count and are scored one by one; without any
training text every decision is even; an empty table gives an empty table; other columns
of the input do not take part.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import groups, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEPTH = 5
# Bytes of texts whose paths are asked for together; the context by which the tree is sharded, the bytes
# of texts for a shard and the most shards.
PORTION = 16 << 20
SPLIT = 3
SHARD_BYTES, SHARDS = 1 << 21, 1024
FREQUENT_WORDS = 1 << 20
END = b""


class Tree(NamedTuple):
    """States are reached by the bytes before a position; each has 256 log10 probabilities."""

    step: np.ndarray  # [inner contexts, 256]: the next state
    log10: np.ndarray  # [states that are no inner context, 256]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ``DEPTH`` zero bytes before and one, the end, after; and their starts."""
    data = b"".join([bytes(DEPTH) + text + b"\0" for text in texts])
    sizes = np.array([len(text) + DEPTH + 1 for text in texts])
    return np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum(sizes)[:-1]]) + DEPTH


def _sequences(texts: list[bytes]) -> np.ndarray:
    """For every byte of the texts and their ends: it and the ``DEPTH`` bytes before, as one number."""
    raw, starts = _padded(texts)
    keys = raw.astype(np.int64)
    for back in range(1, DEPTH + 1):
        keys[back:] |= raw[:-back].astype(np.int64) << np.int64(8 * back)
    use = np.ones(len(raw), bool)
    for back in range(1, DEPTH + 1):
        use[starts - back] = False
    return keys[use]


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    unique, at = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(at, np.concatenate(counts)).astype(np.int64)


def _paths(keys: np.ndarray) -> np.ndarray:
    """Sequences with the byte just before first, then the one before that, and the byte itself last. So
    the paths of one context of any length stand together."""
    paths = keys & 255
    for back in range(1, DEPTH + 1):
        paths |= (keys >> (8 * back) & 255) << (8 * (DEPTH + 1 - back))
    return paths


def _packed(paths: np.ndarray, values: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending paths and a number for each."""
    return zlib.compress(np.diff(paths, prepend=0).tobytes(), 1), zlib.compress(values.tobytes(), 1)


def _unpacked(paths: bytes, values: bytes, kind: type) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(np.frombuffer(zlib.decompress(paths), np.int64)), np.frombuffer(zlib.decompress(values), kind)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows of one portion that come one after the other, with its number. A portion follows from the
    rows before in the partition alone, not from the size of batches."""
    seen, task = 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy().astype(np.int64)
        of = (seen + np.cumsum(sizes) - sizes) // PORTION
        seen += int(sizes.sum())
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        for first, last in zip(cuts, cuts[1:], strict=False):
            if first < last:
                yield task + int(of[first]), batch.slice(first, last - first)


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``portion, rows``: rows of a portion together, compressed."""
    for portion, rows in _portions(batches):
        data = pa.BufferOutputStream()
        with pa.ipc.new_stream(data, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(rows)
        yield pa.RecordBatch.from_pydict({"portion": [portion], "rows": [data.getvalue().to_pybytes()]})


def _received(table: pa.Table) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(rows.as_buffer()).read_all() for rows in table["rows"]])


def _asked(shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``shard, portion, paths, counts``: a portion's distinct paths, and how often training texts have them."""

    def rows(portion: int, keys: list[np.ndarray], counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        unique, n = _added(keys, counts)
        paths = _paths(unique)
        shard = _shard(paths, shards)
        order = np.lexsort((paths, shard))
        paths, shard, n = paths[order], shard[order], n[order]
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        made = [(int(shard[i]), portion, *_packed(paths[i:j], n[i:j])) for i, j in zip(cuts, cuts[1:], strict=False)]
        types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        arrays = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(types)]
        yield pa.RecordBatch.from_arrays(arrays, names=["shard", "portion", "paths", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held, current = [], [], 0, None
        for portion, part in _portions(batches):
            if portion != current and keys:
                yield from rows(current, keys, counts)
                keys, counts, held = [], [], 0
            current = portion
            texts, test = part.column("text").to_pylist(), part.column("held_out").to_pylist()
            for kind in (False, True):
                for _, some in groups([t.encode().lower() for t, h in zip(texts, test, strict=True) if h == kind]):
                    unique, n = np.unique(_sequences(some), return_counts=True)
                    keys.append(unique)
                    counts.append(n * (not kind))
                    held += len(unique)
                    if held > 2_000_000:
                        merged = _added(keys, counts)
                        keys, counts, held = [merged[0]], [merged[1]], 0
        if keys:
            yield from rows(current, keys, counts)

    return run


def _shard(paths: np.ndarray, shards: int) -> np.ndarray:
    context = (paths >> (8 * (DEPTH + 1 - SPLIT))).astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        return ((context * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % shards


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(counts: Counter) -> Iterator[pa.RecordBatch]:
        words, n = list(counts), list(counts.values())
        for at in range(0, len(words), 50_000):
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array(words[at : at + 50_000], pa.binary()), "n": pa.array(n[at : at + 50_000], pa.int64())}
            )

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update((text or "").encode().lower().split())
            counts[END] += 1
            if len(counts) > 500_000:
                yield from rows(counts)
                counts.clear()
    yield from rows(counts)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x >= 0.5: Stirling's series from x + 7 on."""
    y = x + 7
    series = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    product = np.ones_like(x)
    for k in range(7):
        product *= x + k
    return series - np.log(product)


def _decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones seen at each of the 255 binary nodes (numbered from 1) of byte counts."""
    total = np.zeros((len(counts), 512))
    total[:, 256:] = counts
    for k in range(255, 0, -1):
        total[:, k] = total[:, 2 * k] + total[:, 2 * k + 1]
    zeros, ones = total[:, 0:512:2].copy(), total[:, 1:512:2].copy()
    zeros[:, 0] = ones[:, 0] = 0
    return zeros, ones


def _block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - np.log(np.pi)


def _next_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1)


def _byte_log10(one: np.ndarray) -> np.ndarray:
    """log10 probabilities of the 256 bytes from those of a one at the 255 nodes."""
    out = np.zeros((len(one), 512))
    with np.errstate(divide="ignore"):
        yes, no = np.log10(one), np.log10(1 - one)
    for k in range(1, 256):
        out[:, 2 * k] = out[:, k] + no[:, k]
        out[:, 2 * k + 1] = out[:, k] + yes[:, k]
    return out[:, 256:].astype(np.float32)


def build_tree(counts: list[dict[int, np.ndarray]]) -> Tree:
    """The tree of ``counts[depth][context]``, 256 byte counts for each expanded context; in memory, for
    few contexts. ``score`` does not use it: the tests compare the shards with it."""
    if not counts[0]:
        counts[0][0] = np.zeros(256)
    contexts = [np.array(sorted(c), np.int64) for c in counts]
    seen = [np.array([c[k] for k in sorted(c)]).reshape(-1, 256) for c in counts]
    depth = len(counts) - 1
    parents = [None] + [np.searchsorted(contexts[d - 1], contexts[d] & ((1 << 8 * (d - 1)) - 1)) for d in range(1, depth + 1)]
    pooled = []
    for d in range(depth):
        rest = seen[d].copy()
        np.subtract.at(rest, parents[d + 1], seen[d + 1])
        pooled.append(_decisions(np.maximum(rest, 0)))
    nodes = [_decisions(s) for s in seen]
    # Upwards: ln of each node's weighted probability, and the share of its own estimate in it.
    weighted, share = _block(*nodes[depth]), [np.empty(0)] * depth
    for d in range(depth - 1, -1, -1):
        below = _block(*pooled[d])
        np.add.at(below, parents[d + 1], weighted)
        own = _block(*nodes[d])
        weighted = np.logaddexp(own, below) - np.log(2)
        share[d] = np.exp(own - np.log(2) - weighted)
    # Downwards: what the shorter contexts say, and the weight left for longer ones.
    said, left = np.zeros_like(nodes[0][0]), np.ones_like(nodes[0][0])
    ends = []
    for d in range(depth):
        said = said + left * share[d] * _next_one(*nodes[d])
        left = left * (1 - share[d])
        ends.append(_byte_log10(said + left * _next_one(*pooled[d])))
        said, left = said[parents[d + 1]], left[parents[d + 1]]
    longest = _byte_log10(said + left * _next_one(*nodes[depth]))
    # States: inner contexts by depth, then the longest contexts, then the pooled children.
    first = np.concatenate([[0], np.cumsum([len(c) for c in contexts])])
    inner, n = int(first[depth]), int(first[-1])
    step = np.repeat(np.arange(n, n + inner, dtype=np.int32)[:, None], 256, axis=1)
    for d in range(1, depth + 1):
        step[first[d - 1] + parents[d], contexts[d] >> (8 * (d - 1))] = first[d] + np.arange(len(contexts[d]))
    return Tree(step, np.concatenate([longest, *ends]))


def log10_probability(texts: list[bytes], tree: Tree) -> np.ndarray:
    """log10 of each text's probability, its end included."""
    raw, starts = _padded(texts)
    inner, step = len(tree.step), tree.step.ravel()
    last = np.arange(len(raw))[DEPTH:]
    state = np.zeros(len(last), np.int32)
    for back in range(1, DEPTH + 1):
        on = step[np.minimum(state, inner - 1) * np.int64(256) + raw[last - back]]
        state = np.where(state < inner, on, state)
    values = np.zeros(len(raw))
    values[DEPTH:] = tree.log10.ravel()[(state - inner).astype(np.int64) * 256 + raw[last]]
    for back in range(1, DEPTH + 1):
        values[starts - back] = 0
    return np.add.reduceat(values, starts - DEPTH)


class _Nodes(NamedTuple):
    """Nodes of one depth and one of the eight decisions: context and the bits decided before, in one number."""

    ids: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray  # ln of the weighted probability
    share: np.ndarray  # of the node's own estimate in it
    parent: np.ndarray  # its place among the nodes one byte shorter


def _mixed(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln of the weighted probability, and the share of the own estimate in it."""
    own = _block(zeros, ones)
    weighted = np.logaddexp(own, below) - np.log(2)
    return weighted, np.exp(own - np.log(2) - weighted)


def _shorter(ids: np.ndarray, bits: int) -> np.ndarray:
    """The nodes of contexts one byte shorter, with the same ``bits`` decided."""
    return ids >> (bits + 8) << bits | ids & ((1 << bits) - 1)


def _whole(paths: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return _added(paths, counts) if paths else (np.empty(0, np.int64), np.empty(0, np.int64))


def _upwards(paths: np.ndarray, n: np.ndarray, bits: int, shorter: list[tuple[np.ndarray, np.ndarray]]) -> list[_Nodes]:
    """Nodes of one decision from depth ``DEPTH`` to ``SPLIT``; paths of no count change no node."""
    out: list[_Nodes] = []
    seen = []
    for cells, times in [(paths, n), *shorter]:
        ids = cells >> (8 - bits)
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        total = np.add.reduceat(times, first)
        ones = np.add.reduceat(times * (cells >> (7 - bits) & 1), first)
        seen.append((ids[first], (total - ones).astype(float), ones.astype(float)))
    below = None
    for at, (ids, zeros, ones) in enumerate(seen):
        if below is None:
            weighted, share = _block(zeros, ones), np.ones(len(ids))
        else:
            weighted, share = _mixed(zeros, ones, np.bincount(out[-1].parent, below, len(ids)))
        up = _shorter(ids, bits)
        parent = np.searchsorted(seen[at + 1][0], up) if at + 1 < len(seen) else up
        out.append(_Nodes(ids, zeros, ones, weighted, share, parent))
        below = weighted
    return out


def _cells(paths: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The counts of bytes after each context of one byte less than ``DEPTH``, to ``SPLIT``."""
    out = []
    for _ in range(DEPTH - SPLIT):
        paths, n = _added([_shorter(paths, 8)], [n])
        out.append((paths, n))
    return out


def _asked_in_all(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The paths each portion asks a shard for; all of them, ascending, with their counts."""
    asked = [_unpacked(p, c, np.int64) for p, c in zip(table["paths"].to_pylist(), table["counts"].to_pylist(), strict=True)]
    return [paths for paths, _ in asked], *_whole([paths for paths, _ in asked], [n for _, n in asked])


def _shard_up(table: pa.Table) -> pa.Table:
    """``shard, node, zeros, ones, below``: of each context one byte shorter than ``SPLIT`` and decision, what
    this shard adds to its counts and to the ln of the product below it."""
    _, paths, n = _asked_in_all(table)
    shorter = _cells(paths, n)
    rows = []
    for bits in range(8):
        top = _upwards(paths, n, bits, shorter)[-1]
        ids, at = np.unique(top.parent, return_inverse=True)
        node = ids >> bits << 8 | 1 << bits | ids & ((1 << bits) - 1)
        rows.append((node, *[np.bincount(at, x, len(ids)) for x in (top.zeros, top.ones, top.weighted)]))
    node, zeros, ones, below = (np.concatenate(x) for x in zip(*rows, strict=True))
    shard = np.full(len(node), table["shard"][0].as_py(), np.int32)
    return pa.table({"shard": shard, "node": node, "zeros": zeros, "ones": ones, "below": below})


def _short(table: pa.Table) -> tuple[list[tuple], tuple]:
    """``zeros, ones, share, parent`` of the nodes of depths ``SPLIT - 1`` to 1 whose contexts end with one
    byte; and ``node, zeros, ones, below`` of depth 0."""
    node, zeros, ones, below = (table[c].to_numpy() for c in ("node", "zeros", "ones", "below"))
    out = []
    for _ in range(SPLIT - 1):
        weighted, share = _mixed(zeros, ones, below)
        node, at = np.unique(_shorter(node, 8), return_inverse=True)
        out.append((zeros, ones, share, at))
        zeros, ones, below = (np.bincount(at, x, len(node)) for x in (zeros, ones, weighted))
    return out, (node, zeros, ones, below)


def _short_up(table: pa.Table) -> pa.Table:
    return pa.table(dict(zip(("node", "zeros", "ones", "below"), _short(table)[1], strict=True)))


def _short_down(said: np.ndarray, left: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    """``node, said, left``: what contexts to ``SPLIT - 1`` bytes say, and the weight left for longer ones."""

    def run(table: pa.Table) -> pa.Table:
        made, (root, *_) = _short(table)
        says, rest = said[root], left[root]
        for zeros, ones, share, at in reversed(made):
            says, rest = _and_longer(says[at], rest[at], zeros, ones, share)
        return pa.table({"node": table["node"], "said": says, "left": rest})

    return run


def _and_longer(said: np.ndarray, left: np.ndarray, zeros: np.ndarray, ones: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return said + left * share * _next_one(zeros, ones), left * (1 - share)


def _shard_down(table: pa.Table, short: pa.Table) -> pa.Table:
    """``portion, paths, log10``: the log10 probability of the last byte of each path that a portion asks for."""
    asked, paths, n = _asked_in_all(table)
    shorter = _cells(paths, n)
    node, said, left = (short.sort_by("node")[c].to_numpy() for c in ("node", "said", "left"))
    log10 = np.zeros(len(paths))
    for bits in range(8):
        levels = _upwards(paths, n, bits, shorter)
        up = levels[-1].parent
        at = np.searchsorted(node, up >> bits << 8 | 1 << bits | up & ((1 << bits) - 1))
        says, rest = said[at], left[at]
        for depth, here in reversed(list(enumerate(levels))):
            says, rest = _and_longer(says, rest, here.zeros, here.ones, here.share)
            at = levels[depth - 1].parent if depth else np.searchsorted(here.ids, paths >> (8 - bits))
            says, rest = says[at], rest[at]
        log10 += np.log10(np.where(paths >> (7 - bits) & 1, says, 1 - says))
    log10 = log10.astype(np.float32)
    made = [_packed(own, log10[np.searchsorted(paths, own)]) for own in asked]
    return pa.table(
        {"portion": table["portion"], "paths": pa.array([m[0] for m in made], pa.binary()), "log10": pa.array([m[1] for m in made], pa.binary())}
    )


def path_probabilities(docs: DataFrame) -> DataFrame:
    """``portion, paths, log10``: for each portion of ``docs`` its paths with their log10 probabilities,
    packed, by the tree learned from the texts that are not ``held_out``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(SHARDS, 1 + size // SHARD_BYTES)
    asked = docs.select("text", "held_out").mapInArrow(_asked(shards), "shard int, portion bigint, paths binary, counts binary").checkpoint()
    sums = "node bigint, zeros double, ones double, below double"
    parts = asked.groupBy("shard").applyInArrow(_shard_up, f"shard int, {sums}").checkpoint()

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")])

    nodes = added(parts)
    by_byte = nodes.groupBy(F.shiftright("node", 8 * (SPLIT - 1)).alias("byte"))
    # Of the empty context there are the 255 decisions.
    root = np.zeros((256, 3))
    for row in added(by_byte.applyInArrow(_short_up, sums)).toLocalIterator():
        root[row["node"]] = row["zeros"], row["ones"], row["below"]
    zeros, ones, below = root.T
    said, left = _and_longer(np.zeros(256), np.ones(256), zeros, ones, _mixed(zeros, ones, below)[1])
    short = by_byte.applyInArrow(_short_down(said, left), "node bigint, said double, left double")
    needed = parts.select("shard", "node").join(short, "node")
    return asked.groupBy("shard").cogroup(needed.groupBy("shard")).applyInArrow(_shard_down, "portion bigint, paths binary, log10 binary")


def _log10_of(answers: pa.Table) -> Callable[[list[bytes]], np.ndarray]:
    """log10 of each text's probability, its end included, by the probabilities of its portion's paths."""
    made = [_unpacked(p, v, np.float32) for p, v in zip(answers["paths"].to_pylist(), answers["log10"].to_pylist(), strict=True)]
    # Paths are sequences with their contexts turned round, and the other way.
    keys = _paths(np.concatenate([np.empty(0, np.int64), *[paths for paths, _ in made]]))
    order = np.argsort(keys)
    keys, log10 = keys[order], np.concatenate([np.empty(0, np.float32), *[values for _, values in made]])[order]

    def run(texts: list[bytes]) -> np.ndarray:
        asked, of = np.unique(_sequences(texts), return_inverse=True)
        at = np.searchsorted(keys, asked)
        if not len(keys) or at[-1] == len(keys) or not np.array_equal(keys[at], asked):
            raise ValueError("the documents were not read in the same order twice")
        starts = np.cumsum([0, *[len(text) + 1 for text in texts[:-1]]])
        return np.add.reduceat(log10[at].astype(float)[of], starts)

    return run


def score(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, bits_per_byte``; learns from the documents that are not held out."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text"))
    training = docs.filter(~F.col("held_out"))
    words = (
        training.select("text").mapInArrow(_count_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).checkpoint()
    )
    n_train, n_words = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    common = words.filter(F.col("n") * FREQUENT_WORDS >= n_train).toArrow()
    logs = np.log10(common["n"].to_numpy() + 1.0).tolist()
    shared = spark.sparkContext.broadcast(dict(zip(common["word"].to_pylist(), logs, strict=True)))

    def run(sent: pa.Table, answers: pa.Table) -> pa.Table:
        rows, weight = _received(sent), shared.value
        rare = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int32())]))
        log10, scores = _log10_of(answers), [np.empty(0)]
        tokens, known, sums, others, sizes = [], [], [], [], []
        for _, texts in groups([t.encode().lower() for t in rows["text"].to_pylist()]):
            scores.append(log10(texts))
            for text in texts:
                counts = Counter(text.split())
                counts[END] = 1
                tokens.append(counts.total())
                known.append(sum([n for w, n in counts.items() if w in weight]))
                sums.append(sum([n * weight[w] for w, n in counts.items() if w in weight]))
                others.append([{"word": w, "times": n} for w, n in counts.items() if w not in weight])
                sizes.append(len(text) + 1)
        return pa.table(
            [rows["uid"], rows["doc_id"], rows["held_out"], pa.array(tokens, pa.int64()), pa.array(known, pa.int64()),
             pa.array(sums, pa.float64()), pa.array(np.concatenate(scores)), pa.array(sizes, pa.int64()), pa.array(others, rare)],
            names=["uid", "doc_id", "held_out", "n_tokens", "known", "logs", "score", "bytes", "rare"],
        )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.withColumn("uid", F.monotonically_increasing_id()).mapInArrow(_sent, "portion bigint, rows binary")
    # Written once, so that the two uses below see the same row numbers.
    scored = (
        sent.groupBy("portion").cogroup(path_probabilities(docs).groupBy("portion"))
        .applyInArrow(run, f"uid bigint, doc_id {id_type}, held_out boolean, n_tokens bigint, known bigint, logs double, "
                           "score double, bytes bigint, rare array<struct<word: binary, times: int>>")
        .checkpoint()
    )
    rare = (
        scored.select("uid", F.inline("rare"))
        .join(words.select("word", "n"), "word")
        .groupBy("uid")
        .agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_logs"))
    )
    zero = F.lit(0)
    out_of = float(np.log10(n_train + n_words + 1.0))
    return scored.drop("rare").join(rare, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", zero)).alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", zero) - F.col("n_tokens") * out_of).alias("base_score"),
        "score",
        (-F.col("score") * float(np.log2(10)) / F.col("bytes")).alias("bits_per_byte"),
    )
