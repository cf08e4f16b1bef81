"""The trie of conversation beginnings, built as ternary search trees over range shards.

A turn is known by 128 bits of the SHA-256 of its role and text, so texts are hashed where they
are read and never shuffled. Conversations become paths of such keys; the paths are dealt
into shards by range and sorted there, so a beginning's conversations stand together. Each shard
encodes its turns as small numbers (a dictionary in order of the keys) and inserts its distinct
paths into a ternary search tree, the median first and then the medians of both halves, which
keeps its searches short. Nodes are made after their parents, so one walk backwards
over them, without recursion, adds up members, leaves and savings.

Only the nodes on the first and the last path of a shard can have conversations in other shards.
Of these a shard gives out what it alone knows (what ends there, and what hangs off them inside the
shard); a last small tree, of at most two paths a shard, merges them. Nodes inside a shard that
hang off such a node get their parent's name from it by a join.

Equal conversations are one path, however many they are: their ids pass by in sorted order and only
their running digest is kept. A task holds the distinct paths of its shard, 16 bytes a turn, and
of each conversation its turns' keys; texts are never gathered.

Defined results: turns are ordered by turn (missing first), then by role and the turn's key; a
missing role or text counts as empty; repeated rows are turns of their own; rows without a
conversation id belong to none and take no part; a conversation left without turns is a member of the
root; ``c % 20`` of a negative id is that of Spark, which rounds to zero; an empty table has no
nodes; other columns do not take part.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import words_of
from tidemark.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = 16
# Conversations that share a base, and how many turns of it a conversation may take.
FAMILY, HEADS = 20, 4
# Nodes of the merged boundary that go to every task (some 60 bytes each); more are joined.
SMALL = 500_000

STATS = ["ends", "conv", "children", "members", "leaves", "saved"]
NODES = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, key binary, parent_key binary"
)
# What a shard knows of a boundary node.
PARTS = f"words bigint, {', '.join(f'{s} bigint' for s in STATS)}"


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, family, steps``: each conversation's turns in order, as their keys and word counts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    step = F.struct(
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.substring(F.sha2(said, 256), 1, 2 * KEY).alias("key"),
        F.size(words_of(text)).alias("words"),
    )
    known = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), step.alias("step")
    )
    # Dealt by family, so that what follows finds a conversation beside its base.
    family = known.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).repartition("family")
    steps = F.transform(F.array_sort(F.collect_list("step")), lambda s: F.struct(s["key"].alias("key"), s["words"].alias("words")))
    return family.groupBy("family", "conv_id").agg(steps.alias("steps"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, path, words``: conversations that begin with the first turns of their family's base.

    ``path`` holds the turns' keys end to end, ``words`` the words of each turn.
    """
    own = sequences(turns)
    bases = own.filter("conv_id = family").select("family", F.slice("steps", 1, HEADS - 1).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    head = F.slice(F.coalesce("head", F.array().cast(own.schema["steps"].dataType)), F.lit(1), taken)
    rest = F.slice("steps", taken + 1, F.size("steps"))
    return own.join(bases, "family", "left").select("conv_id", F.concat(head, rest).alias("steps")).select(
        "conv_id",
        F.unhex(F.array_join(F.transform("steps", lambda s: s["key"]), "")).alias("path"),
        F.transform("steps", lambda s: s["words"]).alias("words"),
    )


class Tree:
    """A ternary search tree of paths of numbers; node 0 is the root, the empty path.

    Per node: its place among its siblings (``less``, ``more``), the tree of its children (``down``),
    its parent, depth and value.
    """

    def __init__(self) -> None:
        self.value, self.less, self.more, self.down, self.parent, self.depth = [-1], [0], [0], [0], [-1], [0]

    def insert(self, path: list[int]) -> list[int]:
        """The nodes of a path, from the root on, made where they are missing."""
        value, less, more, down = self.value, self.less, self.more, self.down
        nodes, node = [0], 0
        for v in path:
            links, at, child = down, node, down[node]
            while child and value[child] != v:
                links, at = (less, child) if v < value[child] else (more, child)
                child = links[at]
            if not child:
                child = links[at] = len(value)
                value.append(v)
                for column in (less, more, down):
                    column.append(0)
                self.parent.append(node)
                self.depth.append(self.depth[node] + 1)
            nodes.append(child)
            node = child
        return nodes


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of both halves, and so on."""
    spans = [(0, n)]
    for low, high in spans:
        if low < high:
            middle = (low + high) // 2
            yield middle
            spans += [(low, middle), (middle + 1, high)]


def add_up(tree: Tree, words: list[int], stats: dict[str, list], stay: set[int]) -> None:
    """Give every node what its parent needs of it, but for the nodes in ``stay``.

    Children have larger numbers than their parents, so one walk backwards does.
    """
    members, conv, children = stats["members"], stats["conv"], stats["children"]
    leaves, saved = stats["leaves"], stats["saved"]
    for node in range(len(tree.parent) - 1, 0, -1):
        members[node] += stats["ends"][node]
        if node in stay:
            continue
        if not children[node]:
            leaves[node] += 1
        saved[node] += (members[node] - 1) * words[node]
        up = tree.parent[node]
        members[up] += members[node]
        children[up] += 1
        leaves[up] += leaves[node]
        saved[up] += saved[node]
        conv[up] = min(conv[up], conv[node])
    members[0] += stats["ends"][0]


NO_CONV = (1 << 63) - 1
EMPTY = hashlib.sha256(b"").hexdigest()


def _keys(path: list[bytes]) -> list[bytes]:
    """A key of 128 bits for each beginning of a path."""
    out = [bytes(KEY)]
    for step in path:
        out.append(hashlib.sha256(out[-1] + step).digest()[:KEY])
    return out


def _paths(batches: Iterator[pa.RecordBatch]) -> tuple[list, list, list, list, list]:
    """The distinct paths of a sorted shard: keys, words, conversations, least id, digest of ids."""
    paths, words, ends, least, digests = [], [], [], [], []
    last, digest = None, hashlib.sha256()
    for batch in batches:
        sizes, conv = batch.column("words"), batch.column("conv_id").to_pylist()
        for row, path in enumerate(batch.column("path").to_pylist()):
            if path != last:
                if last is not None:
                    digests.append(digest.hexdigest())
                last, digest = path, hashlib.sha256(str(conv[row]).encode())
                paths.append([path[i : i + KEY] for i in range(0, len(path), KEY)])
                words.append(sizes[row].as_py())
                ends.append(1)
                least.append(conv[row])
            else:
                digest.update(b",%d" % conv[row])
                ends[-1] += 1
    if last is not None:
        digests.append(digest.hexdigest())
    return paths, words, ends, least, digests


def _table(columns: dict[str, list]) -> pa.RecordBatch:
    kinds = {"ends_sha256": pa.string(), "key": pa.binary(), "parent_key": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in columns.items()], names=list(columns))


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard; of those on its first and last path what the shard knows (``ends`` is set)."""
    paths, sizes, ends, least, digests = _paths(batches)
    if not paths:
        return
    number = {key: i for i, key in enumerate(sorted({key for path in paths for key in path}))}
    tree, words = Tree(), [0]
    stats: dict[str, list] = {s: [NO_CONV if s == "conv" else 0] for s in STATS}
    digest = {}
    for at in medians(len(paths)):
        known = len(tree.value)
        nodes = tree.insert([number[key] for key in paths[at]])
        made = len(tree.value) - known
        if made:
            words += sizes[at][-made:]
            for name, column in stats.items():
                column += [NO_CONV if name == "conv" else 0] * made
        stats["ends"][nodes[-1]] = ends[at]
        stats["conv"][nodes[-1]] = least[at]
        digest[nodes[-1]] = digests[at]
    keys = {}
    for path in (paths[0], paths[-1]):
        keys.update(zip(tree.insert([number[key] for key in path]), _keys(path), strict=True))
    # A node that stays gives its parent nothing here: the merge does.
    add_up(tree, words, stats, set(keys))
    inside = [node for node in range(len(tree.value)) if node not in keys]
    edge = sorted(keys)
    conv, parent = stats["conv"], tree.parent
    for part in range(0, len(inside), 65_536):
        chosen = inside[part : part + 65_536]
        yield _table({
            "conv_id": [conv[n] for n in chosen],
            "depth": [tree.depth[n] for n in chosen],
            "parent_conv_id": [None if parent[n] in keys else conv[parent[n]] for n in chosen],
            "n_convs": [stats["members"][n] for n in chosen],
            "n_children": [stats["children"][n] for n in chosen],
            "n_leaves": [stats["leaves"][n] for n in chosen],
            "saved_tokens": [stats["saved"][n] for n in chosen],
            "ends_sha256": [digest.get(n, EMPTY) for n in chosen],
            "key": [None] * len(chosen),
            "parent_key": [keys.get(parent[n]) for n in chosen],
            "words": [None] * len(chosen),
            **{s: [None] * len(chosen) for s in STATS},
        })
    unknown = [None] * len(edge)
    yield _table({
        "conv_id": unknown,
        "depth": [tree.depth[n] for n in edge],
        **{c: unknown for c in ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")},
        "ends_sha256": [digest.get(n) for n in edge],
        "key": [keys[n] for n in edge],
        "parent_key": [keys[parent[n]] if n else None for n in edge],
        "words": [words[n] for n in edge],
        **{s: [stats[s][n] for n in edge] for s in STATS},
    })


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The boundary nodes of all shards, once each and complete; parents come first."""
    place: dict[bytes, int] = {}
    tree, words = Tree(), []
    stats: dict[str, list] = {s: [] for s in STATS}
    digests: list[str | None] = []
    parents: list[int] = []
    for batch in batches:
        for row in batch.to_pylist():
            place[row["key"]] = len(place)
            parents.append(place.get(row["parent_key"], -1))
            words.append(row["words"])
            digests.append(row["ends_sha256"])
            for s in STATS:
                stats[s].append(row[s])
            tree.depth.append(row["depth"])
    tree.depth, tree.parent = tree.depth[1:], parents
    if not place:
        return
    # What ends at a node is among the members it was counted with already.
    stats["ends"] = [0] * len(place)
    add_up(tree, words, stats, set())
    if not stats["children"][0]:
        stats["leaves"][0] += 1
    conv = stats["conv"]
    yield _table({
        "conv_id": conv,
        "depth": tree.depth,
        "parent_conv_id": [conv[p] if p >= 0 else None for p in parents],
        "n_convs": stats["members"],
        "n_children": stats["children"],
        "n_leaves": stats["leaves"],
        "saved_tokens": stats["saved"],
        "ends_sha256": [d or EMPTY for d in digests],
        "key": list(place),
        "parent_key": [None] * len(place),
    })


def prefix_nodes(paths: DataFrame) -> DataFrame:
    """One row per node of the trie of ``paths`` (``conv_id, path, words``): ``conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    spark = paths.sparkSession
    folder = f"{shared_dir(spark)}/trie-{uuid.uuid4().hex}"
    sharded = paths.repartitionByRange("path").sortWithinPartitions("path", "conv_id")
    sharded.mapInArrow(_shard, f"{NODES}, {PARTS}").write.parquet(folder)
    made = spark.read.parquet(folder)
    # The same node of several shards: what each knows of it adds up. Parents are less deep.
    sums = [F.min("conv").alias("conv"), *[F.sum(s).alias(s) for s in STATS if s != "conv"]]
    edge = (
        made.filter("key is not null").groupBy("key")
        .agg(F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.first("words").alias("words"),
             F.max("ends_sha256").alias("ends_sha256"), *sums)
        .repartition(1).sortWithinPartitions("depth", "key")
    )
    edge.mapInArrow(_merge, NODES).write.parquet(f"{folder}-edge")
    merged = spark.read.parquet(f"{folder}-edge")
    names = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    if merged.count() <= SMALL:
        names = F.broadcast(names)
    inside = made.filter("key is null").drop("words", *STATS).join(names, "parent_key", "left")
    columns = ["conv_id", "depth", F.coalesce("parent_conv_id", "parent").alias("parent_conv_id")]
    columns += ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return inside.select(*columns).unionByName(
        merged.select(*[c for c in merged.columns if c not in ("key", "parent_key")])
    )
