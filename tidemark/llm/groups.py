"""Groups of similar items: candidates from buckets, verified links, connected components.

Items that share a bucket are candidates. A bucket of copies may hold any share of all
items, so pairs are never enumerated within it. Instead:

1. each bucket's first item is paired with the others (a star), which is linear in the
   bucket; verified pairs are links, and links make components;
2. buckets that are not connected yet are dealt into small random parts, several times anew, and each part's first item
   is paired with those of its part that are still in another component;
3. what remains is settled exactly: the items outside a bucket's largest component are paired
   with items of other components, in small buckets with all, in larger ones with those of
   their random part; parts grow from turn to turn until they are whole buckets, and items
   that were connected meanwhile need no pair any more; as soon as few pairs are left, whole buckets are
   settled at once. With ``keys`` (a property that all similar items
   of a bucket have in common with each other) larger buckets are cut by these instead.

Without ``keys``, items of one bucket that stay unconnected are paired all with all in the end: nothing
else can tell that no link was missed. Links found in a turn are mapped to the roots known before, and only
what joins two roots takes part in the next components.

The result is the components of the graph of *all* verified candidate pairs: a pair is left
out only if its ends are already connected. Nothing is collected to the driver; tables that
later steps build on are checkpointed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAR_ROUNDS = 6
# Nodes of a part of a bucket, after the first turn.
PART = 8
# Nodes of a part of a bucket in the first turn that settles the rest, and its growth from turn to turn.
WIDTH, GROWTH = 32, 8
# So many pairs (for each row of the buckets, and in all) are no reason to wait for further turns.
FEW_EACH, FEW_PAIRS = 16, 100_000
# Another turn of stars must leave less than this share of the pairs that were left before.
ENOUGH = 0.8
# Rows a task of the steps on pairs and links takes.
ROWS_PER_TASK = 200_000
# Buckets of two or more that may be broadcast (8 bytes each).
BROADCAST_BUCKETS = 1_000_000


def _settled(edges: DataFrame, few: int) -> bool:
    """Whether edges (``a`` < ``b``) are stars: every node is a centre only or hangs on one centre only."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("up")).union(edges.select("b", F.lit(1))).coalesce(few)
    seen = ends.groupBy("node").agg(F.max("up").alias("up"), F.count("*").alias("n")).coalesce(few)
    return seen.filter("up = 1 and n > 1").isEmpty()


def _tasks(rows: int) -> int:
    """Tasks that a step on so many small rows needs; steps on few rows must not each leave a
    file for every shuffle partition."""
    return 1 + rows // ROWS_PER_TASK


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``); the root is the smallest node.

    Large-star and small-star rounds in turn, until all edges are stars; links that are stars
    from the start need none.
    """
    edges = links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = edges.checkpoint()
    n = edges.count()
    few = _tasks(2 * n)
    while n and not _settled(edges, few):
        # Large star: every larger neighbour goes to the smallest of the neighbourhood.
        edges = edges.coalesce(few)
        both = edges.union(edges.select("b", "a")).toDF("u", "v").coalesce(few)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(few)
        edges = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).coalesce(few)
        edges = edges.distinct().coalesce(few)
        # Small star: every smaller neighbour and the node itself go to the smallest.
        down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m")).coalesce(few)
        moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a != b")
        edges = moved.union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).coalesce(few).distinct().coalesce(few).checkpoint()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def _joined(roots: DataFrame | None, links: DataFrame, few: int) -> DataFrame | None:
    """``roots`` after more links. What is known already is one node: only links between roots take part
    in the stars, so later turns cost what they find and not all that was found before."""
    if roots is not None:
        for end in ("a", "b"):
            top = roots.select(F.col("node").alias(end), F.col("root").alias("top"))
            # Not coalesced: where the roots are broadcast, the pairs are verified in the tasks of this step.
            links = links.join(top, end, "left").withColumn(end, F.coalesce("top", end)).select("a", "b")
    moved = components(links).coalesce(few).checkpoint()
    if moved.isEmpty():
        return roots
    if roots is None:
        return moved
    tops = moved.select(F.col("node").alias("root"), F.col("root").alias("top"))
    known = roots.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return known.union(moved.join(roots, "node", "left_anti")).coalesce(few).checkpoint()


def shared_buckets(members: DataFrame) -> DataFrame:
    """The rows ``bucket, node`` of buckets that hold two nodes or more.

    ``members`` holds no row twice and must be cheap to make again. The buckets are aggregated before they are
    shuffled; most hold one node, and the few others are broadcast if counted to be few.
    """
    shared = members.groupBy("bucket").count().filter("count > 1").select("bucket").checkpoint()
    if shared.count() <= BROADCAST_BUCKETS:
        shared = F.broadcast(shared)
    return members.join(shared, "bucket")


def group(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    rounds: int = STAR_ROUNDS,
    bound: Callable[[Column, Column], Column] | None = None,
    keys: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``node, root`` of every node that has a verified link.

    ``members`` (``bucket, node`` and, with ``bound``, ``info``) holds buckets of two nodes or
    more, already materialised. ``verify`` keeps of pairs (``a, b``) those that are similar;
    ``bound`` says of two nodes' ``info`` whether they can be, and must not be false for similar nodes.
    ``keys`` gives rows ``bucket, node`` a ``key``, several for a node; similar nodes of a bucket must share one.
    """
    members = members if bound else members.withColumn("info", F.lit(0))
    tested = roots = None
    n = members.count()
    few, few_pairs = _tasks(n), max(min(FEW_EACH * n, FEW_PAIRS), n // 4)
    members = members.coalesce(few)
    shared = members.groupBy("node").agg(F.collect_set("bucket").alias("all")).coalesce(few)
    # Buckets of up to ``width`` nodes are settled.
    turn, width, largest, before = 0, 0, 1, 0
    while width < largest:
        labelled = members if roots is None else members.join(roots, "node", "left")
        root = F.col("node") if roots is None else F.coalesce("root", "node")
        labelled = labelled.select("bucket", "node", root.alias("root"), "info").coalesce(few)
        # Only buckets of several components that are not settled take part.
        parts = labelled.groupBy("bucket", "root").agg(F.count("*").alias("n"))
        major = parts.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("size"), F.count("*").alias("parts"))
        major = major.filter((F.col("parts") > 1) & (F.col("size") > width)).select("bucket", F.col("m.root").alias("major"), "size")
        rows = labelled.join(major, "bucket").coalesce(few).checkpoint()
        outside = F.when(F.col("root") != F.col("major"), F.col("size"))
        largest, most = rows.agg(F.max("size"), F.sum(outside)).first()
        if largest is None:
            break
        # Buckets that are connected stay so: later turns look at the others only.
        members = rows.select("bucket", "node", "info")
        # Few pairs: all are settled now. Stars that connect little: what remains is settled next.
        last = turn > 0 and most <= few_pairs
        if turn > 1 and most > ENOUGH * before:
            rounds = 0
        before = most
        other = F.struct("node", "root", "info")
        if not last and not width and turn < rounds:
            # From the second turn on a bucket is dealt into small parts, anew each turn.
            part = F.lit(0) if turn == 0 else F.pmod(F.xxhash64("node", F.lit(turn)), F.ceil(F.col("size") / PART))
            rows = rows.withColumn("part", part.cast("bigint"))
            others = rows.groupBy("bucket", "part").agg(F.min(other).alias("o"))
            wanted = F.lit(True)
        else:
            keyed = keys and width and not last
            width = largest if last or keyed else width * GROWTH if width else WIDTH
            # Two nodes that are both outside the largest part meet once, the smaller first; and
            # two that share several buckets meet in the smallest of these.
            rows = rows.join(shared, "node")
            if keyed:
                rows = rows.join(keys(rows.select("bucket", "node")).withColumnRenamed("key", "part"), ["bucket", "node"])
            else:
                part = F.pmod(F.xxhash64("node", F.lit(turn)), F.ceil(F.col("size") / width))
                rows = rows.withColumn("part", part.cast("bigint"))
            others = rows.filter("root != major").select("bucket", "part", other.alias("o"), F.col("all").alias("o_all"))
            once = F.array_min(F.array_intersect("all", "o_all")) == F.col("bucket")
            wanted = F.expr("root = major or o.node < node") & once
        turn += 1
        on = ["bucket", "part"]
        can = bound(F.col("info"), F.col("o.info")) if bound else F.lit(True)
        found = rows.join(others, on).filter((F.col("root") != F.col("o.root")) & wanted & can)
        pairs = found.select(F.least("node", "o.node").alias("a"), F.greatest("node", "o.node").alias("b")).coalesce(few).distinct().coalesce(few)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti").coalesce(few)
        pairs = pairs.checkpoint()
        if pairs.isEmpty():
            continue
        tested = pairs if tested is None else tested.union(pairs)
        roots = _joined(roots, verify(pairs).select("a", "b"), few)
    return members.select("node", F.col("node").alias("root")).limit(0) if roots is None else roots
