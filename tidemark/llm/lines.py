"""Fuzzy line dedup: one occurrence of each group of similar lines stays.

A line is normalised (lower case; everything but letters and digits is one space). Lines
of fewer than five words are left alone. A line's SimHash sums the bits of its hashed word
pairs and keeps the majority of each of 64. Two of distance 3 or less agree in three of six blocks of bits at
least, so each line is put in the 20 buckets of three blocks each, and candidates are
verified by edit distance: at most a tenth of the longer line's characters. In buckets of many lines
that stay apart only those sharing a rare gram are compared, which loses no link. Lines joined by
such links are one group, and of all its occurrences only the first stays: the one in the
document of the smallest id, and there at the smallest place.

Everything is a column expression or a join. Equal lines are one node from the start, so a
line that stands in a third of all documents is one row in the search for groups; marking
its occurrences is a join that Spark splits. A line is known by a 64-bit hash of its words.

Defined results: a missing text has no lines and stays missing; a text whose every worded
line goes is dropped as a document, one that had no such line stays as it is; lines that
stay keep their text and order; rows of the same id and text are the same document and fare
alike; a missing id comes after all others; an empty table gives an empty table; all
columns of the input are returned, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_row
from tidemark.llm.groups import group, shared_buckets

MIN_WORDS = 5
# The longer line's characters over this are the edits allowed.
EDITS = 10
BITS, BLOCKS, EQUAL = 64, 6, 3
# Characters of the grams by which large buckets are cut.
GRAM = 5
# Features of a line whose bits are summed in lanes of 16 bits; the upper two stay free, for the majority and the sign.
LANE = 16_383
# Turns of stars before the rest is settled; the rare grams settle it at little cost.
TURNS = 3
# Limits for which Spark works on a band of the table of distances.
LIMITS = tuple(2**k for k in range(3, 15))
# Lines whose texts may be looked up by a broadcast of their hashes (16 bytes each).
BROADCAST_LINES = 1_000_000


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def features(words: Column) -> Column:
    """The hashes of each word with the next. Single words would make all lines of a language
    alike, since its commonest words outweigh the others."""
    return F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.xxhash64(a, b))


def simhash(hashed: DataFrame, key: str, feature: str) -> DataFrame:
    """``key, bits``: the majority of each bit of the features, over a key's rows.

    Summed per bit, so tasks add up what they have before anything is shuffled. A key's
    features may be there any number of times, if each is there equally often.
    """
    ones = [F.sum(F.shiftrightunsigned(feature, k).bitwiseAND(F.lit(1))).alias(f"_bit{k}") for k in range(BITS)]
    summed = hashed.groupBy(key).agg(F.count("*").alias("_features"), *ones)
    none = F.lit(0).cast("bigint")
    bits = [F.when(2 * F.col(f"_bit{k}") > F.col("_features"), F.shiftleft(F.lit(1).cast("bigint"), k)).otherwise(none) for k in range(BITS)]
    return summed.select(key, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("bits"))


def line_simhash(words: DataFrame) -> DataFrame:
    """``raw, node, bits`` of rows ``raw, node, features``, each with at most ``LANE`` of the latter.

    Each row is summed by itself, four bits side by side in a long: 16 sums a row are shuffled, not 64.
    """
    # Numbered before the features are rows; in one step with them, each of these would have its own number.
    each = words.withColumn("line", F.monotonically_increasing_id()).select("raw", "node", "line", F.explode("features").alias("feature"))
    lanes = F.lit(0x0001000100010001)
    sums = [F.sum(F.shiftrightunsigned("feature", k).bitwiseAND(lanes)).alias(f"_sum{k}") for k in range(16)]
    summed = each.groupBy("line", "raw", "node").agg(F.count("*").alias("_features"), *sums)
    # What a majority lacks to the free bit is added in each lane, so that bit says whether it is one.
    lack = (LANE - F.floor(F.col("_features") / 2)) * lanes
    bits = [F.shiftleft(F.shiftrightunsigned(F.col(f"_sum{k}") + lack, 14).bitwiseAND(lanes), k) for k in range(16)]
    return summed.select("raw", "node", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("bits")).distinct()


def _block(bits: Column, at: int) -> Column:
    first, last = at * BITS // BLOCKS, (at + 1) * BITS // BLOCKS
    return F.shiftrightunsigned(bits, first).bitwiseAND(F.lit((1 << (last - first)) - 1))


def buckets(bits: Column) -> Column:
    """The bucket keys of a SimHash: every choice of three of its six blocks."""
    keys = []
    for number, chosen in enumerate(combinations(range(BLOCKS), EQUAL)):
        key = F.lit(number).cast("bigint")
        for at in chosen:
            key = F.shiftleft(key, 11).bitwiseOR(_block(bits, at))
        keys.append(key)
    return F.array(*keys)


def _split(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, pos, line, raw`` of every line; ``raw`` is the hash of its characters."""
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return split.withColumn("raw", F.xxhash64("line"))


def _edit_distance(x: str, y: str, allowed: Column) -> Column:
    """The edit distance where it is at most ``allowed``; -1 if it is beyond the next limit."""
    out = F.levenshtein(x, y)
    for limit in reversed(LIMITS):
        out = F.when(allowed <= limit, F.levenshtein(x, y, limit)).otherwise(out)
    return out


def rare_grams(rows: DataFrame) -> DataFrame:
    """``bucket, node, key`` of rows ``bucket, node, norm``: the rarest grams of each line in its bucket.

    An edit changes at most ``GRAM`` grams. So with the grams of each line in one order, by frequency, two
    lines within ``t`` edits of each other share one among the first ``GRAM`` * t + 1 of each.
    A gram's second occurrence in a line counts as another gram. No line is shorter than nine characters,
    which have more grams than that.
    """
    size = F.length("norm")
    # A line within the limit has at most 10/9 of the characters.
    edits = F.floor(F.floor(size * EDITS / (EDITS - 1)) / EDITS)
    starts = F.sequence(F.lit(1), F.greatest(size - (GRAM - 1), F.lit(1)))
    grams = rows.select("bucket", "node", (edits * GRAM + 1).alias("first"), F.explode(F.transform(starts, lambda at: F.xxhash64(F.substr("norm", at, F.lit(GRAM))))).alias("gram"))
    again = Window.partitionBy("bucket", "node", "gram").orderBy("first")
    keyed = grams.select("bucket", "node", "first", F.xxhash64("gram", F.row_number().over(again)).alias("key"))
    often = keyed.groupBy("bucket", "key").agg(F.count("*").alias("n"))
    order = Window.partitionBy("bucket", "node").orderBy("n", "key")
    chosen = keyed.join(often, ["bucket", "key"]).withColumn("place", F.row_number().over(order))
    # A gram of one line only joins nothing.
    return chosen.filter("place <= first and n > 1").select("bucket", "node", "key")


def line_groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Occurrences ``doc_id, text_hash, pos, raw``, and ``raw, root`` of all worded lines.

    ``docs`` has ``doc_id`` and ``text``. Lines of one root are similar or equal.
    """
    places = _split(docs).drop("line").checkpoint()

    def featured(split: DataFrame) -> DataFrame:
        # An exploded array of one: what follows uses the normalised line, not its expression.
        norm = split.select("raw", F.explode(F.array(normalised(F.col("line")))).alias("norm"))
        worded = norm.filter(F.substring_index("norm", " ", MIN_WORDS - 1) != F.col("norm"))
        return worded.select("raw", F.xxhash64("norm").alias("node"), F.explode(F.array(features(F.split("norm", " ")))).alias("features"))

    # One pass gives each distinct line the hash of its words, the node, and its SimHash. Only a line of more than
    # ``LANE`` characters can have more features; of these lines 64 sums are shuffled. (A dotted capital I is a
    # word in lower case, since its dot is no letter.)
    hashed = line_simhash(featured(_split(docs)).filter(F.size("features") <= LANE))
    longer = _split(docs.filter(F.length("text") > LANE)).filter(F.length("line") > LANE)
    longer = featured(longer).filter(F.size("features") > LANE)
    longer = simhash(longer.select(F.struct("raw", "node").alias("line"), F.explode("features").alias("feature")), "line", "feature")
    known = hashed.union(longer.select("line.raw", "line.node", "bits")).checkpoint()
    nodes = known.groupBy("node").agg(F.min("bits").alias("bits"), F.min("raw").alias("raw")).checkpoint()
    members = shared_buckets(nodes.select("node", F.explode(buckets(F.col("bits"))).alias("bucket"))).checkpoint()
    # One occurrence of each candidate gives its text; only the texts that hold one are cut.
    wanted = nodes.join(members.select("node").distinct(), "node").select("node", "raw")
    first = places.join(wanted, "raw").groupBy("node").agg(F.min(F.struct("text_hash", "pos")).alias("at"))
    wanted = first.select("node", "at.text_hash", "at.pos").checkpoint()
    small = wanted.count() <= BROADCAST_LINES
    holders = docs.select("text", F.xxhash64("text").alias("text_hash")).join(F.broadcast(wanted) if small else wanted, "text_hash")
    texts = (
        holders.select("node", normalised(F.get(F.split("text", "\n"), F.col("pos"))).alias("norm"))
        .groupBy("node").agg(F.min("norm").alias("norm")).checkpoint()
    )

    def verify(pairs: DataFrame) -> DataFrame:
        a = texts.select(F.col("node").alias("a"), F.col("norm").alias("x"))
        b = texts.select(F.col("node").alias("b"), F.col("norm").alias("y"))
        allowed = F.floor(F.greatest(F.length("x"), F.length("y")) / EDITS).cast("int")
        both = pairs.join(a, "a").join(b, "b").withColumn("allowed", allowed)
        # The difference of lengths is a lower bound of the distance.
        near = both.filter(F.abs(F.length("x") - F.length("y")) <= F.col("allowed"))
        # A distance of 0 to ``allowed``, with the distance named once: it is computed once.
        distance = _edit_distance("x", "y", F.col("allowed"))
        return near.filter(F.abs(2 * distance - F.col("allowed")) <= F.col("allowed")).select("a", "b")

    def keys(rows: DataFrame) -> DataFrame:
        return rare_grams(rows.join(texts, "node"))

    roots = known.select("raw", "node").join(group(members, verify, rounds=TURNS, keys=keys), "node", "left")
    return places, roots.select("raw", F.coalesce("root", "node").alias("root"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, places``: the lines of each document that repeat an earlier one."""
    places, roots = line_groups(docs)
    places = places.withColumn("order", F.coalesce("doc_id", F.lit(2**63 - 1)))
    counted = places.groupBy("raw").agg(F.count("*").alias("n"), F.min("order").alias("first"))
    labelled = counted.join(roots, "raw")
    classes = labelled.groupBy("root").agg(F.sum("n").alias("n"), F.min("first").alias("first")).filter("n > 1")
    several = labelled.select("raw", "root").join(classes.select("root", "first"), "root")
    found = places.join(several, "raw")
    # In the group's first document all but the first of its lines repeat.
    inside = found.filter(F.col("order") == F.col("first"))
    kept = inside.groupBy("root").agg(F.min(F.struct("pos", "text_hash")).alias("k"))
    kept = kept.select(F.col("root").alias("of"), F.col("k.text_hash").alias("kept_hash"), F.col("k.pos").alias("kept_pos"))
    late = inside.join(kept, F.col("root") == F.col("of")).filter("text_hash != kept_hash or pos != kept_pos")
    columns = ("doc_id", "text_hash", "pos")
    marked = found.filter(F.col("order") != F.col("first")).select(*columns).union(late.select(*columns))
    return marked.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("places"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``row`` (the input's columns), ``kept_text``, ``n_lines`` and ``n_dropped``."""
    plain = docs.select("doc_id", "text")
    drop = repeated_lines(plain).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "places")
    # The text is moved once, in its row.
    rows = as_row(docs, doc_id=F.col("doc_id"), text_hash=F.xxhash64("text"))
    joined = rows.join(drop, rows["doc_id"].eqNullSafe(drop["id"]) & (rows["text_hash"] == drop["hash"]), "left")
    lines = F.col("lines")
    text = F.col("row.text")
    joined = joined.withColumn("lines", F.split(text, "\n"))
    # Dropped lines become missing ones, by one walk over the sorted places: a long text may
    # hold many, so looking each line up in a list would be quadratic.
    gaps = F.transform(F.concat(F.array(F.lit(-1)), F.sort_array("places")), lambda p: p + 1)
    ends = F.concat(F.sort_array("places"), F.array(F.size(lines)))
    stretches = F.zip_with(gaps, ends, lambda start, end: F.slice(lines, start + 1, F.greatest(end - start, F.lit(0))))
    kept = F.when(F.col("places").isNull(), text).otherwise(F.array_join(F.flatten(stretches), "\n"))
    return joined.select(
        "row",
        kept.alias("kept_text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with only their kept lines; those of which no word is left are gone."""
    made = dedup_lines(docs)
    made = made.filter((F.col("n_dropped") == 0) | F.col("kept_text").rlike(r"[\p{L}\p{N}]"))
    fields = [
        (F.col("kept_text") if name == "text" else F.length("kept_text").cast(docs.schema[name].dataType) if name == "n_chars" else F.col(f"row.`{name}`")).alias(name)
        for name in docs.columns
    ]
    return made.select(*fields)
