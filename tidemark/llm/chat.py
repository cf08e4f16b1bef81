"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and
only its reply is trainable. A conversation that goes on after its last reply (or has
none) gives one more example without a target, so that no turn is lost. Examples grow
with the square of a conversation's turns; that is what the format asks for. They are
made one at a time from the conversation's row and are never gathered again.

Template: ``<|turn|>role<|says|>text<|end|>`` for each turn. In roles and texts ``&`` is
written ``&amp;`` and ``<`` is written ``&lt;``, so no control string can occur inside
them, and reading ``&lt;`` and then ``&amp;`` back restores every text.

Defined results: turns are ordered by turn, role and text, missing numbers first; repeated
rows are turns of their own; a missing role or text counts as empty; a missing conversation
id is a conversation like any other; empty input gives no examples; other columns of the
input do not take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
TARGET = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def examples(turns: DataFrame) -> DataFrame:
    """``conv_id, example, n_turns, formatted, mask_start, mask_length, last``.

    ``formatted`` holds the context and the reply; the mask covers the reply's text
    only (code points from ``mask_start``, of ``mask_length``; missing without a target).
    ``last`` marks the example that holds all turns.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    talks = turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("t")).alias("turns")
    )
    pieces = talks.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(SAYS), escape(t["text"]), F.lit(END)),
        ).alias("pieces"),
        F.transform("turns", lambda t: t["role"] == TARGET).alias("targets"),
    )
    ends = F.filter(
        F.transform("targets", lambda hit, i: F.when(hit | (i == F.size("targets") - 1), i + 1)),
        lambda i: i.isNotNull(),
    )
    split = pieces.select("conv_id", "pieces", "targets", F.posexplode(ends).alias("example", "n_turns"))
    made = split.select(
        "conv_id",
        "example",
        "n_turns",
        F.array_join(F.slice("pieces", F.lit(1), F.col("n_turns")), "").alias("formatted"),
        F.element_at("pieces", F.col("n_turns")).alias("piece"),
        F.element_at("targets", F.col("n_turns")).alias("target"),
        (F.col("n_turns") == F.size("pieces")).alias("last"),
    )
    head = F.length(F.lit(f"{TURN}{TARGET}{SAYS}"))
    return made.select(
        "conv_id",
        "example",
        "n_turns",
        "formatted",
        F.when(F.col("target"), F.length("formatted") - F.length("piece") + head).alias("mask_start"),
        F.when(F.col("target"), F.length("piece") - head - len(END)).alias("mask_length"),
        "last",
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example, as an array of ``(role, text)``."""
    ended = F.split(formatted, "<\\|end\\|>")
    pieces = F.slice(ended, F.lit(1), F.size(ended) - 1)

    def turn(piece: Column) -> Column:
        said = F.split(piece, "<\\|says\\|>")
        return F.struct(
            unescape(F.substr(said[0], F.lit(len(TURN) + 1))).alias("role"), unescape(said[1]).alias("text")
        )

    return F.transform(pieces, turn)


def masked_text(formatted: Column, start: Column, length: Column) -> Column:
    """The original text under the loss mask; missing where there is no target."""
    return F.when(start.isNotNull(), unescape(F.substr(formatted, start + 1, length)))


def conversation_digests(made: DataFrame) -> DataFrame:
    """Per conversation what its examples say, read back from them."""
    rows = made.select(
        "conv_id",
        "example",
        F.when(F.col("last"), read_turns(F.col("formatted"))).alias("turns"),
        masked_text(F.col("formatted"), F.col("mask_start"), F.col("mask_length")).alias("loss"),
        F.length("formatted").alias("chars"),
    )
    grouped = rows.groupBy("conv_id").agg(
        F.max("turns").alias("turns"),
        F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
        F.count("loss").alias("n_targets"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return grouped.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("bigint").alias("formatted_chars"),
        "n_targets",
    )
