"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, ctw, decontam, icws, lines, pii, quality, repair, tokencount, topk, trie, wrapper
from tidemark.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def _spans(spans: Column) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[of_kind(kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(_spans(base), 256).alias("base_sha256"),
        _spans(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("bigint").alias("n_added"),
    )


def op2_icws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return icws.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(
        read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048
    )


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    return chat.conversation_digests(chat.examples(turns.unionByName(extra)))


def op8_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = wrapper.extract(read(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("bigint"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests_by_id(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminations(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(read(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), F.col("kept_text").alias("text"), "n_lines", "n_dropped"
    )


def op7_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(read(spark, sf_dir, "documents"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digests(repair.repair(repair.damaged(read(spark, sf_dir, "conversations"))))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_nodes(trie.rebuilt(read(spark, sf_dir, "conversations")))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_icws": op2_icws,
    "op3_token_counts": op3_token_counts,
    "op4_chat": op4_chat,
    "op5_decontam": op5_decontam,
    "op6_lines": op6_lines,
    "op7_ctw": op7_ctw,
    "op8_wrapper": op8_wrapper,
    "op9_quality": op9_quality,
    "op10_bpe": op10_bpe,
    "op11_repair": op11_repair,
    "op12_trie": op12_trie,
    "op13_topk": op13_topk,
}
