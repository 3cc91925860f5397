"""One query per operator, over the whole of its table with production parameters."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm import (
    chat_format, decontaminate, jaccard_join, kneser_ney, language_id, line_dedup, oracles, quality_rules, secret_scan,
    sentence_pieces, spelling_variants, token_alignment, token_counts, vantage_trees,
)
from clickloom.llm.registry import query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sentence_pieces")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op2_line_dedup", oracles.LINE_DEDUP)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("runs")


@query("op3_quality_rules", oracles.QUALITY_RULES)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_decontaminate", oracles.DECONTAMINATE)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items", "hits")


@query("op10_chat_format", oracles.CHAT_FORMAT)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return chat_format.digests(chat_format.format_turns(rows, vocabulary), vocabulary).drop(
        "n_tokens", "n_loss_tokens")


@query("op5_jaccard_join", oracles.JACCARD_JOIN)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).drop("n_links")


@query("op6_kneser_ney")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.learn(docs))


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = language_id.train(language_id.sample(docs))
    marked = docs.select("doc_id", "text", F.coalesce(language_id.fold_of() == 0, F.lit(False)).alias("held_out"))
    return language_id.identify(marked, net, carry=["doc_id", "held_out"])


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(spelling_variants.word_counts(table(spark, sf_dir, "documents")))


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                            public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_vantage_trees")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vantage_trees.nearest(rows, rows.where(F.col("vec_id") % 20 == 0))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
