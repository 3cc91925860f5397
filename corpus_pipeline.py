"""A corpus pipeline of five stages, near duplicates included; each works on all that its predecessor kept.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame``.  All but the last return the columns of documents;
the last one encodes what is left.  ``run`` writes every stage as Parquet in the shared checkpoint folder and reads it
again for the next, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm import decontaminate, jaccard_join, line_dedup, quality_rules, sentence_pieces
from clickloom.session import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the repetition rules reject."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated line runs; a document that loses all its words goes, n_chars follows the text."""
    names = docs.columns
    # by position, as a column of the documents may have any name
    inner = [f"_c{i}" for i in range(len(names))]
    left = line_dedup.dedup_lines(docs).toDF(*inner, "_lines", "_removed", "_runs")
    text = F.col(inner[names.index("text")])
    left = left.where((F.col("_removed") == 0) | text.rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in names:
        chars = inner[names.index("n_chars")]
        now = F.when(F.col("_removed") == 0, F.col(chars)).otherwise(F.length(text))
        left = left.withColumn(chars, now.cast(docs.schema["n_chars"].dataType))
    return left.select(*inner).toDF(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every component of similar ones: 5 words, 0.8 or more."""
    return jaccard_join.keep_one_each(docs, width=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold passages of benchmark items."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_contaminated(docs, items)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text; ids and the alternative segmentations."""
    return sentence_pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("SentencePiece encoding", encode),
]

# The last stage is a search over a model file's lattice: the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
