"""Impression tables derived from the generated test tables.

``impressions``       one row per event, with the columns a click-prediction table has
``sequences``         one row per document: its word lengths as a long behaviour sequence
``feature_table``     one row per order line, with named numeric features
``embedding_table``   one row per vector, one column per dimension
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SPLIT_DAY = "2024-01-28"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_lengths(text):
    """The length of every word of the whole text, as a comma-separated sequence."""
    return F.array_join(F.transform(F.split(text, " "), lambda t: F.length(t).cast("string")), ",")


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_idx, seq, clicked``; every 67th sequence is null, and few rows are positive."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_idx"), F.when(F.col("doc_id") % 67 != 5, word_lengths(F.col("text"))).alias("seq"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_idx"), "toxic")
    return docs.join(labels, "row_idx", "left").select(
        "row_idx", "seq", F.coalesce("toxic", F.lit(0)).cast("int").alias("clicked"))


def impressions(spark: SparkSession, sf_dir: str, with_seq: bool = False) -> DataFrame:
    """Every event as an impression.

    With ``with_seq`` ten consecutive events share the sequence of one document, so the join is balanced
    whatever the users do; events beyond the last document have no sequence.
    """
    ev = table(spark, sf_dir, "events")
    eid, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("int")
    df = ev.select(
        eid.alias("row_idx"),
        (F.col("event_type") == "click").cast("int").alias("clicked"),
        F.when(eid % 97 != 0, (F.col("user_id") % 3).cast("int")).alias("gender"),
        (F.col("user_id") % 8).cast("string").alias("age_group"),
        k.cast("string").alias("inventory_id"),
        (F.weekday("ts") + 1).cast("string").alias("day_of_week"),
        F.date_format("ts", "HH").alias("hour"),
        F.when(eid % 10 != 3, F.col("value")).alias("feat_e_3"),
        F.when(eid % 53 != 0, (k % 17).cast("double")).alias("history_a_6"),
        F.floor("value").cast("double").alias("history_b_11"),
        F.when(eid % 41 != 0, (eid % 97).cast("double")).alias("history_b_22"),
        (eid % 23).cast("double").alias("history_b_23"),
        (k < 10).alias("_low_k"),
        (F.col("value") + F.col("user_id") > 90).cast("int").alias("learnable"),
        "ts",
    )
    if with_seq:
        docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_doc"), word_lengths(F.col("text")).alias("seq"))
        df = df.withColumn("_doc", F.expr("row_idx div 10")).join(docs, "_doc", "left").drop("_doc")
        df = df.withColumn("seq", F.when(F.col("row_idx") % 71 != 7, F.col("seq")))
    return df


def rare(df: DataFrame) -> DataFrame:
    """Impressions with a rare label (about 2 % positive)."""
    return df.withColumn("clicked", F.when(F.col("_low_k"), F.col("clicked")).otherwise(0))


def public(df: DataFrame) -> DataFrame:
    """Without the helper columns."""
    return df.drop("_low_k", "learnable")


def train_part(df: DataFrame) -> DataFrame:
    return df.where(F.col("ts") < F.lit(SPLIT_DAY).cast("timestamp")).drop("ts")


def test_part(df: DataFrame) -> DataFrame:
    """Everything after the training period, without the label and with an ``ID``."""
    later = F.col("ts") >= F.lit(SPLIT_DAY).cast("timestamp")
    return df.where(later).drop("ts", "clicked").withColumn("ID", F.col("row_idx").cast("string"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_idx, clicked, score``: the rare label and a pseudo-prediction with many ties."""
    df = rare(impressions(spark, sf_dir))
    digest = F.md5(F.concat(F.lit("7|"), F.col("row_idx").cast("string")))
    score = F.conv(F.substring(digest, 1, 4), 16, 10).cast("double") / 65536.0
    return df.select("row_idx", "clicked", score.alias("score"))


FEATURES = [
    "feat_a_1", "feat_a_2", "feat_b_1", "feat_c_1", "feat_d_1", "feat_e_3",
    "history_a_1", "history_a_2", "history_b_1", "history_b_2", "history_b_3", "l_feat_1",
]


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as features; some are nearly equal, one has nulls, and several relate to the label."""
    li = table(spark, sf_dir, "lineitem")
    price, disc, tax, qty = (F.col(c) for c in ("l_extendedprice", "l_discount", "l_tax", "l_quantity"))
    return li.select(
        ((qty > 30) & (disc < 0.05) & (F.col("l_returnflag") == "R")).cast("int").alias("clicked"),
        disc.alias("feat_a_1"), tax.alias("feat_a_2"),
        F.col("l_partkey").cast("double").alias("feat_b_1"), F.col("l_suppkey").cast("double").alias("feat_c_1"),
        F.col("l_linenumber").cast("double").alias("feat_d_1"),
        F.when(F.col("l_orderkey") % 10 != 3, disc * price).alias("feat_e_3"),
        qty.alias("history_a_1"), price.alias("history_a_2"),
        (price * (1 - disc)).alias("history_b_1"), (price * (1 - disc) * (1 + tax)).alias("history_b_2"),
        (qty * 2 + 1).alias("history_b_3"),
        F.dayofyear("l_shipdate").cast("double").alias("l_feat_1"),
    )


DIMENSIONS = 64


def embedding_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_idx"), "label",
        *[F.col("embedding")[i].cast("double").alias(f"emb_{i:02d}") for i in range(DIMENSIONS)])
