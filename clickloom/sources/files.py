"""Small text files on any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """A small file (report, metadata) on whatever file system the path names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(content, "utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]
