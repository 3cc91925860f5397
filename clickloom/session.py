"""Session settings, the shared checkpoint folder, and measured (size-checked) intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType


def local_session(cores: int | str = "*", app: str = "clickloom", **conf) -> SparkSession:
    """A local session for tests, benchmarks and small runs.  On a cluster, pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint`` usable and return the folder.

    The folder is the one the cluster names in ``spark.checkpoint.dir``.  Only a local master, where
    driver and executors share one machine, gets a folder of its own when nothing is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="clickloom-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


# A measured table up to this size may be sorted or scanned by one task.
ONE_TASK_ROWS = 1_000_000


class Scratch:
    """Intermediate tables in a folder of their own below the shared checkpoint folder.

    Written tables survive lost executors and carry true sizes; the result of ``checkpoint`` keeps the estimate of its
    old plan, and estimates of repeated joins multiply from round to round.  ``close`` deletes them; tables that a
    lazy result still reads stay until the driver ends, when every open folder is deleted.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{use_checkpoint_dir(spark)}/clickloom-{uuid.uuid4().hex}"
        self._count = 0
        atexit.register(self._at_exit)

    def keep(self, df: DataFrame) -> DataFrame:
        """Write a table and read it back."""
        path = f"{self.path}/{self._count}"
        self._count += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        atexit.unregister(self._at_exit)
        if self._count:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _at_exit(self) -> None:
        try:
            self.close()
        except Exception:  # the session may have ended before
            pass


@dataclass
class Measured:
    """A persisted table whose size is known, so that join strategies rest on a measured size.

    ``rows`` may be an upper bound when the table is a selection of a counted one.  ``bytes`` counts its texts.

    ``persist`` keeps the lineage: blocks lost with an executor are recomputed.
    """

    df: DataFrame
    rows: int
    bytes: int = 0

    def release(self) -> None:
        self.df.unpersist()


def measure(df: DataFrame) -> Measured:
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, StringType)]
    width = sum(texts, F.lit(0)).cast("bigint")
    rows, size = kept.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return Measured(kept, rows, size)
