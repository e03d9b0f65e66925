"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_held: dict = {}


def held(key, make):
    """One large object for each Python worker, kept for its next task; asking for another lets it go."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


BATCH_ROWS = 1000


def in_batches(df: DataFrame) -> DataFrame:
    """df, for mapInArrow: from here on the session hands Python ``BATCH_ROWS`` rows at once or fewer, as texts may be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` would also change other alphabets."""
    return F.translate(text, UPPER, LOWER)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only in local mode, where all share one machine, a missing setting is made up for.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="keyflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """Tables in a new folder of the shared one: lineage ends at each, so a lost executor costs nothing that was written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, shared_folder(spark, name)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more; without names all of them."""
        for path in [f"{self.folder}/{n}" for n in names] or [self.folder]:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """A table that stays."""
    return Scratch(df.sparkSession, name).write(df, "table")


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)
