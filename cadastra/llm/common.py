"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in one Arrow batch: what a Python worker holds at a time stays bounded
#: however long single texts are.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches for the text operators, unless the session sets its own bound."""
    for key, default, bound in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", None, BATCH_BYTES),
    ):
        now = spark.conf.get(key, None)
        if now is None or now == default or (default is None and int(now) > (1 << 40)):
            spark.conf.set(key, str(bound))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode where none is configured."""
    conf = spark.sparkContext.getConf()
    shared = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not shared and not conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return shared or os.path.join(tempfile.gettempdir(), "cadastra-checkpoints")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for temporary columns that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def passed(df: DataFrame, *results: str) -> list[Column]:
    """The columns of ``df`` but those that have a result's name, in whatever case."""
    replaced = {r.lower() for r in results}
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c.lower() not in replaced]


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


SMALLEST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


class Scratch:
    """Tables written to the shared folder: they cut the lineage and outlive executors."""

    def __init__(self, spark: SparkSession):
        self.spark, self.top, self.n = spark, os.path.join(shared_folder(spark), f"scratch-{uuid.uuid4().hex}"), 0

    def cut(self, df: DataFrame, part: str = "work") -> DataFrame:
        """``df`` written and read again."""
        self.n += 1
        path = f"{self.top}/{part}/{self.n}"
        # Small tables are written as few files; the caller's setting holds again afterwards.
        before = self.spark.conf.get(SMALLEST, None)
        self.spark.conf.set(SMALLEST, "16m")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.unset(SMALLEST) if before is None else self.spark.conf.set(SMALLEST, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, part: str = "work") -> None:
        """Delete the tables of one part; no plan may read them afterwards."""
        delete(self.spark, f"{self.top}/{part}")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
