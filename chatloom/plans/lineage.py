"""Cutting lineage through tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session. Where that is unset, a local master gets a folder of its
    own (tests); a cluster is refused, as a folder of one machine would be lost with it."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="chatloom-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Cuts:
    """Intermediate tables of one job.

    A cut is a compressed Parquet table in the shared folder, so it outlives the loss of any
    executor and costs a fraction of what checkpoint() writes. `drop` frees a table that no later
    plan reads; what a result still reads is deleted when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/chatloom-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        fs, where = self._at(self.root)
        fs.mkdirs(where)
        fs.deleteOnExit(where)

    def _at(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def cut(self, df: DataFrame) -> tuple[DataFrame, str]:
        """Write `df` and return (the table read again, its path)."""
        path = f"{self.root}/{self.count}"
        self.count += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, *paths: str) -> None:
        for path in paths:
            fs, where = self._at(path)
            fs.delete(where, True)
