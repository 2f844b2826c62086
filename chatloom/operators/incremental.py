"""Runs after runs: new messages, the seen store, merged statistics, differences and trends.

Statistics are long rows (`category`, `key`, `value`); the nested document is made of them at the sink.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.functions.ids import clean_id

# Categories whose values aren't summed when runs are merged.
MERGE_RULES = {"users": "max", "date_first": "min", "date_last": "max", "retention": "last", "top_domains": "last", "channels": "last"}


def new_messages(messages: DataFrame, seen: DataFrame, export: str = "export_key", identifier: str = "message_id") -> DataFrame:
    """Messages whose id the store doesn't have for their export, repeats kept.

    Blanks around ids are ignored; messages without an id are always new.
    """
    known = seen.select(F.col(export).alias("_e"), clean_id(identifier).alias("_i")).where("_i is not null").distinct()
    return messages.join(known, (F.col(export) == F.col("_e")) & (clean_id(messages[identifier]) == F.col("_i")), "left_anti")


def seen_upsert(messages: DataFrame, seen: DataFrame, export: str = "export_key", identifier: str = "message_id") -> DataFrame:
    """The entries (`export`, `message_id`) that a run over the messages adds to the store, each once."""
    fresh = new_messages(messages, seen, export, identifier).select(F.col(export), clean_id(identifier).alias("message_id"))
    return fresh.where("message_id is not null").distinct()


def run_log(states: DataFrame, runs: DataFrame) -> DataFrame:
    """Per export the path and time of the latest run and the total of processed messages.

    `states` and `runs` both have export_key, export_path, last_run_at, total_processed; a run adds to the total.
    """
    rows = states.select("export_key", "export_path", "last_run_at", "total_processed").unionByName(runs.select("export_key", "export_path", "last_run_at", "total_processed"))
    return rows.groupBy("export_key").agg(F.max_by("export_path", "last_run_at").alias("export_path"), F.max("last_run_at").alias("last_run_at"), F.sum("total_processed").alias("total_processed"))


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """One set of statistics from two: counters are summed, user counts the larger, dates widened,
    and what only the latest run can tell is taken from it (from the old one where the new has none)."""
    rows = old.select("category", "key", "value", F.lit(0).alias("run")).unionByName(new.select("category", "key", "value", F.lit(1).alias("run")))
    rule = F.coalesce(*[F.when(F.col("category") == c, r) for c, r in MERGE_RULES.items()], F.lit("sum"))
    grouped = rows.groupBy("category", "key").agg(F.sum("value").alias("s"), F.max("value").alias("hi"), F.min("value").alias("lo"), F.max_by("value", "run").alias("last"))
    value = F.when(rule == "max", F.col("hi")).when(rule == "min", F.col("lo")).when(rule == "last", F.col("last")).otherwise(F.col("s"))
    return grouped.select("category", "key", value.alias("value"))


def differences(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keys whose value changed: `old_value`, `new_value` (0 if missing), `delta`, `pct`
    (null if there was none), `status` new, gone or changed."""
    a, b = old.select("category", "key", F.col("value").alias("o")), new.select("category", "key", F.col("value").alias("n"))
    both = a.join(b, ["category", "key"], "full_outer").select("category", "key", F.coalesce("o", F.lit(0)).alias("old_value"), F.coalesce("n", F.lit(0)).alias("new_value"))
    status = F.when(F.col("old_value") == 0, "new").when(F.col("new_value") == 0, "gone").otherwise("changed")
    delta = F.col("new_value") - F.col("old_value")
    return both.where("old_value <> new_value").select("*", delta.alias("delta"), F.try_divide(delta * 100.0, F.col("old_value")).alias("pct"), status.alias("status"))


def trend(runs: DataFrame) -> DataFrame:
    """Per key and run (`run_idx`) the value, its change to the run before, and that in percent."""
    before = F.lag("value").over(Window.partitionBy("category", "key").orderBy("run_idx"))
    rows = runs.withColumn("_b", before)
    return rows.select("category", "key", "run_idx", "value", (F.col("value") - F.col("_b")).alias("delta"), F.try_divide((F.col("value") - F.col("_b")) * 100.0, "_b").alias("pct"))


def runs_of(spark: SparkSession, documents: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Statistics documents of several runs, oldest first, as long rows: `run_idx`, `category`, `key`, `value`.
    What isn't a number is left out."""
    from chatloom.sinks.documents import flat_rows

    rows = []
    for k, document in enumerate(documents):
        for category, key, value in flat_rows(document):
            try:
                rows.append((k, category, key, float(value)))
            except ValueError:
                continue
    return spark.createDataFrame(rows, "run_idx int, category string, key string, value double")


class SeenStore:
    """The store as a Parquet folder, partitioned by export; a run appends what is new.

    Ids are recorded on every run, also the first, and only for rows that passed its filters.
    """

    SCHEMA = "export_key string, message_id string, seen_at timestamp"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def read(self) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        there = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        if not there:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.folder)

    def filter_new(self, messages: DataFrame) -> DataFrame:
        return new_messages(messages, self.read())

    def mark(self, messages: DataFrame) -> None:
        """Record the ids of the messages that aren't in the store yet."""
        entries = seen_upsert(messages, self.read()).withColumn("seen_at", F.current_timestamp())
        entries.select("message_id", "seen_at", "export_key").write.mode("append").partitionBy("export_key").parquet(self.folder)
