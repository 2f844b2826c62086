"""Streams of canonical messages: duplicates, daily counts, answered questions, incremental runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatloom.functions.ids import clean_id
from chatloom.operators.incremental import SeenStore

LATE = "48 hours"


def deduplicated(stream: DataFrame, late: str = LATE) -> DataFrame:
    """The first copy of each message within the watermark; messages without an id all pass."""
    keyed = stream.withColumn("_id", clean_id("message_id"))
    with_id = keyed.where("_id is not null").withWatermark("ts", late).dropDuplicatesWithinWatermark(["export_key", "_id"])
    return with_id.drop("_id")


def daily_counts(stream: DataFrame, late: str = LATE) -> DataFrame:
    """Messages and authors (approximately) per day and channel, closed once the watermark has passed."""
    days = stream.withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("w"), "channel")
    return days.agg(F.count(F.lit(1)).alias("messages"), F.approx_count_distinct("author_id").alias("authors")).select(F.to_date("w.start").alias("day"), "channel", "messages", "authors")


def answered(questions: DataFrame, replies: DataFrame, late: str = LATE) -> DataFrame:
    """J1 on streams: question and reply pairs at most 48 hours apart. The join needs a lower bound
    too: replies earlier than 48 hours before their question are not met, unlike in batch."""
    q = questions.select(F.col("message_id").alias("q_id"), F.col("ts").alias("q_ts")).withWatermark("q_ts", late)
    r = replies.where("reply_to_message_id is not null").select(F.col("reply_to_message_id").alias("r_to"), F.col("ts").alias("r_ts")).withWatermark("r_ts", late)
    near = (F.col("r_ts") <= F.col("q_ts") + F.expr("INTERVAL 48 HOURS")) & (F.col("r_ts") >= F.col("q_ts") - F.expr("INTERVAL 48 HOURS"))
    return q.join(r, (F.col("q_id") == F.col("r_to")) & near)


def incremental_runs(stream: DataFrame, store: SeenStore, run: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
    """Each micro-batch is a run: messages the store hasn't seen go to `run`, then their ids into the store.

    A batch that is replayed after a failure between the two goes to `run` again with the same number.
    """

    def one(batch: DataFrame, number: int) -> None:
        fresh = store.filter_new(batch).persist()
        try:
            run(fresh, number)
            store.mark(fresh)
        finally:
            fresh.unpersist()

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
