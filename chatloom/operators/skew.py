"""Per-key aggregates when a few keys hold most rows (p4)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Heavy hitters are never more than this: a share below 1 / MAX_HEAVY is refused.
MAX_HEAVY = 100_000


def _fresh(df: DataFrame, stem: str) -> str:
    """A column name that `df` doesn't have in any case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name in taken:
        name += "_"
    return name


def sketch(df: DataFrame, key: str, share: float) -> DataFrame:
    """Candidates (`key`) that surely hold every non-null key with at least `share` of the rows.

    A Misra-Gries summary of 2 / share counters is kept by each task over Arrow batches, so any key
    that falls short of the counters in all tasks has less than share / 2 of the rows. Summaries,
    at most 2 / share rows from each task, are summed by an ordinary aggregate.
    """
    if not 1 / MAX_HEAVY <= share <= 1:
        raise ValueError(f"share must lie between {1 / MAX_HEAVY} and 1")
    slots = max(1, int(2 / share))
    kind = df.schema[key].dataType.simpleString()

    def summarise(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        held, seen = None, 0
        for batch in batches:
            column = batch.column(0)
            seen += len(column)
            fresh = pc.value_counts(pc.drop_null(column))
            fresh = pa.table({"k": fresh.field("values"), "c": fresh.field("counts")})
            held = fresh if held is None else pa.concat_tables([held, fresh]).group_by("k").aggregate([("c", "sum")]).rename_columns(["k", "c"])
            if len(held) > slots:  # take the (slots + 1)-th largest count from all
                counts = held.column("c").to_numpy()
                rest = counts - np.partition(counts, -slots - 1)[-slots - 1]
                held = pa.table({"k": held.column("k").filter(pa.array(rest > 0)), "c": rest[rest > 0]})
        if held is None or not len(held):
            return
        yield pa.RecordBatch.from_arrays([held.column("k").combine_chunks().cast(batch_type), pa.array(held.column("c").to_numpy(), pa.int64()), pa.array([seen] + [0] * (len(held) - 1), pa.int64())], names=["k", "c", "n"])

    from pyspark.sql.pandas.types import to_arrow_type

    batch_type = to_arrow_type(df.schema[key].dataType)
    parts = df.select(F.col(key).alias("k")).mapInArrow(summarise, f"k {kind}, c bigint, n bigint")
    # A task's summary undercounts a key by at most its rows / slots, all tasks by rows * share / 2.
    summed = parts.groupBy("k").agg(F.sum("c").alias("c"))
    return summed.orderBy(F.desc("c"), "k").limit(slots).select(F.col("k").alias(key))


def heavy_hitters(df: DataFrame, key: str, share: float, rows: str = "n_rows") -> DataFrame:
    """Exactly the non-null keys with at least `share` of all rows of `df`, and their row counts.

    The candidates of the sketch, at most 2 / share keys, are broadcast; a second pass counts only
    them, with map-side sums, and keeps those at or above the share. An empty table gives no row.
    """
    candidates = sketch(df, key, share)
    counted = (
        df.select(F.col(key).alias("_k"))
        .join(F.broadcast(candidates.select(F.col(key).alias("_c"))), F.col("_k") == F.col("_c"), "left")
        .groupBy(F.col("_c").alias(key))
        .agg(F.count(F.lit(1)).alias(rows))
    )
    total = F.sum(rows).over(_whole())
    # at most 2 / share + 1 rows reach the window
    return counted.withColumn("_total", total).where(F.col(key).isNotNull() & (F.col(rows) >= F.lit(share) * F.col("_total"))).drop("_total")


def _whole():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0))


def aggregate_by_key(
    df: DataFrame,
    key: str,
    partial: Sequence[Column],
    final: Sequence[Column],
    share: float = 0.001,
    salts: int = 64,
    empty_key: bool = True,
) -> DataFrame:
    """Results per key without tasks that run far longer than the rest.

    `partial` are aliased aggregates over rows, `final` aliased aggregates over their results (for
    example sum of counts, min of minima); `key` and all partial names are visible to `final`.
    A sketch names at most 2 / share keys that surely hold all with `share` of the rows; they are
    broadcast, and their rows, and those of the null key, are tagged with one of `salts` sub-keys. One
    aggregate by key and sub-key then serves heavy and other keys alike, of which the latter have a
    single sub-key and meet an ordinary shuffle; the second aggregate unites the sub-keys. So the table is scanned once by
    the sketch and once by the aggregate, and no task meets all rows of a heavy key.

    Null keys form one group (left out with empty_key=False). Other columns of `df`, whatever
    their names, are ignored unless the aggregates use them. An empty table gives no row.
    """
    salt, mark = _fresh(df, "salt_" + uuid.uuid4().hex[:6]), _fresh(df, "heavy_" + uuid.uuid4().hex[:6])
    heavy = sketch(df, key, share).select(F.col(key).alias(mark))
    tagged = df.join(F.broadcast(heavy), F.col(key) == F.col(mark), "left")  # 2 / share rows
    if not empty_key:
        tagged = tagged.where(F.col(key).isNotNull())
    spread = F.when(F.col(mark).isNotNull() | F.col(key).isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0)
    parts = tagged.withColumn(salt, spread.cast("int")).groupBy(key, salt).agg(*partial).drop(salt)
    return parts.groupBy(key).agg(*final)
