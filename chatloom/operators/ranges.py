"""Row numbers for groups of any size, without a task that meets a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.plans.lineage import Cuts


def numbered(df: DataFrame, group: str | None, order: list[Column], out: str, cuts: Cuts) -> DataFrame:
    """`df` with row numbers (from 1) within its groups, or over all rows for no group.

    Rows are sorted over ranges of (group, order), whose bounds are quantiles, so that every task has
    its share of the rows even if all belong to one group and tie in all but the last of `order`, which must be
    unique. A row's number is its place within its range, plus the group's rows in the ranges before:
    one small row per group and range, of which only groups that cross a bound need more than one.
    """
    keys = ([F.col(group)] if group else []) + order
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    fixed, _ = cuts.cut(ranged.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_m")))
    by = [F.col(group).alias("_g")] if group else [F.lit(0).alias("_g")]
    pieces = fixed.groupBy(*by, F.col("_p").alias("_q")).agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_lo"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_g").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = pieces.withColumn("_b", before).select("_g", "_q", "_lo", "_b")
    same = (F.col("_p") == F.col("_q")) & (F.col(group).eqNullSafe(F.col("_g")) if group else F.lit(True))
    return fixed.join(starts, same).withColumn(out, F.col("_b") + F.col("_m") - F.col("_lo") + 1).select(*df.columns, out)
