"""Cross-tabulations over user profiles: rows by what a user mentions, columns by a trait."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.functions.lexicon import BUCKETS, DEEP_FEATURES, REGIONS, RegionProfile

SMALL = 10  #: a row with fewer users is flagged

NONE = "(none)"


def nonzero(mentions: Column, category: str) -> Column:
    """the labels of a category that a user mentioned (from a map of category:label to counts)."""
    prefix = f"{category}:"
    kept = F.map_filter(F.coalesce(mentions, F.create_map().cast("map<string,bigint>")), lambda k, v: k.startswith(prefix) & (v > 0))
    return F.transform(F.map_keys(kept), lambda k: F.substring(k, len(prefix) + 1, 1_000))


def buckets(found: Column, members: Mapping[str, frozenset[str]]) -> Column:
    """The buckets that share a label with what was found, in order; empty if none does."""
    hits = [F.when(F.arrays_overlap(found, F.array(*[F.lit(m) for m in sorted(names)])), F.lit(name)) for name, names in members.items() if names]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def friction_level(labels: Column) -> Column:
    """none, low_1_2 or high_3plus by the number of different labels."""
    return F.when(F.size(labels) == 0, "none").when(F.size(labels) <= 2, "low_1_2").otherwise("high_3plus")


def traits(profiles: DataFrame, region: RegionProfile = REGIONS["global"], members: Mapping[str, Mapping[str, frozenset[str]]] = BUCKETS, deep: frozenset[str] = DEEP_FEATURES, now: str | None = None) -> DataFrame:
    """Profiles with the axes of all pivots."""
    at = F.lit(now).cast("timestamp") if now else profiles.agg(F.max("last_seen")).scalar()
    clusters = dict(members.get("providers", {}))
    if region.providers:
        clusters["regional_api"] = region.providers
    found = {c: nonzero(F.col("mentions"), c) for c in ("providers", "messaging", "features", "install", "friction", "competitors", "acquisition")}
    overlap = F.arrays_overlap(found["features"], F.array(*[F.lit(d) for d in sorted(deep)])) if deep else F.lit(False)
    return profiles.select(
        "author_id", "language_primary",
        buckets(found["providers"], clusters).alias("provider_clusters"), buckets(found["messaging"], members.get("messaging", {})).alias("messaging_buckets"),
        buckets(found["install"], members.get("install", {})).alias("install_buckets"), buckets(found["acquisition"], members.get("acquisition", {})).alias("acquisition_buckets"),
        friction_level(found["friction"]).alias("friction_level"), F.when(overlap, "deep_features").otherwise("chat_only").alias("feature_depth"),
        F.when(F.size(found["competitors"]) > 0, "yes").otherwise("no").alias("has_competitor"),
        F.when(F.col("impersonator_messages") > 0, "yes").otherwise("no").alias("has_impersonator"),
        T.retention_class(F.col("last_seen"), at).alias("retention"),
        F.when(F.col("hour").isNull(), "unknown").otherwise(T.hour_bucket(F.col("hour"), region)).alias("location"),
    )


def pivot(rows: DataFrame, row: str, column: str) -> DataFrame:
    """Users per row and column value: `row_label`, `col_label`, `n`.

    An array as `row` counts a user in every row that matches, and in (none) if none does.
    """
    if rows.schema[row].dataType.typeName() == "array":
        label = F.explode(F.when(F.size(row) > 0, F.col(row)).otherwise(F.array(F.lit(NONE))))
    else:
        label = F.col(row)
    return rows.select(label.alias("row_label"), F.col(column).alias("col_label")).groupBy("row_label", "col_label").agg(F.count(F.lit(1)).alias("n"))


def with_totals(cells: DataFrame) -> DataFrame:
    """Cells, row, column and grand totals (`(all)`), the share of its row, and a flag for rows under SMALL users."""
    cube = cells.cube("row_label", "col_label").agg(F.sum("n").alias("n"), F.grouping("row_label").alias("gr"), F.grouping("col_label").alias("gc"))
    named = cube.select(F.when(F.col("gr") == 1, "(all)").otherwise(F.col("row_label")).alias("row_label"), F.when(F.col("gc") == 1, "(all)").otherwise(F.col("col_label")).alias("col_label"), "n", (F.col("gc") == 1).alias("_t"))
    whole = F.max(F.when(F.col("_t"), F.col("n"))).over(Window.partitionBy("row_label"))
    return named.withColumn("_w", whole).select("row_label", "col_label", "n", F.try_divide(F.col("n") * 100.0, F.col("_w")).alias("row_pct"), (F.col("_w") < SMALL).alias("small"))


# Name -> (row, column) of the shipped pivots.
PIVOTS = {
    "provider_cluster_x_location": ("provider_clusters", "location"),
    "messaging_x_location": ("messaging_buckets", "location"),
    "feature_depth_x_retention": ("feature_depth", "retention"),
    "install_x_friction": ("install_buckets", "friction_level"),
    "impersonator_x_friction": ("has_impersonator", "friction_level"),
    "competitor_x_retention": ("has_competitor", "retention"),
    "acquisition_x_retention": ("acquisition_buckets", "retention"),
}


def all_pivots(rows: DataFrame) -> DataFrame:
    """All shipped pivots of the target-language and bilingual cohort: `pivot`, `row_label`, `col_label`, `n`.

    One pass: each user is spread into the cells of all pivots and counted once.
    """
    cohort = rows.where(F.col("language_primary").isin("target_primary", "bilingual"))
    def cell(name: str, column: str):
        return lambda label: F.struct(F.lit(name).alias("pivot"), label.alias("row_label"), F.col(column).alias("col_label"))

    cells = []
    for name, (row, column) in PIVOTS.items():
        many = rows.schema[row].dataType.typeName() == "array"
        labels = F.when(F.size(row) > 0, F.col(row)).otherwise(F.array(F.lit(NONE))) if many else F.array(F.col(row))
        cells.append(F.transform(labels, cell(name, column)))
    return cohort.select(F.explode_outer(F.concat(*cells)).alias("x")).groupBy("x.pivot", "x.row_label", "x.col_label").agg(F.count(F.lit(1)).alias("n"))
