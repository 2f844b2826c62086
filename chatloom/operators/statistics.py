"""The statistics of a run as long rows: `category`, `key`, `value`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions.lexicon import DOMAINS, REGIONS, Domains, RegionProfile
from chatloom.operators import profiles as P

# Names of the mention categories in the statistics.
SECTIONS = {
    "providers": "providers", "competitors": "competitors", "messaging": "messaging_platforms", "features": "features",
    "install": "install_paths", "friction": "friction_signals", "acquisition": "acquisition_markers", "shadow": "shadow_community_mentions",
}


def _long(df: DataFrame, category: str, key: str, value: str) -> DataFrame:
    return df.select(F.lit(category).alias("category"), F.col(key).cast("string").alias("key"), F.col(value).cast("double").alias("value"))


def _wide(df: DataFrame, category: str) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in df.columns]
    return df.select(F.explode(F.array(*cells)).alias("x")).select(F.lit(category).alias("category"), "x.key", "x.value")


def statistics(rich: DataFrame, people: DataFrame, domains: Domains = DOMAINS, region: RegionProfile = REGIONS["global"], now: str | None = None) -> DataFrame:
    """A1 to A11 of a run. `rich` are enriched messages (persist them: they are read once a section),
    `people` the user profiles of them. Missing instants are left out of the date range."""
    target = F.count_if(F.col("lang_class").isin("target", "mixed"))
    channels = rich.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), target.alias("t"))
    mentions = P.mention_counts(rich)
    section = F.coalesce(*[F.when(F.col("category") == c, s) for c, s in SECTIONS.items()], F.col("category"))
    totals = rich.agg(F.count(F.lit(1)).alias("total_messages"))
    dates = rich.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    cohorts = P.user_cohorts(people)
    parts = [
        _wide(totals, "metadata"),
        dates.select(F.lit("date_first").alias("category"), F.lit("epoch").alias("key"), F.unix_timestamp("lo").cast("double").alias("value")),
        dates.select(F.lit("date_last").alias("category"), F.lit("epoch").alias("key"), F.unix_timestamp("hi").cast("double").alias("value")),
        _long(channels, "channel_message_counts", "channel", "n"), _long(channels, "channel_target_message_counts", "channel", "t"),
        _long(rich.groupBy("lang_class").agg(F.count(F.lit(1)).alias("n")), "language_distribution", "lang_class", "n"),
        _long(cohorts, "users", "language_primary", "n_users"), _wide(people.agg(F.count(F.lit(1)).alias("total")), "users"),
        _wide(P.retention_cohorts(people, now), "retention"), _long(P.location_proxy(people, region), "location_proxy", "bucket", "n_users"),
        mentions.select(section.alias("category"), F.col("label").alias("key"), F.col("n").cast("double").alias("value")),
        _long(P.url_categories(rich, domains), "url_categories", "category", "n"), _long(P.top_domains(rich, domains), "top_domains", "host", "n"),
        P.domain_hits(rich, domains).select(F.concat(F.col("kind"), F.lit("_domains")).alias("category"), F.col("domain").alias("key"), F.col("n").cast("double").alias("value")),
        _wide(P.question_summary(rich), "help_answered"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
