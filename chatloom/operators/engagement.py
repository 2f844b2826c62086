"""Engagement of posters: concentration, stickiness, growth, bots (Stream D)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.operators.ranges import numbered
from chatloom.plans.lineage import Cuts

TOPS = (1, 5, 10, 25, 50, 100, 200)


def posters(rows: DataFrame) -> DataFrame:
    """Per author: messages, active days, first and last instant, first name that isn't empty, kind of the first row.

    `rows` has author_id, ts, ord, and may have author_name and sender_type (a bot's is 'app').
    """
    name = F.nullif(F.col("author_name"), F.lit("")) if "author_name" in rows.columns else F.lit(None).cast("string")
    kind = F.coalesce("sender_type", F.lit("user")) if "sender_type" in rows.columns else F.lit("user")
    keyed = rows.select(F.coalesce(F.col("author_id").cast("string"), F.lit("")).alias("author_id"), "ts", "ord", name.alias("name"), kind.alias("kind"))
    return keyed.groupBy("author_id").agg(
        F.count(F.lit(1)).alias("messages"), F.count_distinct(F.to_date("ts")).alias("days"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"),
        F.min_by("name", F.when(F.col("name").isNotNull(), F.col("ord"))).alias("name"), F.min_by("kind", "ord").alias("kind"), F.min("ord").alias("first_ord"),
    )


def ranked(people: DataFrame, n: int | None = 50) -> DataFrame:
    """Posters by messages, first come first; with their share of all messages in percent.

    With `n` only the top is ranked, by a distributed top-k; without, all posters are, over ranges. So no
    task sorts all posters.
    """
    total = people.agg(F.sum("messages")).scalar()
    if n is None:
        placed = numbered(people, None, [F.desc("messages"), F.col("first_ord")], "rank", Cuts(people.sparkSession, "ranks"))
    else:
        top = people.orderBy(F.desc("messages"), "first_ord").limit(n)
        placed = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("messages"), "first_ord")).cast("bigint"))
    return placed.withColumn("pct", F.try_divide(F.col("messages") * 100.0, total))


def pareto(people: DataFrame, tops: Sequence[int] = TOPS) -> DataFrame:
    """The share of all messages that the N busiest posters wrote; 100 for N beyond their number."""
    best = people.select("messages", "first_ord").orderBy(F.desc("messages"), "first_ord").limit(max(tops))
    rank = F.row_number().over(Window.orderBy(F.desc("messages"), "first_ord"))
    placed = best.withColumn("k", rank)  # at most max(tops) rows
    total = people.agg(F.sum("messages")).scalar()
    sums = placed.agg(*[F.coalesce(F.sum(F.when(F.col("k") <= t, F.col("messages"))), F.lit(0)).alias(f"s{t}") for t in tops]).withColumn("_total", total)
    stacked = F.explode(F.array(*[F.struct(F.lit(t).alias("top_n"), F.col(f"s{t}").alias("messages")) for t in tops])).alias("x")
    return sums.select(stacked, "_total").select("x.top_n", "x.messages", F.try_divide(F.col("x.messages") * 100.0, "_total").alias("pct"))


def stickiness(people: DataFrame) -> DataFrame:
    """Posters per class: one_time, single_day, multi_week (seven days or more), few_day."""
    kind = F.when(F.col("messages") == 1, "one_time").when(F.col("days") == 1, "single_day").when(F.col("days") >= 7, "multi_week").otherwise("few_day")
    return people.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_users"))


def shares(people: DataFrame, members: int | None = None) -> DataFrame:
    """One row: posters, human posters, bots, and rates in percent rounded to two places.

    `members` is the number of humans in the community; rates over it are null without one.
    """
    counts = people.agg(
        F.count(F.lit(1)).alias("posters"), F.count_if(F.col("kind") != "app").alias("humans"), F.count_if(F.col("kind") == "app").alias("bots"),
        F.count_if((F.col("kind") != "app") & (F.col("messages") == 1)).alias("one_time"),
    )
    base = F.lit(members).cast("bigint")
    rate = lambda a, b: F.round(F.try_divide(a * 100.0, b), 2)
    return counts.select(
        "*", rate(F.col("bots"), F.col("posters")).alias("bot_pct"), rate(F.col("one_time"), F.col("humans")).alias("one_time_pct"),
        rate(F.col("humans"), base).alias("poster_pct"), rate(base - F.col("humans"), base).alias("lurker_pct"),
    )


def daily(rows: DataFrame) -> DataFrame:
    """Per day messages, active authors, and authors who post for the first time."""
    keyed = rows.where(F.col("ts").isNotNull()).select(F.coalesce(F.col("author_id").cast("string"), F.lit("")).alias("author_id"), F.to_date("ts").alias("day"))
    by_author = keyed.groupBy("day", "author_id").agg(F.count(F.lit(1)).alias("n"))
    active = by_author.groupBy("day").agg(F.sum("n").alias("messages"), F.count(F.lit(1)).alias("active"))
    fresh = by_author.groupBy("author_id").agg(F.min("day").alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("first_posters"))
    return active.join(fresh, "day", "left").select("day", "messages", "active", F.coalesce("first_posters", F.lit(0)).alias("first_posters"))


def growth(days: DataFrame, joins: DataFrame | None = None) -> DataFrame:
    """Days of posts and joins together, with running totals of first posters and of joins.

    A row a day, so the one ordered window is small whatever the number of messages.
    """
    both = days.join(joins, "day", "full_outer") if joins is not None else days.withColumn("joined", F.lit(0).cast("bigint"))
    filled = both.select("day", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("messages", "active", "first_posters", "joined")])
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return filled.select("*", F.sum("first_posters").over(running).alias("cumulative_posters"), F.sum("joined").over(running).alias("cumulative_joined"))


def peaks(days: DataFrame) -> DataFrame:
    """The day with most messages, with most active authors and with most first posters; the earliest of ties."""
    best = [F.max_by(F.struct(F.lit(c).alias("measure"), "day", F.col(c).alias("value")), F.struct(F.col(c), -F.unix_date("day"))).alias(c) for c in ("messages", "active", "first_posters")]
    return days.agg(*best).select(F.explode(F.array("messages", "active", "first_posters")).alias("x")).where("x is not null").select("x.*")


def join_events(rows: DataFrame) -> DataFrame:
    """Joins told by system messages: `ts`, `joiner`, `inviter`, `method` (invited or qr).

    `rows` has ts and content. "A invited B to the group" counts before "A joined the group"; of the
    latter the inviter is who shared the QR code, if the message says so.
    """
    text = F.coalesce("content", F.lit(""))
    invited, joined = r"^(.+?) invited (.+?) to the group", r"^(.+?) joined the group"
    by = F.nullif(T.strip(F.regexp_extract(text, r"QR Code shared by (.+?)\.", 1)), F.lit(""))
    is_invited, is_joined = text.rlike(invited), text.rlike(joined)
    whom = F.regexp_replace(T.strip(F.regexp_extract(text, invited, 2)), r"\.+$", "")
    return rows.where(is_invited | is_joined).select(
        "ts", F.when(is_invited, whom).otherwise(T.strip(F.regexp_extract(text, joined, 1))).alias("joiner"),
        F.when(is_invited, T.strip(F.regexp_extract(text, invited, 1))).otherwise(by).alias("inviter"),
        F.when(is_invited, "invited").otherwise("qr").alias("method"),
    )


def joins_per_day(events: DataFrame) -> DataFrame:
    """Joins per day, for `growth`."""
    return events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("joined"))


def join_summary(events: DataFrame, humans: int | None = None) -> DataFrame:
    """One row: join events, different joiners, and departures that the membership implies (joiners beyond
    the `humans` of now; null without their number)."""
    one = events.agg(F.count(F.lit(1)).alias("events"), F.count_distinct("joiner").alias("joiners"))
    return one.withColumn("departures", F.col("joiners") - F.lit(humans).cast("bigint"))
