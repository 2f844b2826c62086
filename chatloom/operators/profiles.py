"""From canonical messages to language, mention, URL, question and user views.

Canonical messages have `ord` (arrival), platform, channel, message_id, author_id, author_name, ts,
content, reply_to_message_id, attachment_count. Every function takes and returns DataFrames; nothing
is collected. Aggregates are algebraic, so Spark sums them before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.functions.lexicon import DOMAINS, KEYWORDS, REGIONS, Domains, LanguageProfile, RegionProfile

COLUMNS = ("ord", "platform", "channel", "message_id", "author_id", "author_name", "ts", "content", "reply_to_message_id", "attachment_count")


def narrowed(messages: DataFrame, channels: Sequence[str] = (), since: datetime | str | None = None, until: datetime | str | None = None) -> DataFrame:
    """Rows of the channels (all if none are named) between two instants, both included.

    A bare date as `until` means its midnight. Offsets in the limits are dropped, not converted.
    """
    out = messages
    if channels:
        out = out.where(F.col("channel").isin(list(channels)))
    for limit, keep in ((since, F.col("ts").__ge__), (until, F.col("ts").__le__)):
        if limit is not None:
            at = limit if isinstance(limit, datetime) else datetime.fromisoformat(limit)
            out = out.where(keep(F.lit(at.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp")))
    return out


def enriched(messages: DataFrame, profile: LanguageProfile | None = None, keywords: Mapping[str, Mapping[str, Sequence[str]]] = KEYWORDS, domains: Domains = DOMAINS) -> DataFrame:
    """Messages with `lang_class`, `is_question`, `urls`, `mentions` (array of category, position,
    label), and `names_impersonator` (an impersonator's domain stands in the text, as a URL or bare)."""
    content, lower = F.col("_content"), F.col("_lower")
    found = [T.labels(content, words, category, lower) for category, words in keywords.items()]
    # Columns of their own, so that the many searches below don't fold the text again each.
    prepared = messages.withColumn("_content", F.coalesce("content", F.lit(""))).withColumn("_lower", T.folded(F.col("_content")))
    out = prepared.withColumns(
        {
            "lang_class": T.language_class(F.col("content"), profile),
            "is_question": T.is_question(content, profile.code if profile else None),
            "urls": F.when(lower.contains("http"), T.urls(content)).otherwise(F.array().cast("array<string>")),
            "names_impersonator": T.contains_any(F.lower(content), domains.impersonator),
            "mentions": F.concat(*found) if found else F.array().cast("array<struct<category:string,pos:int,label:string>>"),
        }
    )
    return out.drop("_content", "_lower")


def language_distribution(messages: DataFrame, profile: LanguageProfile | None) -> DataFrame:
    """A2: messages per class."""
    return messages.groupBy(T.language_class(F.col("content"), profile).alias("lang_class")).agg(F.count(F.lit(1)).alias("n"))


def language_distributions(messages: DataFrame, profiles: Sequence[LanguageProfile]) -> DataFrame:
    """A2 for several languages in one pass: `profile`, `lang_class`, `n`."""
    prepared = messages.select(F.coalesce("content", F.lit("")).alias("_c")).withColumn("_t", T.latin_tokens(F.col("_c")))
    classes = F.array(*[F.struct(F.lit(p.code).alias("profile"), T.language_class(F.col("_c"), p, F.col("_t")).alias("lang_class")) for p in profiles])
    # A column of its own: within a generator Spark would compute repeated parts again each.
    return prepared.select(classes.alias("_a")).select(F.explode_outer("_a").alias("x")).groupBy("x.profile", "x.lang_class").agg(F.count(F.lit(1)).alias("n"))


def channel_counts(messages: DataFrame, profile: LanguageProfile | None) -> DataFrame:
    """A1: messages per channel, and those in the target language."""
    lang = T.language_class(F.col("content"), profile)
    return messages.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), F.count_if(lang.isin("target", "mixed")).alias("n_target"))


def mention_rows(rich: DataFrame) -> DataFrame:
    """One row per message and label: ord, author_id, category, pos, label."""
    # The outer form: for the inner one Spark puts a size filter below, which would find the labels twice.
    return rich.select("ord", "author_id", F.explode_outer("mentions").alias("m")).where("m is not null").select("ord", "author_id", "m.category", "m.pos", "m.label")


def mention_counts(rich: DataFrame) -> DataFrame:
    """A4, O1: messages per category and label, with the first row and position that rank ties."""
    return mention_rows(rich).groupBy("category", "label").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"), F.min("pos").alias("pos"))


def mention_sets(rich: DataFrame) -> DataFrame:
    """A4: counts over all authors (`author_id` null, `level` 'all') and per author, in one pass."""
    rows = mention_rows(rich).withColumn("author_id", F.coalesce("author_id", F.lit("")))
    sets = rows.groupingSets([[F.col("category"), F.col("label")], [F.col("category"), F.col("label"), F.col("author_id")]], "category", "label", "author_id")
    return sets.agg(F.count(F.lit(1)).alias("n"), F.grouping("author_id").alias("g")).select("category", "label", "author_id", F.when(F.col("g") == 1, "all").otherwise("author").alias("level"), "n")


def url_rows(rich: DataFrame, domains: Domains = DOMAINS) -> DataFrame:
    """One row per URL occurrence: ord, author_id, url, host, category."""
    rows = rich.select("ord", "author_id", F.posexplode_outer("urls").alias("at", "url")).where("url is not null")
    return rows.select("ord", "author_id", "at", "url", T.host(F.col("url")).alias("host"), T.url_category(F.col("url"), domains).alias("category"))


def url_categories(rich: DataFrame, domains: Domains = DOMAINS) -> DataFrame:
    """A5: URL occurrences per category."""
    return url_rows(rich, domains).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def top_domains(rich: DataFrame, domains: Domains = DOMAINS, n: int = 50) -> DataFrame:
    """O2: the n hosts with most occurrences; ties in order of appearance."""
    counts = url_rows(rich, domains).groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ord", "at")).alias("first"))
    return counts.orderBy(F.desc("n"), "first").limit(n).select("host", "n")


def domain_hits(rich: DataFrame, domains: Domains = DOMAINS) -> DataFrame:
    """Hits of impersonator and official domains per `kind` and `domain`.

    A URL counts under its host; an impersonator named anywhere in a message counts again under the
    listed name.
    """
    by_url = url_rows(rich, domains).where(F.col("category").isin("impersonator", "official")).select(F.col("category").alias("kind"), F.col("host").alias("domain"))
    if domains.impersonator:
        lower = F.lower(F.coalesce("content", F.lit("")))
        named = F.array_compact(F.array(*[F.when(lower.contains(d), F.lit(d)) for d in domains.impersonator]))
        by_url = by_url.unionByName(rich.select(F.lit("impersonator").alias("kind"), F.explode(named).alias("domain")))
    return by_url.groupBy("kind", "domain").agg(F.count(F.lit(1)).alias("n"))


def answered_questions(rich: DataFrame, hours: int = 48) -> DataFrame:
    """Question rows with a reply to their id at most `hours` after them; earlier replies and
    replies by the asker count too. Questions without an id have none.

    Where messages have an `export_key`, ids are compared within one export, as the same id may stand
    for different messages in several.
    """
    asked, earliest, met = _questions_and_replies(rich, hours)
    return asked.join(earliest, met[0] & met[1], "left_semi").drop("_scope")


def _questions_and_replies(rich: DataFrame, hours: int):
    """(questions, first reply to each target, (reply belongs to question, reply comes in time))."""
    scope = F.coalesce("export_key", F.lit("")) if "export_key" in rich.columns else F.lit("")
    asked = rich.where("is_question").select("ord", "message_id", "ts", "lang_class", "author_id", "channel", scope.alias("_scope"))
    replies = rich.where(F.coalesce("reply_to_message_id", F.lit("")) != "").select(scope.alias("_in"), F.col("reply_to_message_id").alias("_to"), F.col("ts").alias("_at"))
    earliest = replies.groupBy("_in", "_to").agg(F.min("_at").alias("_at"))  # one row a target, however many replies it has
    inside = F.col("_at") <= F.col("ts") + F.expr(f"INTERVAL {int(hours)} HOURS")
    return asked, earliest, ((F.col("message_id") == F.col("_to")) & (F.col("_scope") == F.col("_in")), inside)


def question_summary(rich: DataFrame, hours: int = 48) -> DataFrame:
    """One row: questions, those in the target language, those of them answered, and the rate."""
    target = F.col("lang_class").isin("target", "mixed")
    asked, earliest, (same, inside) = _questions_and_replies(rich, hours)
    answered = F.coalesce(inside, F.lit(False))
    one = asked.join(earliest, same, "left").agg(F.count(F.lit(1)).alias("questions"), F.count_if(target).alias("target_questions"), F.count_if(target & answered).alias("answered"))
    return one.withColumn("rate", F.try_divide("answered", "target_questions"))


def user_profiles(rich: DataFrame) -> DataFrame:
    """One row per author (a null id counts as the empty one).

    `display_name` is that of the author's first row. `mentions` maps category:label to messages,
    `hours` maps the UTC hour to messages, `hour` is the modal one (of ties the one seen first, null without any time).

    One scan: each message is spread into what is counted of it (its hour, channel, name, labels). The
    first aggregate counts per author and such key, in buffers of fixed width and before the shuffle,
    so an author with a third of all rows is a few rows a task; the second puts an author's keys together.
    """
    named = F.coalesce("mentions", F.array().cast("array<struct<category:string,pos:int,label:string>>"))
    entry = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"))
    own = F.array(entry("hour", F.coalesce(F.hour("ts"), F.lit(-1))), entry("channel", F.col("channel")), entry("name", F.coalesce("author_name", F.lit(""))))
    counted = F.concat(own, F.transform(named, lambda m: entry("label", F.concat_ws(":", m["category"], m["label"]))))
    # The outer form: for the inner one Spark puts a size filter below, which would find the labels twice.
    spread = rich.select(
        F.coalesce("author_id", F.lit("")).alias("author_id"), "ord", "ts", "lang_class", "is_question", "names_impersonator",
        F.size("urls").alias("_urls"), (F.coalesce("reply_to_message_id", F.lit("")) != "").alias("_reply"), F.explode_outer(counted).alias("_e"),
    )
    once = F.col("_e.kind") == "hour"  # of each message one entry
    keyed = spread.groupBy("author_id", F.col("_e.kind").alias("kind"), F.col("_e.key").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"), F.min(F.when(once, F.col("ts"))).alias("lo"), F.max(F.when(once, F.col("ts"))).alias("hi"),
        F.sum(F.when(once, F.col("_urls"))).alias("u"), *[F.count_if(once & c).alias(k) for k, c in (
            ("t", F.col("lang_class") == "target"), ("x", F.col("lang_class") == "mixed"), ("o", F.col("lang_class") == "other"),
            ("i", F.col("names_impersonator")), ("q", F.col("is_question")), ("r", F.col("_reply")))],
    )
    of = lambda kind, value: F.when((F.col("kind") == kind) & F.col("key").isNotNull(), value)
    timed = lambda value: F.when((F.col("kind") == "hour") & (F.col("key") != "-1"), value)
    hour = F.col("key").cast("int")
    people = keyed.groupBy("author_id").agg(
        F.min_by(of("name", F.col("key")), of("name", F.col("first"))).alias("display_name"), F.min("lo").alias("first_seen"), F.max("hi").alias("last_seen"),
        F.sum(of("hour", F.col("n"))).alias("message_count"), F.sum("t").alias("target_lang_count"), F.sum("x").alias("mixed_count"), F.sum("o").alias("other_lang_count"),
        F.sort_array(F.collect_list(of("channel", F.col("key")))).alias("channels"), F.sum("u").alias("urls_posted"),
        F.sum("i").alias("impersonator_messages"), F.sum("q").alias("questions_asked"), F.sum("r").alias("replies_given"),
        F.map_from_entries(F.sort_array(F.collect_list(timed(F.struct(hour.alias("h"), "n"))))).alias("hours"),  # 24 entries at most
        F.map_from_entries(F.sort_array(F.collect_list(of("label", F.struct("key", "n"))))).alias("mentions"),  # an entry a label
        F.max_by(timed(hour), timed(F.struct("n", -F.col("first")))).alias("hour"),
    )
    people = people.withColumns({m: F.when(F.size(m) > 0, F.col(m)) for m in ("hours", "mentions")})
    return people.withColumn("language_primary", T.language_primary(F.col("target_lang_count"), F.col("mixed_count"), F.col("other_lang_count")))


def user_cohorts(profiles: DataFrame) -> DataFrame:
    """Authors per leaning."""
    return profiles.groupBy("language_primary").agg(F.count(F.lit(1)).alias("n_users"))


def retention_cohorts(profiles: DataFrame, now: str | None = None) -> DataFrame:
    """Of target-language and bilingual authors, how many were active, lapsed, and seen once.

    `now` is the latest instant of all authors unless given. One-time authors count in another cohort too.
    """
    at = F.lit(now).cast("timestamp") if now else profiles.agg(F.max("last_seen")).scalar()
    cohort = profiles.where(F.col("language_primary").isin("target_primary", "bilingual"))
    kind = T.retention_class(F.col("last_seen"), at)
    return cohort.agg(
        *[F.count_if(kind == k).alias(k) for k in ("active_30d", "lapsed_30_90d", "lapsed_90d_plus")],
        F.count_if(F.col("message_count") == 1).alias("one_time"), F.count(F.lit(1)).alias("n_users"),
    )


def modal_hours(rich: DataFrame) -> DataFrame:
    """The UTC hour in which each author posts most; of ties the one seen first."""
    rows = rich.where(F.col("ts").isNotNull()).withColumn("author_id", F.coalesce("author_id", F.lit("")))
    counts = rows.groupBy("author_id", F.hour("ts").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"))
    return counts.groupBy("author_id").agg(F.max_by("h", F.struct("n", -F.col("first"))).alias("hour"))


def location_proxy(profiles: DataFrame, region: RegionProfile = REGIONS["global"]) -> DataFrame:
    """A10: target-language and bilingual authors per evening bucket of their modal hour."""
    cohort = profiles.where(F.col("language_primary").isin("target_primary", "bilingual") & F.col("hour").isNotNull())
    return cohort.groupBy(T.hour_bucket(F.col("hour"), region)).agg(F.count(F.lit(1)).alias("n_users"))


def reply_graph(messages: DataFrame) -> DataFrame:
    """One row: replies, threads (targets), threads with five and with ten replies or more."""
    threads = messages.where(F.coalesce("reply_to_message_id", F.lit("")) != "").groupBy("channel", "reply_to_message_id").agg(F.count(F.lit(1)).alias("n"))
    return threads.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("replies"), F.count(F.lit(1)).alias("threads"),
        F.count_if(F.col("n") >= 5).alias("threads_5plus"), F.count_if(F.col("n") >= 10).alias("threads_10plus"),
    )


def gateway_mix(rich: DataFrame, gateways: Mapping[str, Sequence[str]]) -> DataFrame:
    """URL occurrences and messages per gateway, a gateway being a set of host parts."""
    rows = url_rows(rich)
    out = None
    for name, parts in gateways.items():
        hit = F.lit(False)
        for part in parts:
            hit = hit | F.col("host").contains(part)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    label = F.coalesce(out, F.lit("none")) if out is not None else F.lit("none")
    return rows.groupBy(label.alias("gateway")).agg(F.count(F.lit(1)).alias("n_urls"), F.count_distinct("ord").alias("n_messages"))


def top_timelines(messages: DataFrame, n: int = 20) -> DataFrame:
    """Messages per day of the n authors with most messages."""
    rows = messages.withColumn("author_id", F.coalesce("author_id", F.lit("")))
    ranked = rows.groupBy("author_id").agg(F.count(F.lit(1)).alias("n_all")).orderBy(F.desc("n_all"), "author_id").limit(n)
    days = rows.groupBy("author_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(F.broadcast(ranked.select("author_id")), "author_id")  # n rows


def first_samples(rich: DataFrame, category: str, n: int = 8) -> DataFrame:
    """The first n messages of each label of a category, cut to 250 characters on one line."""
    named = rich.select("ord", "content", F.explode_outer("mentions").alias("m")).where(F.col("m.category") == category)
    rows = named.select("ord", "content", "m.label")
    ranked = rows.withColumn("k", F.row_number().over(Window.partitionBy("label").orderBy("ord"))).where(F.col("k") <= n)
    return ranked.select("label", F.col("k").cast("bigint").alias("k"), "ord", F.substring(F.translate("content", "\n", " "), 1, 250).alias("sample"))
