"""Queries of the chat-analytics operators over the message table, and the SQL they are held against.

The message table's own clock column is text in many notations (see p7); these queries take the
delivery instant as the time of a message, which SQL can read as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import ids
from chatloom.functions import text as T
from chatloom.functions.instants import display_time
from chatloom.functions.lexicon import DOMAINS, KEYWORDS, LANGUAGES, QUESTION_EN, QUESTIONS, REGIONS, Domains, LanguageProfile
from chatloom.operators import ai, caches, crosstabs, engagement, incremental, profiles, retrieval, statistics
from chatloom.plans.lineage import Cuts
from chatloom.session import spread, table
from chatloom.sinks import documents, reports
from chatloom.sources import results

ZH, DE = LANGUAGES["zh"], LANGUAGES["de"]
REGION = REGIONS["global"]
#: Domain lists that fit the test tables.
SITES = Domains(("wiki.quillbase.example", "nordhafen.test"), ("quillbase.example",), (("messaging", ("discord.", "telegram.")), *DOMAINS.by_host))
#: Buckets that fit the labels shipped in KEYWORDS.
GROUPS = {
    "providers": {"toolchain": frozenset({"cargo", "rustup"}), "runtime": frozenset({"tokio", "axum"})},
    "messaging": {"forum": frozenset({"reddit", "github_discussions"}), "video": frozenset({"youtube"})},
    "install": {"packaged": frozenset({"apt", "homebrew", "docker"}), "linux": frozenset({"linux_native", "nix"})},
    "acquisition": {"people": frozenset({"friend", "work"}), "events": frozenset({"conference", "course"})},
}
DEEP = frozenset({"async_await", "macros"})
NOW = "2026-07-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if it has any."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


# --- inputs -------------------------------------------------------------------------------------


def canonical(spark: SparkSession, d: str) -> DataFrame:
    """The message table in canonical shape."""
    return table(spark, d, "messages").select(
        F.col("msg_row").alias("ord"), "platform", "channel", F.trim("message_id").alias("message_id"), F.coalesce("author_id", F.lit("")).alias("author_id"),
        "author_name", F.col("delivered_at").alias("ts"), F.col("content"), F.trim("reply_to_message_id").alias("reply_to_message_id"), "attachment_count",
        "export_key", F.col("ts").alias("ts_text"), "lang",
    )


def spread_canonical(spark: SparkSession, d: str) -> DataFrame:
    """The same, dealt out for work that is heavy on each row."""
    return spread(canonical(spark, d))


def rich(spark: SparkSession, d: str, profile: LanguageProfile | None = ZH) -> DataFrame:
    return profiles.enriched(spread_canonical(spark, d), profile, KEYWORDS, SITES)


# --- pieces of SQL ------------------------------------------------------------------------------

_W = r"\p{L}\p{N}_"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _re2(pattern: str) -> str:
    """A pattern with word boundaries at its ends, for RE2."""
    out = pattern
    if out.startswith(r"\b"):
        out = rf"(^|[^{_W}])" + out[2:]
    if out.endswith(r"\b"):
        out = out[:-2] + (rf"([^{_W}]|$)" if not out.endswith(r"\+\b") else rf"[{_W}]")
    return out


def _keyword_sql(keyword: str) -> str:
    p = T.keyword_pattern(keyword)
    p = p.replace(r"(?<!\w)", rf"(^|[^{_W}])").replace(r"(?!\w)", rf"([^{_W}]|$)")
    return _quoted("(?i)" + _re2(p))


def _any_sql(column: str, keywords) -> str:
    return "(" + " OR ".join(f"regexp_matches({column}, {_keyword_sql(k)})" for k in keywords) + ")"


def _class_sql(column: str, profile: LanguageProfile) -> str:
    strip = rf"regexp_replace({column}, '^[{T.SPACES}]+|[{T.SPACES}]+$', '', 'g')"
    if profile.ranges:
        chars = "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in profile.ranges) + "]"
        ratio = f"coalesce(len(regexp_extract_all({column}, '{chars}')) / nullif(length(regexp_replace({column}, '[{T.SPACES}]', '', 'g')), 0), 0)"
        extra = f"WHEN len(regexp_extract_all({strip}, '{chars}')) >= 3 AND length({strip}) >= 20 THEN 'mixed'"
    else:
        words = "[" + ", ".join(_quoted(w) for w in sorted(profile.stopwords)) + "]"
        tokens = f"regexp_extract_all(lower({column}), '[a-zà-ÿ]+')"
        ratio = f"coalesce(len(list_filter({tokens}, lambda t: list_contains({words}, t))) / nullif(len({tokens}), 0), 0)"
        extra = ""
    return f"CASE WHEN {strip} = '' THEN 'unknown' WHEN {ratio} >= 0.7 THEN 'target' WHEN {ratio} >= {profile.threshold} THEN 'mixed' {extra} WHEN length({strip}) < 5 THEN 'unknown' ELSE 'other' END"


def _question_sql(column: str, code: str | None) -> str:
    parts = [rf"[?][{T.SPACES}]*$", _re2("\\b" + QUESTION_EN.split("|\\b", 1)[1])]
    for p in QUESTIONS.get(code or "", "").split("|"):
        if p:
            parts.append(_re2(p.replace(r"\s", f"[{T.SPACES}]")))
    return f"regexp_matches({column}, {_quoted('(?i)' + '|'.join(f'({p})' for p in parts))})"


def _category_sql(url: str, d: Domains) -> str:
    host = f"split_part(regexp_replace(lower({url}), '^https?://', ''), '/', 1)"
    has = lambda x, parts: "(" + (" OR ".join(f"contains({x}, {_quoted(p)})" for p in parts) or "false") + ")"
    cases = [f"WHEN {has(f'lower({url})', d.impersonator)} THEN 'impersonator'", f"WHEN {has(f'lower({url})', d.official)} THEN 'official'"]
    cases += [f"WHEN {has(host, parts)} THEN '{c}'" for c, parts in d.by_host]
    return f"CASE {' '.join(cases)} ELSE 'other' END"


_HOST = "split_part(regexp_replace(lower(url), '^https?://', ''), '/', 1)"
M = """m AS (SELECT msg_row AS ord, platform, channel, trim(message_id) AS message_id, coalesce(author_id, '') AS author_id, author_name, delivered_at AS ts,
  coalesce(content, '') AS content, trim(reply_to_message_id) AS reply_to_message_id, export_key, ts AS ts_text, lang FROM messages)"""
R = f"""{M}, r AS MATERIALIZED (SELECT *, {_class_sql("content", ZH)} AS lang_class, {_question_sql("content", "zh")} AS is_question,
  regexp_extract_all(content, '(?i)https?://[^\\s)>\\],''"]+') AS urls,
  ({" OR ".join(f"contains(lower(content), {_quoted(p)})" for p in SITES.impersonator)}) AS names_impersonator FROM m)"""
_MENTION_PARTS = " UNION ALL ".join(
    f"SELECT ord, author_id, '{c}' AS category, {k} AS pos, '{label}' AS label FROM m WHERE {_any_sql('content', words)}"
    for c, some in KEYWORDS.items()
    for k, (label, words) in enumerate(some.items())
)
X = f"{R}, x AS MATERIALIZED ({_MENTION_PARTS})"
U = f"{R}, u AS (SELECT ord, author_id, url, {_HOST} AS host, {_category_sql('url', SITES)} AS category FROM (SELECT ord, author_id, unnest(urls) AS url FROM r))"
_PRIMARY = """CASE WHEN t + mi + o = 0 THEN 'silent' WHEN (t + 0.5 * mi) / (t + mi + o) >= 0.7 THEN 'target_primary'
  WHEN (o + 0.5 * mi) / (t + mi + o) >= 0.7 THEN 'other_primary' ELSE 'bilingual' END"""
P = f"""p0 AS (SELECT author_id, arg_min(coalesce(author_name, ''), ord) AS display_name, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS message_count,
  count(*) FILTER (WHERE lang_class = 'target') AS t, count(*) FILTER (WHERE lang_class = 'mixed') AS mi, count(*) FILTER (WHERE lang_class = 'other') AS o,
  array_to_string(list_sort(list(DISTINCT channel)), ',') AS channels, CAST(sum(len(urls)) AS BIGINT) AS urls_posted, count(*) FILTER (WHERE names_impersonator) AS impersonator_messages,
  count(*) FILTER (WHERE is_question) AS questions_asked, count(*) FILTER (WHERE coalesce(reply_to_message_id, '') <> '') AS replies_given FROM r GROUP BY author_id),
p AS (SELECT *, {_PRIMARY} AS language_primary FROM p0)"""
H = """hh AS (SELECT author_id, extract(hour FROM ts AT TIME ZONE 'UTC') AS h, count(*) AS n, min(ord) AS f FROM m WHERE ts IS NOT NULL GROUP BY 1, 2),
h AS (SELECT author_id, CAST(h AS INTEGER) AS hour FROM (SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY n DESC, f) AS k FROM hh) WHERE k = 1)"""
_BUCKET = "CASE " + " ".join(f"WHEN hour BETWEEN {a} AND {b} THEN '{n}'" for n, a, b in REGION.hours) + " ELSE 'other' END"
_RETENTION = f"CASE WHEN last_seen >= TIMESTAMPTZ '{NOW}+00' - INTERVAL 30 DAY THEN 'active_30d' WHEN last_seen >= TIMESTAMPTZ '{NOW}+00' - INTERVAL 90 DAY THEN 'lapsed_30_90d' ELSE 'lapsed_90d_plus' END"

# --- language, channels, filters ----------------------------------------------------------------


@query(f"WITH {M} " + " UNION ALL ".join(f"SELECT '{c}' AS profile, {_class_sql('content', LANGUAGES[c])} AS lang_class, count(*) AS n FROM m GROUP BY 2" for c in ("de", "fr", "es", "pt", "zh", "ru")))
def language_distribution(spark: SparkSession, d: str) -> DataFrame:
    """F5 to F8, A2 for six target languages."""
    return profiles.language_distributions(spread_canonical(spark, d), [LANGUAGES[c] for c in ("de", "fr", "es", "pt", "zh", "ru")])


@query(f"SELECT coalesce(lang, '') AS label, {_class_sql('text', DE)} AS lang_class, count(*) AS n FROM documents GROUP BY 1, 2")
def language_confusion(spark: SparkSession, d: str) -> DataFrame:
    """Class for target language German against the delivered label, over documents."""
    documents = table(spark, d, "documents")
    return documents.groupBy(F.coalesce("lang", F.lit("")).alias("label"), T.language_class(F.col("text"), DE).alias("lang_class")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {R} SELECT channel, count(*) AS n, count(*) FILTER (WHERE lang_class IN ('target', 'mixed')) AS n_target FROM r GROUP BY 1")
def channel_counts(spark: SparkSession, d: str) -> DataFrame:
    """A1."""
    return profiles.channel_counts(spread_canonical(spark, d), ZH)


@query(f"WITH {M} SELECT channel, count(*) AS n FROM m WHERE channel IN ('jam-room-1', 'help-desk-3') AND ts >= TIMESTAMPTZ '2024-03-01 00:00:00+00' AND ts <= TIMESTAMPTZ '2025-03-01 00:00:00+00' GROUP BY 1")
def filter_since_until(spark: SparkSession, d: str) -> DataFrame:
    """P1 to P3."""
    kept = profiles.narrowed(canonical(spark, d), ["jam-room-1", "help-desk-3"], "2024-03-01T00:00:00+05:00", "2025-03-01")
    return kept.groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


# --- mentions, URLs, questions ------------------------------------------------------------------


@query(f"WITH {X} SELECT category, label, count(*) AS n, min(ord) AS first_ord, min(pos) AS pos FROM x GROUP BY 1, 2")
def mention_counts(spark: SparkSession, d: str) -> DataFrame:
    """F10, F11, A4, O1."""
    return profiles.mention_counts(rich(spark, d))


@query(f"WITH {X} SELECT category, label, author_id, 'author' AS level, count(*) AS n FROM x GROUP BY 1, 2, 3 UNION ALL SELECT category, label, NULL, 'all', count(*) FROM x GROUP BY 1, 2")
def mention_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    """A4 in one pass."""
    return profiles.mention_sets(rich(spark, d))


@query(f"WITH {X} SELECT label, k, ord, substr(replace(content, chr(10), ' '), 1, 250) AS sample FROM (SELECT x.label, x.ord, m.content, row_number() OVER (PARTITION BY label ORDER BY x.ord) AS k FROM x JOIN m USING (ord) WHERE category = 'features') WHERE k <= 8")
def brand_samples_first8(spark: SparkSession, d: str) -> DataFrame:
    """The feature labels stand for brands."""
    return profiles.first_samples(rich(spark, d), "features")


@query(f"WITH {U} SELECT category, count(*) AS n FROM u GROUP BY 1")
def url_categories(spark: SparkSession, d: str) -> DataFrame:
    """F12, F13, A5."""
    return profiles.url_categories(rich(spark, d), SITES)


#: A URL of every category, and the texts that hold them: parts name one or two each.
_SAMPLES = ("https://huggingface.co/x", "http://www.modelscope.cn/y", "https://api.deepseek.com/v1", "https://open.feishu.cn/bot", "https://rust-lang.com/fake", "https://doc.rust-lang.org/std", "https://somewhere.example/z")
_NTH = lambda k: F.element_at(F.array(*[F.lit(u) for u in _SAMPLES]), (k % len(_SAMPLES) + 1).cast("int"))


def _part_texts(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part")
    text = F.concat(F.lit("see "), _NTH(F.col("p_partkey")), F.lit(" and ("), _NTH(F.col("p_size")), F.lit(")"))
    return profiles.enriched(parts.select(F.col("p_partkey").alias("ord"), F.col("p_brand").alias("author_id"), text.alias("content")), None, {}, DOMAINS)


_NTH_SQL = lambda k: f"list_extract([{', '.join(map(_quoted, _SAMPLES))}], CAST({k} % {len(_SAMPLES)} + 1 AS BIGINT))"
_PARTS = f"""pt AS (SELECT p_partkey AS ord, 'see ' || {_NTH_SQL('p_partkey')} || ' and (' || {_NTH_SQL('p_size')} || ')' AS content FROM part),
pu AS (SELECT ord, url, {_HOST} AS host, {_category_sql('url', DOMAINS)} AS category FROM (SELECT ord, unnest(regexp_extract_all(content, '(?i)https?://[^\\s)>\\],''"]+')) AS url FROM pt))"""


@query(f"WITH {_PARTS} SELECT category, count(*) AS n FROM pu GROUP BY 1")
def url_categories_every(spark: SparkSession, d: str) -> DataFrame:
    """F12, F13, A5 over texts with URLs of every category."""
    return profiles.url_categories(_part_texts(spark, d), DOMAINS)


@query(f"WITH {_PARTS} SELECT kind, domain, count(*) AS n FROM (SELECT category AS kind, host AS domain FROM pu WHERE category IN ('impersonator', 'official') UNION ALL " + " UNION ALL ".join(f"SELECT 'impersonator', {_quoted(p)} FROM pt WHERE contains(lower(content), {_quoted(p)})" for p in DOMAINS.impersonator) + ") GROUP BY 1, 2")
def url_domain_hits_every(spark: SparkSession, d: str) -> DataFrame:
    """A6, F14 over the same texts."""
    return profiles.domain_hits(_part_texts(spark, d), DOMAINS)


def _pages(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    as_messages = pages.select(F.col("page_id").alias("ord"), F.lit("").alias("author_id"), F.concat(F.col("url"), F.lit(" ("), F.col("url"), F.lit(")")).alias("content"))
    return profiles.enriched(as_messages, None, {}, SITES)


_PAGES = f"""pu AS (SELECT page_id AS ord, url, {_HOST} AS host, {_category_sql('url', SITES)} AS category FROM
  (SELECT page_id, unnest(regexp_extract_all(url || ' (' || url || ')', '(?i)https?://[^\\s)>\\],''"]+')) AS url FROM pages))"""


@query(f"""WITH {R}, e AS (SELECT ord, unnest(urls) AS url, unnest(range(len(urls))) AS pos FROM r), u AS (SELECT ord, pos, {_HOST} AS host FROM e)
SELECT host, count(*) AS n FROM u GROUP BY 1 ORDER BY n DESC, min((ord, pos)) LIMIT 50""")
def url_top_domains(spark: SparkSession, d: str) -> DataFrame:
    """O2."""
    return profiles.top_domains(rich(spark, d), SITES)


@query(f"WITH {_PAGES} SELECT host, count(*) AS n FROM pu GROUP BY 1 ORDER BY n DESC, min(ord) LIMIT 50")
def page_top_domains(spark: SparkSession, d: str) -> DataFrame:
    """O2 over wiki pages."""
    return profiles.top_domains(_pages(spark, d), SITES)


def _domain_hits_sql(with_: str, urls: str, texts: str, text: str) -> str:
    listed = " UNION ALL ".join(f"SELECT 'impersonator', {_quoted(p)} FROM {texts} WHERE contains(lower({text}), {_quoted(p)})" for p in SITES.impersonator)
    return f"WITH {with_} SELECT kind, domain, count(*) AS n FROM (SELECT category AS kind, host AS domain FROM {urls} WHERE category IN ('impersonator', 'official') UNION ALL {listed}) GROUP BY 1, 2"


@query(_domain_hits_sql(U, "u", "r", "content"))
def url_impersonator_double_count(spark: SparkSession, d: str) -> DataFrame:
    """A6, F14."""
    return profiles.domain_hits(rich(spark, d), SITES)


@query(_domain_hits_sql(_PAGES, "pu", "pages", "url"))
def page_impersonator_double_count(spark: SparkSession, d: str) -> DataFrame:
    """A6, F14 over wiki pages."""
    return profiles.domain_hits(_pages(spark, d), SITES)


@query(f"WITH {M} SELECT code, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS code FROM m WHERE {_question_sql('content', c)}" for c in ("en", "zh", "de", "fr", "es", "pt", "ru")) + ") GROUP BY 1")
def question_counts(spark: SparkSession, d: str) -> DataFrame:
    """F15 for all languages of the table."""
    rows = spread_canonical(spark, d)
    codes = ("en", "zh", "de", "fr", "es", "pt", "ru")
    sums = rows.agg(*[F.count_if(T.is_question(F.coalesce("content", F.lit("")), c)).alias(c) for c in codes])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("code"), F.col(c).alias("n")) for c in codes])).alias("x")).select("x.*")


_ANSWERED = "EXISTS (SELECT 1 FROM r b WHERE b.export_key = a.export_key AND b.reply_to_message_id = a.message_id AND b.reply_to_message_id <> '' AND b.ts <= a.ts + INTERVAL 48 HOUR)"


@query(f"WITH {R} SELECT ord, author_id, channel FROM r a WHERE is_question AND {_ANSWERED}")
def help_answered(spark: SparkSession, d: str) -> DataFrame:
    """J1."""
    return profiles.answered_questions(rich(spark, d)).select("ord", "author_id", "channel")


@query(f"""WITH {R}, q AS (SELECT *, lang_class IN ('target', 'mixed') AS tg, {_ANSWERED} AS an FROM r a WHERE is_question)
SELECT count(*) AS questions, count(*) FILTER (WHERE tg) AS target_questions, count(*) FILTER (WHERE tg AND an) AS answered,
count(*) FILTER (WHERE tg AND an) / CAST(nullif(count(*) FILTER (WHERE tg), 0) AS DOUBLE) AS rate FROM q""")
def help_answered_rate(spark: SparkSession, d: str) -> DataFrame:
    """A7."""
    return profiles.question_summary(rich(spark, d))


# --- users --------------------------------------------------------------------------------------


@query(f"""WITH {X}, {P}, {H} SELECT author_id, display_name, epoch_us(first_seen) AS first_us, epoch_us(last_seen) AS last_us, message_count, t AS target_lang_count, mi AS mixed_count,
o AS other_lang_count, channels, urls_posted, impersonator_messages, questions_asked, replies_given, language_primary, hour AS modal_hour,
coalesce((SELECT count(DISTINCT category || ':' || label) FROM x WHERE x.author_id = p.author_id), 0) AS n_labels FROM p LEFT JOIN h USING (author_id)""")
def user_profiles(spark: SparkSession, d: str) -> DataFrame:
    """The profile of every author."""
    return profiles.user_profiles(rich(spark, d)).select(
        "author_id", "display_name", F.unix_micros("first_seen").alias("first_us"), F.unix_micros("last_seen").alias("last_us"), "message_count", "target_lang_count", "mixed_count",
        "other_lang_count", F.array_join("channels", ",").alias("channels"), "urls_posted", "impersonator_messages", "questions_asked", "replies_given", "language_primary",
        F.col("hour").alias("modal_hour"), F.coalesce(F.size("mentions"), F.lit(0)).cast("bigint").alias("n_labels"),
    )


@query(f"WITH {R}, {P} SELECT language_primary, count(*) AS n_users FROM p GROUP BY 1")
def user_cohorts(spark: SparkSession, d: str) -> DataFrame:
    """A8."""
    return profiles.user_cohorts(profiles.user_profiles(rich(spark, d)))


@query(f"""WITH {R}, {P}, c AS (SELECT *, {_RETENTION} AS k FROM p WHERE language_primary IN ('target_primary', 'bilingual'))
SELECT count(*) FILTER (WHERE k = 'active_30d') AS active_30d, count(*) FILTER (WHERE k = 'lapsed_30_90d') AS lapsed_30_90d, count(*) FILTER (WHERE k = 'lapsed_90d_plus') AS lapsed_90d_plus,
count(*) FILTER (WHERE message_count = 1) AS one_time, count(*) AS n_users FROM c""")
def retention_cohorts(spark: SparkSession, d: str) -> DataFrame:
    """A9, P7."""
    return profiles.retention_cohorts(profiles.user_profiles(rich(spark, d)), NOW)


@query(f"WITH {R}, {P}, {H} SELECT {_BUCKET} AS bucket, count(*) AS n_users FROM h JOIN p USING (author_id) WHERE language_primary IN ('target_primary', 'bilingual') GROUP BY 1")
def location_proxy(spark: SparkSession, d: str) -> DataFrame:
    """A10, F17, W8."""
    return profiles.location_proxy(profiles.user_profiles(rich(spark, d)), REGION)


@query(f"WITH {M}, {H} SELECT CAST(h AS INTEGER) AS hour, CAST(sum(n) AS BIGINT) AS n FROM hh GROUP BY 1")
def hour_histogram(spark: SparkSession, d: str) -> DataFrame:
    """F16."""
    return canonical(spark, d).where("ts is not null").groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


_TRAITS = f"""tr AS (SELECT p.author_id, language_primary,
  {", ".join(f"list_filter([{', '.join(f'CASE WHEN EXISTS (SELECT 1 FROM x WHERE x.author_id = p.author_id AND category = {_quoted(c)} AND label IN ({chr(44).join(_quoted(m) for m in sorted(members))})) THEN {_quoted(b)} END' for b, members in GROUPS[c].items())}], lambda v: v IS NOT NULL) AS {n}" for c, n in (("providers", "provider_clusters"), ("messaging", "messaging_buckets"), ("install", "install_buckets"), ("acquisition", "acquisition_buckets")))},
  CASE WHEN fr = 0 THEN 'none' WHEN fr <= 2 THEN 'low_1_2' ELSE 'high_3plus' END AS friction_level, CASE WHEN dp > 0 THEN 'deep_features' ELSE 'chat_only' END AS feature_depth,
  CASE WHEN co > 0 THEN 'yes' ELSE 'no' END AS has_competitor, CASE WHEN impersonator_messages > 0 THEN 'yes' ELSE 'no' END AS has_impersonator,
  {_RETENTION} AS retention, CASE WHEN hour IS NULL THEN 'unknown' ELSE {_BUCKET} END AS location
  FROM p LEFT JOIN h USING (author_id) LEFT JOIN (SELECT author_id, count(DISTINCT label) FILTER (WHERE category = 'friction') AS fr0, count(*) FILTER (WHERE category = 'features' AND label IN ({", ".join(_quoted(v) for v in sorted(DEEP))})) AS dp0,
    count(*) FILTER (WHERE category = 'competitors') AS co0 FROM x GROUP BY 1) z USING (author_id), LATERAL (SELECT coalesce(fr0, 0) AS fr, coalesce(dp0, 0) AS dp, coalesce(co0, 0) AS co))"""
_COHORT = "tr WHERE language_primary IN ('target_primary', 'bilingual', 'other_primary')"


def _traits(spark: SparkSession, d: str) -> DataFrame:
    return crosstabs.traits(profiles.user_profiles(rich(spark, d)), REGION, GROUPS, DEEP, NOW)


def _pivot_sql(name: str, row: str, column: str) -> str:
    label = f"unnest(CASE WHEN len({row}) > 0 THEN {row} ELSE ['(none)'] END)" if row.endswith(("clusters", "buckets")) else row
    return f"SELECT '{name}' AS pivot, row_label, col_label, count(*) AS n FROM (SELECT {label} AS row_label, {column} AS col_label FROM tr WHERE language_primary IN ('target_primary', 'bilingual')) GROUP BY 2, 3"


@query(f"WITH {X}, {P}, {H}, {_TRAITS} " + " UNION ALL ".join(_pivot_sql(n, r, c) for n, (r, c) in crosstabs.PIVOTS.items()))
def pivots_all(spark: SparkSession, d: str) -> DataFrame:
    """The seven shipped pivots."""
    return crosstabs.all_pivots(_traits(spark, d))


@query(f"""WITH {X}, {P}, {H}, {_TRAITS}, c AS (SELECT unnest(CASE WHEN len(install_buckets) > 0 THEN install_buckets ELSE ['(none)'] END) AS row_label, friction_level AS col_label FROM tr),
g AS (SELECT coalesce(row_label, '(all)') AS row_label, coalesce(col_label, '(all)') AS col_label, count(*) AS n FROM c GROUP BY CUBE (row_label, col_label)),
w AS (SELECT row_label, n AS w FROM g WHERE col_label = '(all)') SELECT row_label, col_label, n, n * 100.0::DOUBLE / w AS row_pct, w < 10 AS small FROM g JOIN w USING (row_label)""")
def pivot_cube_totals(spark: SparkSession, d: str) -> DataFrame:
    """Install against friction with totals."""
    return crosstabs.with_totals(crosstabs.pivot(_traits(spark, d), "install_buckets", "friction_level"))


@query(f"WITH {X}, {P}, {H}, {_TRAITS} SELECT friction_level, feature_depth, has_competitor, has_impersonator, retention, location, count(*) AS n FROM tr GROUP BY ALL")
def bucket_membership(spark: SparkSession, d: str) -> DataFrame:
    """F18 to F20 for all authors."""
    return _traits(spark, d).groupBy("friction_level", "feature_depth", "has_competitor", "has_impersonator", "retention", "location").agg(F.count(F.lit(1)).alias("n"))


# --- replies and timelines ----------------------------------------------------------------------


@query(f"""WITH {M}, t AS (SELECT channel, reply_to_message_id, count(*) AS n FROM m WHERE coalesce(reply_to_message_id, '') <> '' GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS replies, count(*) AS threads, count(*) FILTER (WHERE n >= 5) AS threads_5plus, count(*) FILTER (WHERE n >= 10) AS threads_10plus FROM t""")
def reply_graph_stats(spark: SparkSession, d: str) -> DataFrame:
    """A29."""
    return profiles.reply_graph(canonical(spark, d))


@query(f"""WITH {U}, g AS (SELECT ord, CASE WHEN contains(host, 'docs.') THEN 'docs' WHEN contains(host, 'wiki.') THEN 'wiki' ELSE 'none' END AS gateway FROM u)
SELECT gateway, count(*) AS n_urls, count(DISTINCT ord) AS n_messages FROM g GROUP BY 1""")
def gateway_mix(spark: SparkSession, d: str) -> DataFrame:
    """A29."""
    return profiles.gateway_mix(rich(spark, d), {"docs": ("docs.",), "wiki": ("wiki.",)})


@query(f"""WITH {M}, a AS (SELECT author_id FROM m GROUP BY 1 ORDER BY count(*) DESC, author_id LIMIT 20)
SELECT author_id, CAST(epoch(date_trunc('day', ts AT TIME ZONE 'UTC')) // 86400 AS INTEGER) AS day_no, count(*) AS n FROM m JOIN a USING (author_id) GROUP BY 1, 2""")
def top20_timelines(spark: SparkSession, d: str) -> DataFrame:
    """A29."""
    return profiles.top_timelines(canonical(spark, d)).select("author_id", F.unix_date("day").alias("day_no"), "n")


# --- engagement (orders are the posts of customers) ---------------------------------------------


def _posts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_custkey").alias("author_id"), F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("ord"), F.lit("").alias("author_name"), F.when(F.col("o_custkey") % 17 == 0, "app").otherwise("user").alias("sender_type"))


O = """po AS (SELECT o_custkey AS author_id, o_orderdate AS ts, o_orderkey AS ord, CASE WHEN o_custkey % 17 = 0 THEN 'app' ELSE 'user' END AS kind FROM orders),
pp AS (SELECT CAST(author_id AS VARCHAR) AS author_id, count(*) AS messages, count(DISTINCT CAST(ts AS DATE)) AS days, min(ts) AS first_at, max(ts) AS last_at, arg_min(kind, ord) AS kind, min(ord) AS first_ord FROM po GROUP BY 1)"""


@query(f"WITH {O} SELECT author_id, messages, days, kind, first_ord, date_diff('day', DATE '1970-01-01', CAST(first_at AS DATE)) AS first_day FROM pp")
def posters(spark: SparkSession, d: str) -> DataFrame:
    """A21, P8."""
    return engagement.posters(_posts(spark, d)).select("author_id", "messages", "days", "kind", "first_ord", F.unix_date(F.to_date("first_at")).cast("bigint").alias("first_day"))


@query(f"WITH {O} SELECT author_id, messages, row_number() OVER (ORDER BY messages DESC, first_ord) AS rank, messages * 100.0::DOUBLE / (SELECT sum(messages) FROM pp) AS pct FROM pp ORDER BY rank LIMIT 50")
def poster_rank_top50(spark: SparkSession, d: str) -> DataFrame:
    """W1, O3."""
    return engagement.ranked(engagement.posters(_posts(spark, d))).select("author_id", "messages", "rank", "pct")


@query(f"""WITH {O}, k AS (SELECT messages, row_number() OVER (ORDER BY messages DESC, first_ord) AS rn FROM pp)
SELECT CAST(t AS INTEGER) AS top_n, CAST(sum(messages) FILTER (WHERE rn <= t) AS BIGINT) AS messages, sum(messages) FILTER (WHERE rn <= t) * 100.0::DOUBLE / sum(messages) AS pct
FROM k, unnest([{", ".join(map(str, engagement.TOPS))}]) AS v(t) GROUP BY t""")
def pareto_topn(spark: SparkSession, d: str) -> DataFrame:
    """W2."""
    return engagement.pareto(engagement.posters(_posts(spark, d)))


@query(f"WITH {O} SELECT CASE WHEN messages = 1 THEN 'one_time' WHEN days = 1 THEN 'single_day' WHEN days >= 7 THEN 'multi_week' ELSE 'few_day' END AS kind, count(*) AS n_users FROM pp GROUP BY 1")
def stickiness_classes(spark: SparkSession, d: str) -> DataFrame:
    """A23."""
    return engagement.stickiness(engagement.posters(_posts(spark, d)))


@query(f"""WITH {O}, c AS (SELECT count(*) AS posters, count(*) FILTER (WHERE kind <> 'app') AS humans, count(*) FILTER (WHERE kind = 'app') AS bots, count(*) FILTER (WHERE kind <> 'app' AND messages = 1) AS one_time FROM pp)
SELECT *, round(bots * 100.0::DOUBLE / posters, 2) AS bot_pct, round(one_time * 100.0::DOUBLE / humans, 2) AS one_time_pct, round(humans * 100.0::DOUBLE / 20000, 2) AS poster_pct,
round((20000 - humans) * 100.0::DOUBLE / 20000, 2) AS lurker_pct FROM c""")
def stickiness_rates(spark: SparkSession, d: str) -> DataFrame:
    """A24, A25."""
    return engagement.shares(engagement.posters(_posts(spark, d)), 20_000)


DAYS = """pd AS (SELECT date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day_no, author_id FROM po),
f AS (SELECT day_no, count(*) AS first_posters FROM (SELECT author_id, min(day_no) AS day_no FROM pd GROUP BY 1) GROUP BY 1),
dd AS (SELECT day_no, count(*) AS messages, count(DISTINCT author_id) AS active, coalesce(any_value(first_posters), 0) AS first_posters FROM pd LEFT JOIN f USING (day_no) GROUP BY 1)"""


@query(f"""WITH {O}, {DAYS}, j AS (SELECT date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day_no, count(*) AS joined FROM events WHERE event_type = (SELECT min(event_type) FROM events) GROUP BY 1)
SELECT day_no, coalesce(messages, 0) AS messages, coalesce(active, 0) AS active, coalesce(first_posters, 0) AS first_posters, coalesce(joined, 0) AS joined,
CAST(sum(coalesce(first_posters, 0)) OVER (ORDER BY day_no) AS BIGINT) AS cumulative_posters, CAST(sum(coalesce(joined, 0)) OVER (ORDER BY day_no) AS BIGINT) AS cumulative_joined FROM dd FULL JOIN j USING (day_no)""")
def temporal_growth(spark: SparkSession, d: str) -> DataFrame:
    """A26, J7, U6, W3, W7."""
    events = table(spark, d, "events")
    joins = engagement.joins_per_day(events.where(F.col("event_type") == events.agg(F.min("event_type")).scalar()))
    days = engagement.growth(engagement.daily(_posts(spark, d)), joins)
    return days.select(F.unix_date("day").cast("bigint").alias("day_no"), *[c for c in days.columns if c != "day"])


@query(f"WITH {O}, {DAYS} " + " UNION ALL ".join(f"(SELECT '{c}' AS measure, day_no, {c} AS value FROM dd ORDER BY {c} DESC, day_no LIMIT 1)" for c in ("messages", "active", "first_posters")))
def peak_days(spark: SparkSession, d: str) -> DataFrame:
    """O6."""
    return engagement.peaks(engagement.daily(_posts(spark, d))).select("measure", F.unix_date("day").cast("bigint").alias("day_no"), "value")


# --- runs ---------------------------------------------------------------------------------------


@query("""SELECT msg_row FROM messages m WHERE trim(coalesce(message_id, '')) = '' OR NOT EXISTS
(SELECT 1 FROM seen_messages s WHERE s.export_key = m.export_key AND trim(s.message_id) = trim(m.message_id))""")
def incremental_new(spark: SparkSession, d: str) -> DataFrame:
    """J3, U3."""
    return incremental.new_messages(table(spark, d, "messages"), table(spark, d, "seen_messages")).select("msg_row")


@query("""SELECT DISTINCT export_key, trim(message_id) AS message_id FROM messages m WHERE trim(coalesce(message_id, '')) <> '' AND NOT EXISTS
(SELECT 1 FROM seen_messages s WHERE s.export_key = m.export_key AND trim(s.message_id) = trim(m.message_id))""")
def incremental_seen_upsert(spark: SparkSession, d: str) -> DataFrame:
    """J4."""
    return incremental.seen_upsert(table(spark, d, "messages"), table(spark, d, "seen_messages"))


@query("""WITH s AS (SELECT export_key, export_path, last_run_at, total_processed FROM export_state), n AS (SELECT m.export_key, any_value(s.export_path) AS export_path, max(delivered_at) AS last_run_at, count(*) AS total_processed
FROM messages m JOIN export_state s USING (export_key) GROUP BY 1), u AS (SELECT * FROM s UNION ALL SELECT * FROM n)
SELECT export_key, arg_max(export_path, last_run_at) AS export_path, epoch_us(max(last_run_at)) AS last_run_us, CAST(sum(total_processed) AS BIGINT) AS total_processed FROM u GROUP BY 1""")
def run_log_upsert(spark: SparkSession, d: str) -> DataFrame:
    """T2."""
    states = table(spark, d, "export_state")
    runs = table(spark, d, "messages").groupBy("export_key").agg(F.max("delivered_at").alias("last_run_at"), F.count(F.lit(1)).alias("total_processed"))
    named = runs.join(states.select("export_key", "export_path"), "export_key")
    log = incremental.run_log(states, named)
    return log.select("export_key", "export_path", F.unix_micros("last_run_at").alias("last_run_us"), "total_processed")


def _run(spark: SparkSession, d: str, batches: tuple[int, int]) -> DataFrame:
    """Statistics of the deliveries of a span of batches."""
    rows = table(spark, d, "messages").where(F.col("batch_no").between(*batches))
    keys = [("channel_message_counts", F.col("channel")), ("platforms", F.col("platform"))]
    out = None
    for category, key in keys:
        part = rows.groupBy(key.alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit(category).alias("category"), "key", "value")
        out = part if out is None else out.unionByName(part)
    users = rows.agg(F.count_distinct("author_id").cast("double").alias("value")).select(F.lit("users").alias("category"), F.lit("total").alias("key"), "value")
    return out.unionByName(users)


def _run_sql(name: str, low: int, high: int) -> str:
    where = f"FROM messages WHERE batch_no BETWEEN {low} AND {high}"
    return f"""{name} AS (SELECT 'channel_message_counts' AS category, channel AS key, CAST(count(*) AS DOUBLE) AS value {where} GROUP BY 2
UNION ALL SELECT 'platforms', platform, count(*) {where} GROUP BY 2 UNION ALL SELECT 'users', 'total', count(DISTINCT author_id) {where})"""


_TWO = f"{_run_sql('a', 1, 3)}, {_run_sql('b', 4, 1000000)}"


@query(f"""WITH {_TWO}, z AS (SELECT category, key, a.value AS o, b.value AS n FROM a FULL JOIN b USING (category, key))
SELECT category, key, CASE WHEN category = 'users' THEN greatest(coalesce(o, 0), coalesce(n, 0)) ELSE coalesce(o, 0) + coalesce(n, 0) END AS value FROM z""")
def merge_stats_rules(spark: SparkSession, d: str) -> DataFrame:
    """A28, T1."""
    return incremental.merged(_run(spark, d, (1, 3)), _run(spark, d, (4, 1_000_000)))


@query(f"""WITH {_TWO}, z AS (SELECT category, key, coalesce(a.value, 0) AS old_value, coalesce(b.value, 0) AS new_value FROM a FULL JOIN b USING (category, key))
SELECT *, new_value - old_value AS delta, (new_value - old_value) * 100.0::DOUBLE / nullif(old_value, 0) AS pct, CASE WHEN old_value = 0 THEN 'new' WHEN new_value = 0 THEN 'gone' ELSE 'changed' END AS status FROM z WHERE old_value <> new_value""")
def diff_counters(spark: SparkSession, d: str) -> DataFrame:
    """J6, U2, F24."""
    return incremental.differences(_run(spark, d, (1, 3)), _run(spark, d, (4, 1_000_000)))


@query("""WITH r AS (SELECT 'platforms' AS category, platform AS key, CAST(batch_no AS INTEGER) AS run_idx, CAST(count(*) AS DOUBLE) AS value FROM messages GROUP BY 2, 3),
l AS (SELECT *, lag(value) OVER (PARTITION BY category, key ORDER BY run_idx) AS b FROM r) SELECT category, key, run_idx, value, value - b AS delta, (value - b) * 100.0::DOUBLE / nullif(b, 0) AS pct FROM l""")
def run_trend_lag(spark: SparkSession, d: str) -> DataFrame:
    """W6."""
    runs = table(spark, d, "messages").groupBy(F.col("platform").alias("key"), F.col("batch_no").cast("int").alias("run_idx")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return incremental.trend(runs.withColumn("category", F.lit("platforms")))


_ROW = lambda category, key, value, rest: f"SELECT {category} AS category, CAST({key} AS VARCHAR) AS key, CAST({value} AS DOUBLE) AS value {rest}"
_SECTION = "CASE category " + " ".join(f"WHEN '{c}' THEN '{s}'" for c, s in statistics.SECTIONS.items()) + " ELSE category END"
_STATISTICS = " UNION ALL ".join([
    _ROW("'metadata'", "'total_messages'", "count(*)", "FROM r"), _ROW("'date_first'", "'epoch'", "floor(epoch(min(ts)))", "FROM r"), _ROW("'date_last'", "'epoch'", "floor(epoch(max(ts)))", "FROM r"),
    _ROW("'channel_message_counts'", "channel", "count(*)", "FROM r GROUP BY channel"), _ROW("'channel_target_message_counts'", "channel", "count(*) FILTER (WHERE lang_class IN ('target', 'mixed'))", "FROM r GROUP BY channel"),
    _ROW("'language_distribution'", "lang_class", "count(*)", "FROM r GROUP BY lang_class"), _ROW("'users'", "language_primary", "count(*)", "FROM p GROUP BY language_primary"), _ROW("'users'", "'total'", "count(*)", "FROM p"),
    f"SELECT 'retention', key, CAST(value AS DOUBLE) FROM (UNPIVOT (SELECT count(*) FILTER (WHERE k = 'active_30d') AS active_30d, count(*) FILTER (WHERE k = 'lapsed_30_90d') AS lapsed_30_90d, count(*) FILTER (WHERE k = 'lapsed_90d_plus') AS lapsed_90d_plus, count(*) FILTER (WHERE message_count = 1) AS one_time, count(*) AS n_users FROM (SELECT *, {_RETENTION} AS k FROM p WHERE language_primary IN ('target_primary', 'bilingual'))) ON COLUMNS(*) INTO NAME key VALUE value)",
    _ROW("'location_proxy'", _BUCKET, "count(*)", "FROM h JOIN p USING (author_id) WHERE language_primary IN ('target_primary', 'bilingual') GROUP BY 2"),
    _ROW(_SECTION, "label", "count(*)", "FROM x GROUP BY category, label"), _ROW("'url_categories'", "category", "count(*)", "FROM u GROUP BY category"),
    f"SELECT 'top_domains', host, CAST(n AS DOUBLE) FROM (SELECT host, count(*) AS n, min((ord, pos)) AS f FROM (SELECT ord, pos, {_HOST} AS host FROM (SELECT ord, unnest(urls) AS url, unnest(range(len(urls))) AS pos FROM r)) GROUP BY 1 ORDER BY n DESC, f LIMIT 50)",
    "SELECT kind || '_domains', domain, CAST(count(*) AS DOUBLE) FROM (SELECT category AS kind, host AS domain FROM u WHERE category IN ('impersonator', 'official') UNION ALL " + " UNION ALL ".join(f"SELECT 'impersonator', {_quoted(d)} FROM r WHERE contains(lower(content), {_quoted(d)})" for d in SITES.impersonator) + ") GROUP BY 1, 2",
    f"SELECT 'help_answered', key, CAST(value AS DOUBLE) FROM (UNPIVOT (SELECT CAST(count(*) AS DOUBLE) AS questions, CAST(count(*) FILTER (WHERE tg) AS DOUBLE) AS target_questions, CAST(count(*) FILTER (WHERE tg AND an) AS DOUBLE) AS answered, count(*) FILTER (WHERE tg AND an) / CAST(nullif(count(*) FILTER (WHERE tg), 0) AS DOUBLE) AS rate FROM (SELECT *, lang_class IN ('target', 'mixed') AS tg, {_ANSWERED} AS an FROM r a WHERE is_question)) ON COLUMNS(*) INTO NAME key VALUE value)",
])


@query(f"WITH {X}, {P}, {H}, {U.removeprefix(R).lstrip(', ')} {_STATISTICS}")
def statistics_document(spark: SparkSession, d: str) -> DataFrame:
    """A1 to A11 as one long table."""
    messages = rich(spark, d).persist()
    return statistics.statistics(messages, profiles.user_profiles(messages), SITES, REGION, NOW)


@query("SELECT count(*) AS events, count(DISTINCT CAST(user_id % 500 AS VARCHAR)) AS joiners, count(DISTINCT CAST(user_id % 500 AS VARCHAR)) - 90 AS departures FROM events WHERE user_id % 3 < 2")
def join_summary(spark: SparkSession, d: str) -> DataFrame:
    """Events told as system messages of both forms, and others that are no joins."""
    who = F.concat(F.lit("user "), (F.col("user_id") % 500).cast("string"))
    text = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("Ann invited "), who, F.lit(" to the group."))).when(F.col("user_id") % 3 == 1, F.concat(who, F.lit(" joined the group via QR Code shared by Bob."))).otherwise(F.concat(who, F.lit(" left")))
    return engagement.join_summary(engagement.join_events(table(spark, d, "events").select("ts", text.alias("content"))), 90)


@query(r"""SELECT page_id, epoch_us(try_strptime(create_time, '%Y-%m-%d %H:%M')) - 28800000000 AS utc_us FROM pages WHERE regexp_full_match(create_time, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}') AND try_strptime(create_time, '%Y-%m-%d %H:%M') IS NOT NULL""")
def display_times(spark: SparkSession, d: str) -> DataFrame:
    """display times on a clock eight hours east of UTC; other notations are none."""
    shown = table(spark, d, "pages").select("page_id", F.unix_micros(display_time("create_time", 8)).alias("utc_us"))
    return shown.where("utc_us is not null")


# --- retrieval, topics, facts -------------------------------------------------------------------

_SIM = """n AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
e AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS s FROM n)"""


@query(f"""WITH {_SIM}, z AS (SELECT q.vec_id AS query_id, b.vec_id, round(list_inner_product(q.v, b.v) / (q.s * b.s), 6) AS score FROM e q, e b WHERE q.vec_id % 20 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM z) SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 30""")
def semantic_topk(spark: SparkSession, d: str) -> DataFrame:
    """Every row whose id is divisible by 20 against all rows."""
    base = table(spark, d, "embeddings")
    return retrieval.top_k(base, base.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"))


@query(f"""WITH {_SIM}, z AS (SELECT q.vec_id AS query_id, b.vec_id, round(list_inner_product(q.v, b.v) / (q.s * b.s), 6) AS score FROM e q, e b WHERE q.vec_id % 20 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM z)
SELECT query_id, rank, k.vec_id AS ord, trim(message_id) AS message_id, author_name, substr(coalesce(content, ''), 1, 500) AS content FROM k JOIN messages ON msg_row = k.vec_id WHERE rank <= 5""")
def hits_with_messages(spark: SparkSession, d: str) -> DataFrame:
    """Nearest vectors with the messages of the same number."""
    base = table(spark, d, "embeddings").withColumnRenamed("vec_id", "ord")
    hits = retrieval.top_k(base, base.where("ord % 20 = 0").withColumnRenamed("ord", "query_id"), 5, base_id="ord")
    return retrieval.hits_with_messages(hits, canonical(spark, d)).select("query_id", "rank", "ord", "message_id", "author_name", "content")


def _hashed_sql(name: str, key: str, source: str) -> str:
    """CTEs of the offline embedder in SQL: of `name` the non-zero places of each row's unit vector."""
    return f"""{name}w AS (SELECT {key} AS id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[{_W}]+')) AS word FROM {source}),
{name}h AS (SELECT id, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) AS h FROM {name}w),
{name}c AS (SELECT id, h % 64 AS place, sum(1 - 2 * ((h >> 16) & 1)) AS v FROM {name}h GROUP BY 1, 2),
{name}u AS (SELECT id, place, CAST(CAST(v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS FLOAT) AS DOUBLE) AS x FROM {name}c WHERE v <> 0),
{name} AS (SELECT id, place, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS x FROM {name}u)"""


@query(f"""WITH {_hashed_sql('dv', 'doc_id', 'documents')}, {_hashed_sql('iv', 'item_id', 'benchmark')},
pr AS (SELECT i.id AS item_id, d.id AS doc_id, sum(i.x * d.x) AS s FROM iv i JOIN dv d USING (place) GROUP BY 1, 2),
z AS (SELECT b.item_id, d.doc_id, round(coalesce(s, 0), 6) + 0.0 AS score FROM benchmark b CROSS JOIN documents d LEFT JOIN pr USING (item_id, doc_id)),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM z) SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 5""")
def retrieval_offline_embedder(spark: SparkSession, d: str) -> DataFrame:
    """Nearest documents to each benchmark item by the offline embedder."""
    documents = retrieval.embedded(table(spark, d, "documents").select("doc_id", "text"), "text")
    items = retrieval.embedded(table(spark, d, "benchmark").select("item_id", "text"), "text")
    return retrieval.top_k(documents, items, 5, base_id="doc_id", query_id="item_id")


def _by_channel(texts):
    return ["bug_report" if "error" in t.lower() else "install_help" if "server" in t.lower() else "general_discussion" for t in texts]


_TOPIC = "CASE WHEN contains(lower(content), 'error') THEN 'bug_report' WHEN contains(lower(content), 'server') THEN 'install_help' ELSE 'general_discussion' END"


@query(f"WITH {M}, t AS (SELECT {_TOPIC} AS topic, count(*) AS n FROM m GROUP BY 1) SELECT topic, n, round(n * 100.0::DOUBLE / (SELECT sum(n) FROM t), 1) AS pct FROM t")
def topic_distribution(spark: SparkSession, d: str) -> DataFrame:
    """A keyword tagger in place of a model."""
    return ai.topic_distribution(ai.tagged(canonical(spark, d), _by_channel))


@query(f"WITH {M} SELECT {_TOPIC} AS topic, ord FROM m")
def topic_by_category_ids(spark: SparkSession, d: str) -> DataFrame:
    """K6: the messages of each topic, the fallback too, as rows."""
    return ai.tagged(canonical(spark, d), _by_channel).select("topic", "ord")


@query(f"WITH {M} SELECT 'general_discussion' AS topic, count(*) AS n, 100.0::DOUBLE AS pct FROM m")
def topics_dry_run(spark: SparkSession, d: str) -> DataFrame:
    """X2 without a model."""
    return ai.topic_distribution(ai.tagged(canonical(spark, d)))


@query(f"WITH {M} SELECT ord, CAST(floor((row_number() OVER (ORDER BY coalesce(ts_text, ''), ord) - 1) / 100) AS BIGINT) AS chunk_idx FROM m")
def chunk_assignment(spark: SparkSession, d: str) -> DataFrame:
    """W5, O9."""
    return ai.chunks(canonical(spark, d)).select("ord", F.col("chunk_idx").cast("bigint").alias("chunk_idx"))


@query(f"""WITH {M}, k AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY coalesce(ts_text, ''), ord) - 1) / 100) AS BIGINT) AS chunk_idx FROM m)
SELECT chunk_idx, md5(string_agg('[' || coalesce(ts_text, '') || '] ' || coalesce(author_name, '') || ': ' || substr(content, 1, 800), chr(10) ORDER BY coalesce(ts_text, ''), ord)) AS digest, count(*) AS n FROM k GROUP BY 1""")
def chunk_texts(spark: SparkSession, d: str) -> DataFrame:
    """F30, P10."""
    texts = ai.chunk_texts(ai.chunks(canonical(spark, d)))
    return texts.select(F.col("chunk_idx").cast("bigint").alias("chunk_idx"), F.md5("text").alias("digest"), "n")


def _extract(text: str) -> str:
    import json

    found = [{"provider_or_gateway": "docs" if "docs." in line else "wiki", "sentiment": "positive" if "thanks" in line.lower() else None} for line in text.split("\n") if "docs." in line or "wiki." in line]
    return "```json\n" + json.dumps({"provider_usage": [{k: v for k, v in f.items() if v} for f in found], "noise": [1]})[:-1] + ",}\n```"


_CHUNKED = f"""{M}, k AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY coalesce(ts_text, ''), ord) - 1) / 100) AS BIGINT) AS chunk_idx FROM m),
li AS (SELECT chunk_idx, unnest(string_split('[' || coalesce(ts_text, '') || '] ' || coalesce(author_name, '') || ': ' || substr(content, 1, 800), chr(10))) AS line FROM k),
fa AS (SELECT chunk_idx, CASE WHEN contains(line, 'docs.') THEN 'docs' ELSE 'wiki' END AS provider, CASE WHEN contains(lower(line), 'thanks') THEN 'positive' END AS sentiment FROM li WHERE contains(line, 'docs.') OR contains(line, 'wiki.'))"""


def _facts(spark: SparkSession, d: str) -> DataFrame:
    return ai.facts(ai.chunk_texts(ai.chunks(canonical(spark, d))), ["provider_usage"], _extract)


@query(f"WITH {_CHUNKED} SELECT 'provider_usage' AS category, count(*) AS n FROM fa GROUP BY 1")
def fact_counts(spark: SparkSession, d: str) -> DataFrame:
    """A17."""
    return ai.fact_counts(_facts(spark, d))


@query(f"WITH {_CHUNKED} SELECT coalesce(sentiment, 'unknown') AS resolution, count(*) AS n FROM fa GROUP BY 1")
def resolution_breakdown(spark: SparkSession, d: str) -> DataFrame:
    """The sentiment stands for the resolution."""
    found = ai.resolutions(_facts(spark, d), "provider_usage", "sentiment")
    return found.withColumnRenamed("sentiment", "resolution")


@query(f"WITH {_CHUNKED} SELECT chunk_idx, provider FROM fa WHERE contains(lower(provider), 'doc')")
def product_facts(spark: SparkSession, d: str) -> DataFrame:
    """Facts whose provider names the product."""
    found = ai.about_product(_facts(spark, d), "DOC", "provider_usage", "provider_or_gateway")
    return found.select("chunk_idx", F.try_element_at("fact", F.lit("provider_or_gateway")).alias("provider"))


@query(f"WITH {_CHUNKED} SELECT provider AS a, coalesce(sentiment, 'neutral') AS b, count(*) AS n FROM fa GROUP BY 1, 2")
def fact_breakdown(spark: SparkSession, d: str) -> DataFrame:
    """An extractor in place of a model, with the answer's flaws."""
    return ai.pair_counts(_facts(spark, d), "provider_usage", "provider_or_gateway", "sentiment", ("unknown", "neutral"))


@query(f"""WITH {M} SELECT ord, substr(replace(content, chr(10), ' '), 1, 400) AS quote FROM m WHERE regexp_matches(content, {_quoted("(?i)" + ai.COST)})
AND ({" OR ".join(f"contains(content, {_quoted(w)})" for w in ai.COST_WORDS)})""")
def cost_drill(spark: SparkSession, d: str) -> DataFrame:
    """P11, P10."""
    rows = canonical(spark, d).where(ai.is_cost_complaint(F.col("content")))
    return rows.select("ord", F.substring(F.translate("content", "\n", " "), 1, 400).alias("quote"))


@query("SELECT user_id, substr(sha256('salt:' || user_id), 1, 16) AS hashed, 'u_' || substr(sha256('salt' || user_id), 1, 12) AS stream_hash FROM users")
def hash_ids(spark: SparkSession, d: str) -> DataFrame:
    """F1, F2."""
    return table(spark, d, "users").select("user_id", ids.hash_author("user_id", "salt").alias("hashed"), ids.hash_stream_user("user_id", "salt").alias("stream_hash"))


@query("SELECT substr(sha256(text), 1, 16) AS hash, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1")
def content_hash_dedup(spark: SparkSession, d: str) -> DataFrame:
    """F26."""
    return table(spark, d, "documents").groupBy(ids.content_hash("text").alias("hash")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))


@query(f"WITH {M} SELECT ord, channel FROM m ORDER BY sha256(ord || ':0'), ord LIMIT 40")
def deterministic_sample(spark: SparkSession, d: str) -> DataFrame:
    """Forty messages, the same on every run."""
    return ai.sample(canonical(spark, d), "ord", 40, 0).select("ord", "channel")




# --- configured patterns, caches and results as inputs --------------------------------------------

PATTERNS = {"product": r"quill\s?base", "docs_site": r"docs\.|wiki\.", "errors": r"error|fehler|erro\b"}


def _pattern_sql(p: str) -> str:
    return _quoted("(?i)" + _re2(p).replace(r"\s", f"[{T.SPACES}]").replace(r"erro\b", rf"erro([^{_W}]|$)"))


@query(f"WITH {M} SELECT label, count(*) AS n, min(ord) AS first_ord FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS label, ord FROM m WHERE regexp_matches(content, {_pattern_sql(p)})" for k, p in PATTERNS.items()) + ") GROUP BY 1")
def brand_pattern_counts(spark: SparkSession, d: str) -> DataFrame:
    """Messages that name each brand, by configured patterns."""
    return profiles.mention_counts(reports.branded(spread_canonical(spark, d), PATTERNS)).select("label", "n", "first_ord")


@query(f"WITH {M}, t AS (SELECT {_TOPIC} AS topic, count(*) AS n FROM m GROUP BY 1) SELECT topic, n, round(n * 100.0::DOUBLE / (SELECT sum(n) FROM t), 1) AS pct FROM t")
def topics_with_cache(spark: SparkSession, d: str) -> DataFrame:
    """A run that broke off after a part of the messages, and the next one."""
    messages = canonical(spark, d)
    cache = caches.topic_cache(spark, Cuts(spark, "topics").root + "/cache")
    caches.tagged(messages.where("ord % 3 = 0"), _by_channel, cache)
    return ai.topic_distribution(caches.tagged(messages, _by_channel, cache))


@query(f"""WITH t AS (SELECT p_partkey AS ord, 'about ' || p_size || ' 万 token, then ' || p_size || '.5rmb, or ' || p_name AS content FROM part),
a AS (SELECT ord, unnest(regexp_extract_all(content, {_quoted("(?i)" + ai.AMOUNT)}, 1)) AS amount FROM t) SELECT ord, count(*) AS n, min(amount) AS least FROM a GROUP BY 1""")
def amounts(spark: SparkSession, d: str) -> DataFrame:
    """Amounts of tokens or money in texts made of parts."""
    text = F.concat(F.lit("about "), F.col("p_size").cast("string"), F.lit(" 万 token, then "), F.col("p_size").cast("string"), F.lit(".5rmb, or "), F.col("p_name"))
    found = table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.explode_outer(ai.amounts(text)).alias("amount")).where("amount is not null")
    return found.groupBy("ord").agg(F.count(F.lit(1)).alias("n"), F.min("amount").alias("least"))


@query(f"WITH {X}, {P}, {H} SELECT author_id, language_primary, hour, impersonator_messages, coalesce((SELECT count(DISTINCT category || ':' || label) FROM x WHERE x.author_id = p.author_id), 0) AS n_labels, epoch_us(last_seen) // 1000 AS last_ms FROM p LEFT JOIN h USING (author_id)")
def users_as_input(spark: SparkSession, d: str) -> DataFrame:
    """Profiles written as JSON lines and read again as what pivots are made of; of tied hours the earlier, so
    the hour is that of the profile."""
    cuts = Cuts(spark, "users")
    folder = cuts.root + "/rows"
    people, _ = cuts.cut(profiles.user_profiles(rich(spark, d)))  # read twice below
    documents.write_users(people, folder)
    back = results.read_users(spark, folder)
    hours = people.select(F.col("author_id").alias("_a"), F.col("hour").alias("_h"))
    return back.drop("hour").join(hours, F.col("author_id") == F.col("_a")).select(
        "author_id", "language_primary", F.col("_h").alias("hour"), "impersonator_messages", F.size("mentions").cast("bigint").alias("n_labels"), F.unix_millis("last_seen").alias("last_ms")
    )
