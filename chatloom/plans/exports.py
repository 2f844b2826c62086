"""Queries of the readers over exports that are rows of a table, and of sinks read again; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators import incremental
from chatloom.plans.lineage import Cuts
from chatloom.plans.quality import INSTANTS
from chatloom.session import table
from chatloom.sinks import documents
from chatloom.sources import readers

SALT = "salt"
COLUMNS = ("ord", "channel", "message_id", "author_id", "author_name", "ts_us", "content", "reply_to_message_id", "n_reactions", "attachment_count")


def _exports(spark: SparkSession, d: str, *platforms: str) -> DataFrame:
    rows = table(spark, d, "raw_records").where(F.col("platform").isin(*platforms))
    return rows.select(F.col("record_id").alias("file_no"), F.concat(F.lit("c"), F.col("record_id").cast("string")).alias("stem"), F.col("payload").alias("value"))


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select(
        "ord", "channel", "message_id", "author_id", "author_name", F.unix_micros("ts").alias("ts_us"), "content", "reply_to_message_id",
        F.size("reactions").cast("bigint").alias("n_reactions"), F.col("attachment_count").cast("bigint").alias("attachment_count"),
    )


def reader_discord(spark: SparkSession, d: str) -> DataFrame:
    """S1."""
    return _shown(readers.read_discord(spark, _exports(spark, d, "discord"), SALT))


def reader_telegram(spark: SparkSession, d: str) -> DataFrame:
    """S2."""
    return _shown(readers.read_telegram(spark, _exports(spark, d, "telegram"), SALT))


def reader_canonical(spark: SparkSession, d: str) -> DataFrame:
    """S3: canonical exports, also those of platform csv."""
    return _shown(readers.read_canonical(spark, _exports(spark, d, "canonical", "csv"), SALT))


def reader_lark(spark: SparkSession, d: str) -> DataFrame:
    """S4, S4a to S4d."""
    return _shown(readers.read_lark(spark, _exports(spark, d, "lark"), SALT))


def reader_slack(spark: SparkSession, d: str) -> DataFrame:
    """S5, P6, U1."""
    return _shown(readers.read_slack(spark, _exports(spark, d, "slack"), SALT))


def _folder(spark: SparkSession, name: str) -> str:
    return Cuts(spark, name).root


def reader_csv(spark: SparkSession, d: str) -> DataFrame:
    """Messages written as CSV under aliases of the columns' names, and read again."""
    folder = _folder(spark, "csv") + "/rows"
    rows = table(spark, d, "messages").select(F.col("content").alias("Text"), F.col("author_name").alias(" username "), F.col("author_id").alias("USER_ID"), F.date_format("delivered_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"), F.col("channel").alias("channel_name"), F.col("msg_row").alias("id"), F.col("reply_to_message_id").alias("reply_to"))
    rows.write.option("header", True).option("escape", '"').csv(folder)
    return _shown(readers.read_csv(spark, folder, SALT)).drop("ord", "n_reactions", "attachment_count")


def reader_raw(spark: SparkSession, d: str) -> DataFrame:
    """Messages written as NDJSON and read again: contents of at least 20 characters, cut to 100."""
    folder = _folder(spark, "ndjson") + "/rows"
    sender = F.struct(F.struct(F.col("author_id").alias("open_id")).alias("sender_id"), F.col("author_name").alias("name"))
    line = F.struct(F.col("msg_row").cast("string").alias("message_id"), F.when(F.col("msg_row") % 7 == 0, "system").otherwise("text").alias("msg_type"), "content", F.unix_millis("delivered_at").cast("string").alias("create_time"), sender.alias("sender"), F.col("channel").alias("chat_name"))
    table(spark, d, "messages").select(F.to_json(line).alias("value")).write.text(folder)
    return _shown(readers.read_raw(spark, folder, SALT, least=20, cut=100)).select("channel", "message_id", "author_id", "author_name", "ts_us", "content")


def users_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Users written with their names redacted, and read again."""
    folder = _folder(spark, "users") + "/rows"
    documents.write_users(table(spark, d, "users").select(F.col("user_id").alias("author_id"), "display_name", "message_count"), folder)
    return spark.read.json(folder).select("author_id", "display_name", "message_count")


def run_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Counts of two runs as statistics documents, flattened, and read again as long rows by run."""
    rows = table(spark, d, "messages").groupBy((F.col("batch_no") <= 3).alias("old"), F.col("platform").alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value")).withColumn("category", F.lit("platforms"))
    runs = [documents.statistics_document(rows.where(F.col("old") == old).drop("old"), {"label": "x"}) for old in (True, False)]
    return incremental.runs_of(spark, runs)


def facts_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Facts written as CSV with the fields that occur, and read again."""
    folder = _folder(spark, "facts") + "/rows"
    parts = table(spark, d, "part")
    fact = F.map_filter(F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("note"), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit('"q", '), F.col("p_name")))), lambda k, v: v.isNotNull())
    found = parts.select(F.col("p_partkey").alias("chunk_idx"), F.lit("provider_usage").alias("category"), fact.alias("fact"))
    documents.write_facts(found, "provider_usage", folder)
    back = spark.read.option("header", True).option("escape", '"').csv(folder)
    names = {c.lstrip("﻿"): c for c in back.columns}
    return back.select(F.col(f"`{names['chunk_idx']}`").cast("bigint").alias("chunk_idx"), F.col("brand"), F.coalesce("note", F.lit("")).alias("note"))


QUERIES = {f.__name__: f for f in (reader_discord, reader_telegram, reader_canonical, reader_lark, reader_slack, reader_csv, reader_raw, users_round_trip, run_round_trip, facts_round_trip)}

_MESSAGES = "f AS (SELECT record_id, TRY_CAST(payload AS JSON) AS j FROM raw_records WHERE platform IN ({platforms}) AND json_valid(payload))"
_HASHED = "substr(sha256('salt:' || coalesce({id}, '')), 1, 16)"
_COUNT = "CASE WHEN json_type(m, '{path}') = 'ARRAY' THEN CAST(json_array_length(m, '{path}') AS BIGINT) ELSE 0 END"
_FIRST = lambda *paths: "coalesce(" + ", ".join(f"nullif(m ->> '{p}', '')" for p in paths) + ")"


def _sql(platforms: str, items: str, channel: str, message_id: str, author: str, name: str, at: str, content: str, reply: str, attachments: str, where: str = "true", order: str = "idx") -> str:
    """Messages in SQL: `items` is the array of a file `j`, the rest are expressions over an element `m`."""
    return f"""WITH {_MESSAGES.format(platforms=platforms)}, a AS (SELECT record_id, j, {items} AS items FROM f),
nn AS (SELECT record_id, j, items, unnest(range(CAST(json_array_length(items) AS BIGINT))) AS idx FROM a WHERE json_type(items) = 'ARRAY'),
e AS (SELECT record_id, j, idx, json_extract(items, idx) AS m FROM nn), k0 AS (SELECT * FROM e WHERE {where}),
x AS (SELECT *, row_number() OVER (ORDER BY record_id, idx) AS x FROM k0),
v AS (SELECT 'm' AS tbl, x AS row_no, trim({at}) AS v, 'UTC' AS z FROM x), {INSTANTS}
SELECT record_id * 8589934592 + {order} AS ord, {channel} AS channel, coalesce({message_id}, '') AS message_id, {author} AS author_id, coalesce({name}, 'unknown') AS author_name, utc_us AS ts_us,
coalesce({content}, '') AS content, {reply} AS reply_to_message_id, {_COUNT.format(path='$.reactions')} AS n_reactions, CAST({attachments} AS BIGINT) AS attachment_count FROM x JOIN r ON r.row_no = x.x"""


_LARK_ITEMS = "CASE WHEN json_type(j) = 'ARRAY' THEN j WHEN json_type(j, '$.messages') = 'ARRAY' THEN j -> '$.messages' WHEN json_type(j, '$.data.messages') = 'ARRAY' THEN j -> '$.data.messages' ELSE j -> '$.data.items' END"
_SENDER = _FIRST("$.sender.sender_id.open_id", "$.sender.sender_id.user_id", "$.sender.open_id", "$.sender.id", "$.sender.user_id")

ORACLE = {
    "reader_discord": _sql("'discord'", "j -> '$.messages'", "coalesce(j ->> '$.channel.name', 'unknown')", "m ->> '$.id'", _HASHED.format(id="m ->> '$.author.id'"), _FIRST("$.author.nickname", "$.author.name"),
        "m ->> '$.timestamp'", "m ->> '$.content'", "m ->> '$.reference.messageId'", _COUNT.format(path="$.attachments")),
    "reader_telegram": _sql("'telegram'", "j -> '$.messages'", "coalesce(j ->> '$.name', 'telegram')", "m ->> '$.id'", _HASHED.format(id="m ->> '$.from_id'"), _FIRST("$.from"), "m ->> '$.date'",
        "CASE WHEN json_type(m, '$.text') = 'ARRAY' THEN array_to_string(list_transform(json_extract(m, '$.text[*]'), lambda t: coalesce(t ->> '$.text', t ->> '$')), '') ELSE m ->> '$.text' END",
        "nullif(nullif(m ->> '$.reply_to_message_id', ''), '0')", "CASE WHEN coalesce(json_type(m, '$.file'), 'NULL') <> 'NULL' OR coalesce(json_type(m, '$.photo'), 'NULL') <> 'NULL' THEN 1 ELSE 0 END", "m ->> '$.type' = 'message'"),
    "reader_canonical": _sql("'canonical', 'csv'", "j -> '$.messages'", "coalesce(m ->> '$.channel', '')", "m ->> '$.message_id'",
        f"CASE WHEN regexp_matches(coalesce(m ->> '$.author_id', ''), '^(sha256:|hash:)') THEN m ->> '$.author_id' ELSE {_HASHED.format(id='''m ->> '$.author_id' ''')} END", "m ->> '$.author_name'", "m ->> '$.timestamp'", "m ->> '$.content'",
        "m ->> '$.reply_to_message_id'", "coalesce(CAST(m ->> '$.attachment_count' AS BIGINT), 0)"),
    "reader_lark": _sql("'lark'", _LARK_ITEMS, f"coalesce({_FIRST('$.chat_name', '$.chat_id')}, first_value({_FIRST('$.chat_name', '$.chat_id')} IGNORE NULLS) OVER (PARTITION BY record_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 'lark-chat')",
        _FIRST("$.message_id", "$.id"), _HASHED.format(id=_SENDER), f"coalesce({_FIRST('$.sender.name', '$.sender.nickname')}, {_SENDER})", "m ->> '$.create_time'", "json_extract_string(CAST(m ->> '$.body.content' AS JSON), '$.text')",
        _FIRST("$.parent_id", "$.reply_to"), "0", "json_type(m) = 'OBJECT'"),
    "reader_slack": _sql("'slack'", "CASE WHEN json_type(j) = 'ARRAY' THEN j ELSE j -> '$.messages' END", "'c' || record_id", "m ->> '$.ts'",
        f"CASE WHEN nullif(m ->> '$.user', '') IS NULL THEN 'unknown' ELSE {_HASHED.format(id='''m ->> '$.user' ''')} END", _FIRST("$.user"), "m ->> '$.ts'", "m ->> '$.text'",
        "CASE WHEN nullif(m ->> '$.thread_ts', '') <> coalesce(m ->> '$.ts', '') THEN m ->> '$.thread_ts' END", _COUNT.format(path="$.files"),
        "m ->> '$.type' = 'message' AND coalesce(m ->> '$.subtype', '') NOT IN ('channel_join', 'channel_leave', 'channel_name', 'channel_purpose', 'channel_topic') AND NOT starts_with(coalesce(m ->> '$.user', ''), 'B')"),
    "reader_csv": r"""WITH c AS (SELECT *, nullif(regexp_replace(coalesce(content, ''), '^[\s\x{85}\p{Z}]+|[\s\x{85}\p{Z}]+$', '', 'g'), '') AS text, coalesce(nullif(trim(author_id), ''), nullif(trim(author_name), '')) AS who FROM messages)
SELECT coalesce(nullif(trim(channel), ''), 'csv-import') AS channel, CAST(msg_row AS VARCHAR) AS message_id, CASE WHEN who IS NULL THEN 'unknown' ELSE substr(sha256('salt:' || who), 1, 16) END AS author_id,
coalesce(nullif(trim(author_name), ''), 'unknown') AS author_name, epoch_us(delivered_at) AS ts_us, text AS content, nullif(trim(reply_to_message_id), '') AS reply_to_message_id FROM c WHERE text IS NOT NULL""",
    "reader_raw": r"""WITH c AS (SELECT *, regexp_replace(coalesce(content, ''), '^[\s\x{85}\p{Z}]+|[\s\x{85}\p{Z}]+$', '', 'g') AS text FROM messages WHERE msg_row % 7 <> 0)
SELECT coalesce(nullif(channel, ''), 'raw') AS channel, CAST(msg_row AS VARCHAR) AS message_id, substr(sha256('salt:' || coalesce(author_id, '')), 1, 16) AS author_id, coalesce(nullif(author_name, ''), 'unknown') AS author_name,
epoch_us(delivered_at) // 1000 * 1000 AS ts_us, substr(content, 1, 100) AS content FROM c WHERE length(text) >= 20""",
    "users_round_trip": "SELECT user_id AS author_id, '<redacted>' AS display_name, message_count FROM users",
    "run_round_trip": """SELECT CAST(CASE WHEN batch_no <= 3 THEN 0 ELSE 1 END AS INTEGER) AS run_idx, 'platforms' AS category, platform AS key, CAST(count(*) AS DOUBLE) AS value FROM messages GROUP BY 1, 3""",
    "facts_round_trip": """SELECT p_partkey AS chunk_idx, p_brand AS brand, CASE WHEN p_size % 3 = 0 THEN '"q", ' || p_name ELSE '' END AS note FROM part""",
}
