"""Queries of the general data problems p4 to p7, and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.instants import to_utc_us
from chatloom.operators import dedup, nested, skew
from chatloom.session import table


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    """Author ids with at least 2 % of all rows of messages."""
    messages = table(spark, directory, "messages").select(F.nullif("author_id", F.lit("")).alias("author_id"))
    return skew.heavy_hitters(messages, "author_id", 0.02).select("author_id")


def p4_author_activity(spark: SparkSession, directory: str) -> DataFrame:
    """Per-author counts and spans, heavy authors apart from the rest."""
    messages = table(spark, directory, "messages")
    partial = [
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.length("content"), F.lit(0))).alias("chars"),
        F.min("msg_row").alias("first_row"), F.max("delivered_at").alias("last_delivery"),
    ]
    final = [
        F.sum("n").alias("n_rows"), F.sum("chars").alias("n_chars"), F.min("first_row").alias("first_row"),
        F.unix_micros(F.max("last_delivery")).alias("last_delivery"),
    ]
    return skew.aggregate_by_key(messages, "author_id", partial, final, share=0.005)


def _chat_tables(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The shredded tables of all raw records."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return nested.chat_tables(table(spark, directory, "raw_records"))


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    """Every entry of a reactions array in a valid payload."""
    return nested.reaction_table(_chat_tables(spark, directory)).select("record_id", "message_pos", "reaction_pos", "message_id", "author_key", "emoji")


def p5_messages(spark: SparkSession, directory: str) -> DataFrame:
    """The flat message table of all raw records."""
    return nested.message_table(_chat_tables(spark, directory))


def p5_authors(spark: SparkSession, directory: str) -> DataFrame:
    """The flat author table of all raw records."""
    return nested.author_table(nested.message_table(_chat_tables(spark, directory)))


def p5_shredded(spark: SparkSession, directory: str) -> DataFrame:
    """Every cell of every table that shared inlining makes of the raw records, with its keys."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return nested.cell_rows(nested.shred(table(spark, directory, "raw_records"), "record_id", "payload", names=nested.CONTAINERS), "record_id")


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    """Rows of messages and seen_messages to drop."""
    return dedup.duplicate_rows(table(spark, directory, "messages"), table(spark, directory, "seen_messages"))


def p6_kept(spark: SparkSession, directory: str) -> DataFrame:
    """The copy of each message that is kept."""
    kept = dedup.first_copies(table(spark, directory, "messages"), table(spark, directory, "seen_messages"))
    return kept.select("msg_row", "export_key", "message_id", "batch_no")


def stamped(rows: DataFrame, exports: DataFrame, value: str, out: str = "utc_us") -> DataFrame:
    """`rows` with the UTC microseconds of `value`, read on the clock of each row's export.

    export_state has one small row per export and is broadcast only below Spark's own size limit.
    Rows of an unknown export have no zone; their zone-less values give NULL.
    """
    zones = exports.select(F.col("export_key").alias("_zone_key"), F.col("tz_name").alias("_zone"))
    joined = rows.join(zones, F.col("export_key") == F.col("_zone_key"), "left")
    return joined.withColumn(out, to_utc_us(value, "_zone")).drop("_zone_key", "_zone")


def p7_found(spark: SparkSession, directory: str) -> DataFrame:
    """One UTC instant for each usable timestamp of messages and pages."""
    exports = table(spark, directory, "export_state")
    parts = []
    for name, row, value in (("messages", "msg_row", "ts"), ("pages", "page_id", "create_time")):
        rows = table(spark, directory, name).select(F.lit(name).alias("tbl"), F.col(row).alias("row_no"), "export_key", F.col(value).alias("_value"))
        parts.append(stamped(rows, exports, "_value").where(F.col("utc_us").isNotNull()).select("tbl", "row_no", "utc_us"))
    return parts[0].unionByName(parts[1])


QUERIES = {
    "p4_found": p4_found, "p4_author_activity": p4_author_activity, "p5_found": p5_found, "p5_messages": p5_messages,
    "p5_authors": p5_authors, "p5_shredded": p5_shredded, "p6_found": p6_found, "p6_kept": p6_kept, "p7_found": p7_found,
}

_IDS = """m AS (SELECT msg_row, export_key, trim(message_id) AS id FROM messages WHERE trim(coalesce(message_id, '')) <> ''),
s AS (SELECT seen_no, export_key, trim(message_id) AS id FROM seen_messages WHERE trim(coalesce(message_id, '')) <> ''),
d AS (SELECT msg_row FROM (SELECT *, row_number() OVER (PARTITION BY export_key, id ORDER BY msg_row) AS k FROM m) x
      WHERE k > 1 OR EXISTS (SELECT 1 FROM s WHERE s.export_key = x.export_key AND s.id = x.id))"""

_RAW = """raw AS (SELECT record_id, TRY_CAST(payload AS JSON) AS j FROM raw_records WHERE json_valid(payload)),
boxes AS (
  SELECT record_id, '$' AS container, j AS items FROM raw WHERE json_type(j) = 'ARRAY'
  UNION ALL SELECT record_id, '$.messages', j -> '$.messages' FROM raw WHERE json_type(j, '$.messages') = 'ARRAY'
  UNION ALL SELECT record_id, '$.data.messages', j -> '$.data.messages' FROM raw WHERE json_type(j, '$.data.messages') = 'ARRAY'
  UNION ALL SELECT record_id, '$.data.items', j -> '$.data.items' FROM raw WHERE json_type(j, '$.data.items') = 'ARRAY'),
numbered AS (SELECT record_id, container, items, unnest(range(CAST(json_array_length(items) AS BIGINT))) AS message_pos FROM boxes),
msgs AS (SELECT record_id, container, message_pos, json_extract(items, message_pos) AS m FROM numbered),
flat AS (SELECT record_id, container, message_pos, m,
  coalesce(nullif(m ->> '$.message_id', ''), nullif(m ->> '$.id', ''), nullif(m ->> '$.ts', '')) AS message_id,
  coalesce(nullif(m ->> '$.author_id', ''), nullif(m ->> '$.from_id', ''), nullif(m ->> '$.user', ''), nullif(m ->> '$.author.id', ''),
    nullif(m ->> '$.sender.sender_id.open_id', ''), nullif(m ->> '$.sender.sender_id.user_id', ''), nullif(m ->> '$.sender.id', ''), '') AS author_key,
  coalesce(nullif(m ->> '$.author_name', ''), nullif(m ->> '$.author.nickname', ''), nullif(m ->> '$.author.name', ''), nullif(m ->> '$.from', ''),
    nullif(m ->> '$.user_profile.display_name', ''), nullif(m ->> '$.user_profile.real_name', ''), nullif(m ->> '$.sender.name', '')) AS author_name,
  coalesce(nullif(m ->> '$.timestamp', ''), nullif(m ->> '$.ts', ''), nullif(m ->> '$.date', ''), nullif(m ->> '$.create_time', '')) AS sent_at,
  coalesce(nullif(m ->> '$.reply_to_message_id', ''), nullif(m ->> '$.reference.messageId', ''), nullif(m ->> '$.thread_ts', ''), nullif(m ->> '$.parent_id', '')) AS reply_to
  FROM msgs WHERE json_type(m) = 'OBJECT')"""

#: Instants in SQL: of rows `v` (tbl, row_no, v, z) the CTE `r` has (tbl, row_no, utc_us).
INSTANTS = r"""k AS (SELECT *, CASE
  WHEN regexp_full_match(v, '\d{9,10}(\.\d{1,9})?') THEN 'sec' WHEN regexp_full_match(v, '\d{12,13}') THEN 'ms' WHEN regexp_full_match(v, '\d{15,16}') THEN 'us'
  WHEN regexp_matches(v, '^\d{4}[-/]\d\d[-/]\d\d[Tt ]\d\d:\d\d') THEN 'ymd' WHEN regexp_matches(v, '^\d\d\.\d\d\.\d{4} ') THEN 'dmy' WHEN regexp_matches(v, '^\d{8}[Tt]\d{6}') THEN 'compact'
  WHEN regexp_matches(v, '^[A-Z][a-z]{2}, \d\d [A-Z][a-z]{2} \d{4} ') THEN 'mail' WHEN regexp_matches(v, '^[A-Z][a-z]{2} \d{1,2}, \d{4} \d{1,2}:\d\d [AP]M$') THEN 'us12' END AS kind FROM v),
p AS (SELECT *, CASE kind
  WHEN 'ymd' THEN replace(substr(v, 1, 10), '/', '-') || ' ' || regexp_extract(v, '(\d\d:\d\d(:\d\d)?)', 1) || CASE WHEN regexp_matches(v, '\d\d:\d\d:\d\d') THEN '' ELSE ':00' END
  WHEN 'dmy' THEN substr(v, 7, 4) || '-' || substr(v, 4, 2) || '-' || substr(v, 1, 2) || ' ' || substr(v, 12, 8)
  WHEN 'compact' THEN substr(v, 1, 4) || '-' || substr(v, 5, 2) || '-' || substr(v, 7, 2) || ' ' || substr(v, 10, 2) || ':' || substr(v, 12, 2) || ':' || substr(v, 14, 2)
  WHEN 'mail' THEN strftime(try_strptime(substr(v, 6, 20), '%d %b %Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S')
  WHEN 'us12' THEN strftime(try_strptime(v, '%b %d, %Y %I:%M %p'), '%Y-%m-%d %H:%M:%S') END AS clock,
  CASE WHEN kind = 'ymd' THEN rpad(regexp_extract(v, '\.(\d{1,6})', 1), 6, '0') ELSE '0' END AS frac,
  CASE WHEN kind IN ('ymd', 'mail', 'compact') THEN regexp_extract(v, '([+-]\d\d:?\d\d)(\[.*\])?$', 1) ELSE '' END AS off,
  CASE WHEN kind IN ('ymd', 'compact') THEN upper(regexp_extract(v, '([A-Za-z]{1,4})$', 1)) ELSE '' END AS ab FROM k),
n AS (SELECT *, epoch_us(TRY_CAST(clock AS TIMESTAMP)) + TRY_CAST(frac AS BIGINT) AS wall, TRY_CAST(clock AS TIMESTAMP) AS naive FROM p),
o AS (SELECT *, CASE WHEN off <> '' THEN (CASE WHEN off[1] = '-' THEN -1 ELSE 1 END) * (CAST(off[2:3] AS BIGINT) * 60 + CAST(right(off, 2) AS BIGINT))
  WHEN ab IN ('Z', 'UTC', 'GMT') THEN 0 WHEN ab IN ('BST', 'CET') THEN 60 WHEN ab = 'CEST' THEN 120 WHEN ab = 'EST' THEN -300 WHEN ab = 'EDT' THEN -240 END AS minutes,
  epoch_us(timezone(z, naive)) AS u, epoch_us(timezone(z, naive)) - 3600000000 AS e FROM n),
r AS (SELECT tbl, row_no, CASE kind WHEN 'sec' THEN CAST(CAST(v AS DECIMAL(28, 9)) * 1000000 AS BIGINT) WHEN 'ms' THEN CAST(v AS BIGINT) * 1000 WHEN 'us' THEN CAST(v AS BIGINT)
  ELSE CASE WHEN minutes IS NOT NULL THEN wall - minutes * 60000000
    -- a clock time that occurs twice: the hour before shows the same time
    WHEN timezone(z, make_timestamptz(e)) = naive THEN e + CAST(frac AS BIGINT) ELSE u + CAST(frac AS BIGINT) END END AS utc_us FROM o)"""

ORACLE = {
    "p7_found": f"""WITH v AS (SELECT 'messages' AS tbl, msg_row AS row_no, trim(ts) AS v, tz_name AS z FROM messages LEFT JOIN export_state USING (export_key)
UNION ALL SELECT 'pages', page_id, trim(create_time), tz_name FROM pages LEFT JOIN export_state USING (export_key)), {INSTANTS} SELECT tbl, row_no, utc_us FROM r WHERE utc_us IS NOT NULL""",
    "p4_found": "SELECT author_id FROM messages WHERE author_id <> '' GROUP BY author_id HAVING count(*) >= 0.02 * (SELECT count(*) FROM messages)",
    "p4_author_activity": """SELECT author_id, count(*) AS n_rows, CAST(sum(coalesce(length(content), 0)) AS BIGINT) AS n_chars, min(msg_row) AS first_row,
epoch_us(max(delivered_at)) AS last_delivery FROM messages GROUP BY author_id""",
    "p5_found": f"""WITH {_RAW}, listed AS (SELECT *, unnest(range(CAST(json_array_length(m, '$.reactions') AS BIGINT))) AS reaction_pos
  FROM flat WHERE json_type(m, '$.reactions') = 'ARRAY'), r AS (SELECT *, json_extract(m -> '$.reactions', reaction_pos) AS e FROM listed)
SELECT record_id, message_pos, reaction_pos, message_id, author_key, coalesce(nullif(e ->> '$.emoji.name', ''),
  CASE WHEN json_type(e, '$.emoji') = 'VARCHAR' THEN nullif(e ->> '$.emoji', '') END, nullif(e ->> '$.name', ''), nullif(e ->> '$.reaction_type.emoji_type', '')) AS emoji FROM r""",
    "p5_messages": f"WITH {_RAW} SELECT record_id, container, message_pos, message_id, author_key, author_name, sent_at, reply_to FROM flat",
    "p5_authors": f"WITH {_RAW} SELECT author_key, min(author_name) AS author_name, count(*) AS n_messages FROM flat WHERE author_key <> '' GROUP BY author_key",
    # A leaf's row stands at the last array on its way; its column is what follows.
    "p5_shredded": r"""WITH leaf AS (SELECT r.record_id, t.fullkey AS k, t.atom ->> '$' AS value FROM raw_records r, json_tree(CASE WHEN json_valid(payload) THEN payload ELSE 'null' END) t WHERE t.type NOT IN ('OBJECT', 'ARRAY', 'NULL')),
c AS (SELECT record_id, value, regexp_extract(k, '^\$(.*\])?', 0) AS loc, regexp_replace(k, '^\$(.*\])?\.?', '') AS tail FROM leaf)
SELECT record_id, regexp_replace(loc, '\d+', '', 'g') AS path, array_to_string(regexp_extract_all(loc, '\[(\d+)\]', 1), ',') AS keys,
CASE WHEN loc = '$' OR regexp_full_match(loc, '\$\[\d+\]') THEN NULL WHEN contains(regexp_replace(loc, '\[\d+\]$', ''), '[') THEN regexp_replace(regexp_extract(regexp_replace(loc, '\[\d+\]$', ''), '^.*\]', 0), '\d+', '', 'g') ELSE '$' END AS parent_path,
array_to_string(list_slice(regexp_extract_all(loc, '\[(\d+)\]', 1), 1, -2), ',') AS parent_keys, CASE WHEN tail = '' THEN '$' ELSE tail END AS "column", value FROM c""",
    "p6_found": f"""WITH {_IDS} SELECT 'messages' AS tbl, msg_row AS row_no FROM d UNION ALL
SELECT 'seen_messages', seen_no FROM (SELECT *, row_number() OVER (PARTITION BY export_key, id ORDER BY seen_no) AS k FROM s) WHERE k > 1""",
    "p6_kept": f"WITH {_IDS} SELECT msg_row, export_key, message_id, batch_no FROM messages WHERE msg_row NOT IN (SELECT msg_row FROM d)",
}
