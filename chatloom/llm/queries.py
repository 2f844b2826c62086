"""Queries of the language-model training problems, and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import conversations, language, leakage, mixture, pii, subjects
from chatloom.plans.quality import INSTANTS
from chatloom.session import spread, table


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    """The turns of every sound conversation."""
    turns = conversations.conversations(table(spark, directory, "messages"), table(spark, directory, "export_state"))
    return turns.select("conv_row", "turn", "msg_row", "speaker")


def p1_messages(spark: SparkSession, directory: str) -> DataFrame:
    """The turns of every sound conversation with their links, texts and roles."""
    messages = table(spark, directory, "messages")
    turns = conversations.conversations(messages, table(spark, directory, "export_state"))
    texts = messages.select(F.col("msg_row").alias("_row"), "content", "author_name")
    role = F.when(F.col("speaker") == 1, F.lit("asker")).otherwise(F.lit("replier"))
    return turns.join(texts, F.col("msg_row") == F.col("_row")).drop("_row").withColumn("role", role)


def _rows(spark: SparkSession, directory: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table for work that is heavy on each row."""
    return spread(table(spark, directory, name).select(*columns))


def _language_model(spark: SparkSession, directory: str) -> language.Model:
    messages, documents = table(spark, directory, "messages"), table(spark, directory, "documents")
    return language.fit_tables([(messages, "msg_row", "lang", "content"), (documents, "doc_id", "lang", "text")])


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    """Lines and languages of the rows whose label is missing or wrong or whose text mixes languages."""
    model = _language_model(spark, directory)
    found = language.mislabelled(_rows(spark, directory, "messages", "msg_row", "lang", "content"), "messages", "msg_row", "lang", "content", model)
    return found.unionByName(language.mislabelled(_rows(spark, directory, "documents", "doc_id", "lang", "text"), "documents", "doc_id", "lang", "text", model))


def p2_spans(spark: SparkSession, directory: str) -> DataFrame:
    """Every language span of messages and documents with its confidence."""
    model = _language_model(spark, directory)
    found = language.spans(_rows(spark, directory, "messages", "msg_row", "lang", "content"), "messages", "msg_row", "lang", "content", model)
    return found.unionByName(language.spans(_rows(spark, directory, "documents", "doc_id", "lang", "text"), "documents", "doc_id", "lang", "text", model))


def _name_lexicon(spark: SparkSession, directory: str) -> pii.Names:
    messages = table(spark, directory, "messages")
    return pii.fit_lexicon([(messages, "author_name"), (table(spark, directory, "users"), "display_name")], (messages, "content"))


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    """Every item of personal information in the texts and author names of messages."""
    lexicon = _name_lexicon(spark, directory)
    return pii.items(_rows(spark, directory, "messages", "msg_row", "content", "author_name"), "msg_row", ("content", "author_name"), lexicon).drop("end_pos")


def p3_redacted(spark: SparkSession, directory: str) -> DataFrame:
    """The messages with typed placeholders in place of personal information."""
    clean = pii.redacted(_rows(spark, directory, "messages", "msg_row", "content", "author_name"), ("content", "author_name"), _name_lexicon(spark, directory))
    return clean.select("msg_row", "content", "author_name")


def p8_found(spark: SparkSession, directory: str) -> DataFrame:
    """Documents that hold twelve consecutive words of a benchmark item, with the items."""
    return leakage.leaked(_rows(spark, directory, "documents", "doc_id", "text"), table(spark, directory, "benchmark")).select("doc_id", "item_id")


def p8_clean(spark: SparkSession, directory: str) -> DataFrame:
    """The corpus without leaking documents."""
    return leakage.cleaned(table(spark, directory, "documents"), table(spark, directory, "benchmark")).select("doc_id", "source", "n_chars")


def p8_pruned(spark: SparkSession, directory: str) -> DataFrame:
    """Words that documents lose when leaking passages are cut out of them, and words that stay."""
    clean = leakage.pruned(table(spark, directory, "documents"), table(spark, directory, "benchmark"))
    return clean.where("n_removed > 0").select("doc_id", "n_removed", F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+")).cast("bigint").alias("n_left"))


def _sized(spark: SparkSession, directory: str) -> DataFrame:
    documents = _rows(spark, directory, "documents", "doc_id", "source", "text")
    return documents.select("doc_id", "source", mixture.count_tokens(spark, F.col("text")).alias("n_tokens"))


def _sized_in_bytes(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "documents").select("doc_id", "source", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_tokens"))


def p9_found(spark: SparkSession, directory: str) -> DataFrame:
    """Sources that can't reach their share even with all repeats."""
    return mixture.unreachable(_sized(spark, directory), table(spark, directory, "mix_targets"))


def p9_mixture(spark: SparkSession, directory: str) -> DataFrame:
    """The mixture, a row per copy of a document."""
    return mixture.mix(_sized(spark, directory), table(spark, directory, "mix_targets"))


def p9_mixture_bytes(spark: SparkSession, directory: str) -> DataFrame:
    """The mixture with sizes in bytes, which SQL can count."""
    return mixture.mix(_sized_in_bytes(spark, directory), table(spark, directory, "mix_targets"))


def p9_shares(spark: SparkSession, directory: str) -> DataFrame:
    """Target and actual share of each source in the mixture."""
    targets = table(spark, directory, "mix_targets")
    return mixture.reached(mixture.mix(_sized(spark, directory), targets), targets)


def p9_shares_bytes(spark: SparkSession, directory: str) -> DataFrame:
    """The same with sizes in bytes."""
    targets = table(spark, directory, "mix_targets")
    shares = mixture.reached(mixture.mix(_sized_in_bytes(spark, directory), targets), targets)
    return shares.select("source", "n_rows", "n_tokens", F.round("actual_share", 6).alias("actual_share"))


def _subjects(spark: SparkSession, directory: str) -> subjects.Trained:
    named = table(spark, directory, "subjects").select("subject").where(F.col("subject").isNotNull()).distinct().orderBy("subject")
    names = [r["subject"] for r in named.limit(1_001).collect()]
    if len(names) > 1_000:
        raise ValueError("more than 1000 subjects: the model has a column for each")
    return subjects.train(_rows(spark, directory, "documents", "doc_id", "text"), table(spark, directory, "subject_labels"), names)


def p10_found(spark: SparkSession, directory: str) -> DataFrame:
    """Documents with the subjects to which at least two of their sentences are devoted."""
    return _subjects(spark, directory).areas().select("doc_id", "subject")


def p10_areas(spark: SparkSession, directory: str) -> DataFrame:
    """The same with sentence counts and calibrated posteriors."""
    return _subjects(spark, directory).areas()


def p10_composition(spark: SparkSession, directory: str) -> DataFrame:
    """Documents of each source by subject."""
    documents = table(spark, directory, "documents")
    found = _subjects(spark, directory).areas().withColumnRenamed("doc_id", "_doc")
    joined = documents.select("doc_id", "source").join(found, F.col("doc_id") == F.col("_doc"))
    return joined.groupBy("source", "subject").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n_sentences").alias("n_sentences"))


QUERIES = {
    "p1_found": p1_found, "p1_messages": p1_messages, "p2_found": p2_found, "p2_spans": p2_spans, "p3_found": p3_found, "p3_redacted": p3_redacted,
    "p8_found": p8_found, "p8_clean": p8_clean, "p8_pruned": p8_pruned, "p9_found": p9_found, "p9_mixture": p9_mixture, "p9_mixture_bytes": p9_mixture_bytes, "p9_shares": p9_shares, "p9_shares_bytes": p9_shares_bytes,
    "p10_found": p10_found, "p10_areas": p10_areas, "p10_composition": p10_composition,
}
_WORDS = """iw AS (SELECT item_id, list_transform(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'), lambda w: w) AS w FROM benchmark),
dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k : k + 11], ' ') AS g FROM iw, unnest(range(1, len(w) - 10)) AS r(k)),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k : k + 11], ' ') AS g FROM dw, unnest(range(1, len(w) - 10)) AS r(k)),
hits AS (SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g))"""

_CONVERSATIONS = f"""WITH RECURSIVE v AS (SELECT 'messages' AS tbl, msg_row AS row_no, trim(ts) AS v, tz_name AS z FROM messages LEFT JOIN export_state USING (export_key)), {INSTANTS},
m AS (SELECT msg_row, export_key, nullif(trim(message_id), '') AS id, nullif(trim(reply_to_message_id), '') AS rep, nullif(author_id, '') AS author, utc_us,
  NOT regexp_matches(coalesce(content, ''), '[^\\s\\p{{Z}}\\p{{Cc}}\\p{{Cf}}]') AS blank FROM messages JOIN r ON row_no = msg_row),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY export_key, id ORDER BY msg_row) AS k FROM m) WHERE k = 1 OR id IS NULL),
c AS (SELECT a.msg_row, b.msg_row AS parent FROM d a JOIN d b ON b.export_key = a.export_key AND b.id = a.rep),
t(root, msg_row) AS (SELECT msg_row, msg_row FROM d WHERE rep IS NULL UNION ALL SELECT t.root, c.msg_row FROM t JOIN c ON c.parent = t.msg_row),
g AS (SELECT root FROM t JOIN d USING (msg_row) GROUP BY root HAVING count(DISTINCT author) > 1 AND bool_and(author IS NOT NULL AND utc_us IS NOT NULL AND NOT blank)),
turns AS (SELECT root, msg_row, author, row_number() OVER (PARTITION BY root ORDER BY utc_us, msg_row) AS turn FROM t JOIN g USING (root) JOIN d USING (msg_row)),
f AS (SELECT *, min(turn) OVER (PARTITION BY root, author) AS first_turn FROM turns)
SELECT root AS conv_row, turn, msg_row, dense_rank() OVER (PARTITION BY root ORDER BY first_turn) AS speaker FROM f"""

# The draw in SQL: each source's mean by bisection (80 halvings), its distribution, and how many of the
# cumulative probabilities lie below the document's number between 0 and 1.
_DRAWN = """WITH RECURSIVE s AS (SELECT source, sum(strlen(coalesce(text, ''))) AS own FROM documents GROUP BY source),
t AS (SELECT m.source, target_share, max_repeats AS cap, coalesce(own, 0) AS own, target_share * (SELECT sum(own) FROM s) AS wanted FROM mix_targets m LEFT JOIN s USING (source)),
p AS (SELECT *, CASE WHEN own > 0 THEN least(wanted / own, cap) ELSE 0.0 END AS rate FROM t),
b(source, cap, rate, low, high, n) AS (SELECT source, cap, rate, 0.0::DOUBLE, 1024.0::DOUBLE, 0 FROM p WHERE rate < cap AND rate > 0
  UNION ALL SELECT source, cap, rate, CASE WHEN mean < rate THEN (low + high) / 2 ELSE low END, CASE WHEN mean < rate THEN high ELSE (low + high) / 2 END, n + 1
  FROM (SELECT *, list_sum(list_transform(range(cap), lambda k: 1 - list_sum(list_transform(range(k + 1), lambda i: exp(-(low + high) / 2 + i * ln((low + high) / 2) - lgamma(i + 1)))))) AS mean FROM b WHERE n < 90)),
l AS (SELECT source, (low + high) / 2 AS lam, cap FROM b WHERE n = 90),
c AS (SELECT source, list_transform(range(cap), lambda k: list_sum(list_transform(range(k + 1), lambda i: exp(-lam + i * ln(lam) - lgamma(i + 1))))) AS cdf FROM l),
u AS (SELECT doc_id, source, strlen(coalesce(text, '')) AS n_tokens, (CAST('0x' || substr(sha256(doc_id || ':42'), 1, 13) AS BIGINT) + 0.5) / 4503599627370496 AS u FROM documents),
d AS (SELECT doc_id, source, n_tokens, CASE WHEN p.rate >= p.cap THEN p.cap WHEN p.rate > 0 THEN len(list_filter(cdf, lambda x: x < u)) ELSE 0 END AS n FROM u JOIN p USING (source) LEFT JOIN c USING (source))"""

ORACLE = {
    "p9_mixture_bytes": f"{_DRAWN} SELECT doc_id, source, n_tokens, unnest(range(n)) AS copy_no FROM d",
    "p9_shares_bytes": f"""{_DRAWN}, g AS (SELECT source, count(*) FILTER (WHERE n > 0) AS x, sum(n) AS n_rows, sum(n * n_tokens) AS n_tokens FROM d GROUP BY source)
SELECT t.source, CAST(coalesce(n_rows, 0) AS BIGINT) AS n_rows, CAST(coalesce(n_tokens, 0) AS BIGINT) AS n_tokens, round(coalesce(n_tokens, 0) / (SELECT sum(n_tokens) FROM g), 6) AS actual_share FROM t LEFT JOIN g USING (source)""",
    "p1_found": _CONVERSATIONS,
    "p1_messages": f"""SELECT q.*, c.parent AS parent_row, depth, content, author_name, CASE WHEN speaker = 1 THEN 'asker' ELSE 'replier' END AS role FROM ({_CONVERSATIONS}) q
LEFT JOIN (SELECT a.msg_row, b.msg_row AS parent FROM messages a JOIN (SELECT min(msg_row) AS msg_row, export_key, trim(message_id) AS id FROM messages WHERE trim(coalesce(message_id, '')) <> '' GROUP BY 2, 3) b
  ON b.export_key = a.export_key AND b.id = trim(a.reply_to_message_id)) c USING (msg_row)
JOIN (WITH RECURSIVE p AS (SELECT a.msg_row, b.msg_row AS parent FROM messages a LEFT JOIN (SELECT min(msg_row) AS msg_row, export_key, trim(message_id) AS id FROM messages WHERE trim(coalesce(message_id, '')) <> '' GROUP BY 2, 3) b
  ON b.export_key = a.export_key AND b.id = trim(a.reply_to_message_id)), t(msg_row, depth) AS (SELECT msg_row, 0 FROM p WHERE parent IS NULL UNION ALL SELECT p.msg_row, depth + 1 FROM p JOIN t ON p.parent = t.msg_row) SELECT * FROM t) h USING (msg_row)
JOIN (SELECT msg_row, content, author_name FROM messages) USING (msg_row)""",
    "p8_found": f"WITH {_WORDS} SELECT doc_id, item_id FROM hits",
    "p8_clean": f"WITH {_WORDS} SELECT doc_id, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM hits)",
    "p8_pruned": f"""WITH {_WORDS}, placed AS (SELECT doc_id, k, array_to_string(w[k : k + 11], ' ') AS g FROM dw, unnest(range(1, len(w) - 10)) AS r(k)),
gone AS (SELECT DISTINCT doc_id, k + o AS place FROM placed SEMI JOIN ig USING (g), unnest(range(12)) AS r(o))
SELECT doc_id, count(*) AS n_removed, any_value(len(w)) - count(*) AS n_left FROM gone JOIN dw USING (doc_id) GROUP BY doc_id""",
    # The choice of tokenizer doesn't change this list; SQL takes the bytes of the text as its size.
    "p9_found": """WITH s AS (SELECT source, sum(strlen(text)) AS own FROM documents GROUP BY source)
SELECT t.source FROM mix_targets t LEFT JOIN s USING (source) WHERE coalesce(own, 0) * max_repeats < target_share * (SELECT sum(own) FROM s)""",
}
