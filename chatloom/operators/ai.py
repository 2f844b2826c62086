"""Model-backed steps with pluggable functions and offline defaults: topic tags, facts, prompts.

A tagger maps texts to labels and an extractor one chunk of text to JSON. They run in Arrow batches
on the executors; results are kept in cache tables keyed by content, so a run only does what is new.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.ids import content_hash
from chatloom.operators.ranges import numbered
from chatloom.plans.lineage import Cuts

# Topic labels; the last is the fallback.
TOPICS = (
    "install_help", "install_report", "provider_config", "messaging_adapter", "feature_usage", "model_discussion",
    "community_meta", "brand_identity", "bug_report", "feature_request", "success_story", "general_discussion",
)
FALLBACK = TOPICS[-1]

Tagger = Callable[[Sequence[str]], Sequence["str | None"]]
Extractor = Callable[[str], str]


def dry_run(texts: Sequence[str]) -> list[str]:
    """The default tagger: every text is general discussion."""
    return [FALLBACK] * len(texts)


def tagged(messages: DataFrame, tagger: Tagger = dry_run, batch_size: int = 25, cache: DataFrame | None = None) -> DataFrame:
    """`ord`, `message_id`, `hash`, `topic` of every message, keyed by row, not by message id.

    Each different text is tagged once; texts in `cache` (`hash`, `topic`) not at all. A tagger that
    fails on a batch is asked text by text; what still fails or is no known topic gets the fallback.
    """
    rows = messages.select("ord", "message_id", F.coalesce("content", F.lit("")).alias("content")).withColumn("hash", content_hash("content"))
    named = fresh_topics(messages, tagger, batch_size, cache)
    every = named if cache is None else named.unionByName(cache.select("hash", "topic"))
    by_hash = every.select(F.col("hash").alias("_h"), F.coalesce("topic", F.lit(FALLBACK)).alias("topic"))
    return rows.drop("content").join(by_hash, F.col("hash") == F.col("_h")).select("ord", "message_id", "hash", "topic")


def fresh_topics(messages: DataFrame, tagger: Tagger = dry_run, batch_size: int = 25, cache: DataFrame | None = None) -> DataFrame:
    """`hash`, `topic` of each different text that the cache doesn't have; a null topic where the tagger failed, so
    that a cache can leave it out and the next run asks again. An unknown topic is the fallback."""
    rows = messages.select(F.coalesce("content", F.lit("")).alias("content")).withColumn("hash", content_hash("content"))
    todo = rows.groupBy("hash").agg(F.min("content").alias("content"))
    if cache is not None:
        todo = todo.join(cache.select(F.col("hash").alias("_h")), F.col("hash") == F.col("_h"), "left_anti")

    def ask(texts: list[str]) -> list[str | None]:
        try:
            found = list(tagger(texts))
            if len(found) == len(texts):
                return found
        except Exception:  # noqa: BLE001 - a model's failure mustn't end the job
            pass
        out: list[str | None] = []
        for text in texts:
            try:
                out.append(list(tagger([text]))[0])
            except Exception:  # noqa: BLE001
                out.append(None)
        return out

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            topics = [t for k in range(0, len(texts), batch_size) for t in ask(texts[k : k + batch_size])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t if t is None or t in TOPICS else FALLBACK for t in topics], pa.string())], names=["hash", "topic"])

    return todo.select("hash", "content").mapInArrow(run, "hash string, topic string")


def topic_distribution(topics: DataFrame) -> DataFrame:
    """Messages per topic and their share in percent, rounded to one place."""
    counts = topics.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # a row a topic
    return counts.select("topic", "n", F.round(F.col("n") * 100.0 / total, 1).alias("pct"))


def parse_topics(response: str, ids: Sequence[str]) -> dict[str, str] | None:
    """topics by id from a model's answer: the first array of objects, in a fence or not.

    Unknown topics become the fallback; None unless every id is answered.
    """
    body = re.sub(r"```\w*", "", response)
    start = body.find("[")
    while start >= 0:
        try:
            items, _ = json.JSONDecoder().raw_decode(body[start:])
        except ValueError:
            items = None
        if isinstance(items, list) and items and all(isinstance(x, dict) for x in items):
            found = {str(x.get("id")): x.get("topic") if x.get("topic") in TOPICS else FALLBACK for x in items}
            return {i: found[i] for i in ids} if all(i in found for i in ids) else None
        start = body.find("[", start + 1)
    return None


def chunks(messages: DataFrame, size: int = 100, by: str = "ts_text") -> DataFrame:
    """Messages with `chunk_idx`, chunks of `size` in the order of the time as text, then arrival.

    Rows are numbered over ranges, so no task sorts the whole table.
    """
    placed = numbered(messages, None, [F.coalesce(F.col(by), F.lit("")), F.col("ord")], "_n", Cuts(messages.sparkSession, "chunks"))
    return placed.withColumn("chunk_idx", F.floor((F.col("_n") - 1) / size)).drop("_n")


def chunk_texts(chunked: DataFrame, by: str = "ts_text") -> DataFrame:
    """one text a chunk, a line `[time] name: content` a message in order, contents cut to 800 characters."""
    line = F.concat(F.lit("["), F.coalesce(by, F.lit("")), F.lit("] "), F.coalesce("author_name", F.lit("")), F.lit(": "), F.substring(F.coalesce("content", F.lit("")), 1, 800))
    listed = F.sort_array(F.collect_list(F.struct(F.coalesce(by, F.lit("")).alias("k"), "ord", line.alias("line"))))  # a chunk's rows
    return chunked.groupBy("chunk_idx").agg(F.array_join(F.transform(listed, lambda x: x["line"]), "\n").alias("text"), F.count(F.lit(1)).alias("n"))


def tolerant_json(raw: str | None) -> tuple[dict | None, str | None]:
    """the JSON object in a model's answer, or why there is none. Fences, text around the object
    and trailing commas are forgiven; else the last balanced object counts."""
    if not raw or not raw.strip():
        return None, "empty"
    body = re.sub(r"^\s*```\w*\s*|\s*```\s*$", "", raw.strip())
    first, last = body.find("{"), body.rfind("}")
    candidates = [body[first : last + 1]] if 0 <= first < last else []
    candidates += [re.sub(r",(\s*[\]}])", r"\1", c) for c in candidates]
    depth, opened, balanced = 0, -1, []
    for k, c in enumerate(body):
        if c == "{":
            opened = k if depth == 0 else opened
            depth += 1
        elif c == "}" and depth:
            depth -= 1
            if depth == 0:
                balanced.append(body[opened : k + 1])
    for text in candidates + balanced[::-1]:
        try:
            value = json.loads(text)
        except ValueError:
            continue
        if isinstance(value, dict):
            return value, None
    return None, "no JSON object"


def no_facts(text: str) -> str:
    """The default extractor: an answer without facts."""
    return "{}"


def facts(texts: DataFrame, categories: Sequence[str], extractor: Extractor = no_facts, cache: DataFrame | None = None) -> DataFrame:
    """Long facts (`chunk_idx`, `hash`, `category`, `fact` map, `error`) of chunk texts.

    A failed chunk gives one row with `error`, a chunk without facts one without category; as the cache
    is keyed by the text's hash and errors aren't kept in it, failed chunks are tried again by the next run.
    """
    rows = texts.select("chunk_idx", "text", content_hash("text").alias("hash"))
    if cache is not None:
        rows = rows.join(cache.where("error is null").select(F.col("hash").alias("_h")).distinct(), F.col("hash") == F.col("_h"), "left_anti")
    wanted = set(categories)

    def run(batches):
        import pyarrow as pa

        kind = pa.map_(pa.string(), pa.string())
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for chunk, text, digest in zip(*(batch.column(k).to_pylist() for k in range(3))):
                try:
                    found, error = tolerant_json(extractor(text or ""))
                except Exception as e:  # noqa: BLE001
                    found, error = None, f"{type(e).__name__}: {e}"[:200]
                made = [(c, i) for c, items in (found or {}).items() if c in wanted and isinstance(items, list) for i in items if isinstance(i, dict)]
                for category, item in made or [(None, None)]:
                    cells = None if item is None else [(k, ",".join(map(str, v)) if isinstance(v, list) else None if v is None else str(v)) for k, v in item.items()]
                    for column, value in zip(out, (chunk, digest, category, cells, error)):
                        column.append(value)
            kinds = (pa.int64(), pa.string(), pa.string(), kind, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["chunk_idx", "hash", "category", "fact", "error"])

    fresh = rows.select(F.col("chunk_idx").cast("bigint"), "text", "hash").mapInArrow(run, "chunk_idx bigint, hash string, category string, fact map<string,string>, error string")
    return fresh if cache is None else fresh.unionByName(cache)


def fact_counts(found: DataFrame) -> DataFrame:
    """Facts per category; failed chunks under _error_chunks."""
    return found.where("category is not null or error is not null").groupBy(F.coalesce("category", F.lit("_error_chunks")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


def pair_counts(found: DataFrame, category: str, first: str, second: str, defaults: tuple[str, str] = ("unknown", "unknown")) -> DataFrame:
    """Facts of a category per pair of fields; missing fields take the defaults."""
    rows = found.where(F.col("category") == category)
    pair = [F.coalesce(F.try_element_at("fact", F.lit(f)), F.lit(d)).alias(n) for f, d, n in zip((first, second), defaults, ("a", "b"))]
    return rows.select(*pair).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def fact_table(found: DataFrame, category: str, fields: Iterable[str]) -> DataFrame:
    """K8: a category's facts as a flat table of the named fields."""
    return found.where(F.col("category") == category).select("chunk_idx", *[F.try_element_at("fact", F.lit(f)).alias(f) for f in fields])


# What makes a message a complaint about cost.
COST = r"(token|消耗|costs?|费用|tokens?消耗|几十|几百|几千万|烧钱|太贵|expensive|太费|耗费|爆表|超出|超标|burn)"
COST_WORDS = ("贵", "消耗", "费", "烧", "花", "付", "billed", "cost", "expensive", "万 token", "万token", "亿token", "亿 token", "burn", "爆")


def is_cost_complaint(text: Column) -> Column:
    """The pattern in any case and one of the words as written. Null is none."""
    from chatloom.functions.text import contains_any

    return F.coalesce(text.rlike("(?iu)" + COST) & contains_any(text, COST_WORDS), F.lit(False))


def sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """N rows in the order of a hash (SHA-256) of their key, the same on every run and in SQL."""
    return df.orderBy(F.sha2(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")), 256), key).limit(n)


def resolutions(found: DataFrame, category: str = "brand_confusion", field: str = "resolution") -> DataFrame:
    """Facts of a category by how they ended; unknown without a word on it."""
    rows = found.where(F.col("category") == category)
    return rows.groupBy(F.coalesce(F.try_element_at("fact", F.lit(field)), F.lit("unknown")).alias(field)).agg(F.count(F.lit(1)).alias("n"))


def about_product(found: DataFrame, product: str, category: str = "pricing_complaints", field: str = "service") -> DataFrame:
    """Facts of a category whose field names the product, whatever its case; facts without the field don't."""
    return found.where((F.col("category") == category) & F.coalesce(F.lower(F.try_element_at("fact", F.lit(field))).contains(product.lower()), F.lit(False)))


# An amount of tokens or money.
AMOUNT = r"(\d+(?:\.\d+)?)\s*(?:万|千万|亿|k|m|千|百万|万亿)?\s*(?:token|美元|元|块|刀|rmb|\$|￥|¥)"


def amounts(text: Column) -> Column:
    """The numbers of the amounts in a text, in order; an empty array without any."""
    return F.coalesce(F.regexp_extract_all(text, F.lit("(?i)" + AMOUNT), F.lit(1)), F.array().cast("array<string>"))
