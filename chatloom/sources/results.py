"""Results of earlier steps as inputs: users (S9), statistics of runs (S10), streams' outputs."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.instants import to_utc_us
from chatloom.functions.jsonstream import LARGE, Reading, parsed
from chatloom.operators.incremental import runs_of
from chatloom.operators.nested import whole_json
from chatloom.session import spread

# Names of the counters of a user's entry, by mention category.
COUNTERS = {"providers": "providers", "competitors": "competitors", "messaging": "messaging", "features": "features", "install": "install", "friction": "friction", "acquisition": "acquisition"}


def _in_lines(spark: SparkSession, path: str) -> bool:
    """Whether a file is sure not to be one JSON value: two lines in a row are each one, which no JSON text allows.

    Told by the file's beginning; a file that this leaves open has yet to be read as a whole.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
    for size in (1 << 16, LARGE):
        stream = where.getFileSystem(conf).open(where)
        try:
            head = bytes((stream if codec is None else codec.createInputStream(stream)).readNBytes(size))
        finally:
            stream.close()
        lines = head.split(b"\n") if len(head) < size else head.split(b"\n")[:-1]
        before = False
        for line in filter(None, (x.strip() for x in lines)):
            try:
                parsed(line.decode("utf-8", "replace"))
            except (ValueError, RecursionError):
                before = False
            else:
                if before:
                    return True
                before = True
        if len(head) < size:
            break
    return False


def _pieces(text: str, large: int = LARGE) -> Iterator[tuple[str, bool]]:
    """(JSON text, it is sound) of each entry of a text that is one JSON value, else of each line."""
    single = False
    try:
        for key, value, _, _ in Reading(text).members():  # a pass of its own: a text that breaks off is no value
            single = single or key in ("author_id", "user_id") and value is not None
    except ValueError:
        at = 0
        while at < len(text):
            end = text.find("\n", at)
            line, inner = text[at : end if end >= 0 else len(text)], at > 0 or end >= 0
            at = end + 1 if end >= 0 else len(text)
            if inner and len(line) > large // 4:
                yield from _pieces(line, large)
            elif line.strip():
                yield line, False
        return
    if single:
        yield text, True
        return
    for key, value, begin, end in Reading(text).members():
        if isinstance(value, dict):
            yield f"[{text[begin:end]}]" if key is None else f"{{{json.dumps(key)}:{text[begin:end]}}}", True


def _split(batches):
    import pyarrow as pa

    def handed(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_())], names=["value", "sound"])

    for batch in batches:
        for text in batch.column(0):
            rows, size = [], 0
            for piece, sound in _pieces((text.as_py() or "").removeprefix("\ufeff")):
                rows.append((piece, sound))
                size += len(piece)
                if size > 4 << 20 or len(rows) == 5_000:
                    yield handed(rows)
                    rows, size = [], 0
            if rows:
                yield handed(rows)


def _values(spark: SparkSession, path: str, large: int) -> DataFrame:
    """(`v`) of each JSON value of the files: the whole of one, else its lines.

    Files of more than `large` bytes, which a VARIANT may not hold, are read in lines and in parallel if their
    beginning shows them to be lines, and are cut into their entries by a streaming parser if not.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").collect()  # a row a file, without what is in it
    codecs = spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    packed = lambda f: codecs.getCodec(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)) is not None
    big = sorted(f for f, n in files if n > large or packed(f))
    lined = [f for f in big if _in_lines(spark, f)]
    as_named = lambda names: [re.sub(r"([][*?{}\\])", r"\\\1", f) for f in names]
    parts = []
    if len(big) < len(files) or not files:
        small = as_named(sorted({f for f, _ in files} - set(big))) or path
        texts = spark.read.text(small, wholetext=True).select(F.explode(F.when(whole_json(F.col("value")).isNotNull(), F.array("value")).otherwise(F.split("value", r"\r?\n"))).alias("value"))
        parts.append(texts.select(whole_json(F.col("value")).alias("v")))
    if lined:
        parts.append(spark.read.text(as_named(lined), lineSep="\n").select(whole_json(F.col("value")).alias("v")))
    if rest := sorted(set(big) - set(lined)):
        # One task cuts a file; what follows is dealt out where there are few such files.
        pieces = spread(spark.read.text(as_named(rest), wholetext=True).mapInArrow(_split, "value string, sound boolean"), None)
        parts.append(pieces.select(F.when(F.col("sound"), F.parse_json("value")).otherwise(whole_json(F.col("value"))).alias("v")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where("v is not null")


def read_users(spark: SparkSession, path: str, large: int = LARGE) -> DataFrame:
    """Users of a JSON file (an object keyed by user, or a list), or of JSON lines, with what pivots need:
    `author_id`, `language_primary`, `mentions` (category:label to count), `impersonator_messages`, `last_seen`, `hour`.

    Entries that aren't objects are left out; missing counters count as empty. Lines are read in parallel, however
    many; a file of more than `large` bytes that is one JSON value is cut into its entries by one task. An entry too large
    for a VARIANT is refused with an error.
    """
    v = _values(spark, path, large)
    one = F.try_variant_get("v", "$.author_id", "string").isNotNull() | F.try_variant_get("v", "$.user_id", "string").isNotNull()
    keyed = F.map_entries(F.try_variant_get("v", "$", "map<string,variant>"))
    listed = F.transform(F.try_variant_get("v", "$", "array<variant>"), lambda x: F.struct(F.coalesce(F.try_variant_get(x, "$.user_id", "string"), F.try_variant_get(x, "$.author_id", "string"), F.lit("")).alias("key"), x.alias("value")))
    single = F.array(F.struct(F.coalesce(F.try_variant_get("v", "$.author_id", "string"), F.try_variant_get("v", "$.user_id", "string")).alias("key"), F.col("v").alias("value")))
    rows = v.select(F.explode(F.when(one, single).otherwise(F.coalesce(listed, keyed))).alias("e")).select("e.key", F.col("e.value").alias("u")).where(F.schema_of_variant("u").startswith("OBJECT"))
    named = [F.transform_keys(F.coalesce(F.try_variant_get("u", f"$.{field}", "map<string,bigint>"), F.create_map().cast("map<string,bigint>")), _prefixed(category)) for category, field in COUNTERS.items()]
    given = F.coalesce(F.try_variant_get("u", "$.mentions", "map<string,bigint>"), F.create_map().cast("map<string,bigint>"))
    hours = F.map_entries(F.coalesce(F.try_variant_get("u", "$.hours_of_day", "map<string,bigint>"), F.try_variant_get("u", "$.hours", "map<string,bigint>")))
    best = F.array_max(F.transform(hours, lambda e: F.struct(e["value"].alias("n"), (-e["key"].cast("int")).alias("h"))))
    sites = F.aggregate(F.map_values(F.coalesce(F.try_variant_get("u", "$.impersonator_domains", "map<string,bigint>"), F.create_map().cast("map<string,bigint>"))), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return rows.select(
        F.col("key").alias("author_id"), F.coalesce(F.try_variant_get("u", "$.language_primary", "string"), F.lit("silent")).alias("language_primary"),
        F.map_concat(F.map_filter(given, lambda k, n: k.contains(":")), *named).alias("mentions"),
        F.coalesce(F.try_variant_get("u", "$.impersonator_messages", "bigint"), sites).alias("impersonator_messages"),
        F.timestamp_micros(to_utc_us(F.try_variant_get("u", "$.last_seen", "string"), F.lit("UTC"))).alias("last_seen"), (-best["h"]).alias("hour"),
    )


def _prefixed(category: str):
    return lambda k, n: F.concat(F.lit(f"{category}:"), k)


def read_documents(paths: Sequence[str | Path]) -> list[dict[str, Any]]:
    """Statistics documents, in the order given."""
    return [json.loads(Path(p).read_text(encoding="utf-8")) for p in paths]


def read_runs(spark: SparkSession, paths: Sequence[str | Path]) -> DataFrame:
    """Statistics files of several runs, oldest first, as long rows with `run_idx`."""
    return runs_of(spark, read_documents(paths))


def read_topics(spark: SparkSession, folder: str) -> DataFrame:
    """The topics that `write_topics` wrote."""
    return spark.read.schema("message_id string, topic string").json(f"{folder}/topics")


def read_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts as a fact cache holds them; an empty table where nothing was written."""
    from chatloom.operators.caches import FactCache

    return FactCache(spark, folder).read()


def read_streams(folder: str | Path) -> dict[str, Any]:
    """Documents of a folder by name (findings.json, user_pareto.json and so on); what isn't there is left out."""
    return {p.stem: json.loads(p.read_text(encoding="utf-8")) for p in sorted(Path(folder).glob("*.json")) if p.is_file()}
