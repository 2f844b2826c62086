"""Readers of chat exports: Discord, Telegram, canonical JSON, Lark, Slack, CSV, raw NDJSON.

Each gives canonical messages: `ord` (file order, then position), platform, channel, message_id,
author_id (salted hash), author_name, ts (UTC, NULL if unreadable), content, reply_to_message_id,
reactions (emoji, count), attachment_count. JSON is read as VARIANT, so fields of any type and shape
are met by expressions alone; unknown fields are dropped, missing ones take their defaults. Files of
more than LARGE bytes are split into messages by a streaming parser before that, so none is too large
for a VARIANT. A file that is one JSON value is read by one task; NDJSON and CSV are read in parallel.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.ids import hash_author
from chatloom.functions.instants import to_utc_us
from chatloom.functions.jsonstream import LARGE, Reading, head_of
from chatloom.functions.text import strip
from chatloom.operators.nested import reach, whole_json
from chatloom.session import spread

# Subtypes of Slack messages that are no messages of members.
SLACK_EVENTS = ("channel_join", "channel_leave", "channel_name", "channel_purpose", "channel_topic")
# Names of CSV columns, in order of precedence.
CSV_COLUMNS = {
    "content": ("content", "text", "message"), "author": ("author", "user", "username", "sender"), "author_id": ("author_id", "user_id", "sender_id"),
    "timestamp": ("timestamp", "ts", "time", "date"), "channel": ("channel", "channel_name"), "message_id": ("message_id", "id"), "reply_to": ("reply_to", "reply_to_message_id"),
}

POSITION_BITS = 33  #: positions within a file are below 2 ** POSITION_BITS


def _listed(spark: SparkSession, path: str, suffix: str = "") -> list[tuple[str, int]]:
    """(path, bytes) of the file, or of the files of a directory with the suffix, by name."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    status = fs.getFileStatus(where)
    if not status.isDirectory():
        return [(status.getPath().toString(), status.getLen())]
    found = [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(where) if s.isFile()]
    # Names that begin with _ or . are marks and checksums, as for Spark's own readers.
    return sorted((str(f), n) for f, n in found if str(f).endswith(suffix) and str(f).rsplit("/", 1)[-1][0] not in "_.")


def _files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    return [f for f, _ in _listed(spark, path, suffix)]


def _documents(spark: SparkSession, path: str | DataFrame, suffix: str = ".json", large: int = LARGE) -> DataFrame:
    """(`file_no`, `stem`, `value`, `large`) of whole files, or of exports that are rows of a table (`file_no`, `stem`, `value`)."""
    if isinstance(path, DataFrame):
        return path.select(F.col("file_no").cast("bigint"), "stem", "value", (F.octet_length("value") > large).alias("large"))
    files = _listed(spark, path, suffix)
    out = None
    for big in (False, True):
        some = [(k, f) for k, (f, n) in enumerate(files) if (n > large) == big]
        if not some and (big or out is not None or len(files)):
            continue
        if not some:
            return spark.createDataFrame([], "file_no bigint, stem string, value string, large boolean")
        name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
        order = spark.createDataFrame([(k, f.rsplit("/", 1)[-1]) for k, f in some], "file_no bigint, _n string")
        text = spark.read.text([f for _, f in some], wholetext=True).select(F.url_decode(name).alias("_f"), F.regexp_replace("value", "^\\x{FEFF}", "").alias("value"))
        joined = text.join(F.broadcast(order), F.col("_f") == F.col("_n"))  # a row a file
        part = joined.select("file_no", F.regexp_replace("_f", r"\.[^.]*$", "").alias("stem"), "value", F.lit(big).alias("large"))
        out = part if out is None else out.unionByName(part)
    return out


#: What `split_messages` gives: the file, the rest of its JSON, position and JSON text of one element.
_SPLIT = "file_no bigint, stem string, head string, pos bigint, m string"


def split_messages(documents: DataFrame, containers: tuple[tuple[str, ...], ...], by_line: bool = False) -> DataFrame:
    """Elements of the first of the containers (paths of arrays) that a text of (`file_no`, `stem`,
    `value`) has, one at a time; texts that aren't one JSON value give none.

    With `by_line` a text that isn't one value is read line by line, broken lines left out, and a
    message that is no element of a container is one itself; positions count on from line to line.
    """
    wanted = set(containers)

    def found(text: str):
        """(head, element texts) of one JSON value; ValueError if it is none."""
        import json

        head = head_of(text, wanted)
        reach = lambda path: next((v for v in [_inside(head, path)] if isinstance(v, list)), None)
        box = next((p for p in containers if reach(p) is not None), None)
        if box is None:
            single = by_line and isinstance(head, dict) and (head.get("message_id") is not None or head.get("msg_type") is not None)
            return "null", iter([text] if single else [])
        return json.dumps(head, ensure_ascii=False), (text[a:b] for path, _, _, a, b in Reading(text, wanted).elements() if path == box)

    def values(text: str):
        try:
            yield found(text)
        except ValueError:
            if not by_line:
                return
            at = 0
            while at < len(text):
                end = text.find("\n", at)
                end = len(text) if end < 0 else end
                if line := text[at:end].strip():
                    try:
                        yield found(line)
                    except ValueError:
                        pass
                at = end + 1

    def run(batches):
        import pyarrow as pa

        def handed(number, stem, rows):
            columns = [pa.array([number.as_py()] * len(rows), pa.int64()), pa.array([stem.as_py()] * len(rows), pa.string())]
            columns += [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.string(), pa.int64(), pa.string()))]
            return pa.RecordBatch.from_arrays(columns, names=["file_no", "stem", "head", "pos", "m"])

        for batch in batches:
            for number, stem, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                rows, size, position = [], 0, 0
                for head, elements in values(text.as_py() or ""):
                    for element in elements:
                        rows.append((head, position, element))
                        position, size = position + 1, size + len(head) + len(element)
                        if size > 4 << 20 or len(rows) == 5_000:
                            yield handed(number, stem, rows)
                            rows, size = [], 0
                if rows:
                    yield handed(number, stem, rows)

    return documents.select("file_no", "stem", "value").mapInArrow(run, _SPLIT)


def _inside(value, path: tuple[str, ...]):
    for name in path:
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def _text(v: Column, *paths: str) -> Column:
    """The first of the paths that holds text that isn't empty; NULL if none does."""
    return F.coalesce(*[F.nullif(_get(v, p), F.lit("")) for p in paths])


def _size(v: Column, path: str) -> Column:
    return F.coalesce(F.size(_get(v, path, "array<variant>")), F.lit(-1))


def _count(v: Column, path: str) -> Column:
    return F.greatest(_size(v, path), F.lit(0))


def reactions_of(v: Column, path: str = "$.reactions") -> Column:
    """Reactions of any of the known shapes as an array of (emoji, count)."""
    entries = F.coalesce(_get(v, path, "array<variant>"), F.array().cast("array<variant>"))
    emoji = lambda r: _text(r, "$.emoji.name", "$.emoji", "$.name", "$.reaction_type.emoji_type")
    listed = lambda r: F.coalesce(_get(r, "$.count", "bigint"), F.nullif(_size(r, "$.users"), F.lit(-1)).cast("bigint"), F.nullif(_size(r, "$.operators"), F.lit(-1)).cast("bigint"), F.lit(0).cast("bigint"))
    return F.transform(entries, lambda r: F.struct(emoji(r).alias("emoji"), listed(r).alias("count")))


def _ord(position: Column) -> Column:
    return (F.shiftleft(F.col("file_no"), POSITION_BITS) + position.cast("bigint")).alias("ord")


def _at(value: Column, zone: str = "UTC") -> Column:
    return F.timestamp_micros(to_utc_us(value, F.lit(zone)))


def _canonical(rows: DataFrame, platform: Column, channel: Column, message_id: Column, author: Column, name: Column, at: Column, content: Column, reply: Column, reactions: Column, attachments: Column) -> DataFrame:
    return rows.select(
        _ord(F.col("pos")), platform.alias("platform"), channel.alias("channel"), F.coalesce(message_id, F.lit("")).alias("message_id"), author.alias("author_id"),
        F.coalesce(name, F.lit("unknown")).alias("author_name"), at.alias("ts"), F.coalesce(content, F.lit("")).alias("content"), reply.alias("reply_to_message_id"),
        reactions.alias("reactions"), attachments.cast("int").alias("attachment_count"),
    )


def _exploded(documents: DataFrame, containers: tuple[tuple[str, ...], ...] = (("messages",),)) -> DataFrame:
    """(`file_no`, `stem`, `v` the file, `pos`, `m` the message) of the first container that a file has."""
    small = documents.where("not large").withColumn("v", whole_json(F.col("value"))).where("v is not null")
    items = F.coalesce(*[reach(F.col("v"), p, "array<variant>") for p in containers])
    # One task splits a large file; what follows is heavier and is dealt out where there are few such files.
    split = spread(split_messages(documents.where("large"), containers), None)
    # An element is refused aloud if it is too large for a VARIANT by itself.
    elements = split.select("file_no", "stem", F.parse_json("head").alias("v"), "pos", F.parse_json("m").alias("m"))
    return small.select("file_no", "stem", "v", F.posexplode(items).alias("pos", "m")).withColumn("pos", F.col("pos").cast("bigint")).select("file_no", "stem", "v", "pos", "m").unionByName(elements)


def read_discord(spark: SparkSession, path: str | DataFrame, salt: str) -> DataFrame:
    """One object a file with channel.name and messages."""
    rows = _exploded(_documents(spark, path))
    m = F.col("m")
    author = hash_author(F.coalesce(_get(m, "$.author.id"), F.lit("")), salt)
    return _canonical(
        rows, F.lit("discord"), F.coalesce(_get(F.col("v"), "$.channel.name"), F.lit("unknown")), _get(m, "$.id"), author, _text(m, "$.author.nickname", "$.author.name"),
        _at(_get(m, "$.timestamp")), _get(m, "$.content"), _get(m, "$.reference.messageId"), reactions_of(m), _count(m, "$.attachments"),
    )


def read_telegram(spark: SparkSession, path: str | DataFrame, salt: str) -> DataFrame:
    """Messages of type "message"; text is a string or a list of strings and objects with text."""
    rows = _exploded(_documents(spark, path))
    m = F.col("m")
    rows = rows.where(_get(m, "$.type") == "message")
    pieces = F.transform(_get(m, "$.text", "array<variant>"), lambda x: F.coalesce(_get(x, "$.text"), _get(x, "$"), F.lit("")))
    content = F.coalesce(F.array_join(pieces, ""), _get(m, "$.text"))
    attached = _get(m, "$.file", "variant").isNotNull() | _get(m, "$.photo", "variant").isNotNull()
    return _canonical(
        rows, F.lit("telegram"), F.coalesce(_get(F.col("v"), "$.name"), F.lit("telegram")), _get(m, "$.id"), hash_author(F.coalesce(_get(m, "$.from_id"), F.lit("")), salt),
        _text(m, "$.from"), _at(_get(m, "$.date")), content, F.nullif(_text(m, "$.reply_to_message_id"), F.lit("0")), reactions_of(m), F.when(attached, 1).otherwise(0),
    )


def _hashed_or_kept(raw: Column, salt: str) -> Column:
    raw = F.coalesce(raw, F.lit(""))
    return F.when(raw.rlike("^(sha256:|hash:)"), raw).otherwise(hash_author(raw, salt))


def read_canonical(spark: SparkSession, path: str | DataFrame, salt: str) -> DataFrame:
    """S3: messages in canonical shape; ids that say they are hashed are kept."""
    rows = _exploded(_documents(spark, path))
    m = F.col("m")
    return _canonical(
        rows, F.coalesce(_get(m, "$.platform"), F.lit("canonical")), F.coalesce(_get(m, "$.channel"), F.lit("")), _get(m, "$.message_id"), _hashed_or_kept(_get(m, "$.author_id"), salt),
        _get(m, "$.author_name"), _at(_get(m, "$.timestamp")), _get(m, "$.content"), _get(m, "$.reply_to_message_id"), reactions_of(m), F.coalesce(_get(m, "$.attachment_count", "int"), F.lit(0)),
    )


# --- Lark ---------------------------------------------------------------------------------------


def lark_content(kind: Column, raw: Column) -> Column:
    """(text, attachments) of a message's content (VARIANT: plain text, JSON text, or an object with content).

    Text that isn't JSON is taken as it is; JSON is rendered by the message type.
    """
    inner = F.coalesce(_get(raw, "$.content"), _get(raw, "$"))
    kind = F.coalesce(F.nullif(kind, F.lit("")), F.lit("text"))
    low = F.lower(kind)
    c = whole_json(inner)
    is_object = F.schema_of_variant(c).startswith("OBJECT")
    or_mark = lambda *paths: F.coalesce(_text(c, *paths), F.lit("?"))
    line = lambda segments: F.array_join(F.transform(segments.cast("array<variant>"), lambda s: F.coalesce(_get(s, "$.text"), F.lit(""))), "")
    paragraphs = F.filter(F.coalesce(_get(c, "$.content", "array<variant>"), F.array().cast("array<variant>")), lambda p: F.schema_of_variant(p).startswith("ARRAY"))
    body = F.array_join(F.transform(paragraphs, line), "\n")
    title = _text(c, "$.title")
    post = F.when(title.isNotNull(), F.concat(F.lit("[title: "), title, F.lit("]\n"), body)).otherwise(body)
    fields = F.coalesce(F.try_variant_get(c, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    template = F.coalesce(_text(c, "$.template"), F.lit("event"))
    lists = F.filter(F.map_entries(fields), lambda e: F.schema_of_variant(e["value"]).startswith("ARRAY") & (e["key"] != "divider_text"))
    filled = F.aggregate(lists, template, lambda t, e: F.replace(t, F.concat(F.lit("{"), e["key"], F.lit("}")), F.array_join(F.transform(e["value"].cast("array<variant>"), lambda x: _get(x, "$")), ", ")))
    named = _get(c, "$.from_user", "variant").isNotNull() | _get(c, "$.to_chatters", "variant").isNotNull()
    bracket = lambda label, value: F.concat(F.lit(f"[{label}: "), value, F.lit("]"))
    rendered = (
        F.when(low == "text", F.coalesce(_get(c, "$.text"), F.lit("")))
        .when(low == "post", post)
        .when(low == "image", bracket("Image", or_mark("$.image_key")))
        .when(low == "file", bracket("File", or_mark("$.file_name", "$.file_key")))
        .when(low == "audio", bracket("Audio", or_mark("$.file_key")))
        .when(low == "video", bracket("Video", or_mark("$.file_key")))
        .when(low == "sticker", bracket("Sticker", or_mark("$.file_key")))
        .when(low == "interactive", F.lit("[Card]"))
        .when(low == "share_chat", bracket("Shared chat", or_mark("$.chat_id")))
        .when(low == "share_user", bracket("Shared user", or_mark("$.user_id")))
        .when(low == "system", bracket("System", F.when(named, filled).otherwise(template)))
        .otherwise(F.concat(F.lit("["), kind, F.lit("]")))
    )
    plain = ~F.coalesce(inner, F.lit("")).rlike(r"^\s*[{\[]")
    text = (
        F.when(F.coalesce(inner, F.lit("")) == "", "").when(plain, inner).when(c.isNull(), F.concat(F.lit("["), kind, F.lit(": <unparseable>]")))
        .when(~is_object, F.concat(F.lit("["), kind, F.lit("]"))).otherwise(rendered)
    )
    attached = F.when(low.isin("image", "file", "audio", "video") & (F.coalesce(inner, F.lit("")) != "") & (plain | is_object), 1).otherwise(0)
    return F.struct(text.alias("text"), attached.alias("attachments"))


LARK_CONTAINERS = ((), ("messages",), ("data", "messages"), ("data", "items"))


def read_lark(spark: SparkSession, path: str | DataFrame, salt: str, channel: str | None = None, utc_offset_hours: float = 0.0) -> DataFrame:
    """NDJSON, an array, envelopes with data.items or data.messages, concatenated envelopes one a
    line, or canonical messages; told apart by their content, split by a streaming parser.

    The channel of rows without a chat is `channel`, else the first chat name or id of the file, else
    lark-chat. Display times without zone lie `utc_offset_hours` east of UTC.
    """
    split = split_messages(_documents(spark, path, ""), LARK_CONTAINERS, by_line=True)
    rows = split.select("file_no", "pos", F.parse_json("m").alias("m")).where(F.schema_of_variant("m").startswith("OBJECT"))
    m = F.col("m")
    chat = _text(m, "$.chat_name", "$.chat_id")
    if channel is None:
        first = rows.where(chat.isNotNull()).groupBy(F.col("file_no").alias("_f")).agg(F.min_by(chat, "pos").alias("_chat"))
        rows = rows.join(F.broadcast(first), F.col("file_no") == F.col("_f"), "left")  # a row a file
        usual = F.coalesce("_chat", F.lit("lark-chat"))
    else:
        usual = F.lit(channel)
    canonical = _get(m, "$.author_id").isNotNull() | (F.coalesce(_get(m, "$.platform"), F.lit("")) == "canonical")
    kind = F.coalesce(_text(m, "$.msg_type"), F.lit("text"))
    decoded = lark_content(kind, F.coalesce(_get(m, "$.content", "variant"), _get(m, "$.body", "variant")))
    sender = _text(m, "$.sender.sender_id.open_id", "$.sender.sender_id.user_id", "$.sender.open_id", "$.sender.id", "$.sender.user_id")
    when = _text(m, "$.create_time", "$.created_time", "$.update_time")
    display = when.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}(:\d{2})?$")
    shifted = _at(F.coalesce(_text(m, "$.timestamp"), when))
    at = F.when(display & ~canonical, shifted - F.make_interval(secs=F.lit(utc_offset_hours * 3600))).otherwise(shifted) if utc_offset_hours else shifted
    reply = F.coalesce(_text(m, "$._parent_message_id", "$.parent_id", "$.reply_to_message_id", "$.reply_to.message_id", "$.reply_to.id", "$.reply_to"), F.when(kind == "reply", _text(m, "$.upper_message_id")))
    return _canonical(
        rows, F.when(canonical, F.coalesce(_text(m, "$.platform"), F.lit("lark"))).otherwise(F.lit("lark")),
        F.when(canonical, F.coalesce(_text(m, "$.channel"), usual)).otherwise(F.coalesce(chat, usual)), _text(m, "$.message_id", "$.id"),
        F.when(canonical, _hashed_or_kept(_get(m, "$.author_id"), salt)).otherwise(hash_author(F.coalesce(sender, F.lit("")), salt)),
        F.when(canonical, _text(m, "$.author_name")).otherwise(F.coalesce(_text(m, "$.sender.name", "$.sender.nickname"), sender)), at,
        F.when(canonical, _get(m, "$.content")).otherwise(decoded["text"]), reply, reactions_of(m),
        F.when(canonical, F.coalesce(_get(m, "$.attachment_count", "int"), F.lit(0))).otherwise(decoded["attachments"]),
    )


# --- Slack, CSV, raw ----------------------------------------------------------------------------


def unzipped(spark: SparkSession, path: str) -> DataFrame:
    """(`file_no`, `stem`, `value`, `large`) of the JSON members of a zip, by name."""

    def members(batches):
        import io
        import zipfile

        import pyarrow as pa

        for batch in batches:
            for blob in batch.column(0):
                with zipfile.ZipFile(io.BytesIO(blob.as_py())) as bundle:
                    for k, name in enumerate(sorted(n for n in bundle.namelist() if n.endswith(".json"))):
                        stem = name.rsplit("/", 1)[-1][:-5]
                        text = bundle.read(name).decode("utf-8", "replace")
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([stem]), pa.array([text]), pa.array([len(text) > LARGE])], names=["file_no", "stem", "value", "large"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(members, "file_no bigint, stem string, value string, large boolean")


def read_slack(spark: SparkSession, path: str | DataFrame, salt: str) -> DataFrame:
    """A channel's file, a directory of them, or a zip; arrays or objects with messages.

    Joins and other events, and users whose id begins with B, are left out. A reply is a message whose
    thread isn't its own. The channel is the file's name without its ending.
    """
    documents = unzipped(spark, path) if isinstance(path, str) and path.endswith(".zip") else _documents(spark, path)
    rows = _exploded(documents, ((), ("messages",)))
    m = F.col("m")
    user, ts, thread = _text(m, "$.user"), _get(m, "$.ts"), _text(m, "$.thread_ts")
    rows = rows.where((_get(m, "$.type") == "message") & ~F.coalesce(_get(m, "$.subtype"), F.lit("")).isin(*SLACK_EVENTS) & ~F.coalesce(user, F.lit("")).startswith("B"))
    return _canonical(
        rows, F.lit("slack"), F.col("stem"), ts, F.when(user.isNull(), "unknown").otherwise(hash_author(user, salt)), user, _at(ts), _get(m, "$.text"),
        F.when(thread != F.coalesce(ts, F.lit("")), thread), reactions_of(m), _count(m, "$.files"),
    )


def read_csv(spark: SparkSession, path: str, salt: str) -> DataFrame:
    """Tables with a header; column names in any case, blanks around them ignored. Rows without
    content are left out. A cell of blanks counts as given and empty."""
    files = _files(spark, path, "")
    out = None
    for k, file in enumerate(files):
        raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE").csv(file)
        names: dict[str, str] = {}
        for column in raw.columns:
            names[column.lower().strip().lstrip("﻿")] = column

        def cell(field: str, names=names) -> Column:
            given = [F.nullif(F.col("`" + names[a].replace("`", "``") + "`"), F.lit("")) for a in CSV_COLUMNS[field] if a in names]
            return F.nullif(strip(F.coalesce(*given)), F.lit("")) if given else F.lit(None).cast("string")

        rows = raw.withColumn("file_no", F.lit(k).cast("bigint")).withColumn("pos", F.monotonically_increasing_id())
        rows = rows.where(cell("content").isNotNull())
        author = F.coalesce(cell("author_id"), cell("author"))
        part = _canonical(
            rows, F.lit("csv"), F.coalesce(cell("channel"), F.lit("csv-import")), cell("message_id"), F.when(author.isNull(), "unknown").otherwise(hash_author(author, salt)),
            cell("author"), _at(cell("timestamp")), cell("content"), cell("reply_to"), F.array().cast("array<struct<emoji:string,count:bigint>>"), F.lit(0),
        )
        out = part if out is None else out.unionByName(part)
    return out


def read_raw(spark: SparkSession, path: str, salt: str, least: int = 0, cut: int | None = None, keep_system: bool = False) -> DataFrame:
    """NDJSON of raw messages, line by line and so in parallel. Bad lines, system messages
    and contents shorter than `least` characters without blanks around are left out; `cut` shortens contents.

    For join events keep the system messages.
    """
    lines = spark.read.text(path).withColumn("pos", F.monotonically_increasing_id()).withColumn("file_no", F.lit(0).cast("bigint"))
    rows = lines.withColumn("m", whole_json(F.col("value"))).where(F.schema_of_variant("m").startswith("OBJECT"))
    m = F.col("m")
    if not keep_system:
        rows = rows.where(F.coalesce(_get(m, "$.msg_type"), F.lit("")) != "system")
    content = F.coalesce(_get(m, "$.content.text"), _get(m, "$.content"), F.lit(""))
    rows = rows.where(F.length(strip(content)) >= least)
    sender = _text(m, "$.sender.sender_id.open_id", "$.sender.sender_id.user_id", "$.sender.id")
    base = _canonical(
        rows, F.lit("raw"), F.coalesce(_text(m, "$.chat_name", "$.chat_id"), F.lit("raw")), _text(m, "$.message_id", "$.id"), hash_author(F.coalesce(sender, F.lit("")), salt),
        _text(m, "$.sender.name"), _at(_text(m, "$.create_time", "$.timestamp")), F.substring(content, 1, cut) if cut else content, _text(m, "$.parent_id", "$.reply_to"), reactions_of(m), F.lit(0),
    )
    return base


def read_chat(spark: SparkSession, path: str, salt: str, least: int = 3, cut: int = 300) -> DataFrame:
    """The messages that a dashboard drills down to, from a Discord or canonical document, an array, an
    envelope or NDJSON, told apart by their content: `ord`, `author_name`, `ts`, `content` of at least
    `least` characters, cut to `cut`. System messages are left out."""
    split = split_messages(_documents(spark, path, ""), LARK_CONTAINERS, by_line=True)
    rows = split.select("file_no", "pos", F.parse_json("m").alias("m")).where(F.schema_of_variant("m").startswith("OBJECT"))
    m = F.col("m")
    rows = rows.where(F.coalesce(_get(m, "$.msg_type"), F.lit("")) != "system")
    content = strip(F.coalesce(_get(m, "$.content.text"), _text(m, "$.content", "$.text"), F.lit("")))
    name = F.coalesce(_text(m, "$.author.nickname", "$.author.name", "$.author_name", "$.sender.name", "$.from", "$.user"), F.lit("unknown"))
    return rows.where(F.length(content) >= least).select(_ord(F.col("pos")), name.alias("author_name"), _at(_text(m, "$.timestamp", "$.create_time", "$.date", "$.ts")).alias("ts"), F.substring(content, 1, cut).alias("content"))


READERS: dict[str, Callable[..., DataFrame]] = {
    "discord": read_discord, "telegram": read_telegram, "canonical": read_canonical, "lark": read_lark, "slack": read_slack, "csv": read_csv, "raw": read_raw,
}
