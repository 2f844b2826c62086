"""Rebuilding conversations from message rows (p1).

Replies are parent pointers. Each message's pointer is resolved to its root by pointer jumping: in
every round a pointer that hasn't reached a root is replaced by the pointer of what it points at, so
a chain of depth d takes log2(d) rounds, and only unfinished pointers are joined again. A pointer
that ends at a reply to a missing target is an orphan's. As depths in a forest have no gaps, a round
in which no pointer finishes leaves only pointers into cycles; these are dropped.

All joins after the first are on 64-bit row numbers. Tables between rounds are written to the shared
folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.functions.ids import clean_id, is_blank
from chatloom.functions.instants import to_utc_us
from chatloom.operators.ranges import numbered
from chatloom.plans.lineage import Cuts

#: A conversation of more messages than this is ordered by several tasks, however many rows there are in all.
HOT_ROWS = 200_000


def message_nodes(messages: DataFrame, exports: DataFrame) -> DataFrame:
    """(`node`, `e`, `id`, `reply`, `author`, `at`, `bad`) of every row.

    `author` is a 64-bit hash (authors are compared within one conversation only); `bad` marks blank
    content, a missing author and an unusable time.
    """
    zones = exports.select(F.col("export_key").alias("_zone_key"), F.col("tz_name").alias("_zone"))
    author = F.nullif(F.col("author_id"), F.lit(""))
    rows = messages.select(
        F.col("msg_row").alias("node"), F.coalesce("export_key", F.lit("")).alias("e"), clean_id("message_id").alias("id"),
        clean_id("reply_to_message_id").alias("reply"), F.xxhash64(author).alias("author"),
        (is_blank("content") | author.isNull()).alias("_lacks"), "ts",
    )
    stamped = rows.join(zones, rows["e"] == zones["_zone_key"], "left").withColumn("at", to_utc_us("ts", "_zone"))
    return stamped.select("node", "e", "id", "reply", "author", "at", (F.col("_lacks") | F.col("at").isNull()).alias("bad"))


def parent_edges(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(survivors, edges): `node` of the rows that count, and (`node`, `ptr`, `steps`, `end`) of each reply.

    `end` is 1 when `ptr` is a root, 2 when the target is missing (`ptr` null), 0 otherwise.
    """
    # 2 * row + (has a reply): the minimum is that of the lowest row, in one 64-bit buffer.
    code = F.col("node") * 2 + F.col("reply").isNotNull().cast("bigint")
    first = nodes.where(F.col("id").isNotNull()).groupBy("e", "id").agg(F.min(code).alias("code"))
    survivors = first.select(F.shiftright("code", 1).alias("node")).unionByName(nodes.where(F.col("id").isNull()).select("node"))
    refs = nodes.where(F.col("reply").isNotNull()).select("node", "e", "reply")
    target = first.select(F.col("e").alias("te"), F.col("id").alias("tid"), "code")
    joined = refs.join(target, (F.col("e") == F.col("te")) & (F.col("reply") == F.col("tid")), "left")
    end = F.when(F.col("code").isNull(), 2).when(F.col("code") % 2 == 0, 1).otherwise(0)
    edges = joined.select("node", F.shiftright("code", 1).alias("ptr"), F.lit(1).alias("steps"), end.alias("end"))
    return survivors, edges


def resolve_roots(edges: DataFrame, cuts: Cuts) -> tuple[DataFrame, list[str]]:
    """(`node`, `root`, `depth`) of each reply whose chain ends at a root, orphans and cycles left out;
    and the tables that it is read from."""
    finished = edges.where(F.col("end") != 0)
    active, lookup = edges.where(F.col("end") == 0), edges
    paths: list[str] = []
    while True:
        hop = lookup.select(F.col("node").alias("n2"), F.col("ptr").alias("p2"), F.col("steps").alias("s2"), F.col("end").alias("e2"))
        jumped = active.join(hop, F.col("ptr") == F.col("n2")).select("node", F.col("p2").alias("ptr"), (F.col("steps") + F.col("s2")).alias("steps"), F.col("e2").alias("end"))
        seen = Observation()  # counted while the table is written; only whether there are any matters
        table, path = cuts.cut(jumped.observe(seen, F.count_if(F.col("end") == 0).alias("active"), F.count_if(F.col("end") != 0).alias("done")))
        paths.append(path)
        finished = finished.unionByName(table.where(F.col("end") != 0))
        if not seen.get["active"] or not seen.get["done"]:
            break
        active, lookup = table.where(F.col("end") == 0), finished.unionByName(table.where(F.col("end") == 0))
    return finished.where(F.col("end") == 1).select("node", F.col("ptr").alias("root"), F.col("steps").alias("depth")), paths


def conversations(messages: DataFrame, exports: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The messages of sound conversations: `conv_row`, `turn`, `msg_row`, `speaker`, `parent_row`, `depth`.

    A row counts if it has no message id or is the lowest of its id within the export. Sound are
    trees of replies whose root has no reply target, with two authors or more and without a message
    that has blank content, no author or no usable time. Conversations with an orphan (a reply to a
    message that isn't there) hang on no root and those with a cycle have none: both are left out
    whole. Rows with equal instants are ordered by row number. An empty table gives no row; columns
    beyond those read are ignored.
    """
    spark: SparkSession = messages.sparkSession
    cuts = Cuts(spark, "conversations")
    survivors, edges = parent_edges(message_nodes(messages, exports).drop("author", "at", "bad"))
    edges, _ = cuts.cut(edges)
    roots, rounds_at = resolve_roots(edges, cuts)
    parents = edges.where(F.col("end") != 2).select(F.col("node").alias("_c"), F.col("ptr").alias("parent_row"))
    rows = message_nodes(messages, exports).select("node", F.col("reply").isNotNull().alias("replies"), "author", "at", "bad")
    counted = rows.join(survivors.select(F.col("node").alias("_s")), F.col("node") == F.col("_s"), "left_semi")
    linked = counted.join(roots.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left")
    root = F.when(F.col("replies"), F.col("root")).otherwise(F.col("node"))
    placed = linked.select("node", root.alias("root"), F.coalesce("depth", F.lit(0)).alias("depth"), "author", "at", "bad").where(F.col("root").isNotNull())
    placed, _ = cuts.cut(placed)
    cuts.drop(*rounds_at)
    stats = placed.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min("author").alias("a1"), F.max("author").alias("a2"), F.max(F.col("bad").cast("int")).alias("b"))
    seen = Observation()
    judged = stats.where((F.col("b") == 0) & (F.col("a1") != F.col("a2"))).select(F.col("root").alias("_r"), (F.col("n") > hot_rows).alias("_hot"))
    sound, _ = cuts.cut(judged.observe(seen, F.count_if("_hot").alias("hot")))
    some_hot = seen.get["hot"] > 0
    # Cold conversations: one window each. Their rows and the hot ones' take different ways and are united.
    cold = sound.where("not _hot") if some_hot else sound
    kept = placed.drop("bad").join(cold.select("_r"), F.col("root") == F.col("_r"), "left_semi")
    turns = kept.withColumn("turn", F.row_number().over(Window.partitionBy("root").orderBy("at", "node")).cast("bigint"))
    opened = turns.withColumn("_first", F.min("turn").over(Window.partitionBy("root", "author")))
    spoken = opened.withColumn("speaker", F.dense_rank().over(Window.partitionBy("root").orderBy("_first")).cast("bigint")).drop("_first")
    if some_hot:
        hot = placed.drop("bad").join(sound.where("_hot").select("_r"), F.col("root") == F.col("_r"), "left_semi")
        ordered, _ = cuts.cut(numbered(hot, "root", [F.col("at"), F.col("node")], "turn", cuts))
        firsts = ordered.groupBy("root", "author").agg(F.min("turn").alias("_first"))
        voices = numbered(firsts, "root", [F.col("_first")], "speaker", cuts)
        voices = voices.select(F.col("root").alias("_r"), F.col("author").alias("_a"), "speaker")
        heard = ordered.join(voices, (F.col("root") == F.col("_r")) & (F.col("author") == F.col("_a")))
        spoken = spoken.unionByName(heard.select(*spoken.columns))
    return spoken.join(parents, F.col("node") == F.col("_c"), "left").select(
        F.col("root").alias("conv_row"), "turn", F.col("node").alias("msg_row"), "speaker", "parent_row", "depth"
    )
