"""Exactly one copy of each message delivered at least once (p6).

Exact quotient hashing. A message's identity (export key, message id) is laid out as a fixed-width
identifier: a 64-bit word E from the export key and a block M of ID_WIDTH bytes from the id. One
round of an unbalanced Feistel network, (E, M) -> (E xor h(M), M), permutes the identifiers; it is
its own inverse, so nothing is lost and two identifiers never meet. The permuted first word is the
quotient: its value places a row in a shard and a slot. The remainder that the slot stores is the
complete rest, so a match of quotient and remainder is a match of the identifiers, never a false one.
Identities that don't fit the fixed width (a longer id, an export key that isn't 16 hex digits) keep
their whole text as the remainder, under the same scheme.

Shards are the hash partitions of Spark's aggregate, whose map-side table inserts each identifier
once before anything is shuffled, so an identifier that a third of all rows share costs one slot a
task. Which rows to drop is then decided by the unique row number alone; no group is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.ids import clean_id

ID_WIDTH = 24  #: bytes of a fixed-width message id


def quotient_key(scope: Column, identifier: Column) -> list[Column]:
    """The permuted identifier: quotient `q`, remainder `r`, and whole text `x` of misfits (else null)."""
    hexes = F.lower(scope)
    fits = (F.octet_length(identifier) <= ID_WIDTH) & F.coalesce(hexes.rlike("^[0-9a-f]{16}$") & (scope == hexes), F.lit(False))
    block = F.when(fits, identifier)
    # 16 hex digits as one 64-bit word: two halves, as conv() gives an unsigned decimal
    high = F.conv(F.substring(scope, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(scope, 9, 8), 16, 10).cast("bigint")
    word = F.when(fits, F.shiftleft(high, 32).bitwiseOR(low)).otherwise(F.xxhash64(scope))
    quotient = word.bitwiseXOR(F.xxhash64(F.coalesce(block, identifier)))
    misfit = F.when(~fits, F.to_json(F.struct(scope.alias("s"), identifier.alias("i"))))
    return [quotient.alias("q"), F.coalesce(block, F.lit("")).alias("r"), misfit.alias("x")]


def _keyed(df: DataFrame, scope: str, identifier: str, row: str) -> DataFrame:
    # The id is padded by nothing: its own length closes the block, as ids hold no NUL after trimming.
    cleaned = df.select(F.coalesce(F.col(scope).cast("string"), F.lit("")).alias("s"), clean_id(F.col(identifier).cast("string")).alias("i"), F.col(row).alias("row"))
    cleaned = cleaned.where(F.col("i").isNotNull())
    return cleaned.select(*quotient_key(F.col("s"), F.col("i")), "row")


def duplicate_rows(
    messages: DataFrame,
    seen: DataFrame | None = None,
    scope: str = "export_key",
    identifier: str = "message_id",
    row: str = "msg_row",
    seen_row: str = "seen_no",
) -> DataFrame:
    """Rows to drop, as (`tbl`, `row_no`).

    Of messages: all but the lowest `row` of an identity, and every row of one that `seen` holds.
    Of seen: all but the lowest `seen_row` of an identity. Ids are compared within their scope with
    blanks around them ignored; rows with a null, empty or blank id are never dropped. A null scope
    counts as the empty one. `row` and `seen_row` must be unique in their tables. Other columns are
    ignored; empty tables give no row.
    """
    parts = [_keyed(messages, scope, identifier, row).select("q", "r", "x", F.col("row").alias("m"), F.lit(None).cast("bigint").alias("s"))]
    if seen is not None:
        parts.append(_keyed(seen, scope, identifier, seen_row).select("q", "r", "x", F.lit(None).cast("bigint").alias("m"), F.col("row").alias("s")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    slots = rows.groupBy("q", "r", "x").agg(F.min("m").alias("m"), F.min("s").alias("s"))
    # the kept rows of both tables, told apart by the sign bit of 2 n or 2 n + 1
    kept = slots.select(F.explode(F.filter(F.array(F.when(F.col("s").isNull(), F.struct(F.lit(0).alias("t"), F.col("m").alias("n"))), F.when(F.col("s").isNotNull(), F.struct(F.lit(1).alias("t"), F.col("s").alias("n")))), lambda v: v.isNotNull() & v["n"].isNotNull())).alias("v")).select(F.col("v.t").alias("kt"), F.col("v.n").alias("kn"))
    every = rows.select(F.when(F.col("m").isNotNull(), 0).otherwise(1).alias("t"), F.coalesce("m", "s").alias("n"))
    dropped = every.join(kept, (F.col("t") == F.col("kt")) & (F.col("n") == F.col("kn")), "left_anti")
    return dropped.select(F.when(F.col("t") == 0, F.lit("messages")).otherwise(F.lit("seen_messages")).alias("tbl"), F.col("n").alias("row_no"))


def first_copies(
    messages: DataFrame,
    seen: DataFrame | None = None,
    scope: str = "export_key",
    identifier: str = "message_id",
    row: str = "msg_row",
    seen_row: str = "seen_no",
) -> DataFrame:
    """The rows of `messages` to keep, with all their columns: one copy of each message not handled before.

    Rows without an id are all kept. The complement of `duplicate_rows`, with the same rules.
    """
    drop = duplicate_rows(messages, seen, scope, identifier, row, seen_row).where(F.col("tbl") == "messages").select(F.col("row_no").alias("_drop_row"))
    return messages.join(drop, messages[row] == drop["_drop_row"], "left_anti")
