"""Exact retrieval by cosine similarity, in blocks of queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PASS_BYTES = 64 << 20  #: vectors of the queries of one pass, which are broadcast
BLOCK = 512  #: queries that are compared with a batch at once


def normalised(vector: str):
    """F32: the vector with length 1, as doubles; a zero vector stays as it is."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(doubles, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(doubles, lambda x: x / norm)).otherwise(doubles)


def _matrices(column) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length of the vectors of a list column: (rows, matrix); vectors that hold a null are left out."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    out = {}
    for n in np.unique(sizes):
        if n:
            rows = np.flatnonzero(sizes == n)
            m = values[starts[rows][:, None] + np.arange(n)]
            whole = ~np.isnan(m).any(axis=1)
            out[int(n)] = (rows[whole], _unit(m[whole]))
    return out


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def top_k(base: DataFrame, queries: DataFrame, k: int = 30, vec: str = "embedding", base_id: str = "vec_id", query_id: str = "query_id", block: int = BLOCK, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The k rows of `base` most similar to each query: `query_id`, `rank`, `base_id`, `score` (rounded to 6 places).

    The queries of a pass, vectors of at most `pass_bytes` in all, are broadcast, and a pass scans all rows once; more
    queries take more passes. A task compares its rows with a block of queries at a time and keeps its own k best a
    query, so only k rows a task and query are shuffled. Ties go to the lower id. Null vectors and ids, vectors with
    nulls or NaN, and vectors of another length than a query's, aren't compared.
    """
    spark = base.sparkSession
    doubles = lambda: F.transform(F.col(vec), lambda x: x.cast("double"))
    rows = base.select(F.col(base_id).cast("bigint").alias("b"), doubles().alias("v")).where("v is not null and b is not null")
    asked = queries.select(F.col(query_id).cast("bigint").alias("q"), doubles().alias("v")).where("v is not null and q is not null")
    size = asked.agg(F.sum(F.size("v") * 8 + 8).alias("n")).first()["n"] or 0
    passes = max(1, -(-size // pass_bytes))
    schema = f"`{query_id}` bigint, `{base_id}` bigint, score double"

    def scored(table):
        ids = table.column("q").to_numpy()
        known = {n: (ids[at], m) for n, (at, m) in _matrices(table.column("v")).items()}
        shared = spark.sparkContext.broadcast(known)

        def run(batches):
            import pyarrow as pa

            held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}  # (ids, unit vectors) since the last comparison
            best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}  # by length and block: ids and scores, k a query

            def compare(n: int) -> None:
                fresh, m = np.concatenate([i for i, _ in held[n]]), np.concatenate([x for _, x in held[n]])
                held[n] = []
                matrix = shared.value[n][1]
                for at in range(0, len(matrix), block):
                    scores = np.round(matrix[at : at + block] @ m.T, 6) + 0.0
                    here = np.broadcast_to(fresh, scores.shape)
                    if (n, at) in best:
                        here, scores = np.concatenate([best[n, at][0], here], axis=1), np.concatenate([best[n, at][1], scores], axis=1)
                    order = np.lexsort((here, -scores), axis=1)[:, :k]
                    best[n, at] = np.take_along_axis(here, order, axis=1), np.take_along_axis(scores, order, axis=1)

            for batch in batches:
                own = batch.column(0).to_numpy()
                for n, (at, m) in _matrices(batch.column(1)).items():
                    if n in shared.value:
                        held.setdefault(n, []).append((own[at], m))
                        if sum(len(i) for i, _ in held[n]) >= 4_096:
                            compare(n)
            for n in list(held):
                if held[n]:
                    compare(n)
            for (n, at), (here, scores) in best.items():
                names = np.repeat(shared.value[n][0][at : at + block], here.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(here.ravel()), pa.array(scores.ravel())], names=[query_id, base_id, "score"])

        return rows.mapInArrow(run, schema)

    out = None
    for number in range(passes):
        mine = asked if passes == 1 else asked.where(F.pmod(F.xxhash64("q"), F.lit(passes)) == number)
        part = scored(mine.toArrow())
        out = part if out is None else out.unionByName(part)
    rank = F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("score"), base_id))
    return out.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= k).select(query_id, "rank", base_id, "score")


def hashed_embedding(size: int = 64) -> Callable[[Sequence[str | None]], list[list[float]]]:
    """The offline default embedder: words hashed into a normalised vector of counts."""

    def embed(texts: Sequence[str | None]) -> list[list[float]]:
        import hashlib
        import re

        out = np.zeros((len(texts), size))
        places: dict[str, tuple[int, int]] = {}
        for i, text in enumerate(texts):
            for word in re.findall(r"\w+", (text or "").lower()):
                if word not in places:
                    h = int(hashlib.md5(word.encode(), usedforsecurity=False).hexdigest()[:8], 16)
                    places[word] = h % size, 1 - 2 * (h >> 16 & 1)
                place, sign = places[word]
                out[i, place] += sign
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norms, out=out, where=norms > 0).tolist()

    return embed


def hits_with_messages(hits: DataFrame, messages: DataFrame, base_id: str = "ord", cut: int = 500) -> DataFrame:
    """Hits with the message that each is: `message_id`, `ts`, `author_name`, `content` cut to `cut`
    characters. Hits are few; messages are scanned once and never shuffled if the hits fit a broadcast."""
    named = messages.select(F.col(base_id).alias("_b"), "message_id", "ts", "author_name", F.substring(F.coalesce("content", F.lit("")), 1, cut).alias("content"))
    return hits.join(named, F.col(base_id) == F.col("_b")).drop("_b")


def embeddable(messages: DataFrame, least: int = 5, cut: int = 1_500) -> DataFrame:
    """Messages worth an embedding: texts without blanks around them of at least `least` characters, cut to
    what a model's context takes. The cut is the model's, a parameter; it concerns this step alone."""
    from chatloom.functions.text import strip

    text = strip(F.coalesce("content", F.lit("")))
    return messages.where(F.length(text) >= least).withColumn("content", F.substring(text, 1, cut))


def embedded_with_cache(df: DataFrame, text: str, cache: DataFrame, model: str, embedder: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    """(`df` with `embedding`, the entries that the cache lacks). `cache` has `hash`, `model`, `embedding`; a text
    that it has for the model isn't embedded again. The entries are to be written before the result is used."""
    from chatloom.functions.ids import content_hash

    keyed = df.withColumn("_hash", content_hash(F.coalesce(F.col(text), F.lit(""))))
    known = cache.where(F.col("model") == model).select(F.col("hash").alias("_k"), "embedding")
    todo = keyed.groupBy("_hash").agg(F.min(F.coalesce(F.col(text), F.lit(""))).alias("_text")).join(known, F.col("_hash") == F.col("_k"), "left_anti")
    fresh = embedded(todo, "_text", embedder=embedder).select(F.col("_hash").alias("hash"), F.lit(model).alias("model"), "embedding")
    every = known.unionByName(fresh.select(F.col("hash").alias("_k"), "embedding"))
    return keyed.join(every, F.col("_hash") == F.col("_k")).drop("_hash", "_k"), fresh


def embedded(df: DataFrame, text: str, out: str = "embedding", embedder: Callable | None = None) -> DataFrame:
    """`df` with an embedding of its text, by a pluggable function from texts to vectors, in Arrow batches."""
    from pyspark.sql.functions import arrow_udf

    embed = embedder or hashed_embedding()

    @arrow_udf("array<float>")
    def run(column):
        import pyarrow as pa

        return pa.array(embed(column.to_pylist()), pa.list_(pa.float32()))

    return df.withColumn(out, run(F.col(text)))
