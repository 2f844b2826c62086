"""Results of models that outlive a run (K12, K13, T3): Parquet tables keyed by content.

An entry is written once; a run that breaks off has kept what it wrote, and the next one asks only for
the rest. Failures are never entered, so they are asked again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.ids import content_hash
from chatloom.operators import ai, retrieval
from chatloom.plans.lineage import Cuts


class Cache:
    """A folder of Parquet files with one row a key."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, keys: Sequence[str]):
        self.spark, self.folder, self.schema, self.keys = spark, folder.rstrip("/"), schema, tuple(keys)

    def _there(self) -> bool:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder)

    def read(self) -> DataFrame:
        """The entries; of a key that two runs entered at once only one."""
        if not self._there():
            return self.spark.createDataFrame([], self.schema)
        rows = self._stored()
        rest = [c for c in rows.columns if c not in self.keys]
        one = rows.groupBy(*self.keys).agg(F.first(F.struct(*rest)).alias("_x"))
        return one.select(*self.keys, *[F.col(f"_x.{c}").alias(c) for c in rest])

    def add(self, entries: DataFrame) -> None:
        """Write entries that the cache lacks."""
        entries.write.mode("append").parquet(self.folder)


def topic_cache(spark: SparkSession, folder: str) -> Cache:
    return Cache(spark, folder, "hash string, topic string", ["hash"])


def embedding_cache(spark: SparkSession, folder: str) -> Cache:
    return Cache(spark, folder, "hash string, model string, embedding array<float>", ["hash", "model"])


class FactCache(Cache):
    """Facts by the hash of their chunk's text, several rows a chunk; a chunk without facts has one without category."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder, "chunk_idx bigint, hash string, category string, fact map<string,string>, error string", ["hash"])

    def read(self) -> DataFrame:
        return self._stored() if self._there() else self.spark.createDataFrame([], self.schema)


def tagged(messages: DataFrame, tagger: ai.Tagger, cache: Cache, batch_size: int = 25) -> DataFrame:
    """X2 with a cache: texts that it has aren't asked again; new answers are entered, failures aren't."""
    cache.add(ai.fresh_topics(messages, tagger, batch_size, cache.read()).where("topic is not null"))
    return ai.tagged(messages, lambda texts: [None] * len(texts), batch_size, cache.read())


def facts(texts: DataFrame, categories: Sequence[str], extractor: ai.Extractor, cache: FactCache) -> DataFrame:
    """X3 with a cache, keyed by the text of a chunk: facts of all chunks. Failed chunks are rows with an error
    and are asked again by the next run."""
    known = cache.read()
    asked = known.select(F.col("hash").alias("_h")).distinct()
    fresh = ai.facts(texts, categories, extractor, known).join(asked, F.col("hash") == F.col("_h"), "left_anti")
    rows, _ = Cuts(texts.sparkSession, "facts").cut(fresh)
    cache.add(rows.where("error is null"))
    here = texts.select(F.col("chunk_idx").cast("bigint").alias("chunk_idx"), content_hash("text").alias("_here"))  # a chunk may have moved
    return known.unionByName(rows).drop("chunk_idx").join(here, F.col("hash") == F.col("_here")).select("chunk_idx", "hash", "category", "fact", "error")


def embedded(df: DataFrame, text: str, cache: Cache, model: str, embedder: Callable | None = None) -> DataFrame:
    """X4 with a cache: `df` with `embedding`."""
    _, fresh = retrieval.embedded_with_cache(df, text, cache.read(), model, embedder)
    cache.add(fresh)
    return retrieval.embedded_with_cache(df, text, cache.read(), model, embedder)[0]
