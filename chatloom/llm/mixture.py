"""Mixing sources to target shares (p9).

Sizes are tokens of a public tokenizer, counted in Arrow batches. The budget of the mixture is the
size of the corpus; a source's repetition rate is its target size over its own, at most max_repeats.
Each document gets a Poisson number of copies, drawn by inverting the distribution at a hash of its
id (the table of a source's cumulative probabilities is searched in Arrow batches), so a run is
repeatable whatever the partitioning. Copies beyond max_repeats are cut, and the mean
is raised so that the expected number of copies after the cut is the rate.
"""

from __future__ import annotations

import math
import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.plans.lineage import Cuts

#: Vocabulary file of the tokenizer; the folder can be set by CHATLOOM_TOKENIZERS.
TOKENIZER = os.path.join(os.environ.get("CHATLOOM_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.json")

_LOADED: dict = {}
_COUNTED: dict[str, dict[str, int]] = {}
REMEMBERED = 200_000  #: different lines whose counts a worker remembers, each of at most LINE characters
LINE = 500

_SHIPPED: set[tuple[str, str]] = set()


def ship_tokenizer(spark: SparkSession, path: str) -> str:
    """Send the vocabulary file to the workers as a file of the application; the name it has there."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _SHIPPED:
        spark.sparkContext.addFile(path)
        _SHIPPED.add(key)
    return os.path.basename(path)


def _tokenizer(name: str):
    if name not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from pyspark import SparkFiles
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(SparkFiles.get(name))
        loaded.encode_special_tokens = True
        _LOADED[name], _COUNTED[name] = loaded, {}
    return _LOADED[name], _COUNTED[name]


def count_tokens(spark: SparkSession, text: Column, path: str = TOKENIZER) -> Column:
    """Tokens of whole texts; 0 for null and empty ones. Texts are encoded line by line with their
    line feeds, which for a byte-level vocabulary bounds the memory of a long one. Lines that recur,
    in whatever batch, are counted once by a worker."""
    from pyspark.sql.functions import arrow_udf

    name = ship_tokenizer(spark, path)

    @arrow_udf("bigint")
    def count(column):
        import pyarrow as pa

        tokenizer, known = _tokenizer(name)
        if len(known) > REMEMBERED:
            known.clear()
        lines = [t.splitlines(keepends=True) if t else [] for t in column.to_pylist()]
        fresh = list({line for some in lines for line in some if line not in known})
        here = dict.fromkeys(fresh, 0)
        for k in range(0, len(fresh), 2000):
            pieces = fresh[k : k + 2000]
            for piece, coded in zip(pieces, tokenizer.encode_batch_fast(pieces, add_special_tokens=False)):
                here[piece] = len(coded.ids)
        out = [sum(here[line] if line in here else known[line] for line in some) for some in lines]
        known.update((line, n) for line, n in here.items() if len(line) <= LINE)
        return pa.array(out, pa.int64())

    return count(text)


def cumulative(lam: float, most: int) -> np.ndarray:
    """P(X <= k) of a Poisson variable with mean `lam` for k below `most`."""
    k = np.arange(most)
    logs = -lam + k * math.log(lam) - np.array([math.lgamma(x + 1) for x in k]) if lam > 0 else np.where(k == 0, 0.0, -np.inf)
    return np.cumsum(np.exp(logs))


def capped_mean(rate: float, cap: int) -> float:
    """The Poisson mean whose draws, cut at `cap`, have the mean `rate` (which is below `cap`)."""

    def mean_of(lam: float) -> float:
        return float((1 - cumulative(lam, cap)).sum())  # the sum of P(X > k) below the cap

    low, high = 0.0, max(1.0, rate)
    while mean_of(high) < rate:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if mean_of(mid) < rate else (low, mid)
    return (low + high) / 2


def source_sizes(sized: DataFrame, source: str = "source", tokens: str = "n_tokens") -> DataFrame:
    """Tokens of each source, summed before the shuffle."""
    return sized.groupBy(F.col(source).alias("source")).agg(F.sum(tokens).alias("own"))


def plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source of `targets`: `own` tokens, `wanted` tokens, `rate` of repetition, `reachable`.

    The budget is the sum of all sizes, also of sources without a target (these are left out of the
    mixture). A source without text reaches only a target of nothing. Null shares and repeats count
    as 0; of repeated targets of a source the first by share counts.
    """
    total = sizes.agg(F.coalesce(F.sum("own"), F.lit(0))).scalar()
    asked = targets.groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t")).select(
        "source", F.coalesce("t.target_share", F.lit(0.0)).alias("target_share"), F.coalesce("t.max_repeats", F.lit(0)).alias("max_repeats")
    )
    own = sizes.select(F.col("source").alias("_s"), "own")
    joined = asked.join(own, F.col("source") == F.col("_s"), "left").withColumn("total", total)
    joined = joined.withColumn("own", F.coalesce("own", F.lit(0))).withColumn("wanted", F.col("target_share") * F.col("total"))
    most = F.col("own") * F.col("max_repeats")
    rate = F.when(F.col("own") > 0, F.least(F.col("wanted") / F.col("own"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    return joined.select("source", "target_share", "max_repeats", "own", "total", "wanted", rate.alias("rate"), (most >= F.col("wanted")).alias("reachable"))


def uniform(key: Column, seed: int = 42) -> Column:
    """A number between 0 and 1 (both excluded) from the SHA-256 of a key: 52 bits and a half."""
    digits = F.substring(F.sha2(F.concat_ws(":", key.cast("string"), F.lit(str(seed))), 256), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def copies(u: Column, which: Column, tables: list[tuple[np.ndarray, int]]) -> Column:
    """Poisson draws by inversion: for a number between 0 and 1 how many of the cumulative
    probabilities of distribution `which` lie below it. A table is (probabilities below the cap, the
    draw added to all). A null `which` draws 0."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("bigint")
    def draw(numbers, places):
        import pyarrow as pa

        x, at = numbers.to_numpy(zero_copy_only=False), places.fill_null(-1).to_numpy(zero_copy_only=False)
        out = np.zeros(len(x), np.int64)
        for k in np.unique(at):
            if k >= 0:
                here = at == k
                probabilities, least = tables[k]
                out[here] = least + np.searchsorted(probabilities, x[here], side="left")
        return pa.array(out)

    return draw(u, which)


def drawn(sized: DataFrame, targets: DataFrame, doc: str = "doc_id", source: str = "source", tokens: str = "n_tokens", seed: int = 42) -> DataFrame:
    """`sized` with `n_copies`, the draw of each document, and `wanted`, the tokens its source should have.

    `sized` is read twice, for the sizes and for the draw; give a table, not a computation. Sources
    without a target draw 0. A source whose rate reaches its cap, or would exceed it, has all of its
    documents max_repeats times. The table of targets is small by nature (a row a source) and
    is collected to solve the means; more than 10 000 rows are refused. Null sources match no target.
    """
    rows = [r for r in plan(source_sizes(sized, source, tokens), targets).limit(10_001).collect() if r["source"] is not None]
    if len(rows) > 10_000:
        raise ValueError("more than 10 000 sources")
    rows.sort(key=lambda r: r["source"])
    tables: list[tuple[np.ndarray, int]] = []
    for r in rows:
        cap = int(r["max_repeats"])
        whole = r["rate"] >= cap
        tables.append((np.zeros(0), cap) if whole else (cumulative(capped_mean(r["rate"], cap), cap), 0))
    places = sized.sparkSession.createDataFrame([(r["source"], k, float(r["wanted"])) for k, r in enumerate(rows)], "_src string, _which int, wanted double")
    joined = sized.join(F.broadcast(places), F.col(source) == F.col("_src"), "left")  # at most 10 000 rows
    return joined.withColumn("n_copies", copies(uniform(F.col(doc), seed), F.col("_which"), tables)).drop("_src", "_which")


def mix(sized: DataFrame, targets: DataFrame, doc: str = "doc_id", source: str = "source", tokens: str = "n_tokens", seed: int = 42) -> DataFrame:
    """The mixture: `sized` with `copy_no` (0, 1, ...), a row per copy, in the order of a hash shuffle.

    `sized` is written to the shared folder once, as both the sizes and the mixture read it; keep it
    narrow (ids, source, tokens) and join the texts afterwards. Sources without a target are left out.
    """
    sized, _ = Cuts(sized.sparkSession, "sized").cut(sized)
    counted = drawn(sized, targets, doc, source, tokens, seed).drop("wanted").where("n_copies > 0")
    exploded = counted.withColumn("copy_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_copies") - 1))).drop("n_copies")
    place = F.xxhash64(F.col(doc), F.col("copy_no"), F.lit(seed + 1))
    return exploded.withColumn("_place", place).repartitionByRange(F.col("_place")).sortWithinPartitions("_place").drop("_place")


def unreachable(sized: DataFrame, targets: DataFrame, doc: str = "doc_id", source: str = "source", tokens: str = "n_tokens") -> DataFrame:
    """Sources of `targets` (`source`) whose drawn copies are all their text `max_repeats` times and still fall
    short of the target; a source without text falls short of any target above nothing."""
    sized, _ = Cuts(sized.sparkSession, "sized").cut(sized)
    held = drawn(sized, targets, doc, source, tokens).groupBy(F.col(source).alias("_s")).agg(F.sum(F.col("n_copies") * F.col(tokens)).alias("_held"), F.min("n_copies").alias("_least"))
    asked = plan(source_sizes(sized, source, tokens), targets).select("source", "wanted", "max_repeats")
    joined = asked.join(held, F.col("source") == F.col("_s"), "left")
    full = F.coalesce(F.col("_least") >= F.col("max_repeats"), F.lit(True))
    return joined.where(full & (F.coalesce("_held", F.lit(0)) < F.col("wanted"))).select("source")


def reached(mixture: DataFrame, targets: DataFrame, source: str = "source", tokens: str = "n_tokens") -> DataFrame:
    """Shares that a mixture really has: `source`, `target_share`, `n_rows`, `n_tokens`, `actual_share`."""
    sums = mixture.groupBy(F.col(source).alias("_s")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(tokens).alias("n_tokens"))
    asked = targets.groupBy("source").agg(F.max("target_share").alias("target_share"))
    total = sums.agg(F.sum("n_tokens")).scalar()
    joined = asked.join(sums, F.col("source") == F.col("_s"), "left").withColumn("_total", total)
    return joined.select(
        "source", "target_share", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
        F.coalesce(F.try_divide("n_tokens", "_total"), F.lit(0.0)).alias("actual_share"),
    )
