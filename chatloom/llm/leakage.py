"""Evaluation items leaking into training text (p8).

The n-grams of an evaluation set are hashed on the driver and broadcast as sorted arrays. Training
texts are scanned as word windows: words are numbered by the set's own vocabulary (all others break a
window), n-gram hashes of a batch are computed by one polynomial in numpy and looked up by binary
search, and every hit is verified word by word. An evaluation set too large to broadcast is joined
instead: hashes of the windows of both sides meet in one shuffle join, and the pairs of document and
item that it finds are verified with their texts. One pass over the corpus either way.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N = 12  #: words of a passage that counts
BLOCK_WORDS = 2_000_000  #: words of items that are broadcast (about 60 MB); a larger set is joined

_WORDS = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Unbroken runs of letters and digits, case folded. Letters with combining marks that
    have a composed form are one letter; other marks end a word, as they are no letters."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return _WORDS.findall(text.lower())


@dataclass
class Index:
    """Passages of a block of items."""

    n: int
    vocabulary: dict[str, int]
    stream: np.ndarray  #: word numbers of all items, one after the other
    hashes: np.ndarray  #: sorted hashes of the n-grams
    places: np.ndarray  #: where in the stream each starts
    owners: np.ndarray  #: row of the item of each
    items: list[int]


def _mix(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of n words; wrap-around arithmetic on 64 bits."""
    mixed = _mix(ids)
    out = np.zeros(len(ids) - n + 1, np.uint64)
    for k in range(n):
        out = out * _BASE + mixed[k : len(ids) - n + 1 + k]
    return out


def build(items: list[tuple[int, str | None]], n: int = N) -> Index:
    """The index of (id, text) items; those with fewer than n words hold no passage."""
    vocabulary: dict[str, int] = {}
    streams, hashes, places, owners, ids, at = [], [], [], [], [], 0
    for item, text in items:
        numbers = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)], np.int64)
        if len(numbers) >= n:
            grams = _hashes(numbers, n)
            hashes.append(grams)
            places.append(at + np.arange(len(grams)))
            owners.append(np.full(len(grams), len(ids)))
            ids.append(item)
            streams.append(numbers)
            at += len(numbers)
    if not ids:
        none = np.zeros(0, np.int64)
        return Index(n, {}, none, none.astype(np.uint64), none, none, [])
    grams, starts, rows = np.concatenate(hashes), np.concatenate(places), np.concatenate(owners)
    order = np.argsort(grams, kind="stable")
    return Index(n, vocabulary, np.concatenate(streams), grams[order], starts[order], rows[order], ids)


def scan(texts: list[str | None], index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item row, first word of the passage in the text) of every verified window."""
    n, get = index.n, index.vocabulary.get
    none = np.zeros(0, np.int64)
    flat: list[int] = []
    lengths: list[int] = []
    for text in texts:
        before = len(flat)
        flat += [get(w, -1) for w in words_of(text)]
        flat.append(-2)  # the end of a text breaks windows
        lengths.append(len(flat) - before)
    ids = np.array(flat, np.int64)
    if len(ids) < n or not len(index.hashes):
        return none, none, none
    known = np.concatenate([[0], np.cumsum(ids >= 0)])
    whole = np.flatnonzero(known[n:] - known[:-n] == n)  # windows of known words only
    if not len(whole):
        return none, none, none
    grams = _hashes(ids, n)[whole]
    low, high = np.searchsorted(index.hashes, grams, "left"), np.searchsorted(index.hashes, grams, "right")
    hit = high > low
    whole, low, count = whole[hit], low[hit], (high - low)[hit]
    if not len(whole):
        return none, none, none
    window = np.repeat(whole, count)
    entry = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    place = index.places[entry]
    same = np.ones(len(window), bool)
    for k in range(n):
        same &= ids[window + k] == index.stream[place + k]
    window, entry = window[same], entry[same]
    ends = np.cumsum(lengths)
    text = np.searchsorted(ends, window, "right")
    return text, index.owners[entry], window - (ends - lengths)[text]


def _runs(words: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Windows given by their first words (sorted) as unions: (first word, last word) of each."""
    if not len(words):
        return []
    cut = np.flatnonzero(np.diff(words) > n)
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(words) - 1]])
    return [(int(words[a]), int(words[b]) + n - 1) for a, b in zip(first, last)]


_FOUND = "n_windows bigint, first_word bigint, last_word bigint, runs array<struct<a:bigint,b:bigint>>"


def _found(texts: list[str | None], index: Index) -> tuple[list[int], list[int], list[tuple]]:
    """(text, item row, (windows, first word, last word, runs)) of each text and item that meet."""
    t, owner, word = scan(texts, index)
    order = np.lexsort((word, owner, t))
    t, owner, word = t[order], owner[order], word[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    told = []
    for a, b in zip(starts, [*starts[1:], len(t)]):
        words = np.unique(word[a:b])
        told.append((len(words), int(words[0]), int(words[-1]) + index.n - 1, [{"a": x, "b": y} for x, y in _runs(words, index.n)]))
    return t[starts].tolist(), owner[starts].tolist(), told


def _batch(docs, items, told, doc: str, item: str):
    import pyarrow as pa

    runs = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    columns = [pa.array(docs, pa.int64()), pa.array(items, pa.int64()), *[pa.array([x[k] for x in told], pa.int64() if k < 3 else runs) for k in range(4)]]
    return pa.RecordBatch.from_arrays(columns, names=[doc, item, "n_windows", "first_word", "last_word", "runs"])


def _by_broadcast(source: DataFrame, block: list[tuple[int, str | None]], doc: str, item: str, n: int) -> DataFrame:
    """All texts of (`d`, `t`) against a bounded block of items."""
    shared = source.sparkSession.sparkContext.broadcast(build(block, n))

    def run(batches):
        index: Index = shared.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            t, owner, told = _found(batch.column(1).to_pylist(), index)
            yield _batch([ids[k] for k in t], [index.items[k] for k in owner], told, doc, item)

    return source.mapInArrow(run, f"`{doc}` bigint, `{item}` bigint, {_FOUND}")


def window_hashes(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the different windows of n words of each text; words by a 64-bit hash of their letters."""
    import xxhash

    numbers: list[int] = []
    lengths: list[int] = []
    memo: dict[str, int] = {}
    for text in texts:
        words = words_of(text)
        lengths.append(len(words))
        for w in words:
            k = memo.get(w)
            if k is None:
                k = memo[w] = xxhash.xxh64_intdigest(w)
            numbers.append(k)
    sizes = np.array(lengths, np.int64)
    if sizes.sum() < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = _hashes(np.array(numbers, np.uint64), n)
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = owner[: len(grams)] == owner[n - 1 :]
    pairs = np.unique(np.stack([owner[: len(grams)][inside], grams[inside].view(np.int64)]), axis=1)
    return pairs[0], pairs[1]


def _by_join(source: DataFrame, items: DataFrame, doc: str, item: str, n: int) -> DataFrame:
    """All texts of (`d`, `t`) against items (`i`, `u`) of any number: windows meet by their hashes, once a
    document and item; a window that very many documents hold is split by AQE. The pairs are verified with their texts."""

    def hashed(df: DataFrame, key: str) -> DataFrame:
        def run(batches):
            import pyarrow as pa

            for batch in batches:
                texts = batch.column(1).to_pylist()
                for k in range(0, len(texts), 500):  # bounds the windows in memory
                    owner, grams = window_hashes(texts[k : k + 500], n)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 500).take(pa.array(owner)), pa.array(grams)], names=[key, "g"])

        return df.mapInArrow(run, f"{key} bigint, g bigint")

    met = hashed(source, "d").join(hashed(items, "i").withColumnRenamed("g", "h"), F.col("g") == F.col("h")).select("d", "i").distinct()
    pairs = met.join(source.withColumnRenamed("d", "_d"), F.col("d") == F.col("_d")).join(items.withColumnRenamed("i", "_i"), F.col("i") == F.col("_i")).select("d", "t", "i", "u")

    def verify(batches):
        built: dict[int, Index] = {}
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for d, t, i, u in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if i not in built:
                    if len(built) > 1_000:
                        built.clear()
                    built[i] = build([(i, u)], n)
                _, _, told = _found([t], built[i])
                if told:
                    for column, value in zip(out, (d, i, told[0])):
                        column.append(value)
            yield _batch(*out, doc, item)

    return pairs.mapInArrow(verify, f"`{doc}` bigint, `{item}` bigint, {_FOUND}")


def leaked(
    corpus: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text", item_text: str = "text", n: int = N, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Each document with each item of which it holds n consecutive words: `doc`, `item`, `n_windows`,
    `first_word`, `last_word`, `runs` (array of first and last word of each unbroken leak).

    Case and whatever lies between words don't matter. `n_windows` counts the matching windows of the
    document, `first_word` and `last_word` enclose all matching words. Null and empty texts, and
    items shorter than n words, match nothing. Items with equal texts are all reported. Other columns
    are ignored; empty tables give no row. Ids must be whole numbers. Items of up to `block_words` words in
    all are broadcast, more are joined, with the same result.
    """
    source = corpus.select(F.col(doc).cast("bigint").alias("d"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    asked = items.select(F.col(item).cast("bigint").alias("i"), F.col(item_text).alias("u")).where(F.col("u").isNotNull())
    # A word has a letter or digit at least, so this is no fewer than the words there are.
    words = asked.agg(F.sum(F.regexp_count("u", F.lit(r"[\p{L}\p{N}]+"))).alias("n")).first()["n"] or 0
    if words > block_words:
        return _by_join(source, asked, doc, item, n)
    return _by_broadcast(source, [(r["i"], r["u"]) for r in asked.orderBy("i").collect()], doc, item, n)


def cleaned(corpus: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The corpus without the documents that leak an item, all columns kept."""
    bad = leaked(corpus, items, doc=doc, text=text, **options).select(F.col(doc).alias("_leaks")).distinct()
    return corpus.join(bad, F.col(doc) == F.col("_leaks"), "left_anti")


def without_words(text: str | None, runs: list[dict] | None) -> str | None:
    """A text without the runs of words, from the first one's first letter to the last one's last; what
    stood around a run is joined by a blank. A text that loses words comes out in composed form (NFC), in which words are counted."""
    if text is None or not runs:
        return text
    whole = text if text.isascii() else unicodedata.normalize("NFC", text)
    low = whole.lower()
    spans = [m.span() for m in _WORDS.finditer(low if len(low) == len(whole) else whole)]
    out, at = [], 0
    for run in sorted(runs, key=lambda r: r["a"]):
        a, b = spans[run["a"]][0], spans[run["b"]][1]
        if a > at:
            out.append(whole[at:a].strip())
        at = max(at, b)
    out.append(whole[at:].strip())
    return " ".join(x for x in out if x)


def pruned(corpus: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The corpus with the leaking passages cut out of its texts, all columns kept, and `n_removed`: words cut
    out of a document (0 for most). A document that is all passage keeps an empty text."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("string")
    def cut(texts, runs):
        import pyarrow as pa

        return pa.array([without_words(t, r) for t, r in zip(texts.to_pylist(), runs.to_pylist())], pa.string())

    hit = leaked(corpus, items, doc=doc, text=text, **options).select(F.col(doc).alias("_hit"), "runs")
    joined = hit.groupBy("_hit").agg(F.array_sort(F.flatten(F.collect_list("runs"))).alias("_runs"))  # passages of one document
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("end"))
    after = lambda s, r: F.struct((s["n"] + F.greatest(F.lit(0), r["b"] - F.greatest(r["a"] - 1, s["end"]))).alias("n"), F.greatest(s["end"], r["b"]).alias("end"))
    out = corpus.join(joined, F.col(doc) == F.col("_hit"), "left")
    lost = F.coalesce(F.aggregate("_runs", none, after)["n"], F.lit(0))
    return out.withColumns({text: F.when(F.col("_runs").isNull(), F.col(text)).otherwise(cut(F.col(text), F.col("_runs"))), "n_removed": lost}).drop("_hit", "_runs")
