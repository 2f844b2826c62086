"""Subject areas of documents (p10).

The unit is the sentence. Complement naive Bayes weights over hashed words and word pairs are trained
from labelled documents, then refined by expectation-maximization over the sentences of all
documents. A sentence's words are credited with the subjects of the document's other sentences, never
with its own, so phrases that occur with every subject (greetings, thanks) can't talk themselves into
one; evidence below a threshold leaves a sentence without subject. The last rounds credit words with
their own sentence's subject, or with none, but only those that the earlier ones left in favour. Each language has features of its own and is compared with
the shares of subjects within that language. The model is a table of a fixed
number of hashed features, so every round is one pass whose tasks pre-aggregate expected counts and
whose result is bounded.

A document has a subject if its calibrated posterior is one half or more. The posterior is a logistic
function of the evidence of the document's second strongest sentence on the subject (two sentences
must be devoted to it), fitted on labelled documents for each subject by itself: subjects don't
compete, and a sentence may speak for two.

Texts are parsed once, into blocks of documents in which a sentence that recurs is kept once, with
the documents that hold it; all rounds and the answer read these blocks.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.language import LATIN, SEEDS
from chatloom.plans.lineage import Cuts

BITS = 16  #: features of a language are hashed to 2 ** BITS rows; the model never grows beyond that
ROUNDS = 4  #: rounds of expectation-maximization with the subjects of other sentences
OWN_ROUNDS = 4  #: and rounds with a sentence's own
SENTENCES = 2  #: sentences that must be devoted to a subject
LABEL_WEIGHT = 0.5  #: weight of the counts from labels in later rounds
SHRINK = 0.7  #: so many occurrences with the usual shares of subjects are added to each feature's
DEAD_ZONE = 0.7  #: log odds nearer to 0 than this count as none
SCALE = 0.5  #: words and pairs aren't independent; log odds are halved
THRESHOLD = 1.2  #: evidence (nats) that a sentence about no subject has
HELD = 200_000  #: a task hands on its counts of words when it holds so many
CALIBRATION_DOCS = 20_000  #: at most so many labelled documents, chosen by a hash, calibrate the posteriors
SETTLED = 0.01  #: rounds end when less than this share of the expected counts has moved
BLOCK_DOCS, BLOCK_CHARS = 5_000, 4_000_000  #: a block of parsed sentences ends with either
SLOPE = 2.0  #: slope of the logistic function before labels are seen; THRESHOLD is where it is one half
PRIOR = 4.0  #: weight with which a subject's function keeps to that of all subjects, and that one to the above
WRONG = 0.05  #: share of labels taken to be wrong, so that a wrong one doesn't move the function

_LANGUAGES = (*LATIN, "ru", "zh", "")  #: eight, the last for text of no known language
_ROWS = 8 << BITS
_SEEDS = {}
for _code, _text in SEEDS.items():
    for _word in _text.split():
        _SEEDS.setdefault(_word, set()).add(LATIN.index(_code))
_PART = re.compile(r"\n|(?<=[.?!…])[\"'»”)\]]*\s+|(?<=[。？！；])")
_TOKEN = re.compile(r"[一-鿿]+|[^\W\d_]+")
_CODE = re.compile(r"`[^`]*`|\S*[\d@/_=\\{}$]\S*")
_MARKS = re.compile("[̀-ͯ]")
_LABEL = re.compile(r"^\s*(?:[-*•>#]+\s*)?(?:\[?\d{1,2}:\d{2}(?::\d{2})?\]?\s*)?(?:[\w.]{1,32}:\s)?")
_BREAK = re.compile(r"(?<=[^\W\d_A-ZÀ-ÞА-ЯЁ]) (?=[A-ZÀ-ÞА-ЯЁ])")


def _fold(text: str) -> str:
    text = text.lower()
    return text if text.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", text))


def _opening(part: str, times: int, first: Counter[str], shown: Counter[str]) -> None:
    """Counts the words of a part that are capitalised at its start, and anywhere."""
    words = re.findall(r"[^\W\d_]+", part)
    if len(words) > 1 and not part.isupper():
        first[words[0]] += times * words[0][:1].isupper()
        for w in words:
            if w[:1].isupper():
                shown[w] += times


def starters(documents: DataFrame, text: str = "text") -> frozenset[str]:
    """Words that, when capitalised, nearly always begin a sentence, counted over all documents and
    whole texts. Parts that recur are looked at once, with their number. The driver gets only the words that pass."""

    def count(batches):
        import pyarrow as pa

        def handed(parts):
            first: Counter[str] = Counter()
            shown: Counter[str] = Counter()
            for part, times in parts.items():
                _opening(part, times, first, shown)
            words = list(shown)
            for k in range(0, len(words), 20_000):
                some = words[k : k + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([first[w] for w in some], pa.int64()), pa.array([shown[w] for w in some], pa.int64())], names=["w", "first", "shown"])

        parts: Counter[str] = Counter()
        size = 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    size += len(t)
                    parts.update([_LABEL.sub("", part, count=1) for part in _PART.split(t) if part])
                if len(parts) > HELD or size > 40_000_000:
                    yield from handed(parts)
                    parts, size = Counter(), 0
        yield from handed(parts)

    counts = documents.select(F.col(text).alias("t")).mapInArrow(count, "w string, first bigint, shown bigint")
    sums = counts.groupBy("w").agg(F.sum("first").alias("first"), F.sum("shown").alias("shown"))
    return frozenset(r["w"] for r in sums.where((F.col("first") >= 5) & (F.col("first") >= 0.9 * F.col("shown"))).select("w").collect())


def sentences(part: str, begin: frozenset[str] = frozenset()) -> list[str]:
    """The sentences of a part of a text (between line ends and end marks, without a label): split before a
    capitalised word that nearly always begins one where the end mark is missing."""
    out = []
    if begin and " " in part:
        at = 0
        for m in _BREAK.finditer(part):
            word = re.match(r"[^\W\d_]+", part[m.end() :])
            if word and word.group() in begin and m.start() - at > 15:
                out.append(part[at : m.start()])
                at = m.end()
        part = part[at:]
    if len(part) > 3:
        out.append(part)
    return out


class Features:
    """Hashed features of sentences; words are remembered up to a bound."""

    MEMO = 300_000
    PARTS, LONG = 100_000, 500  #: so many parts of texts, of so many characters at most, are remembered

    def __init__(self, begin: frozenset[str]):
        self.begin = begin
        self.memo: dict[str, int] = {}
        self.seen: dict[str, list[tuple[tuple[int, ...], int]]] = {}  #: part -> (words, language) of its sentences
        self.votes = {_fold(w): tuple(js) for w, js in _SEEDS.items()}

    def _sentence(self, sentence: str) -> tuple[tuple[int, ...], int] | None:
        """(hashed words, language, -1 where only the text can tell); None without words."""
        import xxhash

        memo, votes = self.memo, self.votes
        words: list[int] = []
        tally: list[int] | None = None
        script = 7
        for token in _TOKEN.findall(_CODE.sub(" ", _fold(sentence))):
            if "一" <= token[0] <= "鿿":
                script = 6
                pieces = [token[k : k + 2] for k in range(len(token) - 1)] or [token]
            else:
                pieces = (token,)
                if (vote := votes.get(token)) is not None:
                    tally = tally or [0] * 5
                    for j in vote:
                        tally[j] += 1
                elif "Ѐ" <= token[0] <= "ԯ" and script == 7:
                    script = 5
            for piece in pieces:
                k = memo.get(piece)
                if k is None:
                    k = memo[piece] = xxhash.xxh32_intdigest(piece) & 0x7FFFFFFF
                words.append(k)
        if not words:
            return None
        if script < 7:
            return tuple(words), script
        most = max(tally) if tally else 0
        return tuple(words), tally.index(most) if most and tally.count(most) == 1 else -1

    def parsed(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hashed words, words of each different sentence, its language; which sentence each occurrence
        is, sentences of each text).

        Code, links and numbers within sentences are left out; a sentence without any word isn't one.
        """
        if len(self.memo) > self.MEMO:
            self.memo.clear()
        if len(self.seen) > self.PARTS:
            self.seen.clear()
        seen, number = self.seen, {}
        words: list[int] = []
        lengths: list[int] = []
        tongues: list[int] = []
        held: list[int] = []
        counts: list[int] = []
        for text in texts:
            mine: list[tuple[tuple[int, ...], int]] = []
            usual = [0] * 8
            for part in _PART.split(text) if text else ():
                if not part:
                    continue
                part = _LABEL.sub("", part, count=1)
                told = seen.get(part)
                if told is None:
                    told = [x for s in sentences(part, self.begin) if (x := self._sentence(s)) is not None]
                    if len(part) <= self.LONG:
                        seen[part] = told
                for x in told:
                    mine.append(x)
                    if x[1] >= 0:
                        usual[x[1]] += 1
            here = usual.index(max(usual)) if any(usual) else 7
            for ids, tongue in mine:
                key = (ids, here if tongue < 0 else tongue)
                k = number.get(key)
                if k is None:
                    k = number[key] = len(lengths)
                    words.extend(ids)
                    lengths.append(len(ids))
                    tongues.append(key[1])
                held.append(k)
            counts.append(len(mine))
        whole = lambda x: np.array(x, np.int64)
        return whole(words), whole(lengths), whole(tongues), whole(held), whole(counts)


def expanded(ids: np.ndarray, lengths: np.ndarray, tongue: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, its sentence): words and pairs of neighbours, the language in the low three bits."""
    of = np.repeat(np.arange(len(lengths)), lengths)
    if not len(ids):
        return ids, of
    same = of[1:] == of[:-1]
    pairs = (ids[:-1] * 1_000_003 + ids[1:] * 8_191 + 12_345)[same]
    every = np.concatenate([ids ^ (ids >> 13), pairs ^ (pairs >> 17)]) & ((1 << BITS) - 1)
    of = np.concatenate([of, of[1:][same]])
    return every << 3 | tongue[of], of


@dataclass
class Model:
    subjects: list[str]
    weights: np.ndarray  #: float32 (rows, subjects)
    begin: frozenset[str]
    calibration: np.ndarray | None = None  #: (subjects, 2): intercept and slope of the logistic function
    threshold: float = THRESHOLD


def complement_weights(counts: np.ndarray, classes: int) -> np.ndarray:
    """Log odds of each feature in a class against all others together, for the first `classes` columns.

    log P(t | c) / P(t | not c) equals logit P(c | t) - logit P(c), both within the feature's
    language; P(c | t) is shrunk towards P(c).
    """
    total = counts.sum(axis=1, keepdims=True)
    by_language = counts.reshape(-1, 8, counts.shape[1]).sum(axis=0)
    whole = (by_language.sum(axis=0) + 1) / (by_language.sum() + counts.shape[1])
    base = (by_language + 50 * whole) / (by_language.sum(axis=1, keepdims=True) + 50)
    base = np.tile(base, (len(counts) // 8, 1))
    own = np.clip((counts + SHRINK * base) / (total + SHRINK), 1e-9, 1 - 1e-9)
    base = np.clip(base, 1e-9, 1 - 1e-9)  # a single subject has all
    weights = (np.log(own / (1 - own)) - np.log(base / (1 - base)))[:, :classes]
    return (np.sign(weights) * np.maximum(0, np.abs(weights) - DEAD_ZONE)).astype(np.float32)


def evidence(model: Model, feature: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
    """Evidence (nats) of n sentences for each subject against all others."""
    out = np.zeros((n, len(model.subjects)))
    for c in range(out.shape[1]):
        out[:, c] = SCALE * np.bincount(sentence, weights=model.weights[feature, c], minlength=n)
    return out


def responsibilities(found: np.ndarray, threshold: float) -> np.ndarray:
    """Shares of the subjects, and of none in the last column, in each sentence."""
    logits = np.concatenate([found, np.full((len(found), 1), threshold)], axis=1)
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def others(r: np.ndarray, held: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each different sentence the subjects of the other different sentences of the documents that hold
    it, as counts of at most 1 a document, summed over the documents.

    Only sentences that lean to a subject count, so that many with none don't blur the rest.
    """
    about = np.where(r[:, :-1] >= 0.5, r[:, :-1], 0)
    out = np.zeros_like(about)
    if not len(held):
        return out
    owner = np.repeat(np.arange(len(counts)), counts)
    pairs = np.unique(owner * len(r) + held, return_counts=True)
    docs, which = np.divmod(pairs[0], len(r))
    mass = np.zeros((len(counts), about.shape[1]))
    for c in range(about.shape[1]):
        mass[:, c] = np.bincount(docs, weights=about[which, c], minlength=len(counts))
    rest = np.maximum(0, mass[docs] - about[which])
    rest *= (pairs[1] / (rest.sum(axis=1) + 1))[:, None]
    for c in range(about.shape[1]):
        out[:, c] = np.bincount(which, weights=rest[:, c], minlength=len(r))
    return out


def second_best(found: np.ndarray, held: np.ndarray, counts: np.ndarray, rank: int) -> np.ndarray:
    """Of each document the evidence of its `rank`-th strongest sentence on each subject; -inf with fewer sentences."""
    out = np.full((len(counts), found.shape[1]), -np.inf)
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    enough = counts >= rank
    for c in range(found.shape[1]):
        x = found[held, c]
        order = np.lexsort((-x, owner))
        out[enough, c] = x[order][starts[enough] + rank - 1]
    return out


def _accumulate(total: np.ndarray, feature: np.ndarray, sentence: np.ndarray, weight: np.ndarray) -> None:
    """Adds to each feature the weights of its sentences."""
    for c in range(weight.shape[1]):
        here = weight[:, c] > 0
        if here.any():
            at = here[sentence]
            total[:, c] += np.bincount(feature[at], weights=weight[sentence[at], c], minlength=len(total))


def _collect(df: DataFrame, classes: int) -> np.ndarray:
    """Sums of (feature, class, weight) parts; at most 8 * 2 ** BITS rows reach the driver."""
    sums = df.groupBy("f").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(classes)])
    table = sums.toArrow()
    out = np.zeros((_ROWS, classes))
    at = table.column("f").to_numpy()
    for k in range(classes):
        out[at, k] = table.column(f"c{k}").to_numpy()
    return out


def _parts(total: np.ndarray):
    import pyarrow as pa

    rows = np.flatnonzero(total.any(axis=1))
    for k in range(0, len(rows), 20_000):
        some = rows[k : k + 20_000]
        columns = [pa.array(some.astype(np.int32))] + [pa.array(total[some, c]) for c in range(total.shape[1])]
        yield pa.RecordBatch.from_arrays(columns, names=["f"] + [f"c{c}" for c in range(total.shape[1])])


_PARSED = "d array<bigint>, m array<int>, h array<int>, w array<int>, n array<int>, l array<tinyint>"


def parsed(documents: DataFrame, begin: frozenset[str], doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of parsed documents: `d` ids, `m` sentences of each, `h` which sentence of the block each is; of
    the block's different sentences `w` words, `n` numbers of words, `l` languages."""

    def run(batches):
        import pyarrow as pa

        features = Features(begin)

        def block(ids, texts):
            words, lengths, tongues, held, counts = features.parsed(texts)
            columns = ((np.array(ids, np.int64), np.int64), (counts, np.int32), (held, np.int32), (words, np.int32), (lengths, np.int32), (tongues, np.int8))
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x.astype(kind))) for x, kind in columns], names=list("dmhwnl"))

        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i is None or not t:
                    continue
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size > BLOCK_CHARS or len(ids) == BLOCK_DOCS:
                    yield block(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield block(ids, texts)

    return documents.select(F.col(doc).cast("bigint").alias("d"), F.col(text).alias("t")).mapInArrow(run, _PARSED)


def _blocks(batches):
    """(ids, sentences of each, occurrences, feature, its sentence, number of sentences) of each block."""
    for batch in batches:
        for row in range(batch.num_rows):
            d, m, h, w, n, l = (batch.column(k)[row].values.to_numpy(zero_copy_only=False).astype(np.int64) for k in range(6))
            feature, sentence = expanded(w, n, l)
            yield d, m, h, feature, sentence, len(n)


def _label_sets(labels: DataFrame, place: dict[str, int]) -> DataFrame:
    """(`d`, `s` numbers of its subjects) of each labelled document; unknown subjects are left out."""
    known = labels.where(F.col("subject").isin(list(place)) & F.col("doc_id").isNotNull())
    number = F.coalesce(*[F.when(F.col("subject") == name, k) for name, k in place.items()], F.lit(-1)) if place else F.lit(-1)
    return known.groupBy(F.col("doc_id").cast("bigint").alias("d")).agg(F.array_sort(F.collect_set(number)).alias("s"))


class Trained:
    """A model with the parsed documents that it was trained on."""

    def __init__(self, model: Model, blocks: DataFrame):
        self.model, self.blocks = model, blocks

    def areas(self, doc: str = "doc_id") -> DataFrame:
        return areas_of(self.blocks, self.model, doc)


def train(
    documents: DataFrame, labels: DataFrame, subjects: list[str], doc: str = "doc_id", text: str = "text", rounds: int = ROUNDS, own_rounds: int = OWN_ROUNDS, threshold: float = THRESHOLD
) -> Trained:
    """The calibrated model from labels (a few of them wrong) and all documents.

    Labels of documents that aren't there and of subjects that aren't listed are ignored. Without
    labels no sentence gets a subject. Null and empty texts are left out; ids that repeat are
    documents of their own.
    """
    spark = documents.sparkSession
    context = spark.sparkContext
    classes = len(subjects)
    place = {s: k for k, s in enumerate(subjects)}
    begin = starters(documents, text)
    schema = "f int, " + ", ".join(f"c{k} double" for k in range(classes))
    cuts = Cuts(spark, "subjects")
    blocks, _ = cuts.cut(parsed(documents, begin, doc, text))
    if not subjects:
        return Trained(Model([], np.zeros((_ROWS, 0), np.float32), begin, np.zeros((0, 2)), threshold), blocks)
    sets = _label_sets(labels, place)
    told_texts = documents.select(F.col(doc).cast("bigint").alias("_d"), F.col(text).alias("_t")).join(sets, F.col("_d") == F.col("d")).select("_d", "_t", "s")

    def from_labels(batches):
        features, sums = Features(begin), np.zeros((_ROWS, classes))
        for batch in batches:
            words, lengths, tongues, held, counts = features.parsed(batch.column(1).to_pylist())
            feature, sentence = expanded(words, lengths, tongues)
            weight = np.zeros((batch.num_rows, classes))
            for i, known in enumerate(batch.column(2).to_pylist()):
                weight[i, known] = 1 / max(1, len(known)) ** 2  # a document of several subjects says less of each
            each = np.zeros((len(lengths), classes))
            np.add.at(each, held, np.repeat(weight, counts, axis=0))
            _accumulate(sums, feature, sentence, each)
        yield from _parts(sums)

    told = _collect(told_texts.mapInArrow(from_labels, schema), classes)
    model = Model(subjects, complement_weights(told, classes), begin, threshold=threshold)
    beside = model.weights > 0
    before = None
    own = rounds == 0
    left = [rounds, own_rounds]
    while left[own]:
        left[own] -= 1
        shared = context.broadcast(model)

        def expect(batches, shared=shared, own=own):
            model = shared.value
            sums = np.zeros((_ROWS, classes + own))
            for _, m, h, feature, sentence, n in _blocks(batches):
                r = responsibilities(evidence(model, feature, sentence, n), model.threshold)
                _accumulate(sums, feature, sentence, r * np.bincount(h, minlength=n)[:, None] if own else others(r, h, m))
            yield from _parts(sums)

        counts = _collect(blocks.mapInArrow(expect, schema + (f", c{classes} double" if own else "")), classes + own)
        shared.unpersist()
        if own:  # what speaks for a subject must have done so beside other sentences
            weights = np.where(beside, complement_weights(counts, classes), np.minimum(0, model.weights))
        else:
            weights = complement_weights(counts + LABEL_WEIGHT * told, classes)
            beside = weights > 0
        model = Model(subjects, weights, begin, threshold=threshold)
        moved = 1.0 if before is None or before.shape != counts.shape else np.abs(counts - before).sum() / max(1e-9, counts.sum())
        before = counts
        if moved < SETTLED:
            left[own] = 0
        own = own or left[0] == 0
    return Trained(calibrated(model, blocks, sets), blocks)


_MIDDLES = np.arange(-3.0, 9.05, 0.1)
_SLOPES = np.array([0.5, 1.0, 1.5, 2.0, 3.0, 4.0])


def _logistic(x: np.ndarray, y: np.ndarray, middle: float, slope: float, classes: int) -> tuple[float, float]:
    """Middle and slope of P(subject) given the evidence, of most likelihood on a grid; labels are wrong at a
    rate, and both keep near what is given."""
    best, found = -np.inf, (middle, slope)
    high, low = 1 - WRONG, WRONG / max(1, classes)
    for k in _SLOPES:
        for m in _MIDDLES:
            p = low + (high - low) / (1 + np.exp(-np.clip(k * (x - m), -30, 30)))
            told = np.log(np.where(y > 0, p, 1 - p)).sum() - PRIOR / 2 * ((m - middle) ** 2 + np.log(k / slope) ** 2)
            if told > best + 1e-9:
                best, found = told, (float(m), float(k))
    return found


def calibrated(model: Model, blocks: DataFrame, sets: DataFrame) -> Model:
    """The model with a logistic function of each subject, fitted on at most CALIBRATION_DOCS labelled
    documents in the order of a hash: first one for all subjects, then each by itself around it."""
    chosen = sets.orderBy(F.xxhash64("d"), "d").limit(CALIBRATION_DOCS)
    rows = scores_of(blocks, model).join(chosen.withColumnRenamed("d", "_l"), F.col("d") == F.col("_l")).select("z", "s").toArrow()
    fitted = np.tile(np.array([-SLOPE * model.threshold, SLOPE]), (len(model.subjects), 1))
    if rows.num_rows:
        z = _clipped(np.array(rows.column("z").to_pylist()))
        y = np.zeros_like(z)
        for i, some in enumerate(rows.column("s").to_pylist()):
            y[i, some] = 1
        common = _logistic(z.ravel(), y.ravel(), model.threshold, SLOPE, len(fitted))
        for k in range(len(fitted)):
            middle, slope = _logistic(z[:, k], y[:, k], *common, len(fitted))
            fitted[k] = (-slope * middle, slope)
    return Model(model.subjects, model.weights, model.begin, fitted, model.threshold)


def _clipped(z: np.ndarray) -> np.ndarray:
    return np.clip(z, -6.0, 12.0)


def scores_of(blocks: DataFrame, model: Model, least: int = SENTENCES) -> DataFrame:
    """(`d`, `z` evidence of the `least`-th strongest sentence on each subject) of each document."""
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for d, m, h, feature, sentence, n in _blocks(batches):
            z = second_best(evidence(shared.value, feature, sentence, n), h, m, least)
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel()))], names=["d", "z"])

    return blocks.mapInArrow(run, "d bigint, z array<double>")


def areas_of(blocks: DataFrame, model: Model, doc: str = "doc_id", least: int = SENTENCES) -> DataFrame:
    """One row per document and subject with a calibrated posterior of one half or more: `doc`, `subject`,
    `n_sentences` (with as much evidence as the posterior needs), `n_total`, `posterior`.

    Documents with fewer than `least` sentences have no subject.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        model: Model = shared.value
        names = np.array(model.subjects, object)
        intercept, slope = model.calibration[:, 0], model.calibration[:, 1]
        for d, m, h, feature, sentence, n in _blocks(batches):
            found = evidence(model, feature, sentence, n)
            z = second_best(found, h, m, least)
            p = 1 / (1 + np.exp(-np.clip(intercept + slope * _clipped(z), -30, 30)))
            i, k = np.nonzero((p >= 0.5) & np.isfinite(z))
            owner = np.repeat(np.arange(len(d)), m)
            enough = intercept + slope * _clipped(found) >= 0
            devoted = np.stack([np.bincount(owner, weights=enough[h, c], minlength=len(d)) for c in range(len(names))], axis=1) if len(names) else np.zeros((len(d), 0))
            columns = [pa.array(d[i]), pa.array(names[k], pa.string()), pa.array(devoted[i, k].astype(np.int64)), pa.array(m[i]), pa.array(p[i, k])]
            yield pa.RecordBatch.from_arrays(columns, names=[doc, "subject", "n_sentences", "n_total", "posterior"])

    return blocks.mapInArrow(run, f"`{doc}` bigint, subject string, n_sentences bigint, n_total bigint, posterior double")


def areas(documents: DataFrame, model: Model, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The areas of any documents by a trained model. Null and empty texts have no subject. Whole texts are
    read; other columns are ignored."""
    return areas_of(parsed(documents, model.begin, doc, text), model, doc)
