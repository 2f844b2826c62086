"""Languages of documents, lines and mixed-language spans (p2).

Script ranges narrow the candidates of each word (Han: zh, Cyrillic: ru or another language, Latin: five
languages; kana, Hangul and other scripts: another language, shown as "other"). Letters that Russian doesn't
have speak against it. A
Latin word's score is its log-probability in each language, from counts over labelled rows; an
unknown word's comes from a character n-gram model of the same counts. Viterbi over the words of a
line, with a fixed penalty for a switch of language, labels its spans. Labels of the training sample
are partly wrong, so its lines are relabelled by the model and counted again for a few rounds.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("de", "en", "es", "fr", "pt", "ru", "zh")
LATIN = LANGUAGES[:5]
RU, ZH = 5, 6
OTHER = 7  #: a language that isn't one of the seven
NAMES = (*LANGUAGES, "other")

SAMPLE_ROWS = 8_000  #: at most so many labelled rows of each table fit the word scores
VOCABULARY = 50_000  #: at most so many words have scores of their own; others use the n-grams
SWITCH = 7.0  #: penalty (nats) for a change of language between two words; five words of which three are clear pay two
CLIP = 4.0  #: the most (nats) by which one word may favour a language over the best other
MIN_WORDS, MIN_HAN = 5, 8

# Words for "language not known".
UNKNOWN_LABELS = frozenset({"", "unknown", "unk", "und", "undefined", "undetermined", "none", "null", "na", "n/a", "nan", "?", "-", "xx", "zxx", "mis", "mul", "auto", "other"})
# Names of the languages that labels may use instead of codes.
LABEL_NAMES = {
    "english": "en", "eng": "en", "german": "de", "deutsch": "de", "ger": "de", "deu": "de", "french": "fr", "français": "fr", "francais": "fr",
    "fra": "fr", "fre": "fr", "spanish": "es", "español": "es", "espanol": "es", "spa": "es", "portuguese": "pt", "português": "pt", "portugues": "pt",
    "por": "pt", "russian": "ru", "русский": "ru", "rus": "ru", "chinese": "zh", "zho": "zh", "chi": "zh", "cmn": "zh", "中文": "zh",
}
# Frequent function words, the prior of the word scores.
SEEDS = {
    "de": "der die das und ist nicht ich du er sie es wir ihr ein eine einen dem den des im in zu mit auf für von bei nach über wie was wenn aber oder auch noch schon hat haben sind wird",
    "en": "the and is not i you he she it we they a an of in to with on for from by at about how what when but or also still has have are will this that was were be do does",
    "es": "el la los las y es no yo tú él ella un una de en con para por del al como qué cuando pero o también ya ha han son será este esta que se lo muy más hay",
    "fr": "le la les et est ne pas je tu il elle nous vous un une des de du en dans avec pour par sur au aux comme que quand mais ou aussi a ont sont ce cette qui se plus y",
    "pt": "o a os as e é não eu tu ele ela nós um uma de em com para por do da no na ao como que quando mas ou também já há são será este esta se muito mais você",
}

_HAN = re.compile("[㐀-䶿一-鿿豈-﫿]")
_NOT_RUSSIAN = re.compile("[іїєґўђѓјљњћќџѕәғқңөұүһӣӯҷ]")  # letters of other languages in Cyrillic
_FOREIGN = re.compile(r"[\u0370-\u03ff\u0530-\u06ff\u0900-\u0dff\u0e00-\u0e7f\u10a0-\u10ff\u1100-\u11ff\u3040-\u30ff\uac00-\ud7af]")  # scripts of no language here
_WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*$")
_EDGE = "\"'`’‘“”«»„‚.,;:!?¡¿()[]{}<>…-–—*•~|#"
_TIME = re.compile(r"\[?\d{1,2}:\d{2}(?::\d{2})?\]?$")
_CODE = re.compile(r"```.*?```|`[^`]*`")
# A mail address spelt out ("name AT host DOT example", "name (at) host (dot) example") is a login, not words.
_SPELT = re.compile(r"\S+\s+[(\[{<]?at[)\]}>]?\s+\S+(?:\s+[(\[{<]?dot[)\]}>]?\s+\S+)+", re.I)


def label_of(label: str | None) -> str | None:
    """The language a delivered label names; None if it names none."""
    text = (label or "").strip().lower()
    if text in UNKNOWN_LABELS:
        return None
    base = re.split(r"[-_ ]", text)[0]
    if base in UNKNOWN_LABELS:
        return None
    return LABEL_NAMES.get(base, base)


def _grams(word: str) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


@dataclass
class Model:
    """Scores of words and trigrams, one row of differences to the best language each."""

    words: dict[str, int]
    scores: np.ndarray  #: float32, one row a word, columns as LATIN
    grams: dict[str, int]
    gram_scores: np.ndarray

    def score(self, word: str) -> np.ndarray:
        k = self.words.get(word)
        if k is not None:
            return self.scores[k]
        known = [j for g in _grams(word) if (j := self.grams.get(g)) is not None]
        if not known:
            return np.zeros(len(LATIN), np.float32)
        row = self.gram_scores[known].sum(axis=0) * 0.5
        return np.maximum(row - row.max(), -CLIP / 2)


def _normal(counts: np.ndarray, smoothing: float) -> np.ndarray:
    total = counts.sum(axis=0, keepdims=True) + smoothing * max(1, len(counts))
    logs = np.log((counts + smoothing) / total)
    return np.maximum(logs - logs.max(axis=1, keepdims=True), -CLIP).astype(np.float32)


def latin_words(line: str) -> list[str]:
    """The lower-case Latin words of a line, code and labels left out."""
    return [w for w, kind in words_of(line) if kind == 0]


def words_of(line: str) -> list[tuple[str, int]]:
    """(word, kind) of a line: kind 0 Latin, 1 Cyrillic, 2 a run with Han characters, 3 another script.

    Chunks with digits, signs or markup between their letters are code, links or logins, not words;
    a leading time and a leading chunk that ends in a colon are a sender's label.
    """
    if "`" in line:
        line = _CODE.sub(" ", line)
    if "dot" in line or "DOT" in line:
        line = _SPELT.sub(" ", line)
    out, lead = [], True
    for chunk in line.split():
        if lead:
            bare = chunk.strip(_EDGE)
            if _TIME.match(chunk) or not bare:
                continue
            lead = False
            if chunk.endswith(":") and not _HAN.search(chunk):
                continue
        if (kind := _kind(chunk)) is not None:
            out.append(kind)
    return out


def _kind(chunk: str) -> tuple[str, int] | None:
    if not chunk.isascii() and _FOREIGN.search(chunk):
        return chunk, 3
    if _HAN.search(chunk):
        return chunk, 2
    bare = chunk.strip(_EDGE).lower()
    if not _WORD.match(bare):
        return None
    first = bare[0]
    if "Ѐ" <= first <= "ԯ":
        return bare, 1
    if first < "ɐ" or "Ḁ" <= first <= "ỿ":
        return bare, 0
    return None


def fit(rows: list[tuple[str | None, str]], rounds: int = 3) -> Model:
    """Word scores from (label, text) rows whose labels may be wrong; seeds alone if there are none."""
    lines: list[tuple[int, list[str]]] = []
    for label, text in rows:
        code = label_of(label)
        if code in LATIN:
            for line in text.split("\n"):
                if len(words := latin_words(line)) >= 3:
                    lines.append((LATIN.index(code), words))
    total = Counter(w for _, words in lines for w in words)
    seeds = {code: text.split() for code, text in SEEDS.items()}
    vocabulary = [w for w, n in total.most_common(VOCABULARY) if n > 1]
    index = {w: i for i, w in enumerate(vocabulary)}
    for words in seeds.values():
        for w in words:
            index.setdefault(w, len(index))
    prior = np.zeros((len(index), len(LATIN)))
    for j, code in enumerate(LATIN):
        for w in seeds[code]:
            prior[index[w], j] += 3
    encoded = [(j, np.array([index[w] for w in words if w in index], np.int64)) for j, words in lines]
    assigned = [j for j, _ in encoded]
    scores = _normal(prior, 0.5)
    for k in range(rounds):
        counts = prior.copy()
        for (_, ids), j in zip(encoded, assigned):
            if j >= 0:
                np.add.at(counts[:, j], ids, 1)
        scores = _normal(counts, 0.3)
        if k < rounds - 1:
            assigned = []
            for _, ids in encoded:
                sums = np.sort(scores[ids].sum(axis=0)) if len(ids) else np.zeros(2)
                assigned.append(int(scores[ids].sum(axis=0).argmax()) if sums[-1] - sums[-2] > 2 else -1)
    grams: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(LATIN)))
    shares = counts / np.maximum(1e-9, counts.sum(axis=1, keepdims=True))
    for w, i in index.items():
        if len(w) > 2 and shares[i].max() > 0.8:  # words of one language teach its spelling
            for g in _grams(w):
                grams[g] += shares[i]
    names = list(grams)
    gram_counts = np.array([grams[g] for g in names]) if names else np.zeros((0, len(LATIN)))
    return Model(index, scores, {g: i for i, g in enumerate(names)}, _normal(gram_counts, 0.5) if names else gram_counts)


def viterbi(emissions: np.ndarray, starts: np.ndarray, lengths: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The best state of every word, lines side by side. `emissions` (words, states) in line order."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    counts = np.searchsorted(-lengths, -np.arange(longest), side="left")  # lines longer than t
    states = emissions.shape[1]
    back = np.empty(emissions.shape, np.int8)
    own = np.arange(states, dtype=np.int8)[None, :]
    score = np.zeros((len(lengths), states), np.float32)
    for t in range(longest):
        n = counts[t]
        at = starts[:n] + t
        if t:
            best = score[:n].argmax(axis=1)
            jump = score[np.arange(n), best] - penalty
            stay = score[:n] >= jump[:, None]
            back[at] = np.where(stay, own, best[:, None].astype(np.int8))
            score[:n] = np.where(stay, score[:n], jump[:, None])
        score[:n] += emissions[at]
    labels = np.empty(len(emissions), np.int8)
    state = np.zeros(len(lengths), np.int64)
    for t in range(longest - 1, -1, -1):
        n = counts[t]
        ends = slice(counts[t + 1] if t + 1 < longest else 0, n)
        state[ends] = score[ends].argmax(axis=1)
        at = starts[:n] + t
        labels[at] = state[:n]
        if t:
            state[:n] = back[at, state[:n]]
    return labels


class Labeller:
    """Labels the lines of texts, batch by batch, with a growing table of the scores of words met."""

    MEMO = 200_000

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        n = len(NAMES)
        # Rows of the table: Cyrillic words, Han text, Cyrillic words that aren't Russian, other scripts.
        self.table = np.full((1024, n), -12.0, np.float32)
        self.table[0, RU], self.table[0, OTHER] = 0, -1.5
        self.table[1, ZH] = 0
        self.table[2, RU], self.table[2, OTHER] = -CLIP, 0
        self.table[3, OTHER] = 0
        self.used = 4
        self.memo: dict[str, int] = {}

    def _token(self, chunk: str) -> int:
        """Row of a chunk's scores; -1 for no word, -2 for Han text (not remembered)."""
        kind = _kind(chunk)
        if kind is None:
            k = -1
        elif kind[1] == 2:
            return -2
        elif kind[1] == 1:
            k = 2 if _NOT_RUSSIAN.search(kind[0]) else 0
        elif kind[1] == 3:
            k = 3
        else:
            if self.used == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            k = self.used
            self.table[k] = -12.0
            self.table[k, : len(LATIN)] = self.model.score(kind[0])
            self.used += 1
        self.memo[chunk] = k
        return k

    def spans(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """(text, line, span, language, words or Han characters, confidence) of every span of the texts."""
        if len(self.memo) > self.MEMO:
            self._clear()
        tokens: list[int] = []
        sizes: list[int] = []
        owner: list[int] = []
        numbers: list[int] = []
        lengths: list[int] = []
        memo, token = self.memo, self._token
        for i, text in enumerate(texts):
            if not text:
                continue
            fenced = False
            for number, line in enumerate(text.split("\n")):
                if "`" in line:
                    fence = line.count("```") % 2
                    if fenced or fence:
                        was, fenced = fenced, fenced ^ bool(fence)
                        line = line.rpartition("```")[2] if was and fence else "" if was else line.partition("```")[0]
                    line = _CODE.sub(" ", line)
                elif fenced:
                    continue
                if "dot" in line or "DOT" in line:
                    line = _SPELT.sub(" ", line)
                before, lead = len(tokens), True
                for chunk in line.split():
                    if lead:
                        if _TIME.match(chunk) or not chunk.strip(_EDGE):
                            continue
                        lead = False
                        if chunk.endswith(":") and not _HAN.search(chunk):
                            continue
                    k = memo.get(chunk)
                    if k is None:
                        k = token(chunk)
                    if k >= 0:
                        tokens.append(k)
                        sizes.append(1)
                    elif k == -2:
                        tokens.append(1)
                        sizes.append(len(_HAN.findall(chunk)))
                if len(tokens) > before:
                    owner.append(i)
                    numbers.append(number)
                    lengths.append(len(tokens) - before)
        if not tokens:
            none = np.zeros(0, np.int64)
            return none, none, none, none, none, np.zeros(0)
        ids, weights, sizes_of = np.array(tokens), np.array(sizes, np.int64), np.array(lengths)
        starts = np.concatenate([[0], np.cumsum(sizes_of)[:-1]])
        emissions = self.table[ids]
        # A chunk of Han text is as many words as its characters make: it isn't lost between two switches.
        han = np.flatnonzero(ids == 1)
        emissions[han] *= (1 + weights[han] // 4)[:, None]
        labels = viterbi(emissions, starts, sizes_of)
        line_of = np.repeat(np.arange(len(sizes_of)), sizes_of)
        first = np.ones(len(ids), bool)
        first[1:] = (labels[1:] != labels[:-1]) | (line_of[1:] != line_of[:-1])
        at = np.flatnonzero(first)
        sums = np.add.reduceat(emissions, at, axis=0).astype(np.float64)
        shifted = np.exp((sums - sums.max(axis=1, keepdims=True)) / 2)
        confidence = shifted[np.arange(len(at)), labels[at]] / shifted.sum(axis=1)
        lines = line_of[at]
        new_line = np.ones(len(at), bool)
        new_line[1:] = lines[1:] != lines[:-1]
        opened = np.maximum.accumulate(np.where(new_line, np.arange(len(at)), 0))
        return np.array(owner)[lines], np.array(numbers)[lines], np.arange(len(at)) - opened, labels[at].astype(np.int64), np.add.reduceat(weights, at), confidence


_MINIMUM = np.array([MIN_WORDS] * 6 + [MIN_HAN, MIN_WORDS])


def training_rows(df: DataFrame, row: str, label: str, text: str, limit: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """At most `limit` labelled rows for fitting, those of the lowest hashes of their numbers, with whole texts."""
    labelled = df.select(F.col(row).alias("r"), F.col(label).alias("l"), F.col(text).alias("t")).where(F.col("l").isNotNull() & F.col("t").isNotNull())
    total = df.count()
    share = min(1.0, 1.5 * limit / max(1, total))
    place = F.pmod(F.xxhash64("r", F.lit(17)), F.lit(1 << 30))
    chosen = labelled.withColumn("h", place).where(F.col("h") < int(share * (1 << 30)))
    return [(r["l"], r["t"]) for r in chosen.orderBy("h", "r").limit(limit).select("l", "t").collect()]


def fit_tables(tables: list[tuple[DataFrame, str, str, str]]) -> Model:
    """A model from the labelled rows of several (table, row column, label column, text column)."""
    return fit([r for df, row, label, text in tables for r in training_rows(df, row, label, text)])


def _rows(df: DataFrame, name: str, row: str, label: str, text: str) -> DataFrame:
    return df.select(F.lit(name).alias("tbl"), F.col(row).cast("bigint").alias("row_no"), F.col(label).alias("label"), F.col(text).alias("text"))


def spans(df: DataFrame, name: str, row: str, label: str, text: str, model: Model) -> DataFrame:
    """Every span of every line: `tbl`, `row_no`, `line_no`, `span_no`, `lang`, `n_units`, `confidence`.

    `n_units` counts words, for zh Han characters; `lang` is "other" for a language beyond the seven. Null and empty texts, and lines without words,
    have no spans. Columns beyond the three named ones are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        labeller = Labeller(shared.value)
        for batch in batches:
            i, line, span, lang, size, sure = labeller.spans(batch.column(3).to_pylist())
            names = np.array(NAMES, object)[lang]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(i)), batch.column(1).take(pa.array(i)), pa.array(line), pa.array(span), pa.array(names, pa.string()), pa.array(size), pa.array(sure)],
                names=["tbl", "row_no", "line_no", "span_no", "lang", "n_units", "confidence"],
            )

    schema = "tbl string, row_no bigint, line_no bigint, span_no bigint, lang string, n_units bigint, confidence double"
    return _rows(df, name, row, label, text).mapInArrow(run, schema)


def mislabelled(df: DataFrame, name: str, row: str, label: str, text: str, model: Model) -> DataFrame:
    """Lines of the rows whose label is missing, wrong, or whose text mixes languages.

    Gives `tbl`, `row_no`, `line_no`, `lang` for each line and each language of which the line has a
    span of at least five words (zh: eight characters). Rows without such a span give no row; spans of a
    language beyond the seven are left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        labeller = Labeller(shared.value)
        for batch in batches:
            i, line, _, lang, size, _ = labeller.spans(batch.column(3).to_pylist())
            keep = (size >= _MINIMUM[lang]) & (lang != OTHER)
            i, line, lang = i[keep], line[keep], lang[keep]
            n = batch.num_rows
            present = np.zeros((n, len(LANGUAGES)), bool)
            present[i, lang] = True
            codes: dict[str | None, int] = {}
            said = np.array([codes[x] if x in codes else codes.setdefault(x, LANGUAGES.index(c) if (c := label_of(x)) in LANGUAGES else -1) for x in batch.column(2).to_pylist()], np.int64)
            right = (present.sum(axis=1) == 1) & (said >= 0) & present[np.arange(n), np.maximum(said, 0)]
            case = ~right[i]
            keys = np.unique(np.stack([i[case], line[case], lang[case]]), axis=1) if case.any() else np.zeros((3, 0), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keys[0])), batch.column(1).take(pa.array(keys[0])), pa.array(keys[1], pa.int64()), pa.array(np.array(LANGUAGES, object)[keys[2]], pa.string())],
                names=["tbl", "row_no", "line_no", "lang"],
            )

    return _rows(df, name, row, label, text).mapInArrow(run, "tbl string, row_no bigint, line_no bigint, lang string")
