"""Toxicity of texts whose words may be disguised, by decoding a noisy channel and then scoring.

Disguised stretches (digits and signs for letters, letters set apart, letters repeated) become
lattices of the characters that may have been meant, each with what the channel charges for it.
A Viterbi search finds the likeliest reading under a trigram model of characters, counted over
all texts. The restored text is scored by words and beginnings of words learned from labelled rows.

Character counts are combined in each task and come to as many rows as there are trigrams of 28
symbols. Words are counted over a bounded sample of labelled rows in Spark; the weights of a few
features of them are fitted in numpy on the part of the sample whose words were not counted.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import annotate, checkpoint, pieces, quoted, utf8

#: Labelled rows to learn from, at most.
TRAINING_ROWS = 24_000
#: Texts that a word must be in to be learned, and words that are learned at most, the surest first.
LEAST_TEXTS, MOST_WORDS = 4, 4000
#: Lengths of the beginnings of longer words that are learned like words; written with a hyphen.
BEGINNINGS = (4, 5, 6, 7)
#: Score from which a text is called toxic.
TOXIC = 0.7
#: What the channel charges: for a sign instead of its letter, for leaving a sign out, for a letter
#: said again in a run of three or more or of two, for reading a separator between single letters
#: as none or as the end of a word.
SIGN, DROPPED, AGAIN, TWICE, JOINED, PARTED = 0.7, 8.0, 0.5, 6.0, 0.1, 3.0
#: Disguised stretches whose reading a task remembers, and their characters; longer ones are read anew.
MOST_READINGS, LONGEST_REMEMBERED = 100_000, 256

# The letters that a digit or sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "*": "aeiou",
}

#: Symbols: 0 ends words, 1 to 26 are letters, 27 any letter beyond ASCII (one for each byte).
_SYMBOLS = 28
_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[65:91] = _SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = 27
_SIGN = "".join(SIGNS)
_MIXED = re.compile(rf"(?<![^\W_])(?<![{re.escape(_SIGN)}])(?=[a-z]*+[{re.escape(_SIGN)}])[a-z{re.escape(_SIGN)}]{{3,}}+")
_SPACED = re.compile(rf"(?<![^\W_])[a-z{re.escape(_SIGN)}](?:(?:[._*-]|\s++)[a-z{re.escape(_SIGN)}](?![^\W_])){{2,}}+")
_REPEATED = re.compile(r"(?<![^\W_])(?=[a-z]*([a-z])\1\1)[a-z]{3,}+(?![^\W_])")
_RUN = re.compile(r"([a-z])\1\1")
_WORD = re.compile(r"[^\W\d_]+")
_LETTER = re.compile(r"[a-z]")
_BLANKS = re.compile(r"\s+")


def trigram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of the trigrams of symbols over the whole texts of all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS**3, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in pieces(offsets, 1 << 20):
                s = _SYMBOL[data[offsets[a] : offsets[b]]]
                # A zero between texts, before the first and after the last.
                s = np.concatenate([[0], np.insert(s, (offsets[a + 1 : b + 1] - offsets[a]), 0)]).astype(np.int32)
                if len(s) > 2:
                    total += np.bincount((s[:-2] * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:], minlength=_SYMBOLS**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["code", "n"])

    rows = docs.select(docs[quoted(text)].cast("string")).mapInArrow(count, "code int, n long")
    total = np.zeros(_SYMBOLS**3, np.int64)
    for r in rows.groupBy("code").agg(F.sum("n").alias("n")).collect():
        total[r.code] = r.n
    return total.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)


def trigram_costs(counts: np.ndarray) -> np.ndarray:
    """What the model charges for a symbol after two others: its negative log probability.

    Trigrams back off to bigrams, those to single symbols, by additive smoothing.
    """
    one = counts.sum((0, 1)) + 1.0
    two = counts.sum(0) + 2.0 * one / one.sum()
    three = counts + 2.0 * (two / two.sum(1, keepdims=True))[None]
    return -np.log(three / three.sum(2, keepdims=True))


class Decoder:
    """Finds disguised stretches of a text in lower case and restores them."""

    def __init__(self, costs: np.ndarray) -> None:
        self.costs = costs.tolist()
        self.readings: dict[tuple[str, bool], str] = {}

    def restore(self, text: str) -> str:
        text = _SPACED.sub(self._spaced, text)
        text = _MIXED.sub(self._mixed, text)
        return _REPEATED.sub(lambda m: self._read(m[0], False), text) if _RUN.search(text) else text

    def _spaced(self, m: re.Match) -> str:
        stretch = _BLANKS.sub(" ", m[0])
        # Three digits or signs set apart are no word.
        return self._read(stretch, True) if len(stretch) > 5 or _LETTER.search(stretch) else m[0]

    def _mixed(self, m: re.Match) -> str:
        whole = m[0]
        inner = whole.rstrip("!|+*$@")
        if not inner[:2].strip("!|+*$@"):
            inner = inner.lstrip("!|+*$@")
        if len(inner) < 3 or inner.isalpha() or not _LETTER.search(inner):
            return whole
        return whole.replace(inner, self._read(inner, False), 1)

    def _read(self, stretch: str, spaced: bool) -> str:
        if len(stretch) > LONGEST_REMEMBERED:
            return self.viterbi(stretch, spaced)
        known = self.readings.get((stretch, spaced))
        if known is None:
            if len(self.readings) >= MOST_READINGS:
                self.readings.clear()
            known = self.readings[stretch, spaced] = self.viterbi(stretch, spaced)
        return known

    def lattice(self, stretch: str, spaced: bool) -> list[list[tuple[int, float]]]:
        """For each character its readings: a symbol (-1 for none) and what the channel charges."""
        out, last = [], ""
        for i, c in enumerate(stretch):
            if spaced and c in " ._*-":
                out.append([(-1, JOINED), (0, PARTED)])
                continue
            if "a" <= c <= "z":
                options = [(ord(c) - 96, 0.0)]
                if c == last:
                    options.append((-1, AGAIN if c * 3 in stretch[max(0, i - 2) : i + 3] else TWICE))
            else:
                options = [*[(ord(x) - 96, SIGN) for x in SIGNS.get(c, "")], (-1, AGAIN if c == last else DROPPED)]
            out.append(options)
            last = c
        return out

    def viterbi(self, stretch: str, spaced: bool) -> str:
        """The reading of least cost: the channel's and, for each symbol, the language model's."""
        # By the last two symbols: cost and the reading as a linked list.
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for options in self.lattice(stretch, spaced):
            ahead: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, path) in best.items():
                for symbol, charge in options:
                    if symbol < 0:
                        state, value, way = (a, b), cost + charge, path
                    else:
                        state, value, way = (b, symbol), cost + charge + self.costs[a][b][symbol], (symbol, path)
                    if state not in ahead or value < ahead[state][0]:
                        ahead[state] = (value, way)
            best = ahead
        path = min(((cost + self.costs[a][b][0], i, path) for i, ((a, b), (cost, path)) in enumerate(best.items())))[2]
        symbols = []
        while path is not None:
            symbols.append(path[0])
            path = path[1]
        return "".join(" " if s == 0 else chr(s + 96) for s in reversed(symbols))


@dataclass
class Model:
    """Costs of the character model, weights of words, and of the features of a text."""

    costs: np.ndarray
    words: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(6))
    means: np.ndarray = field(default_factory=lambda: np.zeros(5))
    spreads: np.ndarray = field(default_factory=lambda: np.ones(5))

    def __post_init__(self) -> None:
        #: What a word must begin with for any of its forms to be known.
        self.starts = {form[: min(BEGINNINGS)] for form in self.words}

    def features(self, words: set[str]) -> list[float]:
        """Of the weights of a text's words: the three largest and the sum of all; and their number.

        A word counts by the surest of itself and its learned beginnings.
        """
        known, starts, n, found = self.words, self.starts, min(BEGINNINGS), []
        for word in words:
            if word[:n] not in starts:
                continue
            forms = [known[f] for f in (word, *beginnings(word)) if f in known]
            if forms:
                found.append(max(forms))
        found.sort(reverse=True)
        return [*found[:3], *[0.0] * (3 - len(found)), math.log1p(sum(found)), math.log1p(len(words))]

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.weights[0] + ((features - self.means) / self.spreads) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def beginnings(word: str) -> list[str]:
    return [word[:n] + "-" for n in BEGINNINGS if len(word) > n]


def words_of(text: str | None, decoder: Decoder) -> set[str]:
    """The distinct words of a text once it is restored."""
    return set(_WORD.findall(decoder.restore((text or "").lower())))


def sample(docs: DataFrame, labels: DataFrame, learn: Column, id: str, text: str, label: str, rows: int) -> DataFrame:
    """(text, toxic, part) of at most `rows` labelled rows, each distinct text once.

    Rows are drawn by a hash of the id; half of the room is for toxic ones, if there are so many.
    """
    own = labels.select(labels["doc_id"].alias("of"), labels[quoted(label)].cast("int").alias("toxic")).where("toxic in (0, 1)")
    learned = docs.where(learn).select(docs[quoted(id)].alias("id"))
    own = own.groupBy("of").agg(F.max("toxic").alias("toxic")).join(learned, F.col("of") == F.col("id"), "left_semi")
    draw = F.xxhash64(F.col("of").cast("string"), F.lit("toxicity"))
    half = [own.where(F.col("toxic") == t).orderBy(draw, "of").limit(rows // 2) for t in (0, 1)]
    chosen = checkpoint(half[0].union(half[1]))
    content = F.coalesce(docs[quoted(text)].cast("string"), F.lit(""))
    named = docs.where(learn).select(docs[quoted(id)].alias("id"), content.alias("text"))
    named = named.join(F.broadcast(chosen), F.col("id") == F.col("of"))
    texts = named.groupBy("text").agg(F.max("toxic").alias("toxic"))
    return checkpoint(texts.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(3))))


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAINING_ROWS
) -> Model:
    """A model from all texts of docs and from the labelled rows that `learn` holds for.

    Without labelled rows of either kind every text scores alike.
    """
    model = Model(trigram_costs(trigram_counts(docs, text)))
    shared = docs.sparkSession.sparkContext.broadcast(model.costs)
    chosen = sample(docs, labels, learn, id, text, label, rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, seen = Decoder(shared.value), (Counter(), Counter())

        def counted() -> pa.RecordBatch:
            words = list(seen[0].keys() | seen[1].keys())
            columns = [pa.array([s[w] for w in words], pa.int64()) for s in seen]
            for s in seen:
                s.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *columns], names=["word", "clean", "toxic"])

        for batch in batches:
            for content, toxic in zip(*batch.columns):
                words = words_of(content.as_py(), decoder)
                seen[toxic.as_py()].update(words.union(*map(beginnings, words)))
                if len(seen[0]) + len(seen[1]) > 200_000:
                    yield counted()
        yield counted()

    learned = chosen.where("part > 0")
    sizes = dict(learned.groupBy("toxic").count().collect())
    if not sizes.get(0) or not sizes.get(1):
        return model
    n, t = F.col("clean") + 0.5, F.col("toxic") + 0.5
    # A word counts by the lower end of what its texts say for its log odds.
    odds = F.log(t / (sizes[1] + 1)) - F.log(n / (sizes[0] + 1)) - F.sqrt(1 / t + 1 / n)
    counts = learned.select("text", "toxic").mapInArrow(count, "word string, clean long, toxic long")
    total = counts.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sure = total.where(F.col("toxic") >= LEAST_TEXTS).withColumn("weight", odds).where("weight > 0.5")
    best = sure.orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "word").limit(MOST_WORDS)
    model = Model(model.costs, {r.word: r.weight for r in best.select("word", "weight").collect()})
    scored = _features(chosen.where("part = 0"), model, ["toxic"], "text").select("toxic", "found.features")
    rows_ = [(r.toxic, r.features) for r in scored.collect()]
    if rows_:
        _regress(model, np.array([f for _, f in rows_]), np.array([y for y, _ in rows_], float), sizes)
    return model


def _regress(model: Model, x: np.ndarray, y: np.ndarray, sizes: dict[int, int]) -> None:
    """Logistic regression by Newton steps, lightly held towards zero."""
    model.means, model.spreads = x.mean(0), np.maximum(x.std(0), 1e-6)
    a = np.column_stack([np.ones(len(x)), (x - model.means) / model.spreads])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) + 0.1 * w
        bend = (a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w


def _features(docs: DataFrame, model: Model, keep: list[str], text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        own = shared.value
        decoder = Decoder(own.costs)

        def work(texts: pa.Array) -> list[pa.Array]:
            rows = [own.features(words_of(value.as_py(), decoder)) for value in texts]
            score = own.score(np.array(rows, float).reshape(-1, len(own.means)))
            return [pa.array(rows, pa.list_(pa.float64())), pa.array(score, pa.float64())]

        return work

    found = annotate(docs, "features array<double>, score double", make, [text], keep)
    return found.withColumnRenamed(found.columns[-1], "found")


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` of docs and `found`, a struct with the text's features and score (0 to 1).

    Null and empty texts are scored as texts without learned words. Whole texts are read; repeated
    rows each have their result; an empty table gives an empty one.
    """
    return _features(docs, model, keep, text)


def restored_documents(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` of docs and, last, a struct with the restored text in lower case."""
    shared = docs.sparkSession.sparkContext.broadcast(model.costs)

    def make() -> Callable:
        decoder = Decoder(shared.value)
        return lambda texts: [pa.array([decoder.restore((t.as_py() or "").lower()) for t in texts], pa.string())]

    return annotate(docs, "restored string", make, [text], keep)
