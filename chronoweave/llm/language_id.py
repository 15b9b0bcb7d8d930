"""Language of a text from averaged hashed subword embeddings and a linear softmax.

Subwords are the runs of two to four bytes within a word, its edges marked, hashed to a fixed
number of buckets. A text is the mean of its subwords' embeddings; a linear layer and softmax
give the languages' probabilities. Both layers are trained in numpy by stochastic gradient
descent on a bounded sample of labelled rows. Part of the sample is kept from training and gives
the temperature that calibrates the probabilities and the confidence under which a text is
rejected. Prediction is one pass over the whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.llm.common import added, annotate, pieces, quoted, utf8

#: Buckets of subwords, lengths of subwords in bytes, size of an embedding.
BUCKETS, LENGTHS, SIZE = 8192, (2, 3, 4), 16
#: The sample: rows wanted for each language. So many that all languages have together MOST_ROWS are
#: enough, but LEAST_ROWS of each are wanted however many languages there are.
ROWS_PER_LANGUAGE, MOST_ROWS, LEAST_ROWS = 800, 51_200, 100
#: Training: passes, rows in a step, step size, seed.
PASSES, STEP_ROWS, RATE, SEED = 12, 32, 6.0, 11
#: Steps at least, for which a small sample has more passes; rows of each language in a pass at least,
#: for which a rare language's rows are repeated.
LEAST_STEPS, LEAST_SEEN = 960, 80
#: A text is rejected below the confidence that loses LOST of the rightly predicted texts, or below a
#: lower one that leaves at most WRONG of wrong languages where LOST would leave more; but always up
#: to MARGIN of the way from chance, which is one in the number of languages, to certainty.
MARGIN, WRONG, LOST = 0.15, 0.01, 0.001
#: What a text is called that has no letter.
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
#: Bytes of texts whose subwords are made at a time; scores of texts by languages made at a time.
_PIECE, _SCORES = 1 << 20, 1 << 20


def subwords(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length of subwords their buckets and the places where each text's ones begin."""
    folded = _FOLD[data].astype(np.uint32)
    blank = folded == 32
    out = []
    for length in LENGTHS:
        n = len(folded) - length + 1
        if n <= 0:
            out.append((np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)))
            continue
        code, ok = folded[:n].copy(), np.ones(n, bool)
        for k in range(1, length):
            code |= folded[k : k + n] << np.uint32(8 * k)
            if k < length - 1:
                ok &= ~blank[k : k + n]
        if length == 2:
            ok &= ~(blank[:n] & blank[1 : 1 + n])
        for k in range(1, length):  # those that reach into the next text
            crossing = offsets[1:-1] - k
            ok[crossing[(crossing >= 0) & (crossing < n)]] = False
        at = np.flatnonzero(ok)
        bucket = (code[at] * np.uint32(2654435761) + np.uint32(length * 40503)) * np.uint32(2246822519)
        out.append(((bucket >> np.uint32(32 - 13)).astype(np.int64) % BUCKETS, np.searchsorted(at, offsets)))
    return out


def group_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the rows of values from each place in at to the next."""
    sums = np.zeros((len(at) - 1, values.shape[1]))
    full = np.flatnonzero(at[1:] > at[:-1])
    if len(full):
        sums[full] = np.add.reduceat(values, at[full], axis=0)
    return sums


@dataclass
class Model:
    """languages; per bucket what it adds to each language's score; bias; temperature; threshold.

    With more languages than SIZE the table has the embeddings and `weight` makes scores of them.
    """

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    weight: np.ndarray | None = None

    def scores(self, means: np.ndarray) -> np.ndarray:
        """Scores of texts that are given by the means of their subwords' rows of the table."""
        return (means if self.weight is None else means @ self.weight) + self.bias

    def blocks(self, n: int) -> list[slice]:
        """Ranges of n texts whose scores are made together, however many languages there are."""
        step = max(1, _SCORES // len(self.languages))
        return [slice(a, min(n, a + step)) for a in range(0, n, step)]

    def best(self, means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best language's place and its probability for each text."""
        place, confidence = np.zeros(len(means), np.int64), np.zeros(len(means))
        for b in self.blocks(len(means)):
            p = self.confidences(self.scores(means[b]))
            place[b], confidence[b] = p.argmax(axis=1), p.max(axis=1)
        return place, confidence

    def confidences(self, scores: np.ndarray) -> np.ndarray:
        z = scores / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best language's place and its probability for each text."""
        n = len(offsets) - 1
        best, confidence = np.zeros(n, np.int64), np.zeros(n)
        for a, b in pieces(offsets, _PIECE):
            total, count = np.zeros((b - a, self.table.shape[1])), np.zeros(b - a)
            own = data[offsets[a] : offsets[b]]
            for bucket, at in subwords(own, offsets[a : b + 1] - offsets[a]):
                total += group_sums(self.table[bucket], at)
                count += np.diff(at)
            best[a:b], confidence[a:b] = self.best(total / np.maximum(count, 1)[:, None])
        return best, confidence


def bag(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares."""
    counts = np.zeros(BUCKETS, np.int64)
    for bucket, _ in subwords(data, np.array([0, len(data)])):
        counts += np.bincount(bucket, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, (counts[at] / max(1, counts.sum())).astype(np.float32)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: list[str]) -> Model:
    """Embeddings and softmax by stochastic gradient descent on the rows' bags of subwords."""
    rng = np.random.default_rng(SEED)
    embedding = rng.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32)
    weight, bias = np.zeros((SIZE, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    often = -(-LEAST_SEEN // np.maximum(1, np.bincount(labels, minlength=len(languages))))
    seen = np.repeat(np.arange(len(rows)), often[labels])
    in_pass = -(-len(seen) // STEP_ROWS)
    n_passes = max(PASSES, -(-LEAST_STEPS // in_pass))
    n_steps = n_passes * in_pass
    done = 0
    for _ in range(n_passes):
        for chosen in np.array_split(rng.permutation(seen), in_pass):
            at = np.concatenate([rows[i][0] for i in chosen])
            share = np.concatenate([rows[i][1] for i in chosen])[:, None]
            places = np.cumsum([0, *[len(rows[i][0]) for i in chosen]])
            mean = group_sums(embedding[at] * share, places).astype(np.float32)
            z = mean @ weight + bias
            e = np.exp(z - z.max(axis=1, keepdims=True))
            slope = e / e.sum(axis=1, keepdims=True)
            slope[np.arange(len(chosen)), labels[chosen]] -= 1
            slope *= RATE * (1 - done / n_steps) / len(chosen)
            back = slope @ weight.T
            weight -= mean.T @ slope
            bias -= 0.1 * slope.sum(axis=0)
            np.subtract.at(embedding, at, np.repeat(back, np.diff(places), axis=0) * share)
            done += 1
    if len(languages) > SIZE:
        return Model(languages, embedding, bias, weight=weight)
    return Model(languages, (embedding @ weight).astype(np.float32), bias)


def calibrate(model: Model, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
    """Sets temperature and threshold by rows that were not trained on.

    With one language every text is certain and none is rejected.
    """
    chance = 1 / len(model.languages)
    least = chance + MARGIN * (1 - chance)
    model.threshold = least
    if not rows:
        return
    means = np.array([share @ model.table[at] for at, share in rows])
    temperatures = np.geomspace(1, 20, 41)
    loss = dict.fromkeys(temperatures, 0.0)
    for b in model.blocks(len(rows)):
        scores, own = model.scores(means[b]), labels[b]
        for t in temperatures:
            model.temperature = float(t)
            loss[t] -= np.log(np.maximum(model.confidences(scores)[np.arange(len(own)), own], 1e-12)).sum()
    model.temperature = float(min(loss, key=loss.get))
    best, confidence = model.best(means)
    right = best == labels
    order = np.argsort(-confidence)
    wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(wrong <= WRONG)
    spared = max(least, np.quantile(confidence[right], LOST)) if right.any() else least
    # So few rows that none of them may be lost do not tell the quantile; it is taken nearer to least.
    spared = least + (spared - least) * min(1.0, right.sum() * LOST)
    fitted = len(good) and good[-1] == len(order) - 1
    wanted = spared if fitted or not len(good) else confidence[order[good[-1]]]
    model.threshold = float(max(least, min(wanted, spared)))


def remainder(id: Column, by: int) -> Column:
    """crc32 of the id as text modulo `by`; 0 for a null id."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % by, F.lit(0))


def fit(
    docs: DataFrame,
    learn: Column,
    text: str = "text",
    label: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> Model | None:
    """A model learned from the rows that `learn` holds for; None if there is nothing to learn.

    Every language is learned. At most rows_per_language rows of each are used, and of more than
    MOST_ROWS / rows_per_language languages MOST_ROWS together or LEAST_ROWS of each, drawn
    by a hash of the text, so that a language's copies are one row and the same table gives the
    same model. A fifth of them, by the same hash, calibrates; copies are not on both sides. Empty
    texts and null labels are not learned from.
    """
    own, content = docs[quoted(label)].cast("string"), docs[quoted(text)]
    named = docs.where(learn & own.isNotNull() & (F.octet_length(content) > 0))
    copies = F.xxhash64(content, F.lit("language"))
    counts = named.select(own.alias("l"), copies).distinct().groupBy("l").count().collect()
    if not counts:
        return None
    rows_per_language = min(rows_per_language, max(LEAST_ROWS, MOST_ROWS // len(counts)))
    share = [(r["l"], min(1.0, 1.3 * rows_per_language / r["count"])) for r in counts]
    share = F.broadcast(docs.sparkSession.createDataFrame(share, "of string, share double"))
    draw = F.pmod(copies, F.lit(1 << 40)) / float(1 << 40)
    sample = named.select(own.alias("label"), content.alias("text"), draw.alias("draw"))
    sample = sample.join(share, (F.col("label") == F.col("of")) & (F.col("draw") < F.col("share"))).drop("of", "share")

    def make() -> Callable:
        def work(texts: pa.Array) -> list[pa.Array]:
            each = texts.dictionary_encode()
            data, offsets = utf8(each.dictionary)
            bags = [bag(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            return [
                pa.array([at.astype("<u2").tobytes() for at, _ in bags], pa.binary()).take(each.indices),
                pa.array([s.astype("<f4").tobytes() for _, s in bags], pa.binary()).take(each.indices),
            ]

        return work

    bags = annotate(sample, "at binary, share binary", make, ["text"], ["label", "draw"])
    wanted = bags.select("draw", "label", added(bags, "at").alias("at"), added(bags, "share").alias("share"))
    place = F.row_number().over(Window.partitionBy("label").orderBy("draw", "at"))
    first = wanted.where(F.length("at") > 0).distinct().withColumn("place", place).where(F.col("place") <= rows_per_language)
    rows = sorted(first.collect(), key=lambda r: (r.draw, r.label, r.at))
    languages = sorted({r.label for r in rows})
    if not languages:
        return None
    place_of = {language: i for i, language in enumerate(languages)}
    labels = np.array([place_of[r.label] for r in rows])
    parsed = [(np.frombuffer(r.at, "<u2"), np.frombuffer(r.share, "<f4")) for r in rows]
    kept_back = np.array([int(r.draw * (1 << 40)) % 5 == 0 for r in rows])
    # A language without any other row is learned from those.
    kept_back &= (np.bincount(labels[~kept_back], minlength=len(languages)) > 0)[labels]
    model = train([parsed[i] for i in np.flatnonzero(~kept_back)], labels[~kept_back], languages)
    calibrate(model, [parsed[i] for i in np.flatnonzero(kept_back)], labels[kept_back])
    return model


def predict(docs: DataFrame, model: Model | None, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Columns `keep` of docs and, last, a struct: lang, score (0 to 1), rejected.

    Null texts and texts without a letter are `und` with score 0 and rejected, as is every text if
    there is no model; others get a learned language, rejected below the model's threshold. Whole
    texts are read; repeated rows each have their result; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        own = shared.value

        def work(texts: pa.Array) -> list[pa.Array]:
            data, offsets = utf8(texts)
            n = len(texts)
            plain = np.flatnonzero((_FOLD[data] >= 97) & (data < 128))
            lettered = np.diff(np.searchsorted(plain, offsets)) > 0
            for i in np.flatnonzero(~lettered & (offsets[1:] > offsets[:-1])):
                lettered[i] = _LETTER.search(texts[int(i)].as_py()) is not None
            best, score = own.predict(data, offsets) if own else (np.zeros(n, np.int64), np.zeros(n))
            if own is None:
                lettered[:] = False
            score[~lettered] = 0.0
            names = np.array([*(own.languages if own else []), UNKNOWN], object)
            names = names[np.where(lettered, best, len(names) - 1)]
            rejected = ~lettered | (score < (own.threshold if own else 0.0))
            return [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]

        return work

    return annotate(docs, "lang string, score double, rejected boolean", make, [text], keep)


def accepted_documents(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows whose language is not rejected, with their own columns.

    Without a model, as when no row has a language, only texts without a letter go.
    """
    if model is None:
        return docs.where(F.coalesce(docs[quoted(text)].rlike(r"\p{L}"), F.lit(False)))
    found = predict(docs, model, text=text)
    kept = found.where(~added(found, "rejected"))
    return kept.select(*[kept[quoted(c)] for c in docs.columns])
