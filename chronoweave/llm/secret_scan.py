"""Secrets in texts: expressions find the plain ones, Markov models of characters the rest.

One Markov chain of second order is learned for each kind of random string and one for ordinary
identifiers and words, all from labelled strings. A long token is reported when the log-likelihood ratio
of random against ordinary outweighs how rare secrets are among tokens.

Labels come from the corpus: what the expressions confirm is random, every other long token of all texts
is ordinary. Each different token counts once, so that no copied text outweighs the rest. Strings made
by rule are added, of each random kind and of ordinary identifiers in styles that prose lacks.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import annotate, added, quoted

#: Kinds in the order in which spans of one start are listed; the first three are always reported.
KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
ORDINARY = "ordinary"
#: Fewest characters of a token that is judged, and of one that is learned from as ordinary.
LEAST_JUDGED, LEAST_LEARNED = 16, 8
#: A token is reported if random is so many times likelier than ordinary, as one token in so many is a secret.
ODDS = 1e4
#: Weights of a character's probabilities after two, one and no characters before it, and what unseen contexts weigh.
SHARES, HELD = (0.6, 0.25, 0.15), 4.0
#: Strings made by rule for each kind; different tokens that a task holds before it passes them on.
MADE, HELD_TOKENS = 600, 200_000

# The alphabets of random strings by kind.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
# Words of which ordinary identifiers are made.
WORDS = (
    "account action address admin array async base batch buffer button cache callback channel char class client code column "
    "config connection content context count create data date default delete detail document element enable error event field "
    "file filter format function get group handler header height id image index info init input instance item key label last "
    "length level limit line list load local log manager map max message method min mode model module name node number object "
    "offset option order output page parent path position prefix process project property query read ref release request "
    "reset response result row scale schema server service session set size source start state status string style system "
    "table target task template test text time title total type update url user value version view width window write"
).split()

_CODES = np.zeros(256, np.int64)
for _i, _c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 1):
    _CODES[ord(_c)] = _i
#: Codes of characters; 0 stands for what is before a token.
N_CODES = int(_CODES.max()) + 1

# Only A-Z and a-z are each other's case.
_ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_JUDGED = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_JUDGED},}}")
_LEARNED = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_LEARNED},}}")


class Span(NamedTuple):
    """A find: kind, code points [start, end), where its value starts, and the value's log-likelihood ratio."""

    kind: str
    start: int
    end: int
    value: int
    score: float


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) of what the expressions find, by start, then kind."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span(), m.start(1)) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [("access", *m.span(), m.start()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def apart(places: Iterator[tuple[int, int]], spans: list[tuple[str, int, int, int]]) -> Iterator[tuple[int, int]]:
    """Of places in order those that overlap no span; spans are sorted by start."""
    at, reach = 0, 0
    for start, end in places:
        while at < len(spans) and spans[at][1] < end:
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= start:
            yield start, end


# Markov models -------------------------------------------------------------------------------


def grams(token: str) -> np.ndarray:
    """A number for each character of the token together with the two before it."""
    codes = np.zeros(len(token) + 2, np.int64)
    codes[2:] = _CODES[np.frombuffer(token.encode("ascii", "replace"), np.uint8)]
    return (codes[:-2] * N_CODES + codes[1:-1]) * N_CODES + codes[2:]


def log_chain(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of a character after two others, from counts of all three; less context fills gaps."""
    three = counts.reshape(N_CODES, N_CODES, N_CODES).astype(float)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    alone = (one + 1) / (one.sum() + N_CODES)
    after_one = (two + HELD * alone) / (two.sum(axis=1, keepdims=True) + HELD)
    after_two = (three + HELD * after_one) / (three.sum(axis=2, keepdims=True) + HELD)
    return np.log(SHARES[0] * after_two + SHARES[1] * after_one + SHARES[2] * alone).ravel()


class Model:
    """Log probabilities of the ordinary chain and of each random one."""

    def __init__(self, counts: dict[str, np.ndarray]):
        nothing = np.zeros(N_CODES**3)
        self.ordinary = log_chain(counts.get(ORDINARY, nothing)).astype(np.float32)
        self.random = np.array([log_chain(c) for kind, c in sorted(counts.items()) if kind != ORDINARY], np.float32)

    def ratio(self, token: str) -> float:
        """Log likelihood of the token as a random string, of whichever kind, less that as an ordinary one."""
        if not len(self.random) or not token:
            return 0.0
        at = grams(token)
        likely = self.random[:, at].sum(axis=1, dtype=float)
        most = float(likely.max())
        mixed = most + math.log(float(np.exp(likely - most).mean()))
        return mixed - float(self.ordinary[at].sum(dtype=float))

    def spans(self, text: str) -> list[Span]:
        """All spans of a text by start, then kind; those the models add overlap no other."""
        base = base_spans(text)
        found = [Span(k, s, e, v, self.ratio(text[v:e].replace(".", "="))) for k, s, e, v in base]
        for start, end in apart((m.span() for m in _JUDGED.finditer(text)), base):
            score = self.ratio(text[start:end])
            if score >= math.log(ODDS):
                found.append(Span("random", start, end, start, score))
        return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


# Labelled strings ----------------------------------------------------------------------------


def made_strings(n: int = MADE, seed: int = 11) -> list[tuple[str, str]]:
    """(token, label) of n strings of each random kind and as many ordinary identifiers in each of several styles."""
    draw = random.Random(seed)
    rows = [("".join(draw.choices(letters, k=draw.randint(16, 64))), kind) for kind, letters in ALPHABETS.items() for _ in range(n)]
    for _ in range(n):
        words = draw.choices(WORDS, k=draw.randint(2, 5))
        title = [w.title() for w in words]
        number = str(draw.randint(0, 10 ** draw.randint(1, 18)))
        rows += [
            (name, ORDINARY)
            for name in (
                "_".join(words), "-".join(words), "/".join(words), "/" + "/".join(words), "_".join(words).upper(), "".join(title),
                words[0] + "".join(title[1:]), "_".join([*words, number]), "-".join([words[0], number]), f"{words[0]}={words[1]}", number,
                f"20{draw.randint(0, 99):02}-{draw.randint(1, 12):02}-{draw.randint(1, 28):02}T{draw.randint(0, 235959):06}Z",
            )
        ]
    return rows + [(sign * k, ORDINARY) for sign in ALPHABETS["base64"] + "-_=" for k in (16, 40)]


def labelled_strings(docs: DataFrame, text: str = "text") -> DataFrame:
    """(token, label), each once: from the whole texts of docs and those made by rule.

    Hexadecimal runs and access keys are random, other long tokens outside all that the expressions find are
    ordinary. Null and empty texts give none; an empty table leaves those made by rule.
    """

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], None] = {}

        def held() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k in seen], pa.string()) for i in (0, 1)]
            seen.clear()
            return pa.RecordBatch.from_arrays(columns, names=["token", "label"])

        for batch in batches:
            for content in batch.column(0):
                own = content.as_py() or ""
                base = base_spans(own)
                seen.update(((own[s:e], "hex" if kind == "hex" else "upper"), None) for kind, s, e, _ in base if kind != "assign")
                seen.update(((own[s:e], ORDINARY), None) for s, e in apart((m.span() for m in _LEARNED.finditer(own)), base))
                if len(seen) > HELD_TOKENS:
                    yield held()
        yield held()

    found = docs.select(docs[quoted(text)].alias("text")).mapInArrow(collect, "token string, label string")
    return found.union(docs.sparkSession.createDataFrame(made_strings(), "token string, label string")).distinct()


def fit(samples: DataFrame) -> Model:
    """Markov chains of the labelled strings (token, label): one of ORDINARY ones, one of each other label.

    Characters outside the tokens' alphabet are one character. Null tokens or labels are left out, rows count
    as often as they stand there. Without random labels no token is judged random. The counts that reach the
    driver are bounded by the alphabet and the labels.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for token, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if label not in totals:
                    totals[label] = np.zeros(N_CODES**3, np.int64)
                np.add.at(totals[label], grams(token), 1)
        for label, total in totals.items():
            at = np.flatnonzero(total)
            columns = [pa.array([label] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(total[at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "gram", "n"])

    good = samples.select("token", "label").where("token is not null and label is not null")
    counted = good.mapInArrow(count, "label string, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    for r in counted.collect():
        counts.setdefault(r.label, np.zeros(N_CODES**3, np.int64))[r.gram] = r.n
    return Model(counts)


# Texts ---------------------------------------------------------------------------------------


def redact(text: str, spans: list[Span]) -> str:
    """The text with the value of each span, overlapping ones together, replaced by its kind in brackets."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.value, -s.end)):
        if s.value >= at:
            out += [text[at : s.value], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


FIELDS = "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string, scores array<double>, redacted string"


def find_secrets(docs: DataFrame, model: Model, keep: list[str] | None = None, text: str = "text", with_text: bool = True) -> DataFrame:
    """Columns `keep` of docs and, last, a struct of the secrets in each whole text.

    Its fields: counts by kind, the digest of the base spans, `spans` (kind:start:end in code points, by start,
    then kind, comma-joined), the log-likelihood ratios of their values, and with `with_text` the text with the
    values replaced. Null and empty texts have no spans, and null stays null when replaced. Repeated rows each
    have their result, an empty table gives an empty one, other columns may have any names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        own = shared.value

        def work(texts: pa.Array) -> list[pa.Array]:
            counts, sums, lists, scores, clean = [[] for _ in KINDS], [], [], [], []
            for value in texts:
                content = value.as_py()
                spans = own.spans(content or "")
                for n, kind in zip(counts, KINDS):
                    n.append(sum(s.kind == kind for s in spans))
                base = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans if s.kind in BASE)
                sums.append(hashlib.sha256(base.encode()).hexdigest())
                lists.append(",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans))
                scores.append([s.score for s in spans])
                clean.append(redact(content, spans) if with_text and spans else content if with_text else None)
            return [
                *[pa.array(n, pa.int64()) for n in counts],
                pa.array(sums, pa.string()),
                pa.array(lists, pa.string()),
                pa.array(scores, pa.list_(pa.float64())),
                pa.array(clean, pa.string()),
            ]

        return work

    return annotate(docs, FIELDS, make, [text], keep)


def redacted_documents(docs: DataFrame, model: Model, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """docs with secrets in `text` replaced by their kind; `length`, if there, is counted anew."""
    found = find_secrets(docs, model, text=text)

    def column(name: str) -> Column:
        if name == text:
            return added(found, "redacted").alias(name)
        if name == length:
            new = F.char_length(added(found, "redacted")).cast(docs.schema[name].dataType)
            return F.when(added(found, "spans") != "", new).otherwise(found[quoted(name)]).alias(name)
        return found[quoted(name)]

    return found.select(*[column(c) for c in docs.columns])
