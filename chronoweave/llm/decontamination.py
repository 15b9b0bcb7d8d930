"""Benchmark passages in training texts, found with suffix arrays over the training words.

Each task reads its documents in shards of a few MB and builds a suffix array of each shard's
words: all suffixes that begin with a word of the benchmark (no other can match), sorted as far
as a benchmark item is long. Every suffix of every item that holds a whole window is then
looked up by binary search, several words in each step. The interval that it ends in holds all
places of the window; from there the longest verbatim match is read off. Documents never move, so
there is no shuffle, whatever a passage's frequency. The benchmark is cut into blocks of bounded
size that are broadcast one by one, each block adding its finds to those of the blocks before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import added, annotate, pieces, quoted, utf8, word_bounds, word_hashes

#: Words in a window; shorter items are one window.
WINDOW = 10
#: Bytes of documents in a shard, and of benchmark texts in a broadcast block.
SHARD_BYTES, BLOCK_BYTES = 4 << 20, 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of words: digits, small letters and all bytes of characters beyond ASCII.
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """The bytes in lower case, the words' starts, ends and hashes, and each text's first word."""
    low = _LOWER[data]
    starts, ends, first = word_bounds(low, offsets, _IS_WORD)
    return low, starts, ends, word_hashes(low, starts, ends), first


class Tests:
    """The suffixes of a block of benchmark items, ready to be looked up.

    flat holds the words' numbers from 1 on, item after item. Of every suffix that holds a whole window there
    are its item, place in it, first word, window's size and words left; order and group sort them by
    window, heads are one suffix of each. All are arrays, of some 60 bytes a word.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        texts = [(text or "").encode() for _, text in items]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        self.low, self.starts, self.ends, hashes, first = _words(data, offsets)
        self.names = [name for name, _ in items]
        self.known = np.unique(hashes)
        numbers = np.searchsorted(self.known, hashes) + 1
        sizes = np.diff(first)
        self.longest = int(sizes.max(initial=0))
        self.flat = np.concatenate([numbers, np.zeros(self.longest + 64, np.int64)])
        # Of an item of n words n - window + 1 windows; of a shorter one the whole.
        n_windows = np.where(sizes > window, sizes - window + 1, np.minimum(sizes, 1))
        self.item = np.repeat(np.arange(len(items)), n_windows)
        self.place = np.arange(len(self.item)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        self.at = first[self.item] + self.place
        self.size = np.minimum(sizes[self.item], window)
        self.rest = first[self.item + 1] - self.at
        # Windows of the same words are looked up once, and stand for all their items.
        self.order = np.arange(len(self.at))
        for j in range(window):
            word = np.where(j < self.size, self.flat[self.at + j], 0)
            self.order = self.order[np.argsort(word[self.order], kind="stable")]
        differ = np.ones(len(self.order), bool)
        if len(differ):
            differ[1:] = False
            for j in range(window):
                word = np.where(j < self.size, self.flat[self.at + j], 0)[self.order]
                differ[1:] |= word[1:] != word[:-1]
        self.group = np.append(np.flatnonzero(differ), len(self.order))
        self.heads = self.order[self.group[:-1]]
        # A block is far smaller than 2 GB.
        for name in ("starts", "ends", "flat", "item", "place", "at", "size", "rest", "order", "group", "heads"):
            setattr(self, name, getattr(self, name).astype(np.int32))

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[list, dict]]]:
        """Words of each text; for texts with finds their hit words' spans and their items.

        The items come with the longest verbatim match: (words, start in the item, first word).
        """
        low, starts, ends, hashes, first = _words(data, offsets)
        n_words, found = np.diff(first), {}
        if not len(hashes) or not len(self.heads):
            return n_words, found
        number = np.searchsorted(self.known, hashes)
        number[number == len(self.known)] = 0
        number = np.where(self.known[number] == hashes, number + 1, 0)
        # A zero stands after each text, so that no match reaches into the next.
        n_texts = len(n_words)
        own = np.repeat(np.arange(n_texts), n_words)
        ids = np.zeros(len(number) + n_texts + self.longest + 64, np.int64)
        shifted = np.arange(len(number)) + own
        ids[shifted] = number
        for window, at in zip(*self._lookup(ids)):
            text = int(np.searchsorted(first + np.arange(n_texts + 1), at, "right")) - 1
            word = int(at) - text
            head, size = int(self.at[self.heads[window]]), int(self.size[self.heads[window]])
            here = (low[starts[word + i] : ends[word + i]].tobytes() for i in range(size))
            if any(own != self._word(head + i) for i, own in enumerate(here)):
                continue  # equal hashes of different words
            spans, items = found.setdefault(text, ([], {}))
            spans.append((word - int(first[text]), word - int(first[text]) + size))
            for k in self.order[self.group[window] : self.group[window + 1]].tolist():
                name = self.names[self.item[k]]
                if name is not None:
                    n = self._extent(ids, int(at), k)
                    best = (n, -int(self.place[k]), -(word - int(first[text])))
                    items[name] = max(items.get(name, best), best)
        return n_words, found

    def _word(self, at: int) -> bytes:
        return self.low[self.starts[at] : self.ends[at]].tobytes()

    def _extent(self, ids: np.ndarray, at: int, k: int) -> int:
        """Words that the text from `at` and the item's suffix k have in common."""
        rest, start = int(self.rest[k]), int(self.at[k])
        differ = np.flatnonzero(ids[at : at + rest] != self.flat[start : start + rest])
        return int(differ[0]) if len(differ) else rest

    def _lookup(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of windows and the places in ids where they stand."""
        bits = int(len(self.known)).bit_length()
        step = 63 // bits
        keys = np.zeros(len(ids) - step, np.int64)
        for j in range(step):
            keys = (keys << bits) | ids[j : j + len(keys)]
        order = suffix_array(ids, keys, step, self.longest)
        low, high = np.zeros(len(self.heads), np.int64), np.full(len(self.heads), len(order))
        at, size = self.at[self.heads], self.size[self.heads]
        for depth in range(0, int(size.max()), step):
            count = np.clip(size - depth, 0, step)
            want = np.zeros(len(at), np.int64)
            for j in range(step):
                want = (want << bits) | np.where(j < count, self.flat[at + depth + j], 0)
            above = want + (np.int64(1) << (bits * (step - count)))
            open_ = (low < high) & (count > 0)
            for bound, target in ((low, want), (high, above)):
                bound[open_] = _bisect(keys, order, depth, low[open_], high[open_], target[open_])
            # The second search began at the new lower end, which is never beyond the upper one.
        sizes = np.maximum(high - low, 0)
        window = np.repeat(np.arange(len(at)), sizes)
        inner = np.arange(len(window)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return window, order[np.repeat(low, sizes) + inner]


def _bisect(keys: np.ndarray, order: np.ndarray, depth: int, low: np.ndarray, high: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The first place in order[low:high] whose key at `depth` is not below the target."""
    low, high = low.copy(), high.copy()
    last = len(keys) - 1
    while True:
        active = low < high
        if not active.any():
            return low
        middle = (low + high) >> 1
        below = active & (keys[np.minimum(order[np.minimum(middle, len(order) - 1)] + depth, last)] < target)
        low = np.where(below, middle + 1, low)
        high = np.where(active & ~below, middle, high)


def suffix_array(ids: np.ndarray, keys: np.ndarray, step: int, depth: int) -> np.ndarray:
    """Starts of all suffixes of ids that begin above 0, in order of their first `depth` ids.

    keys[i] holds ids[i:i+step] in one number. Suffixes that tie are sorted again by the rank of
    what follows, over twice the length each time.
    """
    starts = np.flatnonzero(ids[: len(keys)] > 0)
    order = starts[np.argsort(keys[starts], kind="stable")]
    if not len(order):
        return order
    head = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    rank = np.zeros(len(ids) + depth + step + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0)) + 1
    length = step
    while length < depth:
        tied = ~head
        tied[:-1] |= ~head[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        group, following = rank[order[slots]], rank[order[slots] + length]
        by = np.lexsort((following, group))
        order[slots] = order[slots][by]
        group, following = group[by], following[by]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (following[1:] != following[:-1])])
        head[slots] = new
        # A rank is the place of the first suffix that ties; ranks are set once all are sorted.
        rank[order[slots]] = np.maximum.accumulate(np.where(new, slots, 0)) + 1
        length *= 2
    return order


FIELDS = (
    "n_words long, spans array<struct<start:int,end:int>>, "
    "matches array<struct<item_id:string,n_words:int,item_start:int,doc_start:int>>"
)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str] | None = None,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Columns `keep` of docs and, last, a struct of the benchmark's passages in each text.

    Its fields: n_words; spans, the ranges of words that windows cover, merged; matches, for each
    item with a window in the text, sorted by item_id as a string, its longest verbatim match in
    words and where it stands in item and text. Null and empty texts have no words; null and empty
    items no windows; an item without item_id covers words but is not listed; items that repeat an
    item_id count as one. Without any item nothing is found. Repeated rows each have their result.
    """
    keep = list(docs.columns if keep is None else keep)
    items = benchmark.select(
        F.col(quoted(item_id)).cast("string").alias("name"), F.col(quoted(item_text)).cast("string").alias("text")
    ).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = size // block_bytes + 1
    found = docs
    for k in range(n_blocks):
        block = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(n_blocks)) == k)
        tests = Tests([tuple(r) for r in block.collect()], window)
        shared = docs.sparkSession.sparkContext.broadcast(tests)
        before = found.columns[-1] if k else None
        found = annotate(found, FIELDS, _search(shared), [text, *[before] * bool(k)], [*keep, *[text] * (k + 1 < n_blocks and text not in keep)])
    last = found.columns[-1]
    return found.select(*[found[quoted(c)] for c in keep], found[quoted(last)])


def _search(shared) -> Callable:
    def make() -> Callable:
        tests = shared.value

        def work(texts: pa.Array, before: pa.Array | None = None) -> list[pa.Array]:
            data, offsets = utf8(texts)
            n_words, spans, matches = [], [], []
            for a, b in pieces(offsets, SHARD_BYTES):
                n, found = tests.find(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                n_words += n.tolist()
                for i in range(b - a):
                    own, items = found.get(i, ((), {}))
                    old = before[a + i].as_py() if before is not None else {"spans": [], "matches": []}
                    spans.append(merged([*own, *[(s["start"], s["end"]) for s in old["spans"]]]))
                    best = {m["item_id"]: (m["n_words"], -m["item_start"], -m["doc_start"]) for m in old["matches"]}
                    for name, value in items.items():
                        best[name] = max(best.get(name, value), value)
                    matches.append([(name, n, -p, -q) for name, (n, p, q) in sorted(best.items())])
            return [
                pa.array(n_words, pa.int64()),
                pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(
                    [[dict(zip(("item_id", "n_words", "item_start", "doc_start"), m)) for m in x] for x in matches],
                    pa.list_(pa.struct([("item_id", pa.string()), *[(c, pa.int32()) for c in ("n_words", "item_start", "doc_start")]])),
                ),
            ]

        return work

    return make


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that cover the same words without overlap."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no window of the benchmark, with their own columns."""
    found = find_benchmark(docs, benchmark, **options)
    clean = found.where(F.size(added(found, "spans")) == 0)
    return clean.select(*[clean[quoted(c)] for c in docs.columns])
