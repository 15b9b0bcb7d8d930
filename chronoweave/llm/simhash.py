"""Near-duplicate texts by SimHash fingerprints and distance tables to reference fingerprints.

Texts of one fingerprint are one class, combined before anything is compared. Fingerprints at
most `most_bits` apart agree in all bits of at least bands - most_bits of `bands` ranges of bits,
so the classes are grouped by each choice of that many ranges; this names every pair that can
link, and the number of ranges follows the number of classes so that a group stays small. In a
group each fingerprint has its row in a table of Hamming distances to the reference
fingerprints. By the triangle inequality a pair whose rows differ in any place by more than
`most_bits` cannot link and is discarded; the distance of what is left is computed and decides.
Groups of any size are dealt out in pairs of blocks, and only the links of a spanning forest
leave a task, so a large group of copies costs no more rows than it has members.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import added, annotate, checkpoint, components, forest, pair_blocks, quoted, runs

#: Words in a shingle, bits that linked fingerprints may differ in, seed of the shingles' hash.
SHINGLE, MOST_BITS, SEED = 4, 4, 42
#: Reference fingerprints in the distance table, and the seed they are drawn with.
REFERENCES, REFERENCE_SEED = 48, 7
#: Classes in a block of a split group, and rows in a task.
BLOCK, LOAD = 2048, 5_000
#: Classes that a group should have on average at most; sets the number of bands.
GROUP = 128



def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64 bits of a text: those set in over half of its shingles' hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    n = max(1, len(words) - shingle + 1)
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[s:e], SEED) for s, e in zip(starts[:n], stops)], "<u8")
    total = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keep: list[str] | None = None, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Columns `keep` of docs and, last, a struct with the fingerprint as a signed long, `bits`.

    Null, empty and blank texts have fingerprint zero; texts of fewer words than a shingle are one
    shingle.
    """

    def make() -> Callable:
        def work(texts: pa.Array) -> list[pa.Array]:
            found = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            return [pa.array(found.view(np.int64), pa.int64())]

        return work

    return annotate(docs, "bits long", make, [text], keep)


def bands_for(n_classes: int, most_bits: int, group: int = GROUP) -> list[list[tuple[int, int]]]:
    """Choices of ranges (first bit, length), one of which every linked pair agrees in.

    The fewest ranges for which a group by the bits of a choice has `group` members on average.
    """
    for n in range(most_bits + 1, 17):
        at = [64 * i // n for i in range(n + 1)]
        ranges = [(a, b - a) for a, b in zip(at, at[1:])]
        choices = [list(c) for c in itertools.combinations(ranges, n - most_bits)]
        if n_classes / 2 ** min(sum(size for _, size in c) for c in choices) <= group:
            break
    return choices


def close_pairs(bits: np.ndarray, table: np.ndarray, left: slice, right: slice, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked pairs, one of each slice: survivors of the distance table, then verified."""
    a, b = np.arange(left.start, left.stop), np.arange(right.start, right.stop)
    if left == right:
        i, j = np.triu_indices(len(a), 1)
        i, j = a[i], b[j]
    else:
        i, j = np.repeat(a, len(b)), np.tile(b, len(a))
    for column in table:
        near = np.abs(column[i] - column[j]) <= most_bits
        i, j = i[near], j[near]
    near = np.bitwise_count(bits[i] ^ bits[j]) <= most_bits
    return i[near], j[near]


def links(classes: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that are `most_bits` apart.

    classes has one row for each fingerprint, `bits`. Of the links in a group those of a spanning
    forest are returned: each member with the smallest it is connected to.
    """
    rng = np.random.default_rng(REFERENCE_SEED)
    references = rng.integers(0, 1 << 64, REFERENCES, np.uint64, endpoint=False)
    choices = bands_for(classes.count(), most_bits)
    keys = [
        F.struct(
            F.lit(k).alias("choice"),
            sum(
                (F.shiftrightunsigned("bits", first).bitwiseAND(F.lit((1 << size) - 1)) * F.lit(1 << shift))
                for (first, size), shift in zip(c, itertools.accumulate([0, *[s for _, s in c[:-1]]]))
            ).alias("band"),
        )
        for k, c in enumerate(choices)
    ]
    rows = classes.select("bits", F.explode(F.array(*keys)).alias("key")).select("bits", "key.choice", "key.band")
    dealt = pair_blocks(rows, ["choice", "band"], "bits", BLOCK, LOAD)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(side=group.side.fillna(-1))
        group = group.sort_values(["choice", "band", "part", "side", "bits"], kind="stable")
        bits = group.bits.to_numpy().view(np.uint64)
        table = np.bitwise_count(references[:, None] ^ bits[None, :]).astype(np.int8)
        side = group.side.to_numpy()
        low, high = [], []
        for start, stop in runs(group.choice.to_numpy(), group.band.to_numpy(), group.part.to_numpy()):
            cut = start + int(np.searchsorted(side[start:stop], 1)) if side[start] >= 0 else stop
            a, b = [], []
            if side[start] < 0:
                for s in range(start, stop, 256):
                    block = slice(s, min(s + 256, stop))
                    found = [close_pairs(bits, table, block, block, most_bits)]
                    if block.stop < stop:
                        found.append(close_pairs(bits, table, block, slice(block.stop, stop), most_bits))
                    a += [x for x, _ in found]
                    b += [y for _, y in found]
            else:
                for s in range(start, cut, 256):
                    x, y = close_pairs(bits, table, slice(s, min(s + 256, cut)), slice(cut, stop), most_bits)
                    a.append(x), b.append(y)
            a, b = np.concatenate(a) - start, np.concatenate(b) - start
            if len(a):
                root = forest(stop - start, a, b)
                inner = np.flatnonzero(root != np.arange(stop - start))
                low.append(root[inner] + start), high.append(inner + start)
        if not low:
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        signed = bits.view(np.int64)
        return pd.DataFrame({"a": signed[np.concatenate(high)], "b": signed[np.concatenate(low)]})

    return dealt.groupBy("task").applyInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, most_bits: int = MOST_BITS
) -> DataFrame:
    """(doc_id, bits, component_id) for each row of docs.

    Texts whose fingerprints differ in at most `most_bits` bits link, and component_id is the
    smallest id reachable by links, itself included. Texts without words have fingerprint zero and
    link like any other. Rows without id take part; they have a component_id where a row with id
    is reachable, else null. Rows that repeat an id or a text each have their result. An empty
    table gives an empty one.
    """
    found = fingerprints(docs, [id], text, shingle)
    rows = checkpoint(found.select(found[quoted(id)].alias("doc_id"), added(found, "bits").alias("bits")))
    classes = checkpoint(rows.groupBy("bits").agg(F.min("doc_id").alias("least")))
    joined = classes.join(components(links(classes, most_bits)), classes.bits == F.col("node"), "left")
    rooted = joined.select("bits", "least", F.coalesce("root", "bits").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("bits").alias("of"), "component_id")
    return rows.join(named, rows.bits == F.col("of"), "left").select("doc_id", "bits", "component_id")


def distinct_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of docs for each component: that of its component_id.

    A component without any id, and rows that repeat an id, keep the row that sorts first of all
    their columns.
    """
    found = near_duplicates(docs, id, text, **options)
    kept = found.where("doc_id <=> component_id").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("bits").alias("b"))
    sole, more = kept.where("n = 1 and doc_id is not null"), kept.where("n > 1 or doc_id is null")
    ids = sole.select(F.col("doc_id").alias("kept_id"))
    rows = docs.join(ids, docs[quoted(id)] == ids.kept_id, "left_semi")
    repeated = checkpoint(more.select("doc_id"))
    if repeated.isEmpty():
        return rows
    some = docs.join(repeated, docs[quoted(id)].eqNullSafe(repeated.doc_id), "left_semi")
    return rows.union(first_of_each(some, id, text, **options))


def first_of_each(docs: DataFrame, id: str, text: str, shingle: int = SHINGLE, **_) -> DataFrame:
    """Of rows with one id the first in the order of all columns; without id, the first of each fingerprint."""
    found = fingerprints(docs, text=text, shingle=shingle)
    key = F.when(found[quoted(id)].isNull(), added(found, "bits"))
    columns = [found[quoted(c)] for c in docs.columns]
    whole = found.select(found[quoted(id)].alias("id"), key.alias("bits"), F.struct(*columns).alias("row"))
    return whole.groupBy("id", "bits").agg(F.min("row").alias("row")).select("row.*")
