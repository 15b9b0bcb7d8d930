"""What the corpus operators share: annotated batches, checkpoints, UTF-8 words, pairs, components."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A list of hot keys of at most so many rows is broadcast; a longer one is joined by shuffle.
MOST_BROADCAST_KEYS = 50_000

#: Bytes of a batch that an operator works on at a time; a larger row is worked on alone.
PART_BYTES = 6 << 20


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def annotate(docs: DataFrame, fields: str, make: Callable, inputs: list[str], keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) of docs and, last, a struct column with `fields` (DDL).

    make() runs once in each task and gives a function from the arrays of `inputs` to the arrays
    of the fields. The struct's name avoids the names of all other columns; find it by `added`.
    No row moves, so there is no shuffle and a lost task is simply run again.
    """
    keep = list(docs.columns if keep is None else keep)
    name = "found"
    while name.lower() in {c.lower() for c in keep}:
        name += "_"
    read = list(dict.fromkeys([*keep, *inputs]))
    struct = T.StructType.fromDDL(fields)
    # Under plain names inside: a column's own name may hold dots.
    plain = [f"c{i}" for i in range(len(read))]
    schema = T.StructType([T.StructField(p, docs.schema[c].dataType) for p, c in zip(plain, keep)] + [T.StructField("found", struct)])
    places, names, n_keep = [read.index(c) for c in inputs], struct.names, len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for whole in batches:
            n_rows = max(1, whole.num_rows * PART_BYTES // max(1, whole.nbytes))
            for at in range(0, whole.num_rows, n_rows):
                batch = whole.slice(at, n_rows)
                found = pa.StructArray.from_arrays(work(*[batch.column(i) for i in places]), names=names)
                yield pa.RecordBatch.from_arrays([*batch.columns[:n_keep], found], names=[*plain[:n_keep], "found"])

    own = docs.select(*[docs[quoted(c)].alias(p) for c, p in zip(read, plain)])
    return own.mapInArrow(run, schema).toDF(*keep, name)


def added(df: DataFrame, field: str):
    """The field of the struct that annotate() put last."""
    return df[quoted(df.columns[-1])].getField(field)


def checkpoint(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder of spark.checkpoint.dir.

    Only where the session names no folder, as in tests, one of our own is set.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    return (
        spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.checkpoint.dir", None)
        or tempfile.mkdtemp(prefix="checkpoints-")
    )


# Words of UTF-8 text ------------------------------------------------------------------------

#: The multiplier of word hashes and its inverse modulo 2**64.
FACTOR = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(FACTOR, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 21), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the offsets of the texts; null counts as empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes together; a longer text is a range of its own."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each text's words begin among them.

    A word is a longest run of bytes that is_word (256 flags) marks, within one text.
    """
    inside = is_word[data]
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[offsets < len(data)]
    before[edges] = False
    after[offsets[offsets > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes; equal words have equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(FACTOR, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(INVERSE, len(data))[starts]
    return mixed(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


# Pairs within groups ------------------------------------------------------------------------


def pair_blocks(rows: DataFrame, keys: list[str], spread: str, block: int, load: int) -> DataFrame:
    """rows with `task`, `part` and `side`, so that pairs of a key's rows meet without a hot task.

    A key of over `block` rows is split by the hash of column `spread` into parts of about that
    size, and each pair of parts is a group of its own: (key, part). side is 0 or 1 in a group of
    two parts, whose pairs are those across; it is null in a group of one part, whose pairs are
    all. Groups are dealt to tasks of about `load` rows. Every pair of rows of a key meets once.
    """
    counts = rows.groupBy(*keys).count().withColumn("parts", F.ceil(F.col("count") / block))
    n_rows, n_hot = counts.agg(F.sum(F.col("count") * F.col("parts")), F.count_if(F.col("parts") > 1)).first()
    plain = rows.withColumn("parts", F.lit(1).cast("long"))
    if n_hot:
        split = counts.where("parts > 1").select(*[F.col(k).alias(f"hot_{k}") for k in keys], "parts")
        split = F.broadcast(split) if n_hot <= MOST_BROADCAST_KEYS else split
        same = [F.col(k) == F.col(f"hot_{k}") for k in keys]
        plain = rows.join(split, same, "left").drop(*[f"hot_{k}" for k in keys]).withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64(spread), F.col("parts"))
    each = plain.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    part = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    side = F.when(F.col("own") != F.col("other"), (F.col("own") > F.col("other")).cast("int"))
    n_tasks = max(1, (n_rows or 0) // load)
    each = each.withColumns({"part": part, "side": side}).drop("own", "other", "parts")
    return each.withColumn("task", F.pmod(F.xxhash64(*keys, "part"), F.lit(n_tasks)).cast("int"))


def runs(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal values in columns that are sorted together."""
    n = len(columns[0])
    if n:
        change = np.zeros(n - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        at = [0, *(np.flatnonzero(change) + 1).tolist(), n]
        yield from zip(at, at[1:])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each of n items' components under links a-b."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low != high
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


# Connected components -----------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b); root is the smallest node reachable.

    Rounds of hooking every node's neighbours to the smallest of them, larger neighbours first,
    then smaller, until the links are stars. Minima are combined before each shuffle and a hub's
    links are joined, not gathered, so that skewed joins can be split. Each round is kept in the
    shared folder, so that a lost executor costs one round at most.
    """
    links = checkpoint(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = signature(links)
    while state[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        near = least.select("a", F.least("a", "m").alias("m"))
        # The larger neighbours b of a go to the smallest around a.
        large = links.select(F.col("b").alias("a"), F.col("a").alias("v")).join(near, "a")
        links = large.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        small = links.join(least, "a")
        hooked = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        links = checkpoint(hooked.union(least.select("a", F.col("m").alias("b"))).distinct())
        last, state = state, signature(links)
        if last == state:
            break
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def signature(links: DataFrame) -> tuple:
    """Number and combined hash of the links: equal for equal sets of them."""
    half = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(links.agg(F.count("*"), F.sum(half), F.sum(F.hash("a", "b").cast("long"))).first())
