"""Near-equal vectors of one label, found with a pivot-permutation index.

Each vector is described by its nearest reference points ("pivots"), in order of nearness. The
inverted list of a pivot holds the vectors that have it among their nearest. Two vectors are
candidates if they share enough pivots; a pair meets in the list of the first pivot that it
shares, and there the cosine of the two decides.

Equal vectors are one class, combined beforehand. Lists of any length are compared in pairs of
blocks, and a task returns each class's number of links and the one member it hangs on, so rows do
not grow with the square of a list. The number of pivots grows with the root of the number of
classes, up to a bound that is reached at 10^9 classes of up to 256 dimensions, 10^8 of 768; lists are longer
beyond. Each class is indexed, only the pivots are a sample.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import added, annotate, checkpoint, components, forest, pair_blocks, quoted, runs

#: Cosine from which vectors link.
LEAST_COSINE = 0.93
#: Pivots that describe a vector, and how many of them candidates share.
NEAREST, SHARED = 8, 2
#: The sample of pivots: its growth with the root of the classes, and its bounds.
PIVOT_RATE, LEAST_PIVOTS, MOST_PIVOTS, MOST_PIVOT_BYTES = 2, 16, 1 << 16, 128 << 20
#: Distances from vectors to pivots that a task holds at a time.
MOST_DISTANCES = 1 << 22
#: Of sampled pivots whose cosine is this or more, one stays: near copies tell vectors nothing apart.
PIVOT_COSINE = 0.8
#: Classes in a block of a long list, rows in a task, pairs whose cosine is computed at a time.
BLOCK, LOAD, PAIRS = 1024, 3_000, 1 << 15


def vectors(table: DataFrame, id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, label, dim, vec, node): vec is the vector in doubles, node names label and vector.

    Rows whose label is null or whose vector cannot link have a null node.
    """

    def make() -> Callable:
        def work(lists: pa.Array, labels: pa.Array) -> list[pa.Array]:
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) + 0.0
            ends = np.cumsum(sizes)
            dims, vecs, nodes = [], [], []
            for name, size, end in zip(labels.to_pylist(), sizes.tolist(), ends.tolist()):
                own = flat[end - size : end]
                good = name is not None and size and np.isfinite(own).all() and own.any()
                raw = own.tobytes() if good else None
                dims.append(size if good else None)
                vecs.append(raw)
                nodes.append(hashlib.blake2b(raw, digest_size=16, key=hashlib.md5(name.encode()).digest()).hexdigest() if good else None)
            return [pa.array(dims, pa.int32()), pa.array(vecs, pa.binary()), pa.array(nodes, pa.string())]

        return work

    own = table.select(
        table[quoted(id)].alias("vec_id"), table[quoted(embedding)].alias("v"), table[quoted(label)].cast("string").alias("label")
    )
    found = annotate(own, "dim int, vec binary, node string", make, ["v", "label"], ["vec_id", "label"])
    return found.select("vec_id", "label", *[added(found, n).alias(n) for n in ("dim", "vec", "node")])


def units(raw: list[bytes], dim: int) -> np.ndarray:
    """Vectors of length one."""
    v = np.frombuffer(b"".join(raw), np.float64).reshape(-1, dim)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def apart(places: np.ndarray) -> np.ndarray:
    """Of unit vectors, in order, those whose cosine with all that were taken before is below PIVOT_COSINE."""
    taken = places[:0]
    for at in range(0, len(places), 1024):
        block = places[at : at + 1024]
        free = np.ones(len(block), bool)
        for start in range(0, len(taken), 4096):
            free &= (block @ taken[start : start + 4096].T).max(axis=1) < PIVOT_COSINE
        near = block @ block.T >= PIVOT_COSINE
        chosen: list[int] = []
        for i in np.flatnonzero(free):
            if not near[i, chosen].any():
                chosen.append(int(i))
        taken = np.concatenate([taken, block[chosen]])
    return taken


def with_pivots(classes: DataFrame, nearest: int) -> tuple[DataFrame, int]:
    """classes with `pivots`, the numbers of their nearest pivots in order; and how many a row has.

    Pivots are the classes of the smallest names, which are hashes. Vectors of another dimension
    than a pivot's are compared with it as far as both go.
    """
    n, dim = classes.agg(F.count("*"), F.max("dim")).first()
    wanted = max(LEAST_PIVOTS, math.ceil(PIVOT_RATE * math.sqrt(n)))
    wanted = max(1, min(wanted, MOST_PIVOTS, MOST_PIVOT_BYTES // (8 * (dim or 1))))
    sample = classes.orderBy("node").limit(wanted).select("vec", "dim").collect()
    places = np.zeros((len(sample), dim or 1))
    for k, r in enumerate(sample):
        places[k, : r.dim] = units([bytes(r.vec)], r.dim)
    kept = apart(places)
    shared, k = classes.sparkSession.sparkContext.broadcast(kept), min(nearest, len(kept))
    # Rows whose distances to all pivots are held at a time.
    rows_at_once = max(1, min(2048, MOST_DISTANCES // max(1, len(kept))))

    def make() -> Callable:
        pivots = shared.value

        def work(raw: pa.Array, dims: pa.Array) -> list[pa.Array]:
            raw, dims = raw.to_pylist(), dims.to_numpy(zero_copy_only=False)
            out = np.zeros((len(raw), k), np.int32)
            for d in np.unique(dims):
                for at in np.array_split(np.flatnonzero(dims == d), -(-int((dims == d).sum()) // rows_at_once)):
                    near = units([raw[i] for i in at], int(d)) @ pivots[:, :d].T
                    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                    out[at] = np.take_along_axis(top, np.lexsort((top, -np.take_along_axis(near, top, 1))), 1)
            return [pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1) * k, pa.int32()), pa.array(out.ravel(), pa.int32()))]

        return work

    found = annotate(classes, "pivots array<int>", make, ["vec", "dim"])
    return found.select(*classes.columns, added(found, "pivots").alias("pivots")), k


def linked(unit: np.ndarray, has: np.ndarray, before: np.ndarray, left: slice, right: slice, shared: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked pairs, one of each slice, that share enough pivots and none `before`."""
    ok = has[left] @ has[right].T >= shared
    ok &= has[left][:, before] @ has[right][:, before].T == 0
    if left == right:
        ok = np.triu(ok, 1)
    a, b = np.nonzero(ok)
    a, b = a + left.start, b + right.start
    near = [np.einsum("ij,ij->i", unit[a[s : s + PAIRS]], unit[b[s : s + PAIRS]]) >= least for s in range(0, len(a), PAIRS)]
    near = np.concatenate(near) if near else np.zeros(0, bool)
    return a[near], b[near]


def links(classes: DataFrame, least: float = LEAST_COSINE, nearest: int = NEAREST, shared: int = SHARED) -> DataFrame:
    """(a, b, n): class a has n links more and hangs together with class b, maybe itself.

    classes: label, dim, vec, node and n, the rows of a class. Rows of one a add up.
    """
    described, k = with_pivots(classes, nearest)
    described = checkpoint(described)
    shared = min(shared, k)
    rows = described.withColumn("pivot", F.explode("pivots"))
    dealt = pair_blocks(rows, ["label", "dim", "pivot"], "node", BLOCK, LOAD)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(side=group.side.fillna(-1)).sort_values(["label", "dim", "pivot", "part", "side", "node"], kind="stable")
        side, weight, node = group.side.to_numpy(), group.n.to_numpy(), group.node.to_numpy()
        raw, pivots = group.vec.tolist(), np.array(group.pivots.tolist()).reshape(len(group), -1)
        keys = [group[c].to_numpy() for c in ("label", "dim", "pivot", "part")]
        found = []
        for start, stop in runs(*keys):
            n = stop - start
            unit = units([bytes(x) for x in raw[start:stop]], int(keys[1][start]))
            known, place = np.unique(pivots[start:stop], return_inverse=True)
            has = np.zeros((n, len(known)), np.float32)
            has[np.arange(n)[:, None], place.reshape(n, -1)] = 1
            before = np.flatnonzero(known < keys[2][start])
            cut = int(np.searchsorted(side[start:stop], 1)) if side[start] >= 0 else 0
            a, b = [], []
            for s in range(0, cut or n, 512):
                own = slice(s, min(s + 512, cut or n))
                for other in [slice(cut, n)] if cut else [own, slice(own.stop, n)]:
                    x, y = linked(unit, has, before, own, other, shared, least)
                    a.append(x), b.append(y)
            if side[start] >= 0 and not cut:
                continue
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                own = weight[start:stop]
                total = np.bincount(a, own[b], n) + np.bincount(b, own[a], n)
                at = np.flatnonzero(total)
                root = forest(n, a, b)
                found.append(pd.DataFrame({"a": node[start + at], "b": node[start + root[at]], "n": total[at].astype(np.int64)}))
        empty = pd.DataFrame({"a": pd.Series([], dtype=str), "b": pd.Series([], dtype=str), "n": pd.Series([], dtype=np.int64)})
        return pd.concat(found) if found else empty

    wanted = dealt.select("label", "dim", "vec", "node", "n", "pivots", "pivot", "part", "side", "task")
    return wanted.groupBy("task").applyInPandas(compare, "a string, b string, n long")


def near_duplicates(table: DataFrame, id: str = "vec_id", embedding: str = "embedding", label: str = "label", least: float = LEAST_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of the table.

    Rows link if their labels are equal and not null and the cosine of their vectors is at least
    `least`. n_links counts the other rows linked directly, component_id is the smallest vec_id
    reachable, kept says that it is the row's own. Rows whose label is null and vectors that are
    null, empty, zero or hold null or non-finite components link with nothing; nor do vectors of
    different dimensions. Rows that repeat a vec_id count as rows; those without one take part. An
    empty table gives an empty one.
    """
    rows = checkpoint(vectors(table, id, embedding, label))
    classes = rows.where("node is not null").groupBy("node", "label", "dim", "vec")
    classes = checkpoint(classes.agg(F.count("*").alias("n"), F.min("vec_id").alias("least")))
    found = checkpoint(links(classes.drop("least"), least))
    total = found.groupBy("a").agg(F.sum("n").alias("near"))
    roots = components(found.where("a <> b").select("a", "b")).withColumnRenamed("node", "of")
    named = classes.select("node", "n", "least").join(roots, F.col("node") == F.col("of"), "left")
    named = named.select("node", "n", "least", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(smallest, "root").join(total, F.col("node") == F.col("a"), "left")
    named = named.select(F.col("node").alias("of"), (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("links"), "component")
    result = rows.select("vec_id", "node").join(named, F.col("node") == F.col("of"), "left")
    component = F.coalesce("component", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
