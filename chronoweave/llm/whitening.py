"""Whitening of vectors: incremental eigendecomposition in partitions, spectra combined up a tree.

A partition keeps the spectrum of its scatter matrix, that is mean, eigenvalues and eigenvectors.
Each vector is a centred rank-one update of it: in the eigenvectors' basis the new matrix is
D + zz', whose eigenvalues solve the secular equation 1 + sum z_k^2 / (d_k - x) = 0. Parts of z that
do not count and equal d_k are deflated first. Spectra of partitions are combined by successive rank-one
updates, one for each eigenpair of the other and one for the distance of the means, a few at a time
up a tree. What rounding has left in the eigenvectors is removed by a Rayleigh-Ritz step: the covariance in
their basis, summed exactly centred over all partitions, is nearly diagonal, and its own eigenvectors turn
them into place.

Memory is that of a few square matrices of the dimension, in a task and on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import annotate, checkpoint, quoted

#: An entry c counts as floor(SCALE * c) + SHIFT, and as MOST at most without the shift, either sign.
SCALE, SHIFT, MOST = 64, 1_000_000, 1 << 47
#: Components of the result, spectra that one task combines, rows worked on at a time.
COMPONENTS, FAN, ROWS = 32, 8, 2048

EPS = np.finfo(float).eps
#: A root counts as found when the terms of the secular equation cancel to this; Loewner's z takes up the rest.
CLOSE = 1e-13
SPECTRUM = "key long, n long, mean binary, values binary, vectors binary"


class Model(NamedTuple):
    """Of n vectors with entry sums `sums`: variances along `axes` (columns), largest first, and their trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float


def entries(lists: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the usable rows, those rows' lengths, and floor(SCALE * c) of their entries in a row.

    A row is unusable if it is null or empty, holds null or non-finite entries, or has another length than dim.
    """
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = (bad[ends] == bad[ends - sizes]) & (sizes > 0 if dim is None else sizes == dim)
    kept = flat[np.repeat(good, sizes)]
    whole = np.floor(np.clip(SCALE * kept, -MOST, MOST)).astype(np.int64)
    return np.flatnonzero(good), sizes[good], whole


def matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    """The usable rows of the first column as integer matrices of at most ROWS rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            _, _, whole = entries(batch.column(0).slice(at, ROWS), dim)
            yield whole.reshape(-1, dim)


# Rank-one updates ----------------------------------------------------------------------------


def secular(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots x of 1 + sum w_k / (d_k - x) = 0, and the exact differences d_k - x_i in row i.

    d grows, w is positive. Each root is sought as an offset from the pole nearest to it, by rational
    interpolation of the sums over the poles on either side, held in a bracket.
    """
    k = len(d)
    if k == 1:
        return d + w, -w[:, None]
    gap = np.append(d[1:] - d[:-1], w.sum())
    left = np.arange(k)
    below = np.tri(k)

    def steps(rows: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """f, what it may be wrong by, and the step to its root, if it is c + a pole on either side."""
        r = w / t
        f = 1 + r.sum(axis=1)
        slope = r / t
        under = np.einsum("ij,ij->i", slope, below[rows])
        total = slope.sum(axis=1)
        last = rows == k - 1
        here = np.arange(len(rows))
        a, b = t[here, rows], t[here, np.minimum(rows + 1, k - 1)]
        c = f - a * under - b * (total - under)
        p, q = (a + b) * f - a * b * total, a * b * f
        root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            # The last root has no pole on the right.
            step = np.where(last, a + a * a * under / (f - a * under), step)
        return f, CLOSE * (1 + np.abs(r).sum(axis=1)), step

    f, _, step = steps(left, d - (d + gap / 2)[:, None])
    right = (f < 0) & (left < k - 1)
    origin = left + right
    low = np.where(right, -gap / 2, np.where(f < 0, gap / 2, 0.0))
    high = np.where(right, 0.0, np.where(f < 0, gap, gap / 2))
    poles = d - d[origin][:, None]
    trial = gap / 2 + step - gap * right
    mu = np.where((trial > low) & (trial < high), trial, (low + high) / 2)
    rows = left
    for _ in range(60):
        f, wrong, step = steps(rows, poles[rows] - mu[rows, None])
        own, least, most = mu[rows], low[rows], high[rows]
        least, most = np.where(f < 0, own, least), np.where(f < 0, most, own)
        low[rows], high[rows] = least, most
        open_ = (np.abs(f) > wrong) & (most - least > 2 * EPS * np.maximum(np.abs(least), np.abs(most)))
        if not open_.any():
            break
        trial = own + step
        trial = np.where((trial > least) & (trial < most), trial, (least + most) / 2)
        rows = rows[open_]
        mu[rows] = trial[open_]
    return d[origin] + mu, poles - mu[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of the matrix with this spectrum (values grow) plus weight * vv'."""
    z = vectors.T @ v
    size = math.sqrt(float(z @ z))
    if not size or weight <= 0:
        return values, vectors
    least = 8 * EPS * max(abs(values[-1]), abs(values[0]), weight * size * size)
    close = np.diff(values) <= least
    if close.any():
        # Among equal eigenvalues any basis will do: one that turns z into a single part of it.
        vectors = vectors.copy()
        edges = np.flatnonzero(np.diff(np.concatenate([[False], close, [False]]).astype(np.int8)))
        for start, stop in zip(edges[::2], edges[1::2] + 1):
            own = z[start:stop]
            length = math.sqrt(float(own @ own))
            if length:
                h = own.copy()
                h[-1] += math.copysign(length, own[-1])
                vectors[:, start:stop] -= np.outer(vectors[:, start:stop] @ h, h * (2 / float(h @ h)))
                z[start:stop] = 0
                z[stop - 1] = -math.copysign(length, h[-1])
    moved = np.flatnonzero(weight * size * np.abs(z) > least)
    if not len(moved):
        return values, vectors
    d, part = values[moved], z[moved]
    found, t = secular(d, weight * part * part)
    # The z that has exactly these roots (Loewner), so that the eigenvectors are orthogonal.
    k = len(d)
    exact = np.abs(t[-1])
    if k > 1:
        apart = d[:, None] - d
        poles = np.where(np.tri(k - 1, k, -1, dtype=bool) | np.eye(k - 1, k, dtype=bool), apart[1:], apart[:-1])
        exact = exact * np.abs(t[:-1] / poles).prod(axis=0)
    turn = (np.copysign(np.sqrt(exact), part) / t).T
    turn /= np.sqrt((turn * turn).sum(axis=0))
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[moved] = found
    new_vectors[:, moved] = vectors[:, moved] @ turn
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


class Spectrum:
    """Mean and scatter matrix of the vectors added so far, the latter by its eigenpairs."""

    def __init__(self, dim: int):
        self.n, self.mean, self.values, self.vectors = 0, np.zeros(dim), np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray, times: int = 1) -> None:
        """One vector, so many times."""
        apart = x - self.mean
        total = self.n + times
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, apart, self.n * times / total)
        self.mean = self.mean + apart * (times / total)
        self.n = total

    def add_reduced(self, x: np.ndarray, times: np.ndarray) -> None:
        """Vectors (rows) so many times each, by as many updates as they have entries.

        The triangular factor of the centred vectors has their scatter matrix; its rows are added one by one,
        and the vectors' mean is added as often as there are vectors.
        """
        n = int(times.sum())
        mean = times @ x / n
        for row in np.linalg.qr((x - mean) * np.sqrt(times)[:, None], mode="r"):
            self.values, self.vectors = rank_one(self.values, self.vectors, row, 1.0)
        self.add(mean, n)

    def combine(self, other: Spectrum) -> None:
        """The vectors of another spectrum."""
        if other.n:
            for value, vector in zip(other.values, other.vectors.T):
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, value)
            n, mean = other.n, other.mean
            self.add(mean, n)

    def row(self, key: int) -> dict:
        raw = {name: np.ascontiguousarray(getattr(self, name)).tobytes() for name in ("mean", "values", "vectors")}
        return {"key": key, "n": self.n, **raw}

    @classmethod
    def of(cls, row) -> Spectrum:
        found = cls(0)
        found.n = int(row.n)
        found.mean, found.values, vectors = (np.frombuffer(x) for x in (row.mean_, row.values_, row.vectors_))
        found.vectors = vectors.reshape(len(found.mean), -1)
        return found


# Over all partitions -------------------------------------------------------------------------


def up_the_tree(rows: DataFrame, merge: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """One row (or none) from rows with a `key` of 0 and up: merge() makes one of FAN, level by level."""
    rows = checkpoint(rows)
    most = rows.agg(F.max("key")).first()[0] or 0
    while most:
        most //= FAN
        rows = rows.withColumn("key", F.floor(F.col("key") / FAN)).groupBy("key").applyInPandas(merge, rows.schema)
    return rows


def totals(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number and entry sums of the usable vectors of the only column, of the most frequent length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                _, sizes, whole = entries(batch.column(0).slice(at, ROWS))
                for size in np.unique(sizes):
                    own = whole[np.repeat(sizes == size, sizes)].reshape(-1, size)
                    n, places = len(own), np.arange(size)
                    columns = [np.full(size, size), places, np.full(size, n), own.sum(axis=0)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["size", "place", "n", "total"])

    parts = vectors.mapInArrow(count, "size long, place long, n long, total long")
    sums = checkpoint(parts.groupBy("size", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
    chosen = sums.where("place = 0").orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    if not chosen:
        return 0, []
    return chosen[0].n, [int(r.total) for r in sums.where(F.col("size") == chosen[0]["size"]).orderBy("place").collect()]


def spectrum(vectors: DataFrame, dim: int, reduced: bool = False) -> Spectrum:
    """Of all usable vectors of the only column: partitions by rank-one updates, combined up a tree."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Spectrum(dim)
        for whole in matrices(batches, dim):
            rows, times = np.unique(whole, axis=0, return_counts=True)
            if reduced and len(rows) > dim:
                found.add_reduced(rows.astype(float), times)
                continue
            for x, n in zip(rows.astype(float), times.tolist()):
                found.add(x, n)
        if found.n:
            yield pa.RecordBatch.from_pylist([found.row(TaskContext.get().partitionId())], schema=schema)

    schema = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("mean", pa.binary()), ("values", pa.binary()), ("vectors", pa.binary())])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.rename(columns={"mean": "mean_", "values": "values_", "vectors": "vectors_"})
        first, *rest = (Spectrum.of(r) for r in rows.sort_values("n", ascending=False).itertuples())
        for other in rest:
            first.combine(other)
        return pd.DataFrame([first.row(int(rows["key"].iloc[0]))])

    row = up_the_tree(vectors.mapInArrow(own, SPECTRUM), merge).first()
    return Spectrum.of(pd.Series({"n": row.n, "mean_": bytes(row.mean), "values_": bytes(row["values"]), "vectors_": bytes(row.vectors)}))


def products(vectors: DataFrame, dim: int, make: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum of y'y over all usable vectors, where make() gives rows y of so many columns."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((width, width)), 0
        for whole in matrices(batches, dim):
            y = make(whole)
            total += y.T @ y
            n += len(y)
        if n:
            yield pa.RecordBatch.from_pydict({"key": pa.array([TaskContext.get().partitionId()], pa.int64()), "data": pa.array([total.tobytes()], pa.binary())})

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x) for x in rows["data"]], axis=0)
        return pd.DataFrame({"key": rows["key"].iloc[:1], "data": [total.tobytes()]})

    row = up_the_tree(vectors.mapInArrow(own, "key long, data binary"), merge).first()
    return np.frombuffer(bytes(row["data"])).reshape(width, width)


def scaled_distances(whole: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: of 64-bit integers if they are enough, else of Python's."""
    most = n * int(np.abs(whole).max(initial=0)) + max(map(abs, sums), default=0)
    if most < 1 << 62:
        return whole * n - np.array(sums, np.int64)
    return whole.astype(object) * n - np.array(sums, object)


def fit(table: DataFrame, embedding: str = "embedding", reduced: bool = False) -> Model | None:
    """The variances and axes of the usable vectors of table; None without any.

    Each vector is one update of its partition's spectrum. With `reduced`, for tables on which that takes too
    long, a batch of vectors is first turned into as many as they have entries, of the same scatter.

    Rows whose vector is null or empty or holds null or non-finite entries do not take part, nor do
    vectors of another length than the most frequent one (of equals the longest). Repeated rows count
    again. Entries beyond MOST / SCALE count as that.
    """
    vectors = table.select(table[quoted(embedding)].alias("v"))
    n, sums = totals(vectors)
    if not n:
        return None
    dim = len(sums)
    rough, _ = np.linalg.qr(spectrum(vectors, dim, reduced).vectors)

    def turned(whole: np.ndarray) -> np.ndarray:
        return (scaled_distances(whole, n, sums).astype(float) / n) @ rough

    values, turn = np.linalg.eigh(products(vectors, dim, turned, dim) / n)
    axes = (rough @ turn)[:, ::-1]
    # Either sign will do: the largest entry of an axis is positive.
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(dim)] < 0, -1.0, 1.0)
    return Model(n, sums, np.maximum(values[::-1], 0), axes, float(values.sum()))


def whitener(model: Model, components: int) -> tuple[np.ndarray, int]:
    """The matrix that makes whitened vectors of centred ones, and how many components vary at all."""
    varied = int((model.values > len(model.sums) * EPS * model.values[0]).sum())
    k = min(components, varied)
    return model.axes[:, :k] / np.sqrt(model.values[:k]), k


def identity_error(table: DataFrame, model: Model, components: int = COMPONENTS, embedding: str = "embedding") -> float | None:
    """The largest entry, of either sign, of the covariance of the whitened vectors minus the identity."""
    turn, k = whitener(model, components)
    if not k:
        return None

    def whitened(whole: np.ndarray) -> np.ndarray:
        own = (scaled_distances(whole, model.n, model.sums).astype(float) / model.n) @ turn
        return np.column_stack([own, np.ones(len(own))])

    found = products(table.select(table[quoted(embedding)].alias("v")), len(model.sums), whitened, k + 1) / model.n
    return float(np.abs(found[:k, :k] - np.outer(found[k, :k], found[k, :k]) - np.eye(k)).max())


def whiten(table: DataFrame, model: Model, keep: list[str] | None = None, components: int = COMPONENTS, embedding: str = "embedding") -> DataFrame:
    """Columns `keep` of table and, last, a struct: `whitened`, an array of doubles, and `deviation`.

    deviation is the sum over the entries of (n * x - sum)^2, exact, null if it is no long. Both are null in
    rows that did not take part in the fit; entries along axes without variance are null. Repeated rows each
    have their result, an empty table gives an empty one, other columns may have any names.
    """
    turn, k = whitener(model, components)
    shared = table.sparkSession.sparkContext.broadcast(turn)
    n, sums, dim = model.n, model.sums, len(model.sums)
    width = min(components, dim)

    def make() -> Callable:
        def work(lists: pa.Array) -> list[pa.Array]:
            places, squares, rows = [], [], []
            for start in range(0, len(lists), ROWS):
                at, _, whole = entries(lists.slice(start, ROWS), dim)
                apart = scaled_distances(whole.reshape(-1, dim), n, sums)
                places.append(at + start)
                squares += square_sums(apart)
                found = np.full((len(at), width), np.nan)
                found[:, :k] = (apart.astype(float) / n) @ shared.value
                rows.append(found)
            at = np.concatenate(places) if places else np.zeros(0, np.int64)
            flat = np.concatenate(rows).ravel() if rows else np.zeros(0)
            there = np.zeros(len(lists), bool)
            there[at] = True
            offsets = np.concatenate([[0], np.cumsum(there * width)]).astype(np.int32)
            starts = pa.array(offsets, pa.int32(), mask=np.append(~there, False))
            deviation = np.full(len(lists), None, object)
            deviation[at] = squares
            return [pa.ListArray.from_arrays(starts, pa.array(flat, pa.float64(), from_pandas=True)), pa.array(deviation, pa.int64())]

        return work

    return annotate(table, "whitened array<double>, deviation long", make, [embedding], keep)


def square_sums(apart: np.ndarray) -> list[int | None]:
    """The sum of squares of each row of integers; None where it is no long."""
    if not apart.size:
        return [0] * len(apart)
    if apart.dtype != object and int(np.abs(apart).max()) ** 2 * apart.shape[1] < 1 << 63:
        return (apart * apart).sum(axis=1).tolist()
    exact = [sum(x * x for x in map(int, row)) for row in apart.tolist()]
    return [x if x < 1 << 63 else None for x in exact]
