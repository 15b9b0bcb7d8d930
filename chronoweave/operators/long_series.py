"""Running totals and lags over series of any length, without a task that holds a whole series.

A window over a series puts all its rows into one task. That is well for days, of which a series has some
thousands, but not for quarter hours of many years or a series that holds a third of all rows. Here a series
is cut into blocks of time. What the blocks before carry over, a number of rows and a sum each, comes from
one aggregation with a row a block; the rows themselves only meet those of their block. Frames that reach
over the edge of a block get the few rows beyond it as well, a halo.

Rows of a series need different values of the columns in `order`, and `block` must grow with them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of a chunk in which frames are computed, beside its halo.
CHUNK_ROWS = 4096


def with_carried(rows: DataFrame, series: Sequence[str], block: Column, values: dict[str, Column]) -> DataFrame:
    """The rows with `_block` and, for each of `values`, its sum over the blocks before as `_carried_<name>`.

    Sums of a block are combined before the shuffle; a series has one row a block here.
    """
    cut = rows.withColumn("_block", block)
    sums = cut.groupBy(*series, "_block").agg(*[F.sum(v).alias(f"_sum_{n}") for n, v in values.items()])
    before = W.partitionBy(*series).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select(*series, "_block", *[F.sum(f"_sum_{n}").over(before).alias(f"_carried_{n}") for n in values])
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in series] + [F.col("a._block") == F.col("b._block")]
    return cut.alias("a").join(carried.alias("b"), same).select("a.*", *[f"b._carried_{n}" for n in values])


def numbered_rows(rows: DataFrame, series: Sequence[str], order: Sequence[str], block: Column, name: str = "row_no") -> DataFrame:
    """The rows with their number in the series, from 1."""
    found = with_carried(rows, series, block, {"n": F.lit(1)})
    here = W.partitionBy(*series, "_block").orderBy(*order)
    number = F.coalesce("_carried_n", F.lit(0)) + F.row_number().over(here)
    return found.select(*rows.columns, number.cast("bigint").alias(name))


def running_totals(rows: DataFrame, series: Sequence[str], order: Sequence[str], block: Column, totals: dict[str, str]) -> DataFrame:
    """The rows with a running total for each (new name: column); null before the first value."""
    found = with_carried(rows, series, block, {n: F.col(c) for n, c in totals.items()})
    here = W.partitionBy(*series, "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    own = {n: F.sum(c).over(here) for n, c in totals.items()}
    whole = {n: F.coalesce(F.col(f"_carried_{n}") + own[n], F.col(f"_carried_{n}"), own[n]) for n in totals}
    return found.select(*rows.columns, *[v.alias(n) for n, v in whole.items()])


def chunks(rows: DataFrame, series: Sequence[str], order: Sequence[str], block: Column, back: int, ahead: int, size: int) -> DataFrame:
    """Numbered rows in chunks of `size`, `_chunk`, each with the last `back` rows before and the first `ahead` behind it.

    Rows of the halo have another `_home` than their chunk.
    """
    if max(back, ahead) > size:
        raise ValueError(f"a frame of {max(back, ahead)} rows reaches over a chunk of {size}")
    found = numbered_rows(rows, series, order, block, "_no").withColumn("_home", F.floor((F.col("_no") - 1) / size))
    place = (F.col("_no") - 1) % size
    also = F.array(
        F.col("_home"),
        F.when(place >= size - back, F.col("_home") + 1),
        F.when((place < ahead) & (F.col("_home") > 0), F.col("_home") - 1),
    )
    return found.withColumn("_chunk", F.explode(F.array_compact(also)))


def framed_sums(
    rows: DataFrame, series: Sequence[str], order: Sequence[str], block: Column, frames: dict[str, tuple[str, int, int]], size: int = CHUNK_ROWS
) -> DataFrame:
    """The rows with, for each (new name: (column, first, last)), the sum of the column over the rows from `first`
    to `last` places on (before the row: below 0); null where there is none. (column, -n, -n) is a lag of n."""
    back = max(0, *[-first for _, first, _ in frames.values()])
    ahead = max(0, *[last for _, _, last in frames.values()])
    cut = chunks(rows, series, order, block, back, ahead, size)
    here = W.partitionBy(*series, "_chunk").orderBy("_no")
    sums = {n: F.sum(c).over(here.rowsBetween(first, last)) for n, (c, first, last) in frames.items()}
    return cut.withColumns(sums).where("_chunk = _home").select(*rows.columns, *frames)
