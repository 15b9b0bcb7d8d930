"""Running totals and frames over blocks against plain windows, and the bound on what meets in a task."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoweave.operators.long_series import chunks, framed_sums, numbered_rows, running_totals

SERIES, ORDER = ["site_id", "activity_id"], ["day", "slot"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(6)
    made = []
    for site, activity, n in ((1, 1, 1500), (1, 2, 40), (None, 2, 25), (2, 7, 1), (2, 8, 0)):
        places = sorted(draw.sample(range(4000), n))
        made += [(site, activity, p // 40, p % 40, None if draw.random() < 0.1 else float(draw.randint(-5, 9)), p) for p in places]
    draw.shuffle(made)
    return spark.createDataFrame(made, "site_id int, activity_id int, day int, slot int, v double, w int").cache()


def plain(rows, columns):
    return sorted(map(str, rows.withColumns(columns).collect()))


@pytest.mark.parametrize("days", [1, 7, 1000])
def test_numbers_and_running_totals(rows, days):
    block, whole = F.floor(F.col("day") / days), W.partitionBy(*SERIES).orderBy(*ORDER)
    so_far = whole.rowsBetween(W.unboundedPreceding, W.currentRow)
    found = running_totals(rows, SERIES, ORDER, block, {"total": "v", "steps": "w"})
    assert sorted(map(str, found.collect())) == plain(rows, {"total": F.sum("v").over(so_far), "steps": F.sum("w").over(so_far)})
    found = numbered_rows(rows, SERIES, ORDER, block)
    assert sorted(map(str, found.collect())) == plain(rows, {"row_no": F.row_number().over(whole).cast("bigint")})


@pytest.mark.parametrize("size", [13, 64, 5000])
def test_frames(rows, size):
    frames = {"c1": ("v", -1, -1), "c4": ("v", -13, -7), "mean3": ("w", -1, 1), "later": ("v", 2, 5), "far": ("w", -13, 13)}
    whole = W.partitionBy(*SERIES).orderBy(*ORDER)
    found = framed_sums(rows, SERIES, ORDER, F.col("day"), frames, size)
    assert sorted(map(str, found.collect())) == plain(rows, {n: F.sum(c).over(whole.rowsBetween(a, b)) for n, (c, a, b) in frames.items()})


def test_no_group_is_larger_than_a_chunk_and_its_halo(rows):
    cut = chunks(rows, SERIES, ORDER, F.col("day"), 13, 2, 50)
    assert cut.groupBy(*SERIES, "_chunk").count().agg(F.max("count")).first()[0] <= 50 + 13 + 2
    assert cut.where("_chunk = _home").count() == rows.count()
    with pytest.raises(ValueError, match="reaches over"):
        chunks(rows, SERIES, ORDER, F.col("day"), 13, 2, 12)


def test_rows_never_meet_by_series_alone(rows):
    plan = running_totals(rows, SERIES, ORDER, F.col("day"), {"t": "v"})._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_carried" not in line]
    assert windows and all("_block" in line for line in windows)


def test_no_rows(rows):
    none = rows.limit(0)
    assert running_totals(none, SERIES, ORDER, F.col("day"), {"t": "v"}).count() == 0
    assert framed_sums(none, SERIES, ORDER, F.col("day"), {"c": ("v", -1, 0)}).count() == 0
