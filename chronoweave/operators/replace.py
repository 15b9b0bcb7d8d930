"""Replacing what an import wrote before, and marking the source rows it reads."""

from __future__ import annotations

import datetime as dt
import heapq
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions.text import sql_text
from chronoweave.model import SERIES, Run, broadcast_if_small, literal_rows, local_table
from chronoweave.functions.calendar import with_calendar
from chronoweave.operators.intervals import constant
from chronoweave.operators.matching import HITS, numbered, with_dates, with_hits

RANGE, TAIL, HEAD = "range", "tail", "head"

#: So many imports at most are tried one by one when source rows are marked.
FEW_MARKS = 16


@dataclass(frozen=True)
class Scope:
    """The stored rows an import replaces.

    `range` is from..until; `tail` is everything from the first day on, `head` everything
    before the last day. Without an activity, `filter` picks the activities.
    """

    import_id: int
    site_id: int
    forecast_id: int
    date_from: dt.date
    date_until: dt.date
    activity_id: int | None = None
    mode: str = RANGE
    filter: str = ""


def scope_of(run: Run) -> Scope:
    mode = TAIL if run.has("DELETE_TAIL") else HEAD if run.has("DELETE_HEAD") else RANGE
    return Scope(
        run.import_id, run.site_id, run.forecast_id, run.date_from, run.date_until,
        run.activity_id, mode,
    )


# Days since 1970-01-01 that no date lies beyond, either way.
_FIRST, _LAST = -10_000_000, 10_000_000


def _days(scope: Scope) -> tuple[int, int]:
    """First and last day of a scope, counted from 1970-01-01."""
    epoch = dt.date(1970, 1, 1)
    first, last = (scope.date_from - epoch).days, (scope.date_until - epoch).days
    return (first, _LAST) if scope.mode == TAIL else (_FIRST, last - 1) if scope.mode == HEAD else (first, last)


def owned_spans(spans: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Disjoint spans in order, each with the smallest number of the given (first, last, number) that hold it."""
    starts = sorted(s for s in spans if s[0] <= s[1])
    edges = sorted({e for first, last, _ in starts for e in (first, last + 1)})
    out: list[tuple[int, int, int]] = []
    active: list[tuple[int, int]] = []
    at = 0
    for start, end in zip(edges, edges[1:]):
        while at < len(starts) and starts[at][0] <= start:
            heapq.heappush(active, (starts[at][2], starts[at][1]))
            at += 1
        while active and active[0][1] < start:
            heapq.heappop(active)
        if active:
            owner = active[0][0]
            if out and out[-1][2] == owner and out[-1][1] == start - 1:
                out[-1] = (out[-1][0], end - 1, owner)
            else:
                out.append((start, end - 1, owner))
    return out


def scope_table(spark: SparkSession, scopes: Sequence[tuple[int, Scope]]) -> DataFrame:
    """One row per series: the first and last days of its spans and the number of the scope that owns each."""
    by_series: dict[tuple, list[tuple[int, int, int]]] = defaultdict(list)
    for number, s in scopes:
        by_series[s.site_id, s.activity_id, s.forecast_id].append((*_days(s), number))
    rows = []
    for key, spans in by_series.items():
        owned = owned_spans(spans)
        columns = zip(*owned) if owned else ([], [], [])
        rows.append(dict(zip([f"_{k}" for k in SERIES], (key[0], key[1], key[2])), **{n: list(c) for n, c in zip(("_firsts", "_lasts", "_numbers"), columns)}))
    return local_table(spark, rows, "_site_id int, _activity_id int, _forecast_id int, _firsts ints, _lasts ints, _numbers ints")


def _by_series(old: DataFrame, scopes: Sequence[tuple[int, Scope]]) -> DataFrame:
    """`old` with `_scope`, the number of the first scope of the row's series that holds its day: one search."""
    table = scope_table(old.sparkSession, scopes)
    found = old.join(table, [F.col(k) == F.col(f"_{k}") for k in SERIES], "left")
    most = len(scopes).bit_length()
    steps = constant([1 << k for k in range(most, -1, -1)], "array<int>")
    day = F.unix_date("date")

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get("_firsts", at + step - 1) <= day, at + step).otherwise(at)

    below = F.aggregate(steps, F.lit(0), further) - 1
    found = found.withColumn("_below", F.when(F.col("_firsts").isNotNull(), below))
    # Before the first span there is nothing to get: place -1.
    return found.select(*old.columns, F.when(F.get("_lasts", "_below") >= day, F.get("_numbers", "_below")).alias("_scope"))


def _by_filter(old: DataFrame, scopes: Sequence[tuple[int, Scope]], activity: DataFrame | None, dates: DataFrame | None) -> DataFrame:
    """`old` with `_scope`, the number of the first scope whose filter holds for the row."""
    found = old if activity is None else _left_activity(old, activity)
    found = with_dates(with_calendar(found), dates)
    texts = [
        f"site_id = {s.site_id} AND forecast_id = {s.forecast_id} AND date BETWEEN '{s.date_from}' AND '{s.date_until}'"
        + (f" AND ({sql_text(s.filter)})" if s.filter.strip() else "")
        for _, s in scopes
    ]
    found = with_hits(found, texts, only=False)
    numbers = constant([n for n, _ in scopes], "array<int>")
    return found.select(*old.columns, F.get(numbers, F.array_min(HITS)).alias("_scope"))


def with_owner(
    old: DataFrame, scopes: Sequence[Scope], activity: DataFrame | None = None, dates: DataFrame | None = None, name: str = "owner"
) -> DataFrame:
    """`old` with the import that replaces the row: of several the first in the order of the scopes; else null.

    Rows stay as many as they are, however many scopes overlap.
    """
    numbered_ = list(enumerate(scopes))
    series = [(n, s) for n, s in numbered_ if s.activity_id is not None]
    filters = [(n, s) for n, s in numbered_ if s.activity_id is None]
    columns, found, scope = old.columns, old, F.lit(None).cast("int")
    if series:
        found = _by_series(found, series).withColumnRenamed("_scope", "_first_scope")
        scope = F.col("_first_scope")
    if filters:
        found = _by_filter(found, filters, activity, dates)
        scope = F.least("_first_scope", "_scope") if series else F.col("_scope")
    ids = constant([s.import_id for s in scopes], "array<int>")
    return found.select(*columns, F.get(ids, scope).alias(name))


def without_scopes(
    old: DataFrame,
    scopes: Sequence[Scope],
    activity: DataFrame | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """The rows of `old` that no scope replaces."""
    return with_owner(old, scopes, activity, dates, "_owner").where("_owner is null").drop("_owner")


def _left_activity(rows: DataFrame, activity: DataFrame) -> DataFrame:
    extra = [c for c in activity.columns if c not in rows.columns]
    return rows.join(
        broadcast_if_small(activity.select("activity_id", *extra)), "activity_id", "left"
    )


def replaced_counts(
    old: DataFrame,
    scopes: Sequence[Scope],
    activity: DataFrame | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """`import_id, rows_deleted`: how many rows of `old` each scope replaces."""
    owned = with_owner(old, scopes, activity, dates, "_owner").where("_owner is not null")
    return owned.groupBy(F.col("_owner").alias("import_id")).agg(F.count(F.lit(1)).alias("rows_deleted"))


def replacement(
    old: DataFrame,
    new: DataFrame,
    scopes: Sequence[Scope],
    activity: DataFrame | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """All rows that take part in a replacement: those of `old` with `deleted_by`, the import that replaces them,
    and `new` with `inserted_by`. What stays is where `deleted_by` is null."""
    kept = with_owner(old, scopes, activity, dates, "deleted_by").withColumn("inserted_by", F.lit(None).cast("int"))
    added = new.select(*old.columns).withColumns({"deleted_by": F.lit(None).cast("int"), "inserted_by": F.col("import_id").cast("int")})
    return kept.unionByName(added)


def replacement_counts(rows: DataFrame) -> DataFrame:
    """`import_id, rows_deleted, rows_inserted` of a replacement, in one pass."""
    which = F.coalesce("deleted_by", "inserted_by")
    return rows.where(which.isNotNull()).groupBy(which.alias("import_id")).agg(
        F.count("deleted_by").alias("rows_deleted"), F.count("inserted_by").alias("rows_inserted")
    )


def replace_range(
    old: DataFrame,
    new: DataFrame,
    scopes: Sequence[Scope],
    activity: DataFrame | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """`old` with the rows of the scopes removed and `new` added; day and 15-minute facts alike."""
    return without_scopes(old, scopes, activity, dates).unionByName(new)


def write_back(
    source: DataFrame, runs: Sequence[Run], import_field: str = "import_id"
) -> DataFrame:
    """`source` with `import_field` set to the import that reads the row, and `updated_by`.

    Imports go in order, so the last one that reads a row keeps it; with
    `-SOURCE_UPDATE_NULL` an import only takes rows that have no id by then. `updated_by` is
    null on untouched rows; counting it per id gives the rows each import holds in the end.
    """
    old = F.col(import_field).cast("int")
    found, over, fill = (_marks_of_few if len(runs) <= FEW_MARKS else _marks)(source, runs)
    updated = F.coalesce(over, F.when(old.isNull(), fill))
    return found.withColumn("updated_by", updated).select(
        *[F.coalesce("updated_by", old).alias(c) if c == import_field else F.col(f"`{c}`") for c in source.columns],
        "updated_by",
    )


def _marks_of_few(source: DataFrame, runs: Sequence[Run]) -> tuple[DataFrame, Column, Column]:
    """As `_marks`, each import being tried on its own, which costs less for a few."""

    def read_by(r: Run) -> Column:
        text = sql_text(r.filter, source.columns)
        day = F.expr(sql_text(r.group_by, source.columns) or "date").cast("date")
        test = day.between(F.lit(r.date_from), F.lit(r.date_until))
        test = test & F.expr(text) if text else test
        test = test & (F.col("site_id") == r.site_id) if "site_id" in source.columns else test
        return F.when(test, F.lit(r.import_id))

    none = F.lit(None).cast("int")
    over = [read_by(r) for r in reversed(runs) if not r.has("SOURCE_UPDATE_NULL")]
    fill = [read_by(r) for r in runs if r.has("SOURCE_UPDATE_NULL")]
    return source, F.coalesce(*over, none), F.coalesce(*fill, none)


def _marks(source: DataFrame, runs: Sequence[Run]) -> tuple[DataFrame, Column, Column]:
    """`source` with what is needed to tell the last import that overwrites a row's mark, and the first that
    fills in a missing one."""
    site = "site_id" in source.columns
    filters = numbered(sql_text(r.filter, source.columns) for r in runs)
    days = numbered(sql_text(r.group_by, source.columns) or "date" for r in runs)
    by_filter: list[list[dict]] = [[] for _ in filters]
    for place, r in enumerate(runs):
        by_filter[filters[sql_text(r.filter, source.columns)]].append(
            {
                "place": place,
                "id": r.import_id,
                "fills": r.has("SOURCE_UPDATE_NULL"),
                "day": days[sql_text(r.group_by, source.columns) or "date"],
                "site": r.site_id,
                "first": r.date_from,
                "last": r.date_until,
            }
        )
    # One expression, however many imports there are: the imports of the filters that a row
    # meets, those of its day and site, and among them the last that overwrites, else the old
    # id, else the first that fills gaps.
    marks = literal_rows(
        [{"imports": m} for m in by_filter],
        "imports array<struct<place: int, id: int, fills: boolean, day: int, site: int, first: date, last: date>>",
    )
    found = with_hits(source, list(filters), only=False)
    found = found.withColumn("_days", F.array(*[F.expr(d).cast("date") for d in days]))

    def reads(m: Column) -> Column:
        test = F.get("_days", m["day"]).between(m["first"], m["last"])
        return test & (F.col("site_id") == m["site"]) if site else test

    met = F.flatten(F.transform(HITS, lambda h: F.get(marks, h)["imports"]))
    found = found.withColumn("_met", F.filter(met, reads))

    def choose(kind: bool, pick) -> Column:
        own = F.filter("_met", lambda m: m["fills"] == kind)
        return pick(F.transform(own, lambda m: F.struct(m["place"], m["id"])))["id"]

    return found, choose(False, F.array_max), choose(True, F.array_min)
