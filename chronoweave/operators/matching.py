"""Which rows does each import read?

Filters are free SQL text per import, so thousands of imports could mean thousands of scans.
Here all distinct filters are tried in one pass over the rows, however many there are, and
imports are attached afterwards by an equi-join on the number of the filter plus the keys.
Operators aggregate between the two steps, so rows are never copied once per import. Filters
that only ask for constants in columns are looked up by an equi-join, those with ranges of
values by a search in their bounds; only the others are tried one by one.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions.calendar import with_calendar
from chronoweave.functions.text import sql_text
from chronoweave.model import Run, broadcast_if_small, local_table
from chronoweave.operators.intervals import Conjunction, conjunction, hull, interval_hits

ANY = -1
#: So many filters with ranges are searched for; fewer are tried one by one, which costs less.
LEAST_INDEXED = 16
HITS = "_filter_hits"

KEYS = ["filter_no", "site_id", "activity_key", "forecast_key"]


@dataclass(frozen=True)
class Want:
    """What one import reads: rows of a filter, narrowed to a key where the import gives one."""

    run: Run
    filter: str = ""
    activity: int = ANY
    forecast: int = ANY
    role: str = ""


def match_filters(rows: DataFrame, filters: Sequence[str], number: str = "filter_no") -> DataFrame:
    """Each row once per filter it meets, with the filter's position in `number`."""
    if len(filters) == 1:
        text = filters[0]
        return (rows.where(F.expr(text)) if text else rows).withColumn(number, F.lit(0))
    found = with_hits(rows, filters)
    return found.select(*rows.columns, F.explode(HITS).alias(number))


def with_hits(rows: DataFrame, filters: Sequence[str], only: bool = True) -> DataFrame:
    """The rows with an array of the numbers of the filters they meet, in one pass.

    Filters that only ask for constants are looked up by an equi-join on their columns, one table
    per set of columns, and many filters with ranges in an index of their bounds; the others are
    tried on the row. With `only`, rows that meet none may be left out, by a condition that can
    reach the scan.
    """
    kinds = dict(rows.dtypes)
    lookups: dict[tuple[str, ...], list[tuple[int, dict]]] = {}
    tried: list[tuple[int, str]] = []
    indexed: list[tuple[int, Conjunction]] = []
    for n, text in enumerate(filters):
        constants = _constants(text, kinds)
        if constants is not None:
            lookups.setdefault(tuple(sorted(constants)), []).append((n, constants))
        elif (found := conjunction(text, kinds)).ranges:
            indexed.append((n, found))
        else:
            tried.append((n, text))
    if len(indexed) < LEAST_INDEXED:
        tried, indexed = sorted([*tried, *[(n, filters[n]) for n, _ in indexed]]), []
    outline = hull([f for _, f in indexed])
    if only and all(text for _, text in tried) and (outline or not indexed):
        among = [
            reduce(lambda a, b: a & b, [F.expr(_in(c, {k[c] for _, k in found})) for c in columns])
            for columns, found in lookups.items()
        ]
        whole = [F.expr(outline)] if indexed else []
        rows = rows.where(_any([*among, *whole, *[F.expr(text) for _, text in tried]]))
    return _look_up(rows, lookups, tried, indexed)


def _any(tests: list[Column]) -> Column:
    """Any of the tests, as a balanced tree, so that its depth stays small."""
    while len(tests) > 1:
        tests = [reduce(lambda a, b: a | b, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


def _in(column: str, values: Iterable) -> str:
    """SQL for `column` being one of some whole numbers or texts without quotes or escapes."""
    listed = [f"'{v}'" if isinstance(v, str) else str(v) for v in sorted(values)]
    return f"`{column}` in ({', '.join(listed)})"


def numbered(values: Iterable) -> dict:
    """Distinct values in order of appearance, each with its position."""
    return {v: i for i, v in enumerate(dict.fromkeys(values))}


def _tried(filters: Sequence[tuple[int, str]]) -> Column:
    """The numbers of the filters that a row meets, each filter being tried."""
    tests = [(n, F.expr(f) if f else F.lit(True)) for n, f in filters]
    return F.array_remove(F.array(*[F.when(t, F.lit(n)).otherwise(ANY) for n, t in tests]), ANY)


_COMPARED = re.compile(r"[\s(]*`?(\w+)`?\s*=\s*(?:'([^'\\]*)'|(-?\d{1,18}))[\s)]*")
_WHOLE = {"tinyint", "smallint", "int", "bigint"}


def _constants(text: str, kinds: dict[str, str]) -> dict[str, object] | None:
    """Column -> constant, if the filter is nothing but such comparisons joined by AND."""
    out: dict[str, object] = {}
    for part in re.split(r"\bAND\b", text, flags=re.IGNORECASE):
        m = _COMPARED.fullmatch(part)
        if m is None or m.group(1) in out:
            return None
        column, word, whole = m.groups()
        kind = kinds.get(column)
        if word is not None and kind == "string":
            out[column] = word
        elif whole is not None and kind in _WHOLE:
            out[column] = int(whole)
        else:
            return None
    return out if text.count("(") == text.count(")") else None


def _look_up(
    rows: DataFrame,
    lookups: dict[tuple[str, ...], list[tuple[int, dict]]],
    tried: Sequence[tuple[int, str]],
    indexed: Sequence[tuple[int, Conjunction]],
) -> DataFrame:
    """Constant filters by a join on their columns, together with those of an index and those tried."""
    kinds, columns_in = dict(rows.dtypes), rows.columns
    hits = [_tried(tried)] if tried else []
    if indexed:
        hits.append(interval_hits(rows, indexed))
    for i, (columns, found) in enumerate(lookups.items()):
        numbers: dict[tuple, list[int]] = {}
        for n, constants in found:
            numbers.setdefault(tuple(constants[c] for c in columns), []).append(n)
        keys = {c: f"_key{i}_{j}" for j, c in enumerate(columns)}
        types = {c: "string" if kinds[c] == "string" else "bigint" for c in columns}
        table = local_table(
            rows.sparkSession,
            [{f"_hits{i}": n, **dict(zip(keys.values(), values))} for values, n in numbers.items()],
            f"_hits{i} ints, " + ", ".join(f"{keys[c]} {types[c]}" for c in columns),
        )
        rows = rows.withColumns({k: F.col(c).cast(types[c]) for c, k in keys.items()})
        rows = rows.join(table, list(keys.values()), "left")
        hits.append(F.coalesce(f"_hits{i}", F.array().cast("array<int>")))
    return rows.select(*columns_in, F.concat(*hits).alias(HITS))


class Reading:
    """The rows wanted by a set of imports, and the table that attaches the imports to them."""

    def __init__(self, spark: SparkSession, wants: Sequence[Want]):
        self.spark = spark
        self.wants = list(wants)
        self._number = numbered(sql_text(w.filter) for w in self.wants)
        self.filters = list(self._number)
        self._kinds = sorted({(w.activity != ANY, w.forecast != ANY) for w in self.wants})

    def rows(self, source: DataFrame) -> DataFrame:
        """Rows that some import reads, with the join keys of `attach`.

        Literal bounds on the key columns reach the scan; the exact keys are settled by the
        join.
        """
        rows = source
        sites = sorted({w.run.site_id for w in self.wants})
        rows = rows.where(_among("site_id", sites))
        if all(a for a, _ in self._kinds):
            rows = rows.where(_among("activity_id", sorted({w.activity for w in self.wants})))
        if all(f for _, f in self._kinds):
            rows = rows.where(_among("forecast_id", sorted({w.forecast for w in self.wants})))
        matched = match_filters(rows, self.filters)

        def key(column: str, given: bool) -> Column:
            return (F.col(column) if given else F.lit(ANY)).cast("int")

        if len(self._kinds) == 1:
            a, f = self._kinds[0]
            return matched.withColumns(
                {"activity_key": key("activity_id", a), "forecast_key": key("forecast_id", f)}
            )
        pairs = F.array(
            *[
                F.struct(
                    key("activity_id", a).alias("activity_key"),
                    key("forecast_id", f).alias("forecast_key"),
                )
                for a, f in self._kinds
            ]
        )
        return (
            matched.withColumn("_pair", F.explode(pairs))
            .withColumns(
                {"activity_key": F.col("_pair.activity_key"), "forecast_key": F.col("_pair.forecast_key")}
            )
            .drop("_pair")
        )

    def runs(self, extra: dict[str, tuple[str, object]] | None = None) -> DataFrame:
        """One row per import: the join keys, the window, the series to write and `extra`.

        `extra` maps a column name to its type and a function of the `Want`.
        """
        extra = extra or {}
        rows = [
            {
                "filter_no": self._number[sql_text(w.filter)],
                "site_id": w.run.site_id,
                "activity_key": w.activity,
                "forecast_key": w.forecast,
                "import_id": w.run.import_id,
                "to_activity": w.run.activity_id,
                "to_forecast": w.run.forecast_id,
                "date_from": w.run.date_from,
                "date_until": w.run.date_until,
                **{name: value(w) for name, (_, value) in extra.items()},
            }
            for w in self.wants
        ]
        ddl = (
            "filter_no int, site_id int, activity_key int, forecast_key int, import_id int, "
            "to_activity int, to_forecast int, date_from date, date_until date"
        )
        return local_table(
            self.spark, rows, ddl + "".join(f", {n} {t}" for n, (t, _) in extra.items())
        )

    def attach(self, rows: DataFrame, extra: dict | None = None) -> DataFrame:
        return rows.join(self.runs(extra), KEYS)

    def earliest(self, days_before: int = 0):
        first = min(w.run.date_from for w in self.wants)
        return first if (first - dt.date.min).days <= days_before else first - dt.timedelta(days=days_before)

    def latest(self):
        return max(w.run.date_until for w in self.wants)

    def in_any_window(self, rows: DataFrame, date: str = "date", days_before: int = 0) -> DataFrame:
        """Rows between the first and the last day that any import asks for."""
        return rows.where(F.col(date).between(F.lit(self.earliest(days_before)), F.lit(self.latest())))


def _among(column: str, values: Sequence[int]) -> Column:
    """`column` is one of `values`; for long lists the scan itself tests their range."""
    return F.expr(_in(column, values))


def own_window() -> Column:
    return F.col("date").between(F.col("date_from"), F.col("date_until"))


def target_series(rows: DataFrame) -> DataFrame:
    """Names the written series after the attached import."""
    return rows.withColumns(
        {"activity_id": F.col("to_activity"), "forecast_id": F.col("to_forecast")}
    )


def filterable(
    facts: DataFrame, activity: DataFrame | None, dates: DataFrame | None = None
) -> DataFrame:
    """Facts with activity and calendar attributes; those that no filter uses are pruned."""
    return with_dates(with_calendar(with_activity(facts, activity)), dates)


def with_dates(rows: DataFrame, dates: DataFrame | None) -> DataFrame:
    """Rows plus the attributes a user keeps in a date table; null on days it does not hold."""
    if dates is None:
        return rows
    extra = [c for c in dates.columns if c not in rows.columns]
    if not extra:
        return rows
    kept = dates.select(F.col("date").cast("date").alias("date"), *extra).dropDuplicates(["date"])
    return rows.join(broadcast_if_small(kept), "date", "left")


def with_activity(facts: DataFrame, activity: DataFrame | None) -> DataFrame:
    """Facts with the activity's attributes for filters; facts of unknown activities drop out.
    Without an activity table only the fact columns can be filtered on."""
    if activity is None:
        return facts
    extra = [c for c in activity.columns if c not in facts.columns]
    return facts.join(broadcast_if_small(activity.select("activity_id", *extra)), "activity_id")
