"""Forecasts by log-linear equations whose coefficients come from staged files."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoweave.functions.calendar import day_week
from chronoweave.functions.text import field_list, sql_text, to_int
from chronoweave.model import Run, as_fact_day, local_table
from chronoweave.operators.matching import ANY, KEYS, Reading, Want, match_filters, numbered

# Days of history read before the window, enough for the longest lag.
HISTORY_DAYS = 30

# Rows back (from, to) that each lag category sums.
LAG_ROWS = {0: (0, 0), 1: (-1, -1), 2: (-2, -2), 3: (-6, -3), 4: (-13, -7)}
CATEGORIES = tuple(LAG_ROWS)
WEEKDAYS = (1, 2, 3, 4, 5, 6)

# Staged-file columns of the coefficients.
LAG_LAYOUT = {"offset": "D", "inc": "E", "d1": "F", "d2": "G", "d3": "H", "d4": "I", "d5": "J", "d6": "K", "f": "L"}
SIMPLE_LAYOUT = {
    "offset": "D", "cat0": "F", "cat1": "G", "cat2": "H", "cat3": "I", "cat4": "J",
    "d1": "K", "d2": "L", "d3": "M", "d4": "N", "d5": "O", "d6": "P",
}


def check(run: Run) -> None:
    if not run.filter.strip():
        raise ValueError(f"import {run.import_id}: the filter must define the input series")
    if not run.p1.strip():
        raise ValueError(f"import {run.import_id}: p1 must select the parameter rows")


def wants(runs: Sequence[Run]) -> list[Want]:
    """A filter that names no activity reads the parent's; one that names no forecast reads 0."""
    out = []
    for r in runs:
        check(r)
        text = r.filter.lower()
        out.append(
            Want(
                r,
                filter=r.filter,
                activity=ANY if "activity" in text else to_int(r.parent),
                forecast=ANY if "forecast" in text else 0,
            )
        )
    return out


def daily_input(facts: DataFrame, runs: Sequence[Run], dense: bool = False) -> DataFrame:
    """`import_id, date, value1` and the target keys: the summed input of each import."""
    reading = Reading(facts.sparkSession, wants(runs))
    rows = reading.rows(reading.in_any_window(facts, days_before=HISTORY_DAYS))
    per_day = rows.groupBy(*KEYS, "date").agg(F.sum("value1").alias("value1"))
    daily = reading.attach(per_day).where(
        F.col("date").between(F.date_sub("date_from", HISTORY_DAYS), F.col("date_until"))
    )
    if not dense:
        return daily
    keys = [c for c in daily.columns if c not in ("date", "value1")]
    span = (
        daily.groupBy(*keys)
        .agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
        .select(*keys, F.explode(F.sequence("_lo", "_hi")).alias("date"))
    )
    return span.join(daily.select("import_id", "date", "value1"), ["import_id", "date"], "left")


def lag_categories(daily: DataFrame) -> DataFrame:
    """Adds c0..c4. Lags count rows with data; null where no such row exists.

    One window pass per import: a partition holds one row per day of the import's window.
    """
    by_date = W.partitionBy("import_id").orderBy("date")
    value = F.coalesce("value1", F.lit(0.0))
    return daily.withColumns(
        {
            f"c{k}": value if k == 0 else F.sum(value).over(by_date.rowsBetween(lo, hi))
            for k, (lo, hi) in LAG_ROWS.items()
        }
    )


def parameter_rows(
    staged: DataFrame, runs: Sequence[Run], layout: dict[str, str]
) -> DataFrame:
    """`import_id, cat` and the coefficients: staged rows of `p1` whose column A is the activity."""
    filters = numbered(sql_text(r.p1) for r in runs)
    table = local_table(
        staged.sparkSession,
        [
            {"import_id": r.import_id, "_p": filters[sql_text(r.p1)], "_a": r.activity_id}
            for r in runs
        ],
        "import_id int, _p int, _a int",
    )
    rows = match_filters(staged, list(filters), "_p").withColumn("_a", F.trim("A").try_cast("int"))
    return rows.join(table, ["_p", "_a"]).select(
        "import_id",
        F.right(F.trim("C"), F.lit(1)).try_cast("int").alias("cat"),
        *[F.trim(F.col(c)).try_cast("double").alias(n) for n, c in layout.items()],
    )


def lag_parameters(staged: DataFrame, runs: Sequence[Run]) -> DataFrame:
    """One row per import: `p0..p4`, the coefficients per category, `n` and `repeated`."""
    rows = parameter_rows(staged, runs, LAG_LAYOUT)
    coefficients = F.struct(*LAG_LAYOUT)
    one = {k: F.col("cat") == k for k in CATEGORIES}
    rows = rows.where(F.col("cat").isin(*CATEGORIES))
    return rows.groupBy("import_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.greatest(*[F.count_if(one[k]) for k in CATEGORIES]).__gt__(1).alias("repeated"),
        *[F.max(F.when(one[k], coefficients)).alias(f"p{k}") for k in CATEGORIES],
    )


def _weekday_effect(day: Column, coefficient) -> Column:
    effect = F.lit(0.0)
    for k in WEEKDAYS:
        effect = effect + (day == k).cast("double") * coefficient(f"d{k}")
    return effect


def _clamped(x: Column) -> Column:
    """Negative becomes 0; null stays null."""
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def regression_lag_categories(
    facts: DataFrame,
    staged: DataFrame,
    runs: Sequence[Run],
    when: dt.datetime | None = None,
    dense: bool = False,
) -> DataFrame:
    """Sum of one log-linear equation per lag category.

    `value2..value6` are the categories today, 1, 2, 3-6 and 7-13 rows back, each
    `exp(offset + inc*ln(c+f) + weekday) - f` and not below 0; `value1` is their sum and
    `value8` the sum without today. `fields_source` may be expressions over these.
    `dense` counts lags in days instead of rows with data.
    """
    lagged = lag_categories(daily_input(facts, runs, dense)).where(
        F.col("date").between(F.col("date_from"), F.col("date_until"))
    )
    parameters = lag_parameters(staged, runs).where(
        F.when(
            F.col("repeated"),
            F.raise_error(
                F.concat(F.lit("repeated parameter category for import "), F.col("import_id").cast("string"))
            ).cast("boolean"),
        ).otherwise(F.lit(True))
    )
    joined = lagged.join(parameters, "import_id")
    day = day_week(F.col("date"))

    def category(k: int) -> Column:
        def p(name: str) -> Column:
            return F.col(f"p{k}.{name}")

        y = F.exp(
            p("offset") + p("inc") * F.ln(F.col(f"c{k}") + p("f")) + _weekday_effect(day, p)
        ) - p("f")
        # A lone category without its lag stays null; otherwise the other rows count it as 0.
        alone = (F.col("n") == 1) & F.col(f"p{k}").isNotNull()
        return _clamped(F.when(alone, y).otherwise(F.coalesce(y, F.lit(0.0))))

    values = joined.withColumns({f"value{k + 2}": category(k) for k in CATEGORIES})
    later = F.col("value3") + F.col("value4") + F.col("value5") + F.col("value6")
    values = values.withColumns({"value1": F.col("value2") + later, "value8": later}).withColumns(
        {f"value{i}": F.lit(None).cast("double") for i in (7, 9, 10)}
    )
    shapes: dict[tuple, list[int]] = defaultdict(list)
    for r in runs:
        fields = field_list(r.fields_source) or ["value1"]
        targets = field_list(r.fields_target) or ["value1"]
        if len(fields) != len(targets):
            raise ValueError(f"import {r.import_id}: source and target fields differ in number")
        shapes[tuple(fields), tuple(targets)].append(r.import_id)
    # Many shapes would repeat the plan above, so the mapping is by column, not by branch.
    keys = ["date", "import_id", "site_id", "to_activity", "to_forecast"]
    mapped: dict[str, Column] = {}
    for (fields, targets), ids in shapes.items():
        for f, t in zip(fields, targets):
            name = t.strip("`")
            value = F.expr(f).try_cast("double")
            value = value if len(shapes) == 1 else F.when(F.col("import_id").isin(*ids), value)
            mapped[name] = F.coalesce(mapped[name], value) if name in mapped else value
    out = values.select(*keys, *[c.alias(n) for n, c in mapped.items()])
    return as_fact_day(
        out.withColumnsRenamed({"to_activity": "activity_id", "to_forecast": "forecast_id"}), when
    )


def regression_simple(
    facts: DataFrame,
    staged: DataFrame,
    runs: Sequence[Run],
    when: dt.datetime | None = None,
    dense: bool = False,
) -> DataFrame:
    """One equation over all five lag terms, summed over the import's parameter rows:
    `exp(offset + sum(cat_i * ln(1+c_i)) + weekday) - 1`. A day without a full history is null."""
    lagged = lag_categories(daily_input(facts, runs, dense)).where(
        F.col("date").between(F.col("date_from"), F.col("date_until"))
    )
    logs = lagged.withColumns({f"l{k}": F.ln(1 + F.col(f"c{k}")) for k in CATEGORIES})
    joined = logs.join(parameter_rows(staged, runs, SIMPLE_LAYOUT), "import_id")
    terms = F.col("offset")
    for k in CATEGORIES:
        terms = terms + F.col(f"l{k}") * F.col(f"cat{k}")
    terms = terms + _weekday_effect(day_week(F.col("date")), F.col)
    keys = ["date", "import_id", "site_id", "to_activity", "to_forecast"]
    found = joined.groupBy(*keys).agg(F.sum(F.exp(terms) - 1).alias("value"))
    target_of = {r.import_id: (field_list(r.fields_target) or ["value1"])[0].strip("`") for r in runs}
    names = sorted(set(target_of.values()))
    mapped = found.select(
        "date",
        "import_id",
        "site_id",
        F.col("to_activity").alias("activity_id"),
        F.col("to_forecast").alias("forecast_id"),
        *[
            (
                F.col("value")
                if len(names) == 1
                else F.when(
                    F.col("import_id").isin(*[i for i, t in target_of.items() if t == n]), F.col("value")
                )
            ).alias(n)
            for n in names
        ],
    )
    return as_fact_day(mapped, when)


