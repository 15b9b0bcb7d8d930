"""Resolving imports: procedure defaults, overrides, windows, flags and the choice of imports."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.calendar import with_calendar
from chronoweave.functions.text import blank_as_null, flag_set, sql_text, to_int
from chronoweave.model import OPEN_FROM, OPEN_UNTIL, Run

_OVERRIDES = ["p1", "p2", "p3", "p4", "p5", "schedule", "source", "group_by"]
_FIELDS = ["fields_source", "fields_target"]


def _text(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit(""))


def _override(name: str, default: str = "") -> Column:
    """The import's text if it has any, else the procedure's, trimmed."""
    own, shared = F.col(f"i.{name}"), F.col(f"p.{name}")
    return F.coalesce(blank_as_null(own), F.trim(shared), F.lit(default)).alias(name)


def _merged_filter() -> Column:
    own, shared = blank_as_null(F.col("i.filter")), blank_as_null(F.col("p.filter"))
    return F.concat_ws(" AND ", shared, F.concat(F.lit("("), own, F.lit(")")))


def _merged_commands() -> Column:
    return F.concat_ws(" ", blank_as_null(F.col("p.commands")), blank_as_null(F.col("i.commands")))


def _window(run_date: Column) -> tuple[Column, Column]:
    """Import date, import days, procedure date, procedure days, then no bound."""

    def days(side: str, name: str) -> Column:
        return F.trim(F.col(f"{side}.{name}")).try_cast("int")

    def date(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}").cast("date")

    return (
        F.coalesce(
            date("i", "date_import_from"),
            F.date_sub(run_date, days("i", "days_back")),
            date("p", "date_import_from"),
            F.date_sub(run_date, days("p", "days_back")),
            F.lit(OPEN_FROM),
        ),
        F.coalesce(
            date("i", "date_import_until"),
            F.date_add(run_date, days("i", "days_forward")),
            date("p", "date_import_until"),
            F.date_add(run_date, days("p", "days_forward")),
            F.lit(OPEN_UNTIL),
        ),
    )


def resolve_config(
    imports: DataFrame,
    procedures: DataFrame,
    activity: DataFrame,
    forecast: DataFrame,
    run_date: dt.date | None = None,
) -> DataFrame:
    """One row per import with everything a run needs; imports without a positive activity,
    forecast and site, or without their procedure, activity or forecast, drop out."""
    today = F.current_date() if run_date is None else F.lit(run_date)
    joined = (
        imports.alias("i")
        .join(procedures.alias("p"), F.col("i.procedure_id") == F.col("p.procedure_id"))
        .join(activity.alias("a"), F.col("i.activity_id") == F.col("a.activity_id"))
        .join(forecast.alias("f"), F.col("i.forecast_id") == F.col("f.forecast_id"))
        .where("i.activity_id > 0 AND i.forecast_id > 0 AND i.site_id > 0")
    )
    date_from, date_until = _window(today)
    old = F.lit(dt.datetime(1900, 1, 1)).cast("timestamp")
    order = lambda s: F.coalesce(F.col(f"{s}.sort_order").cast("int"), F.lit(1))
    active = [F.coalesce(F.col(f"{s}.active"), F.lit(False)) for s in "ipaf"]
    return joined.select(
        "i.import_id",
        "a.category",
        "a.domain",
        _text(F.col("p.procedure_name")).alias("procedure_name"),
        _text(F.col("p.procedure_code")).alias("procedure_code"),
        _text(F.col("p.app")).alias("app"),
        _text(F.col("p.status")).alias("status"),
        "p.procedure_id",
        _merged_commands().alias("commands"),
        "i.activity_id",
        "i.forecast_id",
        *[_override(n) for n in _OVERRIDES],
        *[_override(n, "value1") for n in _FIELDS],
        (order("p") * 1000 + order("a") * 100 + order("i")).alias("sort_order"),
        F.coalesce("p.description", F.lit("")).alias("description"),
        date_from.alias("date_import_from"),
        date_until.alias("date_import_until"),
        _merged_filter().alias("filter"),
        *[
            _text(F.col(f"a.{n}")).alias(n)
            for n in (
                "activity_name", "activity_set", "parent", "resource", "channel", "segment",
                "slicer1", "slicer2", "slicer3",
            )
        ],
        "f.forecast_name",
        "i.site_id",
        (active[0] & active[1] & active[2] & active[3]).cast("int").alias("active"),
        F.when(
            F.coalesce("i.date_updated", old) > F.coalesce("p.date_updated", old),
            F.col("i.date_updated"),
        )
        .otherwise(F.col("p.date_updated"))
        .alias("date_updated"),
        F.concat(_text(F.col("p.version")), F.lit(" "), _text(F.col("i.version"))).alias("version"),
        *[
            F.col(f"{s}.{n}").alias(f"{name}_{n}")
            for s, name in (("i", "import"), ("p", "procedure"))
            for n in ("days_back", "days_forward", "date_import_from", "date_import_until", "domain", "category")
        ],
    )


def select_imports(
    resolved: DataFrame,
    procedure_code: str | None = None,
    import_id: int = 0,
    site_id: int = 0,
    activity_id: int = 0,
    forecast_id: int = 0,
    procedure_name: str = "",
    category: str = "",
) -> DataFrame:
    """The active imports to run; 0 or blank means all. `procedure_name` is an id or a LIKE
    pattern. The order of running is by `sort_order, procedure_name`; see `in_run_order`."""
    rows = resolved.where(F.col("active") == 1)
    if procedure_code is not None:
        rows = rows.where(F.col("procedure_code") == procedure_code)
    for name, value in (
        ("import_id", import_id),
        ("activity_id", activity_id),
        ("forecast_id", forecast_id),
    ):
        if value:
            rows = rows.where(F.col(name) == value)
    if site_id:
        rows = rows.where((F.col("site_id") == site_id) | F.col("site_id").isNull())
    if procedure_name:
        by_name = F.col("procedure_name").like(procedure_name)
        number = to_int(procedure_name)
        rows = rows.where(by_name | (F.col("procedure_id") == number) if number else by_name)
    if category:
        rows = rows.where(F.col("procedure_category") == category)
    return rows


def in_run_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy("sort_order", "procedure_name", "import_id")


def parameter(name: str, own: Column, passed: Column) -> Column:
    """One key of the import's JSON parameters with those passed for the run laid over them;
    a key passed as null takes the import's own value away."""
    return F.when(F.map_contains_key(passed, name), passed[name]).otherwise(own[name])


def _parameters(text: Column) -> Column:
    kind = "map<string,string>"
    return F.coalesce(F.from_json(text, kind), F.create_map().cast(kind))


def with_parameters(
    rows: DataFrame, passed: str | Column = "{}", own: str = "p1", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Lays the JSON keys `date_import_from`, `date_import_until`, `source_import_id_field` and
    `intraday_duration` over the configuration; values that do not parse change nothing.
    `keep` names further keys to return as columns."""
    over = F.lit(passed) if isinstance(passed, str) else passed
    rows = rows.withColumns({"_own": _parameters(F.col(own)), "_passed": _parameters(over)})

    def value(name: str) -> Column:
        return parameter(name, F.col("_own"), F.col("_passed"))

    minutes = value("intraday_duration").try_cast("int")
    dates = ("date_import_from", "date_import_until")
    return rows.withColumns(
        {
            **{n: F.coalesce(value(n).try_cast("date"), F.col(n)) for n in dates},
            "source_import_id_field": F.coalesce(value("source_import_id_field"), F.lit("")),
            "intraday_duration": F.when(minutes > 0, minutes).otherwise(15),
            **{n: value(n) for n in keep},
        }
    ).drop("_own", "_passed")


def due(schedule: str) -> Column:
    """Whether a schedule holds, over the columns of `with_run_columns`; null counts as no."""
    return F.coalesce(F.expr(sql_text(schedule)), F.lit(False))


def with_run_columns(days: DataFrame) -> DataFrame:
    """What a schedule may test, for days with `date` and the time stamp `run_ts`: `run_date`
    and the calendar attributes."""
    return with_calendar(days.withColumn("run_date", F.col("date")))


def to_run(row, commands: str = "") -> Run:
    """A resolved row as an operator's input; the caller's commands go in front."""
    words = f"{commands} {row['commands']}".strip()
    return Run(
        import_id=row["import_id"],
        activity_id=row["activity_id"],
        forecast_id=row["forecast_id"],
        site_id=row["site_id"],
        date_from=row["date_import_from"],
        date_until=row["date_import_until"],
        **{
            n: row[n] or ""
            for n in (
                "source", "filter", "group_by", "fields_source", "fields_target", "schedule",
                "p1", "p2", "p3", "p4", "p5", "parent", "procedure_name",
            )
        },
        commands=words,
        sort_order=row["sort_order"],
        flags=flag_set(words),
    )


def current_year_window(run: Run, run_date: dt.date) -> Run:
    """An open bound becomes the first or last day of the current year."""
    first = dt.date(run_date.year, 1, 1) if run.date_from == OPEN_FROM else run.date_from
    last = dt.date(run_date.year, 12, 31) if run.date_until == OPEN_UNTIL else run.date_until
    return replace(run, date_from=first, date_until=last)


def to_json(values: dict) -> str:
    return json.dumps(values, default=str)
