"""Calendar attributes and year bounds as column expressions.

Every attribute is a function of the date alone, so operators add the ones they need to
their rows in place; a join to a date table is only needed for attributes a user maintains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A Monday: week 0 of the continuous week count.
WEEK_ZERO = "2000-01-03"


def day_week(d: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(d) + 1


def iso_year(d: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), d).cast("int")


def continuous_week(d: Column) -> Column:
    """Weeks since 2000-01-03, negative before it; never restarts at a new year."""
    return F.floor(F.datediff(d, F.lit(WEEK_ZERO).cast("date")) / 7).cast("int")


def calendar_columns(d: Column) -> dict[str, Column]:
    """Attribute name -> expression, for the date `d`."""
    year, month, week, year52 = F.year(d), F.month(d), F.weekofyear(d), iso_year(d)
    return {
        "year": year,
        "month": month,
        "day_month": F.dayofmonth(d),
        "day_week": day_week(d),
        "week": week,
        "year52": year52,
        "year_month": year * 100 + month,
        "year_month_char": F.date_format(d, "yyyyMM"),
        "year_week": year52 * 100 + week,
        "year_week_short": F.concat(year52.cast("string"), F.lit("W"), F.lpad(week.cast("string"), 2, "0")),
        "year_quarter": year * 10 + F.quarter(d),
        "month_days": F.dayofmonth(F.last_day(d)),
        "day_year": F.dayofyear(d),
        "weeks_2000": continuous_week(d),
    }


def with_calendar(rows: DataFrame, date: str = "date") -> DataFrame:
    """Rows plus the calendar attributes they do not have yet."""
    have = set(rows.columns)
    return rows.withColumns(
        {n: c for n, c in calendar_columns(F.col(date)).items() if n not in have}
    )


def _day(d: Column | None) -> Column:
    return F.current_date() if d is None else F.coalesce(d.cast("date"), F.current_date())


def _first_of_year(d: Column | None, years: int) -> Column:
    return F.add_months(F.trunc(_day(d), "YEAR"), 12 * years)


def first_day_current_year(d: Column | None = None) -> Column:
    """1 January of the year of `d`; a null or absent date means today, as in all of these."""
    return _first_of_year(d, 0)


def first_day_next_year(d: Column | None = None) -> Column:
    return _first_of_year(d, 1)


def first_day_previous_year(d: Column | None = None) -> Column:
    return _first_of_year(d, -1)


def last_day_current_year(d: Column | None = None) -> Column:
    return F.date_sub(_first_of_year(d, 1), 1)


def last_day_next_year(d: Column | None = None) -> Column:
    return F.date_sub(_first_of_year(d, 2), 1)


def last_day_previous_year(d: Column | None = None) -> Column:
    return F.date_sub(_first_of_year(d, 0), 1)


def first_day_current_year_week(d: Column | None = None) -> Column:
    """Monday of ISO week 1 of the calendar year of `d` (the week that holds 4 January)."""
    return _week_one(F.year(_day(d)))


def _week_one(iso: Column) -> Column:
    """Monday of week 1 of an ISO year."""
    return F.trunc(F.make_date(iso, F.lit(1), F.lit(4)), "WEEK")


def same_week_in_year(d: Column, years: Column) -> Column:
    """The day with the same ISO week and weekday `years` ISO years later; null if that year
    lacks the week (week 53)."""
    year = iso_year(d)
    day = F.date_add(d, F.datediff(_week_one(year + years), _week_one(year)))
    return F.when(day < _week_one(year + years + 1), day)


def same_day_in_year(d: Column, years: Column) -> Column:
    """The same day and month `years` years later; null for 29 February in a common year."""
    day = F.add_months(d, years * 12)
    return F.when(F.dayofmonth(day) == F.dayofmonth(d), day)


def day_of_year_in(year: Column, day_year: Column) -> Column:
    """Day number `day_year` of `year`; null if the year is too short."""
    day = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day_year - 1)
    return F.when(F.year(day) == year, day)
