"""The library's functions under SQL names, for filters, schedules and reports in SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

_DAY = "coalesce(d, current_date())"

# Name -> (parameter, result type, body). Spark inlines these, so filters that use them are
# optimised and pushed down like any other expression.
FUNCTIONS = {
    "first_day_current_year": ("d DATE DEFAULT NULL", "DATE", f"trunc({_DAY}, 'YEAR')"),
    "first_day_next_year": ("d DATE DEFAULT NULL", "DATE", f"add_months(trunc({_DAY}, 'YEAR'), 12)"),
    "first_day_previous_year": ("d DATE DEFAULT NULL", "DATE", f"add_months(trunc({_DAY}, 'YEAR'), -12)"),
    "last_day_current_year": ("d DATE DEFAULT NULL", "DATE", f"date_sub(add_months(trunc({_DAY}, 'YEAR'), 12), 1)"),
    "last_day_next_year": ("d DATE DEFAULT NULL", "DATE", f"date_sub(add_months(trunc({_DAY}, 'YEAR'), 24), 1)"),
    "last_day_previous_year": ("d DATE DEFAULT NULL", "DATE", f"date_sub(trunc({_DAY}, 'YEAR'), 1)"),
    "first_day_current_year_week": ("d DATE DEFAULT NULL", "DATE", f"trunc(make_date(year({_DAY}), 1, 4), 'WEEK')"),
    "string_spaces": ("s STRING", "STRING", r"regexp_replace(s, '[ \\t\\r\\n]+', ' ')"),
}


def register_functions(spark: SparkSession, when: dt.datetime | None = None) -> None:
    """Makes the functions, and `getdate()`, known to the session's SQL.

    `getdate()` is the time of the run if given, so that a run can be repeated as of its day.
    """
    for name, (parameter, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameter}) RETURNS {result} RETURN {body}")
    if when is None:
        now = "current_timestamp()"
    else:
        zoned = when if when.tzinfo else when.replace(tzinfo=dt.timezone.utc)
        since = zoned - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
        now = f"timestamp_micros({since // dt.timedelta(microseconds=1)})"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION getdate() RETURNS TIMESTAMP RETURN {now}")
