"""What a change of facts means for derived series: which imports are concerned, and which of their days.

An import that has replaced some days changes, in the series derived from them, only the days that those
can reach: the rest of the year for year-to-date totals, the days some years on for parallel periods, the
periods they lie in for alerts. Derived imports are then run for these days alone, or not at all; the
facts are those of a full run. Splits, correlations and regressions look back over rows, not days, so
they run for their whole window if anything they read has changed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from chronoweave.functions.text import sql_text
from chronoweave.model import Run
from chronoweave.operators import alert, correlation, parallel, regression, ytd
from chronoweave.operators.matching import ANY, Want
from chronoweave.operators.replace import HEAD, TAIL, Scope

#: Periods that alerts may group days by, and the calendar unit that holds each whole.
_UNITS = {
    "date": "day", "year_month": "month", "year_month_char": "month", "year_week": "week", "year_week_short": "week",
    "weeks_2000": "week", "year_quarter": "quarter", "year": "year", "year52": "iso year",
}


@dataclass(frozen=True)
class Change:
    """Days of a series whose facts may have changed; without an activity those of any."""

    site_id: int
    forecast_id: int
    activity_id: int | None
    first: dt.date
    last: dt.date


def change_of(scope: Scope) -> Change:
    """What replacing a scope may change."""
    first = dt.date.min if scope.mode == HEAD else scope.date_from
    last = dt.date.max if scope.mode == TAIL else scope.date_until
    return Change(scope.site_id, scope.forecast_id, scope.activity_id, first, last)


def derived_scope(operator: str, run: Run) -> Scope:
    """Year-to-date and parallel imports with a filter replace all its activities."""
    wide = (operator == "ytd" and len(run.filter) >= 4) or (
        operator == "parallel" and run.filter.strip() != ""
    )
    return Scope(
        run.import_id, run.site_id, run.forecast_id, run.date_from, run.date_until,
        None if wide else run.activity_id, filter=run.filter if wide else "",
    )


def narrowed(operator: str, run: Run, changes: Sequence[Change]) -> Run | None:
    """The run for the days that the changes can reach, from the first to the last; None if there are none."""
    spans = [_reached(operator, run, c) for c in changes if _reads(operator, run, c)]
    first = max(run.date_from, min((s[0] for s in spans), default=dt.date.max))
    last = min(run.date_until, max((s[1] for s in spans), default=dt.date.min))
    return run.with_window(first, last) if first <= last else None


def wants(operator: str, run: Run) -> list[Want]:
    """What a derived import reads."""
    if operator == "ytd":
        return ytd.wants([run])
    if operator == "parallel":
        return parallel.wants([run])
    if operator == "alert":
        return alert.wants([run])
    if operator.startswith("regression"):
        return regression.wants([run])
    if operator == "correlation":
        return [Want(run, activity=a, forecast=f) for a, f, _ in correlation.reads(run)]
    return [Want(run, filter=run.filter)]


def _reads(operator: str, run: Run, change: Change) -> bool:
    """Whether the import may read what has changed. Filters are taken to let everything pass."""
    return change.site_id == run.site_id and any(
        w.forecast in (ANY, change.forecast_id) and (change.activity_id is None or w.activity in (ANY, change.activity_id))
        for w in wants(operator, run)
    )


def _reached(operator: str, run: Run, change: Change) -> tuple[dt.date, dt.date]:
    if operator == "ytd":
        return _whole("iso year" if "w" in run.p2.lower() else "year", change.first, change.last)
    if operator == "parallel":
        return parallel.target_span(run, change.first, change.last)
    unit = _UNITS.get((sql_text(run.group_by) or "date").strip("`").lower()) if operator == "alert" else None
    return _whole(unit, change.first, change.last) if unit else (run.date_from, run.date_until)


def _whole(unit: str, first: dt.date, last: dt.date) -> tuple[dt.date, dt.date]:
    """The days of all units that lie between two days in part."""
    return _start(unit, first), _end(unit, last)


def _start(unit: str, day: dt.date) -> dt.date:
    if unit == "year":
        return day.replace(month=1, day=1)
    if unit == "quarter":
        return day.replace(month=(day.month - 1) // 3 * 3 + 1, day=1)
    if unit == "month":
        return day.replace(day=1)
    if unit in ("week", "iso year") and day.toordinal() > 7:
        monday = day - dt.timedelta(day.weekday())
        return monday if unit == "week" else _start("week", dt.date(day.isocalendar().year, 1, 4))
    return day


def _end(unit: str, day: dt.date) -> dt.date:
    if unit == "day" or day.year >= 9999:
        return dt.date.max if unit != "day" else day
    following = {"year": 366, "quarter": 92, "month": 31, "week": 7, "iso year": 371}[unit]
    return _start(unit, _start(unit, day) + dt.timedelta(following)) - dt.timedelta(1)

