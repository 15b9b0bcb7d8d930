"""Which import writes what another one reads, and so which can run together.

Every import writes a series, or all activities of a forecast, within its window, and reads others. An import
goes after those that write what it reads, whatever procedures they belong to, and after earlier ones that
write what it writes. What has no such tie is on one level: imports of one operator on a level share a plan,
which reads their facts once. Imports that wait for each other in a ring cannot be put in order.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from chronoweave.model import Run
from chronoweave.operators import correlation, parallel, regression
from chronoweave.operators.matching import ANY
from chronoweave.plans.changes import derived_scope, wants


@dataclass(frozen=True)
class Span:
    """Days of a series; ANY stands for every forecast or activity."""

    site_id: int
    forecast_id: int
    activity_id: int
    first: dt.date
    last: dt.date

    def meets(self, other: Span) -> bool:
        return (
            self.site_id == other.site_id
            and (self.forecast_id == other.forecast_id or ANY in (self.forecast_id, other.forecast_id))
            and (self.activity_id == other.activity_id or ANY in (self.activity_id, other.activity_id))
            and self.first <= other.last
            and other.first <= self.last
        )


def written(operator: str, run: Run) -> Span:
    s = derived_scope(operator, run)
    return Span(s.site_id, s.forecast_id, ANY if s.activity_id is None else s.activity_id, s.date_from, s.date_until)


def read(operator: str, run: Run) -> list[Span]:
    """What an import reads of the day facts; nothing if it imports another source."""
    if operator == "import" and run.source.strip():
        return []
    first, last = run.date_from, run.date_until
    if operator == "parallel":
        first, last = parallel.source_span(run)
    elif operator.startswith("regression"):
        first = dt.date.fromordinal(max(first.toordinal() - regression.HISTORY_DAYS, 1))
    elif operator == "correlation":
        first, last = dt.date.min, correlation.reach([run])[1]
    elif operator == "split":
        first, last = dt.date.min, dt.date.max
    if operator == "import":
        return [Span(run.site_id, ANY, ANY, first, last)]
    return [Span(run.site_id, w.forecast, w.activity, first, last) for w in wants(operator, run)]


def levels(imports: Sequence[tuple[str, Run]]) -> tuple[list[list[int]], list[list[int]]]:
    """Places of the imports (operator, run) by level, each level in the given order, and the rings among them."""
    writes = [written(o, r) for o, r in imports]
    by_site: dict[int, list[int]] = defaultdict(list)
    by_forecast: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i, w in enumerate(writes):
        by_site[w.site_id].append(i)
        by_forecast[w.site_id, w.forecast_id].append(i)
    before: dict[int, set[int]] = {}
    for i, (operator, run) in enumerate(imports):
        # An import that reads its own series, such as those of earlier years, does not wait for itself.
        before[i] = {j for j in by_forecast[writes[i].site_id, writes[i].forecast_id] if j < i and writes[j].meets(writes[i])}
        for r in read(operator, run):
            writers = by_site[r.site_id] if r.forecast_id == ANY else by_forecast[r.site_id, r.forecast_id]
            before[i] |= {j for j in writers if j != i and writes[j].meets(r)}
    rings: list[list[int]] = []
    while True:
        order = TopologicalSorter(before)
        try:
            order.prepare()
            break
        except CycleError as e:
            ring = sorted(set(e.args[1]))
            rings.append(ring)
            before = {i: b.difference(ring) for i, b in before.items() if i not in ring}
    out = []
    while order.is_active():
        ready = order.get_ready()
        out.append(sorted(ready))
        order.done(*ready)
    return out, rings
