"""Filters that compare columns with constants, found by one search per column instead of one test each.

The bounds of all filters cut a column into elementary intervals: each bound, and each gap between
two. A row finds its interval by bisection. The intervals are the leaves of a binary tree; a filter
is kept at the few nodes that cover its range together, so the nodes above a row's interval hold
just the filters whose range on that column the row meets. Bounds on further columns are compared as
interval numbers, and whatever else a filter asks is tried on the rows that have come so far. Thus a
row costs as many steps as the logarithm of the number of filters, and as it meets filters.
"""

from __future__ import annotations

import json
import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.text import split_outside

_CONSTANT = r"'(?P<{0}text>[^'\\]*)'|(?:date\s*)'(?P<{0}day>\d{{4}}-\d\d-\d\d)'|(?P<{0}number>[+-]?(?:\d{{1,18}}(?:\.\d{{0,15}})?|\.\d{{1,15}}))"
_COLUMN = r"`?(?P<column>[A-Za-z_]\w*)`?"
_AFTER = re.compile(rf"\s*{_COLUMN}\s*(?P<sign><=|>=|=|<|>)\s*(?:{_CONSTANT.format('')})\s*", re.IGNORECASE)
_BEFORE = re.compile(rf"\s*(?:{_CONSTANT.format('')})\s*(?P<sign><=|>=|=|<|>)\s*{_COLUMN}\s*", re.IGNORECASE)
_BETWEEN = re.compile(rf"\s*{_COLUMN}\s+between\s+(?:{_CONSTANT.format('low_')})\s+and\s+(?:{_CONSTANT.format('high_')})\s*", re.IGNORECASE)
_MIRRORED = {"<": ">", ">": "<", "<=": ">=", ">=": "<=", "=": "="}
_UNSPLIT = r"\b(?:OR|CASE)\b"
_DAY = re.compile(r"\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])")

_WHOLE = {"tinyint", "smallint", "int", "bigint"}
#: Whole numbers up to this are the same number as a double.
_EXACT = 1 << 53


@dataclass
class Range:
    """The values of a column between two bounds, either of which may be missing."""

    low: object = None
    high: object = None
    low_in: bool = True
    high_in: bool = True

    def narrow(self, sign: str, value) -> None:
        """Also asks that the value be `sign` the constant."""
        if sign in (">", ">=", "=") and (self.low is None or value > self.low or (value == self.low and sign == ">")):
            self.low, self.low_in = value, sign != ">"
        if sign in ("<", "<=", "=") and (self.high is None or value < self.high or (value == self.high and sign == "<")):
            self.high, self.high_in = value, sign != "<"


@dataclass
class Conjunction:
    """A filter as ranges of columns, and the rest of its text, all of which must hold."""

    ranges: dict[str, Range] = field(default_factory=dict)
    rest: str = ""


def conjunction(text: str, kinds: dict[str, str]) -> Conjunction:
    """The ranges that a filter's text asks for, given the types of the columns.

    Only comparisons whose meaning does not depend on a conversion count: numbers with numeric columns,
    days with date and time stamp columns, texts with text columns.
    """
    out, rest = Conjunction(), []
    for part in _conjuncts(text):
        found = _comparison(part, kinds)
        if found is None:
            rest.append(f"({part.strip()})")
        for column, sign, value in found or ():
            out.ranges.setdefault(column, Range()).narrow(sign, value)
    out.rest = " AND ".join(rest)
    return out


def _conjuncts(text: str) -> list[str]:
    """The parts of a text that AND joins; brackets around it all are taken off."""
    parts = split_outside(text, r"\bAND\b")
    bare = text.strip()
    if len(parts) == 1 and bare.startswith("(") and bare.endswith(")") and len(split_outside(bare[1:-1], r"\)")) == 1:
        return _conjuncts(bare[1:-1])
    if len(parts) == 1:
        return parts if bare else []
    if any(len(split_outside(p, _UNSPLIT)) > 1 for p in parts):
        return [text]
    out: list[str] = []
    for part in parts:  # the AND of a BETWEEN joins nothing
        if out and len(split_outside(out[-1], r"\bBETWEEN\b")) > len(split_outside(out[-1], r"\bAND\b")):
            out[-1] += " AND " + part
        else:
            out.append(part)
    return [c for p in out for c in ([p] if len(split_outside(p, r"\bBETWEEN\b")) > 1 else _conjuncts(p))]


def _comparison(part: str, kinds: dict[str, str]) -> list[tuple[str, str, object]] | None:
    """(column, sign, constant) that a part asks for; None if it is anything else."""
    if m := _BETWEEN.fullmatch(part):
        wanted = [(">=", "low_"), ("<=", "high_")]
    elif m := _AFTER.fullmatch(part):
        wanted = [(m["sign"], "")]
    elif m := _BEFORE.fullmatch(part):
        wanted = [(_MIRRORED[m["sign"]], "")]
    else:
        return None
    column = next((c for c in kinds if c.lower() == m["column"].lower()), None)
    if column is None:
        return None
    out = []
    for sign, prefix in wanted:
        found = _value(kinds[column], sign, *(m[prefix + k] for k in ("text", "day", "number")))
        if found is None:
            return None
        out.append((column, *found))
    return out


def _value(kind: str, sign: str, text: str | None, day: str | None, number: str | None) -> tuple[str, object] | None:
    """The sign and constant in the column's own type; None where comparing needs a conversion."""
    if kind == "string" and text is not None:
        return sign, text
    if kind in ("date", "timestamp", "timestamp_ntz") and (day or text):
        return (sign, day or text) if _DAY.fullmatch(day or text) else None
    if number is None:
        return None
    exact = Decimal(number)
    if kind == "double" and abs(exact) < _EXACT:
        return sign, float(exact)
    if kind in _WHOLE:
        whole = math.floor(exact)
        if whole == exact:
            return sign, whole
        # Between two whole numbers: above it is from the next one on, below it is up to this one.
        return {">": (">", whole), ">=": (">", whole), "<": ("<=", whole), "<=": ("<=", whole), "=": None}[sign]
    return None


# The index -----------------------------------------------------------------------------------


class Cuts:
    """A column cut at sorted bounds: places 1, 3, .. are the bounds, places 0, 2, .. the gaps around them."""

    def __init__(self, column: str, kind: str, bounds: set):
        self.column, self.kind, self.bounds = column, kind, sorted(bounds)
        self.places = 2 * len(self.bounds) + 1

    def span(self, r: Range) -> tuple[int, int]:
        """First and last place of a range; none if the first is above the last."""
        first = 0 if r.low is None else 2 * bisect_left(self.bounds, r.low) + (1 if r.low_in else 2)
        last = self.places - 1 if r.high is None else 2 * bisect_left(self.bounds, r.high) + (1 if r.high_in else 0)
        return first, last

    def place(self) -> Column:
        """The place of a row's value, by bisection; null for null."""
        n = len(self.bounds)
        kind = "bigint" if self.kind in _WHOLE else self.kind
        texts = constant([str(b) for b in self.bounds], "array<string>") if kind != "double" else None
        bounds = constant(self.bounds, "array<double>") if texts is None else F.transform(texts, lambda b: b.cast(kind))
        value = F.col(f"`{self.column}`").cast(kind)
        steps = constant([1 << k for k in range(n.bit_length() - 1, -1, -1)], "array<int>")

        def further(at: Column, step: Column) -> Column:
            return F.when((at + step <= n) & (F.get(bounds, at + step - 1) <= value), at + step).otherwise(at)

        below = F.aggregate(steps, F.lit(0), further)
        hit = F.transform(F.array(below), lambda at: F.when(F.get(bounds, at - 1) == value, 2 * at - 1).otherwise(2 * at))
        return F.when(value.isNotNull(), F.get(hit, F.lit(0)))


def constant(values, kind: str) -> Column:
    """A constant array. Spark evaluates it once, when it plans."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def covering(first: int, last: int, size: int) -> list[int]:
    """The nodes of a binary tree over `size` leaves (a power of two; the root is 1) that cover first..last exactly."""
    out, a, b = [], first + size, last + size + 1
    while a < b:
        if a & 1:
            out.append(a)
            a += 1
        if b & 1:
            b -= 1
            out.append(b)
        a, b = a // 2, b // 2
    return out


def interval_hits(rows: DataFrame, filters: Sequence[tuple[int, Conjunction]]) -> Column:
    """An array of the numbers of the filters that a row meets; each filter has a range at least."""
    kinds = dict(rows.dtypes)
    bounds: dict[str, set] = defaultdict(set)
    for _, f in filters:
        for column, r in f.ranges.items():
            bounds[column] |= {b for b in (r.low, r.high) if b is not None}
    cuts = {c: Cuts(c, kinds[c], b) for c, b in bounds.items()}
    groups: dict[str, list[tuple[int, Conjunction]]] = defaultdict(list)
    for n, f in filters:
        # The column with the most bounds tells filters apart best.
        groups[max(f.ranges, key=lambda c: (len(bounds[c]), c))].append((n, f))
    return F.concat(*[_hits_by(cuts, column, found) for column, found in groups.items()])


def _hits_by(cuts: dict[str, Cuts], column: str, filters: Sequence[tuple[int, Conjunction]]) -> Column:
    further = sorted({c for _, f in filters for c in f.ranges} - {column})
    rests = list(dict.fromkeys(f.rest for _, f in filters if f.rest))
    size = 1 << (cuts[column].places - 1).bit_length()
    nodes: list[list[int]] = [[] for _ in range(2 * size)]
    for at, (_, f) in enumerate(filters):
        for node in covering(*cuts[column].span(f.ranges[column]), size):
            nodes[node].append(at)
    tree = constant(nodes, "array<array<int>>")
    numbers = constant([n for n, _ in filters], "array<int>")
    levels = constant(list(range(size.bit_length())), "array<int>")
    spans = {c: [cuts[c].span(f.ranges[c]) if c in f.ranges else None for _, f in filters] for c in further}
    first, last = (
        {c: constant([s and s[i] for s in spans[c]], "array<int>") for c in further} for i in (0, 1)
    )
    rest = constant([rests.index(f.rest) if f.rest else None for _, f in filters], "array<int>")

    # The places are worked out once a row: inside, they are names of a function.
    def met(row: Column) -> Column:
        above = F.transform(levels, lambda k: F.get(tree, F.call_function("shiftright", row[column] + size, k)))

        def ok(at: Column) -> Column:
            test = F.lit(True)
            for c in further:
                test &= F.get(first[c], at).isNull() | F.coalesce(row[c].between(F.get(first[c], at), F.get(last[c], at)), F.lit(False))
            if rests:
                own = F.get(rest, at)
                test &= own.isNull() | F.coalesce(_one_of(rests, own, 0, len(rests)), F.lit(False))
            return test

        found = F.flatten(above)
        found = F.filter(found, ok) if further or rests else found
        return F.transform(found, lambda at: F.get(numbers, at))

    places = F.struct(*[cuts[c].place().alias(c) for c in [column, *further]])
    hits = F.get(F.transform(F.array(places), met), F.lit(0))
    return F.coalesce(hits, F.array().cast("array<int>"))


def _one_of(texts: Sequence[str], number: Column, first: int, until: int) -> Column:
    """The test of that number, found by halving, so that no other test is tried."""
    if until - first == 1:
        return F.expr(texts[first])
    middle = (first + until) // 2
    return F.when(number < middle, _one_of(texts, number, first, middle)).otherwise(_one_of(texts, number, middle, until))


def hull(filters: Sequence[Conjunction]) -> str:
    """SQL that every row of any of the filters meets and that a scan can use: the outermost bounds of each
    column that all of them bound. Blank if there is none."""
    shared = Counter(c for f in filters for c in f.ranges)
    parts = []
    for column in sorted(c for c, n in shared.items() if n == len(filters)):
        ranges = [f.ranges[column] for f in filters]
        for sign, bounds in ((">=", [r.low for r in ranges]), ("<=", [r.high for r in ranges])):
            if None not in bounds:
                most = min(bounds) if sign == ">=" else max(bounds)
                parts.append(f"`{column}` {sign} " + (f"'{most}'" if isinstance(most, str) else repr(most)))
    return " AND ".join(parts)
