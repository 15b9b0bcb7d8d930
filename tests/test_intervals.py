"""The index over range filters against trying each filter, and the splitting of filter texts."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from chronoweave.functions.text import field_list, split_outside
from chronoweave.operators import matching
from chronoweave.operators.intervals import Conjunction, Range, conjunction, covering, hull
from chronoweave.operators.matching import match_filters, with_hits

KINDS = {"x": "double", "n": "int", "d": "date", "s": "string", "t": "timestamp_ntz"}


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(4)
    nan, day = float("nan"), dt.date(2024, 1, 1)

    def maybe(value):
        return None if draw.random() < 0.08 else value

    made = [
        (
            i, maybe(draw.choice([nan, 2.5, 3.0, -0.0, 1e9, draw.uniform(-5, 15)])), maybe(draw.randint(-3, 12)),
            maybe(day + dt.timedelta(draw.randint(0, 40))), maybe(draw.choice(["", "a", "ab", "é", "b c", "B"])),
            maybe(dt.datetime(2024, 1, 1) + dt.timedelta(hours=draw.randint(0, 900))),
        )
        for i in range(400)
    ]
    ddl = "id int, x double, n int, d date, s string, t timestamp_ntz"
    return spark.createDataFrame(made, ddl).cache()


def _random_filter(draw):
    def one():
        kind = draw.choice("xndst")
        a, b = sorted((draw.randint(-3, 12), draw.randint(-3, 12)))
        day = f"2024-0{draw.randint(1, 2)}-{draw.randint(10, 28)}"
        sign = draw.choice(["<", "<=", ">", ">=", "="])
        return {
            "x": draw.choice([f"x {sign} {a}.5", f"x between {a} and {b}", f"{a} {sign} x", f"[x] {sign} {b}"]),
            "n": draw.choice([f"n {sign} {a}", f"n {draw.choice(['<', '>', '<=', '>='])} {a}.25", f"(n between {a} AND {b})", f"N>={a}"]),
            "d": draw.choice([f"d {sign} '{day}'", f"d between '2024-01-05' and '{day}'", f"date'{day}' {sign} d"]),
            "s": draw.choice([f"s {sign} 'ab'", "s = 'B'", "s like 'a%'", "s is not null"]),
            "t": f"t {sign} '{day}'",
        }[kind]

    parts = [one() for _ in range(draw.randint(1, 4))]
    if draw.random() < 0.2:
        parts.append(draw.choice(["(n = 1 or x > 3)", "not s = 'a'", "n in (1, 2, 3)", "case when n > 2 and x < 9 then 1 else 0 end = 1"]))
    return draw.choice([" and ", " AND "]).join(parts)


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_what_trying_finds(rows, monkeypatch, seed):
    draw = random.Random(seed)
    filters = list(dict.fromkeys(_random_filter(draw) for _ in range(150)))
    filters += ["", "n = 3", "n = 3 and s = 'a'", "x > 3 and x < 3", "n > 5 and n < 2"]

    def hits():
        found = match_filters(rows, [matching.sql_text(f) for f in filters]).select("id", "filter_no").collect()
        return sorted(map(tuple, found))

    found = hits()
    monkeypatch.setattr(matching, "LEAST_INDEXED", 10**9)
    assert found == hits() and len(found) > 1000


def test_rows_of_no_filter_keep_an_empty_array(rows):
    filters = [f"x > {n} and x <= {n + 1}" for n in range(2, 40)]
    found = with_hits(rows, filters, only=False)
    assert found.count() == 400
    assert found.where(f"x is null and size({matching.HITS}) > 0").count() == 0
    nan = found.where("isnan(x)").select(F.size(matching.HITS)).distinct().collect()
    assert [r[0] for r in nan] == [0]


def test_bounds_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    filters = [f"o_totalprice >= {n * 100} and o_totalprice < {n * 100 + 50}" for n in range(1, 50)]
    plan = match_filters(orders, filters)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThanOrEqual(o_totalprice,100" in plan and "<= 4950.0)" in plan


def test_many_ranges_cost_little_more_than_few(spark):
    rows = spark.range(0, 400_000, 1, 4).select((F.col("id") % 9600).cast("double").alias("x"))

    def seconds(n):
        filters = [f"x >= {k * 9600 / n} and x < {(k + 1) * 9600 / n}" for k in range(n)]
        found = match_filters(rows, filters).groupBy("filter_no").count()
        best = 1e9
        for _ in range(3):
            start = time.monotonic()
            assert found.agg(F.sum("count")).first()[0] == 400_000
            best = min(best, time.monotonic() - start)
        return best

    assert seconds(960) < 3 * seconds(60)


def test_covering_nodes():
    for size in (1, 8, 64):
        for a in range(size):
            for b in range(a, size):
                nodes = covering(a, b, size)
                leaves = [leaf for leaf in range(size) for k in range(size.bit_length()) if (leaf + size) >> k in nodes]
                assert leaves == list(range(a, b + 1)) and len(nodes) <= 2 * size.bit_length()
    assert covering(3, 2, 8) == []


def test_conjunctions():
    def ranges(text):
        found = conjunction(text, KINDS)
        return {c: (r.low, r.low_in, r.high, r.high_in) for c, r in found.ranges.items()}, found.rest

    assert ranges("(x >= 1 and x < 2.5)") == ({"x": (1.0, True, 2.5, False)}, "")
    assert ranges("n > 1.5 and 4.5 >= n") == ({"n": (1, False, 4, True)}, "")
    assert ranges("n = 1.5")[0] == {} and ranges("x = '1'")[0] == {} and ranges("d > '2024-1-5'")[0] == {}
    assert ranges("d between '2024-01-05' and '2024-02-01' and (s = 'a and b' and abs(x) > 1)") == (
        {"d": ("2024-01-05", True, "2024-02-01", True), "s": ("a and b", True, "a and b", True)}, "(abs(x) > 1)",
    )
    assert ranges("x between 1 and n + 2 and n < 3") == ({"n": (None, True, 3, False)}, "(x between 1  AND  n + 2)")
    assert ranges("(x > 1) or (x < 0)")[0] == {} and ranges("x > 1 or n = 2 and x < 0")[0] == {}
    assert ranges("unknown > 1")[0] == {} and ranges("")[0] == {}


def test_hull():
    a, b = Conjunction({"x": Range(1.0, 2.0), "d": Range("2024-01-01")}), Conjunction({"x": Range(0.5, None), "d": Range("2023-05-01", "2024-05-01")})
    assert hull([a, b]) == "`d` >= '2023-05-01' AND `x` >= 0.5" and hull([a, Conjunction({"n": Range(1, 2)})]) == ""


def test_field_lists_keep_quotes_and_brackets():
    assert field_list('"a,b",c') == ['"a,b"', "c"]
    assert field_list("`a,b`, f(c, d[1, 2]) , 'it''s, x', map(1, 'a')") == ["`a,b`", "f(c, d[1, 2])", "'it''s, x'", "map(1, 'a')"]
    assert field_list(r"'a\',b',c,,") == [r"'a\',b'", "c"] and field_list("") == []
    assert split_outside("a and (b and c) AND 'd and e'", r"\bAND\b") == ["a ", " (b and c) ", " 'd and e'"]
