"""Imports, range replacement and source marking over the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chronoweave.functions.text import flag_set
from chronoweave.model import Run
from chronoweave.operators.imports import delta_windows, import_day, import_intraday
from chronoweave.operators.replace import Scope, replace_range, replacement, replacement_counts, write_back
from chronoweave.sources.staged import StagedFile, quoted_records, staged_cell, staged_cells, staged_date, staged_number, with_problem
from workload.inputs import (
    EVENT_ACTIVITY,
    EVENT_SOURCE,
    INTRADAY_FACTS,
    ORDER_FACTS,
    SUPPLIER_ACTIVITY,
    SUPPLIER_FACTS,
    event_source,
    intraday_facts,
    order_facts,
    rounded,
    shown,
    supplier_activity,
    supplier_facts,
    table,
)

D = dt.date


def order_imports() -> list[Run]:
    """One import per priority over the orders table."""
    return [
        Run(
            import_id=100 + n,
            activity_id=n,
            forecast_id=1,
            filter=f"o_orderpriority like '{n}-%'",
            group_by="o_orderdate",
            fields_source="count(*), sum(o_totalprice)",
            fields_target="[value1],[value2]",
        )
        for n in range(1, 6)
    ]


def imported_orders(spark, sf):
    return import_day(table(spark, sf, "orders"), order_imports())


def q_import_day(spark, sf):
    return shown(imported_orders(spark, sf), "value1", "value2")


SQL_IMPORT_DAY = f"""WITH {ORDER_FACTS}
SELECT date, activity_id, forecast_id, site_id, import_id, {rounded('value1', 'value2')} FROM order_facts"""


def staged_lines(spark, sf):
    """Lines as staged text rows: A flag, B status, H quantity, I price with unreadable cells."""
    return table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.lit(1).alias("site_id"),
        F.col("l_returnflag").alias("A"),
        F.col("l_linestatus").alias("B"),
        F.col("l_quantity").cast("string").alias("H"),
        F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
        .when(F.col("l_linenumber") == 6, F.lit(""))
        .otherwise(F.col("l_extendedprice").cast("string"))
        .alias("I"),
    )


STAGED_LINES = """staged_lines AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS a, l_linestatus AS b, l_quantity AS h,
         CASE WHEN l_linenumber IN (6, 7) THEN NULL ELSE l_extendedprice END AS i
  FROM lineitem)"""


def q_import_day_sumfields(spark, sf):
    runs = [
        Run(
            import_id=200 + n,
            activity_id=n,
            forecast_id=4,
            filter=f"(A='{flag}')",
            fields_source="H,I",
            fields_target="value1,value2",
            date_from=D(1996, 1, 1),
            date_until=D(2000, 12, 31),
            flags=flag_set("-NOGROUPBY -SUMFIELDS"),
        )
        for n, flag in enumerate("ANR", 1)
    ]
    return shown(import_day(staged_lines(spark, sf), runs), "value1", "value2")


SQL_IMPORT_DAY_SUMFIELDS = f"""WITH {STAGED_LINES}
SELECT date, CASE a WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS activity_id, 4 AS forecast_id, 1 AS site_id,
       CASE a WHEN 'A' THEN 201 WHEN 'N' THEN 202 ELSE 203 END AS import_id,
       round(sum(h), 4) AS value1, round(sum(i), 4) AS value2
FROM staged_lines WHERE a IN ('A', 'N', 'R') AND date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
GROUP BY date, a"""


def q_import_day_nogroupby(spark, sf):
    runs = [
        Run(
            import_id=300 + n,
            activity_id=n,
            forecast_id=1,
            filter=f"o_orderstatus = '{status}'",
            group_by="[o_orderdate]",
            fields_source="o_totalprice, case when o_totalprice > 100000 then 1 else 0 end",
            fields_target="value1,value3",
            flags=flag_set("-NOGROUPBY"),
        )
        for n, status in enumerate("FOP", 1)
    ]
    return shown(import_day(table(spark, sf, "orders"), runs), "value1", "value3")


SQL_IMPORT_DAY_NOGROUPBY = """
SELECT CAST(o_orderdate AS DATE) AS date, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS activity_id,
       1 AS forecast_id, 1 AS site_id, CASE o_orderstatus WHEN 'F' THEN 301 WHEN 'O' THEN 302 ELSE 303 END AS import_id,
       round(o_totalprice, 4) AS value1, CAST(CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS DOUBLE) AS value3
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')"""


def _line_filters() -> list[tuple[str, str | None, int]]:
    """(flag, status or None for any, line number): all are looked up by joins."""
    return [(f, s, n) for f in "ANR" for s in ("O", "F", None) for n in range(1, 8)]


def q_import_many_filters(spark, sf):
    """An import per flag, status and line number, and one per flag and line number."""
    runs = [
        Run(
            import_id=i,
            activity_id=n,
            forecast_id=1,
            filter=f"l_returnflag = '{flag}' AND (l_linenumber = {n}" + (f" and l_linestatus = '{status}')" if status else ")"),
            group_by="l_shipdate",
            fields_source="sum(l_quantity), max(l_extendedprice)",
            fields_target="value1,value2",
        )
        for i, (flag, status, n) in enumerate(_line_filters(), 1)
    ]
    return shown(import_day(table(spark, sf, "lineitem"), runs), "value1", "value2")


SQL_IMPORT_MANY_FILTERS = f"""WITH runs(import_id, flag, status, n) AS (VALUES {
    ", ".join(f"({i}, '{f}', {repr(s) if s else 'NULL'}, {n})" for i, (f, s, n) in enumerate(_line_filters(), 1))
})
SELECT CAST(l_shipdate AS DATE) AS date, n AS activity_id, 1 AS forecast_id, 1 AS site_id, import_id,
       round(sum(l_quantity), 4) AS value1, round(max(l_extendedprice), 4) AS value2
FROM lineitem JOIN runs ON l_returnflag = flag AND l_linenumber = n AND l_linestatus = coalesce(status, l_linestatus)
GROUP BY ALL"""


def event_imports(**more) -> list[Run]:
    return [
        Run(
            import_id=400 + n,
            activity_id=n,
            forecast_id=1,
            filter=f"event_type = '{name}'",
            fields_source="count(*), sum(value)",
            fields_target="value1,value2",
            **more,
        )
        for name, n in EVENT_ACTIVITY.items()
    ]


def q_import_intraday(spark, sf):
    rows = import_intraday(event_source(spark, sf), event_imports(), durations={401: 30})
    return shown(rows, "value1", "value2", more=("interval_id", "duration_min"))


SQL_IMPORT_INTRADAY = f"""WITH {EVENT_SOURCE}
SELECT date, interval_id, activity_id, 1 AS forecast_id, 1 AS site_id, 400 + activity_id AS import_id,
       CAST(CASE WHEN activity_id = 1 THEN 30 ELSE 15 END AS SMALLINT) AS duration_min,
       CAST(count(*) AS DOUBLE) AS value1, round(sum(value), 4) AS value2
FROM event_source GROUP BY date, interval_id, activity_id"""


def q_import_by_source_id(spark, sf):
    """Marks events with their import first, then imports by that mark instead of the filter."""
    runs = event_imports(flags=flag_set("-SOURCE_FILTER_IMPORT"), date_from=D(2024, 1, 3))
    marked = write_back(event_source(spark, sf), runs).drop("updated_by")
    return shown(import_day(marked, runs, import_field="import_id"), "value1", "value2")


SQL_IMPORT_BY_SOURCE_ID = f"""WITH {EVENT_SOURCE}
SELECT date, activity_id, 1 AS forecast_id, 1 AS site_id, 400 + activity_id AS import_id,
       CAST(count(*) AS DOUBLE) AS value1, round(sum(value), 4) AS value2
FROM event_source WHERE date >= DATE '2024-01-03' GROUP BY date, activity_id"""

DELTA_CASES = (
    ("", D(1997, 3, 1), D(9999, 1, 1)),
    ("-NODELTA", D(1994, 1, 1), D(2010, 12, 31)),
    ("-FORCEDELTA -NODELTA", D(1999, 1, 1), D(1999, 12, 31)),
    ("", D(1900, 1, 1), D(1994, 12, 31)),
)


def delta_imports() -> list[Run]:
    return [
        Run(
            import_id=10 * n + c,
            activity_id=n,
            forecast_id=1,
            filter=f"l_returnflag = '{flag}'",
            group_by="l_shipdate",
            date_from=lo,
            date_until=hi,
            flags=flag_set(commands),
        )
        for n, flag in enumerate("ANRX", 1)
        for c, (commands, lo, hi) in enumerate(DELTA_CASES)
    ]


def q_delta_window(spark, sf):
    return delta_windows(table(spark, sf, "lineitem"), delta_imports())


def _delta_sql() -> str:
    rows = ", ".join(
        f"({r.import_id}, '{'ANRX'[r.activity_id - 1]}', DATE '{r.date_from}', DATE '{r.date_until}', "
        f"{r.has('FORCEDELTA')}, {r.has('NODELTA') and not r.has('FORCEDELTA')})"
        for r in delta_imports()
    )
    return f"""WITH runs(import_id, flag, f, u, forced, skipped) AS (VALUES {rows}),
spans AS (SELECT l_returnflag AS flag, CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi
          FROM lineitem GROUP BY 1),
src AS (SELECT r.*, coalesce(lo, DATE '9999-01-01') AS lo, coalesce(hi, DATE '1900-12-31') AS hi
        FROM runs r LEFT JOIN spans s ON r.flag = s.flag),
w AS (SELECT import_id,
        CASE WHEN skipped THEN f WHEN forced THEN lo ELSE greatest(f, lo) END AS date_from,
        CASE WHEN skipped THEN u WHEN forced THEN hi ELSE least(u, hi) END AS date_until FROM src)
SELECT import_id, date_from, date_until, date_until >= date_from AS has_rows FROM w"""


def day_scopes(mode: str = "range") -> list[Scope]:
    return [
        Scope(900 + n, 1, 1, D(1996 + n, 1, 1), D(1997 + n, 6, 30), n, mode) for n in range(1, 6)
    ]


def _scope_values() -> str:
    return ", ".join(
        f"({s.import_id}, {s.activity_id}, DATE '{s.date_from}', DATE '{s.date_until}')" for s in day_scopes()
    )


def _new_day_rows(spark, sf):
    """Shipped lines per status, as the rows that replace order counts."""
    windows = {s.activity_id: s for s in day_scopes()}
    runs = [
        Run(
            import_id=900 + n,
            activity_id=n,
            forecast_id=1,
            group_by="l_shipdate",
            filter=f"l_linenumber = {n}",
            fields_source="count(*), sum(l_extendedprice)",
            fields_target="value1,value2",
            date_from=windows[n].date_from,
            date_until=windows[n].date_until,
        )
        for n in range(1, 6)
    ]
    return import_day(table(spark, sf, "lineitem"), runs)


NEW_DAY_ROWS = f"""scopes(import_id, activity_id, f, u) AS (VALUES {_scope_values()}),
new_rows AS (
  SELECT CAST(l_shipdate AS DATE) AS date, s.activity_id, 1 AS forecast_id, 1 AS site_id, s.import_id,
         CAST(count(*) AS DOUBLE) AS value1, sum(l_extendedprice) AS value2
  FROM lineitem JOIN scopes s ON l_linenumber = s.activity_id
  WHERE CAST(l_shipdate AS DATE) BETWEEN f AND u GROUP BY ALL)"""


def _replace_day(mode: str):
    def query(spark, sf):
        rows = replace_range(order_facts(spark, sf), _new_day_rows(spark, sf), day_scopes(mode))
        return shown(rows, "value1", "value2")

    return query


def _replace_day_sql(test: str) -> str:
    columns = "date, activity_id, forecast_id, site_id, import_id, " + rounded("value1", "value2")
    return f"""WITH {ORDER_FACTS}, {NEW_DAY_ROWS}
SELECT {columns} FROM order_facts o
WHERE NOT EXISTS (SELECT 1 FROM scopes s WHERE s.activity_id = o.activity_id AND {test})
UNION ALL SELECT {columns} FROM new_rows"""


def q_replace_range_intraday(spark, sf):
    """Every event type's first half of the month is written anew with other values."""
    runs = [
        Run(
            import_id=500 + n,
            activity_id=n,
            forecast_id=1,
            filter=f"event_type = '{name}'",
            fields_source="max(value), count(*)",
            fields_target="value2,value1",
            date_from=D(2024, 1, 2),
            date_until=D(2024, 1, 15),
        )
        for name, n in EVENT_ACTIVITY.items()
    ]
    scopes = [Scope(r.import_id, 1, 1, r.date_from, r.date_until, r.activity_id) for r in runs]
    new = import_intraday(event_source(spark, sf), runs)
    rows = replace_range(intraday_facts(spark, sf), new, scopes)
    return shown(rows, "value1", "value2", more=("interval_id", "duration_min"))


SQL_REPLACE_RANGE_INTRADAY = f"""WITH {INTRADAY_FACTS}
SELECT date, interval_id, activity_id, forecast_id, site_id, import_id, duration_min, {rounded('value1', 'value2')}
FROM intraday_facts WHERE date NOT BETWEEN DATE '2024-01-02' AND DATE '2024-01-15'
UNION ALL
SELECT date, interval_id, activity_id, 1, 1, 500 + activity_id, CAST(15 AS SMALLINT),
       CAST(count(*) AS DOUBLE), round(max(value), 4)
FROM event_source WHERE date BETWEEN DATE '2024-01-02' AND DATE '2024-01-15'
GROUP BY date, interval_id, activity_id"""


def region_scopes() -> list[Scope]:
    return [
        Scope(601, 1, 1, D(1996, 5, 1), D(1999, 4, 30), filter="domain in ('ASIA', 'EUROPE')"),
        Scope(602, 1, 1, D(1998, 1, 1), D(2000, 12, 31), filter="A.[domain] = 'AFRICA' and S.value1 > 20"),
    ]


def q_replace_range_by_filter(spark, sf):
    """Year-to-date style replacement: all activities that meet a filter on the dimension."""
    facts = supplier_facts(spark, sf)
    new = facts.where("date between '1996-05-01' and '1996-05-31'").withColumns(
        {"value1": F.col("value1") * 2, "import_id": F.lit(601)}
    )
    rows = replace_range(facts, new, region_scopes(), supplier_activity(spark, sf))
    return shown(rows, "value1", "value2")


SQL_REPLACE_RANGE_BY_FILTER = f"""WITH {SUPPLIER_FACTS}, {SUPPLIER_ACTIVITY}
SELECT date, f.activity_id, forecast_id, site_id, import_id, {rounded('value1', 'value2')}
FROM supplier_facts f JOIN supplier_activity a ON f.activity_id = a.activity_id
WHERE NOT (domain IN ('ASIA', 'EUROPE') AND date BETWEEN DATE '1996-05-01' AND DATE '1999-04-30')
  AND NOT (domain = 'AFRICA' AND value1 > 20 AND date BETWEEN DATE '1998-01-01' AND DATE '2000-12-31')
UNION ALL
SELECT date, activity_id, forecast_id, site_id, 601, round(value1 * 2, 4), round(value2, 4)
FROM supplier_facts WHERE date BETWEEN DATE '1996-05-01' AND DATE '1996-05-31'"""


def q_run_summary(spark, sf):
    """Rows deleted and inserted per import of a replacing run."""
    return replacement_counts(replacement(order_facts(spark, sf), _new_day_rows(spark, sf), day_scopes()))


SQL_RUN_SUMMARY = f"""WITH {ORDER_FACTS}, {NEW_DAY_ROWS},
d AS (SELECT s.import_id, count(*) AS n FROM order_facts o JOIN scopes s
      ON s.activity_id = o.activity_id AND date BETWEEN f AND u GROUP BY 1),
i AS (SELECT import_id, count(*) AS n FROM new_rows GROUP BY 1)
SELECT coalesce(d.import_id, i.import_id) AS import_id, CAST(coalesce(d.n, 0) AS BIGINT) AS rows_deleted,
       CAST(coalesce(i.n, 0) AS BIGINT) AS rows_inserted
FROM d FULL JOIN i ON d.import_id = i.import_id"""


def q_import_id_writeback(spark, sf):
    """Events marked by overlapping imports; the last one that reads an event keeps it, and one
    only takes events without a mark."""
    runs = [
        Run(1, 1, 1, filter="event_type in ('click', 'view')"),
        Run(2, 2, 1, filter="value > 10", date_from=D(2024, 1, 10), date_until=D(2024, 1, 20)),
        Run(3, 3, 1, filter="event_type <> 'error'", flags=flag_set("-SOURCE_UPDATE_NULL")),
    ]
    return write_back(event_source(spark, sf), runs).select("event_id", "import_id", "updated_by")


SQL_IMPORT_ID_WRITEBACK = """
SELECT event_id, i AS import_id, i AS updated_by FROM (
  SELECT event_id, CASE
    WHEN value > 10 AND CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' THEN 2
    WHEN event_type IN ('click', 'view') THEN 1
    WHEN event_type <> 'error' THEN 3 END AS i
  FROM events)"""


def q_staged_file_cast(spark, sf):
    """Orders as CSV lines, read by the staged files' own parsing; what does not parse is null."""
    lines = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat_ws(
            ";",
            F.when(F.col("o_orderstatus") == "P", F.lit("x")).otherwise(F.concat(F.lit('" '), F.col("o_custkey"), F.lit('"'))),
            F.date_format("o_orderdate", "dd-MM-yyyy"),
            F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")),
        ).alias("line"),
    )
    cells = lines.withColumn("cell", staged_cells(F.col("line"), ";"))
    return cells.select(
        "o_orderkey",
        staged_number(staged_cell(F.col("cell"), "A")).cast("int").alias("a_int"),
        staged_number(staged_cell(F.col("cell"), "C")).alias("h_real"),
        staged_date(staged_cell(F.col("cell"), "B"), "dd-MM-yyyy").cast("date").alias("d_date"),
    )


SQL_STAGED_FILE_CAST = """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS INTEGER) END AS a_int,
       CASE WHEN o_orderstatus <> 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS h_real,
       CAST(o_orderdate AS DATE) AS d_date
FROM orders"""


def q_staged_quoted_records(spark, sf):
    """Orders as lines of five files, some with line breaks inside quotes, cut into blocks wherever it falls;
    records are put together again and read as cells."""
    orders = table(spark, sf, "orders")
    late = F.col("o_orderkey") % 3 == 0
    parts = F.when(late, F.array(
        F.concat(F.col("o_orderkey"), F.lit(',"first '), F.col("o_orderstatus")), F.lit(""), F.concat(F.lit('"",third"",",'), F.col("o_custkey"))
    )).otherwise(F.array(F.concat_ws(",", "o_orderkey", "o_orderstatus", "o_custkey")))
    lines = orders.select(
        F.col("o_orderpriority").alias("path"), (F.col("o_orderkey") * 3).alias("first"), F.posexplode(parts).alias("place", "value")
    ).withColumn("id", F.col("first") + F.col("place"))
    found = quoted_records(lines.select("path", F.expr("id div 1000").alias("block"), "id", "value"))
    cells = found.withColumn("cells", staged_cells(F.col("value")))
    return cells.select(
        "path", "line", "record",
        staged_number(staged_cell(F.col("cells"), "A")).cast("bigint").alias("o_orderkey"),
        staged_cell(F.col("cells"), "B").alias("note"),
        staged_number(staged_cell(F.col("cells"), "C")).cast("bigint").alias("o_custkey"),
    )


SQL_STAGED_QUOTED_RECORDS = """
SELECT o_orderpriority AS path, CAST(1 + coalesce(sum(CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 1 END) OVER w, 0) AS BIGINT) AS line,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS record, o_orderkey,
       CASE WHEN o_orderkey % 3 = 0 THEN 'first ' || o_orderstatus || chr(10) || chr(10) || '",third",' ELSE o_orderstatus END AS note, o_custkey
FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def q_staged_bad_lines(spark, sf):
    """Lines of orders that cannot be staged: a quote left open, too many columns, no date, no number."""
    orders = table(spark, sf, "orders")
    kind = F.col("o_orderkey") % 50
    line = F.concat_ws(
        ";",
        F.when(kind == 7, F.concat(F.lit('"'), F.col("o_orderstatus"))).otherwise(F.col("o_orderstatus")),
        F.when(kind == 11, F.date_format("o_orderdate", "yyyy/dd/MM")).when(kind == 12, F.lit(" ")).otherwise(F.date_format("o_orderdate", "dd.MM.yyyy")),
        F.when(kind == 23, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")),
        F.when(kind == 31, F.repeat(F.lit(";"), 75)).when(kind == 32, F.repeat(F.lit(";"), 74)),
    )
    file = StagedFile("orders.csv", 1, separator=";", field_date="B", field_date_format="dd.MM.yyyy", numbers="C")
    found = with_problem(orders.select(F.col("o_orderkey").alias("line"), line.alias("value")), file)
    return found.where("problem is not null").select("line", F.col("problem").alias("reason"), "value")


SQL_STAGED_BAD_LINES = """WITH o AS (SELECT o_orderkey AS line, o_orderkey % 50 AS k, o_orderstatus AS s, o_orderdate AS d, CAST(o_custkey AS VARCHAR) AS c FROM orders)
SELECT line, CASE k WHEN 7 THEN 'a quote is not closed' WHEN 11 THEN 'no date in column B: ' || strftime(d, '%Y/%d/%m')
         WHEN 23 THEN 'no number in column C: n/a' ELSE 'more columns than BZ' END AS reason,
       CASE k WHEN 7 THEN '"' ELSE '' END || s || ';' || CASE k WHEN 11 THEN strftime(d, '%Y/%d/%m') ELSE strftime(d, '%d.%m.%Y') END || ';' ||
         CASE k WHEN 23 THEN 'n/a' ELSE c END || CASE k WHEN 31 THEN repeat(';', 76) ELSE '' END AS value
FROM o WHERE k IN (7, 11, 23, 31)"""


def q_import_range_filters(spark, sf):
    """An import per price range: 960 filters that no lookup can settle."""
    runs = [
        Run(
            import_id=700 + n, activity_id=n, forecast_id=1, group_by="o_orderdate",
            filter=f"o_totalprice >= {n * 625} and o_totalprice < {(n + 1) * 625}",
            fields_source="sum(o_totalprice), count(*)", fields_target="value1,value2",
        )
        for n in range(960)
    ]
    return shown(import_day(table(spark, sf, "orders"), runs), "value1", "value2")


SQL_IMPORT_RANGE_FILTERS = """
SELECT CAST(o_orderdate AS DATE) AS date, CAST(floor(o_totalprice / 625) AS INTEGER) AS activity_id, 1 AS forecast_id, 1 AS site_id,
       CAST(700 + floor(o_totalprice / 625) AS INTEGER) AS import_id,
       round(sum(o_totalprice), 4) AS value1, CAST(count(*) AS DOUBLE) AS value2
FROM orders WHERE o_totalprice >= 0 AND o_totalprice < 600000 GROUP BY ALL"""


def _overlapping() -> list[tuple[int, int, int, str, str]]:
    """(import, least price, first year, status, comparison of the priority): nested ranges on two columns."""
    signs = ("<=", ">")
    return [
        (5000 + 40 * n + 4 * y + 2 * s + k, 12500 * n, 1995 + y, "FO"[s], signs[k])
        for n in range(40) for y in range(10) for s in range(2) for k in range(2)
    ]


def q_import_overlapping_ranges(spark, sf):
    """1600 imports whose ranges of price and day overlap, each with a status and a test of the priority."""
    runs = [
        Run(
            import_id=i, activity_id=i, forecast_id=1, group_by="o_orderdate",
            filter=f"o_totalprice > {price} AND (o_orderdate between '{year}-01-01' AND '{year + 1}-06-30') "
            f"and [o_orderstatus] = '{status}' and left(o_orderpriority, 1) {sign} '2'",
            fields_source="count(*), max(o_totalprice)", fields_target="value1,value2", date_from=D(1996, 1, 1), date_until=D(1996, 3, 31),
        )
        for i, price, year, status, sign in _overlapping()
    ]
    return shown(import_day(table(spark, sf, "orders"), runs), "value1", "value2")


SQL_IMPORT_OVERLAPPING_RANGES = f"""WITH runs(import_id, price, y, status, sign) AS (VALUES {
    ", ".join(str(r) for r in _overlapping())
})
SELECT CAST(o_orderdate AS DATE) AS date, import_id AS activity_id, 1 AS forecast_id, 1 AS site_id, import_id,
       CAST(count(*) AS DOUBLE) AS value1, round(max(o_totalprice), 4) AS value2
FROM orders JOIN runs ON o_totalprice > price AND o_orderstatus = status AND (left(o_orderpriority, 1) > '2') = (sign = '>')
  AND o_orderdate >= make_date(y, 1, 1) AND o_orderdate <= make_date(y + 1, 6, 30)
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-03-31' GROUP BY ALL"""


def q_import_nested_names(spark, sf):
    """Elements of arrays, fields of a struct named like a table letter, and bracketed names."""
    orders = table(spark, sf, "orders").select(
        "o_orderdate", "o_orderpriority", F.struct(F.col("o_totalprice").alias("value"), F.col("o_orderstatus").alias("id")).alias("data")
    )
    runs = [
        Run(
            import_id=800 + n, activity_id=n, forecast_id=1, group_by="[o_orderdate]",
            filter=f"split([o_orderpriority], '-')[0] = '{n}' and data.id <> 'S.P'",
            fields_source="sum(data.value)", fields_target="[value1]",
        )
        for n in range(1, 6)
    ]
    return shown(import_day(orders, runs), "value1")


SQL_IMPORT_NESTED_NAMES = """
SELECT CAST(o_orderdate AS DATE) AS date, CAST(left(o_orderpriority, 1) AS INTEGER) AS activity_id, 1 AS forecast_id, 1 AS site_id,
       800 + CAST(left(o_orderpriority, 1) AS INTEGER) AS import_id, round(sum(o_totalprice), 4) AS value1
FROM orders WHERE o_orderpriority[2] = '-' GROUP BY ALL"""

QUERIES = {
    "import_range_filters": q_import_range_filters,
    "import_overlapping_ranges": q_import_overlapping_ranges,
    "import_nested_names": q_import_nested_names,
    "import_day": q_import_day,
    "import_day_sumfields": q_import_day_sumfields,
    "import_day_nogroupby": q_import_day_nogroupby,
    "import_many_filters": q_import_many_filters,
    "import_intraday": q_import_intraday,
    "import_by_source_id": q_import_by_source_id,
    "delta_window": q_delta_window,
    "replace_range_day": _replace_day("range"),
    "delete_tail": _replace_day("tail"),
    "delete_head": _replace_day("head"),
    "replace_range_intraday": q_replace_range_intraday,
    "replace_range_by_filter": q_replace_range_by_filter,
    "run_summary": q_run_summary,
    "import_id_writeback": q_import_id_writeback,
    "staged_file_cast": q_staged_file_cast,
    "staged_quoted_records": q_staged_quoted_records,
    "staged_bad_lines": q_staged_bad_lines,
}
ORACLE = {
    "import_range_filters": SQL_IMPORT_RANGE_FILTERS,
    "import_overlapping_ranges": SQL_IMPORT_OVERLAPPING_RANGES,
    "import_nested_names": SQL_IMPORT_NESTED_NAMES,
    "import_day": SQL_IMPORT_DAY,
    "import_day_sumfields": SQL_IMPORT_DAY_SUMFIELDS,
    "import_day_nogroupby": SQL_IMPORT_DAY_NOGROUPBY,
    "import_many_filters": SQL_IMPORT_MANY_FILTERS,
    "import_intraday": SQL_IMPORT_INTRADAY,
    "import_by_source_id": SQL_IMPORT_BY_SOURCE_ID,
    "delta_window": _delta_sql(),
    "replace_range_day": _replace_day_sql("date BETWEEN f AND u"),
    "delete_tail": _replace_day_sql("date >= f"),
    "delete_head": _replace_day_sql("date < u"),
    "replace_range_intraday": SQL_REPLACE_RANGE_INTRADAY,
    "replace_range_by_filter": SQL_REPLACE_RANGE_BY_FILTER,
    "run_summary": SQL_RUN_SUMMARY,
    "import_id_writeback": SQL_IMPORT_ID_WRITEBACK,
    "staged_file_cast": SQL_STAGED_FILE_CAST,
    "staged_quoted_records": SQL_STAGED_QUOTED_RECORDS,
    "staged_bad_lines": SQL_STAGED_BAD_LINES,
}
