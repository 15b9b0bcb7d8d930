"""Compares registered queries with their oracle SQL: `python -m workload.check [sf] [name ...]`."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from workload import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _key(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    start = time.monotonic()
    df = registry.QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    seconds = time.monotonic() - start
    if name not in registry.ORACLE:
        return len(got) > 0, f"{len(got)} rows, no oracle, {seconds:.1f}s"
    rel = con.sql(registry.ORACLE[name])
    want = rel.fetchall()
    g, gc = rows_of(df.columns, got)
    w, wc = rows_of(list(rel.columns), want)
    types = {c: t for c, t in df.dtypes}
    other = {c: str(t).lower() for c, t in zip(rel.columns, rel.types)}
    if gc != wc:
        return False, f"columns {gc} vs {wc}"
    note = f"{len(g)} rows vs {len(w)}, {seconds:.1f}s"
    odd = {c: (types[c], other[c]) for c in gc if not _same_type(types[c], other[c])}
    if odd:
        note += f" TYPES {odd}"
    if g == w:
        return not odd, note
    a, b = [r for r in g if r not in set(w)][:3], [r for r in w if r not in set(g)][:3]
    return False, f"{note} DIFF columns {gc}\n   spark {a}\n   oracle {b}"


_SAME = {
    "int": {"integer"}, "bigint": {"bigint"}, "smallint": {"smallint"}, "double": {"double"},
    "string": {"varchar"}, "date": {"date"}, "boolean": {"boolean"},
    "timestamp_ntz": {"timestamp"}, "timestamp": {"timestamp"},
}


def _same_type(spark_type: str, duck_type: str) -> bool:
    return duck_type in _SAME.get(spark_type, set())


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "sf0.01"
    names = argv[1:] or list(registry.QUERIES)
    sf_dir = f"/root/testdata/{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001 - a report, not a run
            ok, note = False, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{len(names) - bad} of {len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
