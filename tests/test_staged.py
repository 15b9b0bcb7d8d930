"""Staged files: quoted records over splits, cells, bad lines set aside."""

import random

import pytest
from pyspark.sql import functions as F

from chronoweave.model import SOURCE_FILE
from chronoweave.plans.runner import Runner, Tables
from chronoweave.plans.store import FactStore
from chronoweave.sources import staged
from chronoweave.sources.staged import StagedFile, quoted_records, read_staged_files, stage_files, staged_cells


def quoted_file(path, seed, rows=400, end="\n"):
    draw = random.Random(seed)

    def cell():
        if draw.random() < 0.4:
            return draw.choice(["1", "x y", "", " pad ", "é"])
        return '"' + "".join(draw.choice(["a", f"b{end}", f"{end}{end}", '""', ";", "c,d"]) for _ in range(draw.randint(0, 12))) + '"'

    path.write_bytes("".join(",".join([str(i)] + [cell() for _ in range(draw.randint(1, 4))]) + end for i in range(rows)).encode())


@pytest.mark.parametrize("seed, end, size", [(1, "\n", 300), (2, "\n", 1000), (3, "\r\n", 500), (4, "\n", 100_000)])
def test_records_over_splits_are_those_of_one_task(spark, tmp_path, seed, end, size):
    quoted_file(tmp_path / "q.csv", seed, end=end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        splits = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        got = read_staged_files(spark, [StagedFile(str(tmp_path / "q.csv"), 1, multi_line=True, rows_skip=3)])
        rows = sorted(map(tuple, got.select("A", "B", "C", "D", "E").collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    one_task = spark.read.schema("A string, B string, C string, D string, E string").csv(str(tmp_path), multiLine=True, escape='"')
    assert rows == sorted((tuple(r) for r in one_task.collect() if r.A not in ("0", "1", "2")), key=str)
    assert size == 100_000 or splits > 5


def test_records_are_numbered_in_their_file(spark):
    lines = ['a,"x', "y", 'z",1', "b", '"c"', 'd,"', '"', "e"]
    rows = [(p, k // 2, k, v) for p in ("f", "g") for k, v in enumerate(lines)]
    got = quoted_records(spark.createDataFrame(rows, "path string, block long, id long, value string"))
    wanted = [(1, 1, 'a,"x\ny\nz",1'), (4, 2, "b"), (5, 3, '"c"'), (6, 4, 'd,"\n"'), (8, 5, "e")]
    assert sorted(map(tuple, got.collect())) == [(p, *w) for p in ("f", "g") for w in wanted]
    assert quoted_records(spark.createDataFrame([], "path string, block long, id long, value string")).count() == 0


def test_a_quote_that_is_never_closed_gathers_nothing(spark, monkeypatch):
    monkeypatch.setattr(staged, "MOST_RECORD_LINES", 50)
    rows = [("f", k // 20, k, 'x,"y' if k == 7 else f"l{k}") for k in range(200)]
    got = quoted_records(spark.createDataFrame(rows, "path string, block long, id long, value string")).orderBy("line").collect()
    assert [(r.line, r.value) for r in got] == [(k + 1, f"l{k}") for k in range(7)] + [(8, 'x,"y')]


def test_cells_are_those_of_the_csv_reader(spark):
    draw = random.Random(9)
    cells = ["", "a", " b ", '"c"', '"d;e"', '"f ""g"""', '""', '"h" ', 'i"j', "é", '" k"', "'l'", "\\"]
    values = [";".join(draw.choice(cells) for _ in range(5)) for _ in range(400)]
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    read = F.from_csv("value", "a string, b string, c string, d string, e string", {"sep": ";", "escape": '"'})
    for r in rows.select("value", staged_cells(F.col("value"), ";").alias("own"), read.alias("csv")).collect():
        assert list(r.own) == list(r.csv), r.value
    wide = spark.createDataFrame([("a||b|c||\"d||e\"",), ("",), ("||",)], "value string")
    assert [r[0] for r in wide.select(staged_cells(F.col("value"), "||")).collect()] == [["a", "b|c", "d||e"], [None], [None, None]]


LONG_ROW = ",".join(map(str, range(79)))


def staged_folder(tmp_path):
    (tmp_path / "a.csv").write_text(f"day,n\n2024-01-01,1\n2024-13-01,2\n\n2024-01-02,x\n{LONG_ROW}\n2024-01-03,\n2024-01-04,\"5\n,7\n")
    (tmp_path / "b.csv").write_text("".join(f"2024-01-01,{'no' if k % 2 else k},{'y' * 120}\n" for k in range(40)))
    quote = '2024-02-01,"1\n2"\n2024-02-02,"3\n\n4"\n2024-02-03,5\n'
    (tmp_path / "c.csv").write_text("day,n\n" + quote + '2024-02-04,"6\n')
    return [
        StagedFile(str(tmp_path / "a.csv"), 1, rows_skip=1, field_date="A", numbers="B"),
        StagedFile(str(tmp_path / "b.csv"), 2, field_date="A", numbers="B", most_errors=19),
        StagedFile(str(tmp_path / "c.csv"), 3, rows_skip=1, field_date="A", fields="B", multi_line=True),
    ]


@pytest.mark.parametrize("size", [1500, 100_000])
def test_bad_lines_are_set_aside(spark, tmp_path, size):
    files = staged_folder(tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        found = stage_files(spark, files, str(tmp_path / "out"), "s")
        bad = sorted((r.file_id, r.line, r.reason, r.value) for r in found.bad.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [b for b in bad if b[0] != 2] == [
        (1, 3, "no date in column A: 2024-13-01", "2024-13-01,2"), (1, 5, "no number in column B: x", "2024-01-02,x"),
        (1, 6, "more columns than BZ", LONG_ROW), (1, 8, "a quote is not closed", '2024-01-04,"5'), (3, 8, "a quote is not closed", '2024-02-04,"6'),
    ]
    assert [b[1] for b in bad if b[0] == 2] == list(range(2, 41, 2))
    assert found.errors == {1: 4, 2: 20, 3: 1} and found.rejected == [2]
    assert found.rows.columns == SOURCE_FILE.names
    rows = sorted(((r.file_id, str(r.date)[:10], r.A, r.B) for r in found.rows.collect()), key=str)
    assert rows == [
        (1, "2024-01-01", "2024-01-01", "1"), (1, "2024-01-03", "2024-01-03", None), (1, "None", None, "7"),
        (3, "2024-02-01", None, "1\n2"), (3, "2024-02-02", None, "3\n\n4"), (3, "2024-02-03", None, "5"),
    ]


def test_good_files_have_no_bad_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2\n")
    (tmp_path / "empty.csv").write_text("")
    files = [StagedFile(str(tmp_path / "a.csv"), 1), StagedFile(str(tmp_path / "empty.csv"), 2)]
    found = stage_files(spark, files, str(tmp_path / "out"))
    assert found.rows.count() == 1 and found.bad.count() == 0 and found.errors == {} and found.rejected == []
    assert stage_files(spark, files[1:], str(tmp_path / "out")).rows.count() == 0


def test_files_are_read_once(spark, tmp_path):
    found = stage_files(spark, staged_folder(tmp_path)[:2], str(tmp_path / "out"))
    plan = found.rows._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.lower().replace("context", "") and "parquet" in plan.lower()


def test_runner_loads_files(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "day"))
    runner = Runner(spark, Tables(None, None, None, None), store, log_path=str(tmp_path / "log"))
    files = staged_folder(tmp_path)
    runner.load_files(files, str(tmp_path / "out"))
    assert runner.tables.staged.groupBy("file_id").count().orderBy("file_id").collect() == [(1, 3), (3, 3)]
    (tmp_path / "a.csv").write_text("day,n\n2025-01-01,1\n")
    runner.load_files(files[:1], str(tmp_path / "out"))
    assert sorted((r.file_id, r.B) for r in runner.tables.staged.collect()) == [(1, "1"), (3, "1\n2"), (3, "3\n\n4"), (3, "5")]
    log = spark.read.parquet(str(tmp_path / "log")).where("step = 'LOAD'").collect()
    assert sorted((r.object_id, r.result, r.value) for r in log) == [(1, "Warning", 4), (2, "Failed", 20), (3, "Warning", 1)]
