"""User files (CSV, TXT) as staged rows: text columns A, B, .. BZ plus file and date.

Files are read as lines, so that every file is split like any text input. Where quoted cells hold line
breaks, the number of quotes says how lines belong together: a line starts a record if an even number of
quotes stands before it in the file. Each split counts its own; what the splits before leave over, one
parity each, is added up afterwards, and only records of several lines are gathered.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.model import LETTERS, SOURCE_FILE, local_table, schema_of, union_all


@dataclass(frozen=True)
class StagedFile:
    """How to read one file. `fields` limits the columns that are kept (comma-separated
    letters, blank for all); `field_date` is the letter of the date column and `numbers` are those of
    columns that hold numbers. With `multi_line` quoted cells may hold line breaks; every quote then
    counts, so cells that hold one have to be quoted, and lines end with a line feed. A file with more than
    `most_errors` bad lines is left out as a whole when bad lines are set aside."""

    path: str
    file_id: int
    source: str = ""
    site_id: int = 1
    rows_skip: int = 0
    fields: str = ""
    field_date: str = ""
    field_date_format: str = "yyyy-MM-dd"
    separator: str = ","
    activity_id: int | None = None
    forecast_id: int | None = None
    multi_line: bool = False
    numbers: str = ""
    most_errors: int = 1000


#: Files whose first lines are broadcast at most; beyond, they are joined by shuffle.
MOST_BROADCAST_FILES = 50_000
#: Lines of a record; a quote that is still open then is an error of the line it stands in.
MOST_RECORD_LINES = 10_000
#: Reasons why lines are set aside.
TOO_WIDE, OPEN_QUOTE = "more columns than BZ", "a quote is not closed"
BAD_LINES = schema_of("file_id int, path string, line bigint, reason string, value string")


def configured_files(files: DataFrame, folder: str, **more) -> list[StagedFile]:
    """The active rows of an `import_file` table as files of `folder`, in order of their id.

    `more` are settings the table does not hold, such as `separator` and `multi_line`.
    """
    rows = files.where(F.coalesce("active", F.lit(True))).orderBy("file_id").collect()
    return [
        StagedFile(
            f"{folder.rstrip('/')}/{r['file_name']}",
            r["file_id"],
            r["source"] or "",
            1 if r["site_id"] is None else r["site_id"],
            r["rows_skip"] or 0,
            r["fields"] or "",
            (r["field_date"] or "").strip(),
            (r["field_date_format"] or "").strip() or StagedFile.field_date_format,
            activity_id=r["activity_id"],
            forecast_id=r["forecast_id"],
            **more,
        )
        for r in rows
    ]


# Cells ---------------------------------------------------------------------------------------


def staged_cells(value: Column, separator: str = ",") -> Column:
    """The cells of a line as an array; empty ones, quoted or not, are null.

    A quoted cell may hold separators and doubled quotes; blanks may follow its closing quote. A cell in
    which anything else follows is taken as it stands.
    """
    sep = re.escape(separator)
    bare = rf"[^{sep}]*+" if len(separator) == 1 else rf"(?:(?!{sep})[\s\S])*+"
    quoted = r'"[^"]*+(?:""[^"]*+)*+"'
    # Each cell with the separator before it, so that no find is empty.
    found = F.regexp_extract_all(F.concat(F.lit(separator), value), F.lit(rf"{sep}({quoted}{bare}|{bare})"), F.lit(1))

    def cell(raw: Column) -> Column:
        whole = raw.rlike(rf"^{quoted}\s*$")
        inner = F.replace(F.regexp_extract(raw, r'^"([\s\S]*)"\s*$', 1), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(raw.startswith('"') & whole, inner).otherwise(raw), F.lit(""))

    plain = F.transform(F.split(value, sep), lambda c: F.nullif(c, F.lit("")))
    return F.when(F.contains(value, F.lit('"')), F.transform(found, cell)).otherwise(plain)


def staged_cell(cells: Column, letter: str) -> Column:
    """The cell of a column; null past the end of the line."""
    return F.get(cells, F.lit(LETTERS.index(letter.strip().upper())))


def staged_number(cell: Column) -> Column:
    return F.trim(cell).try_cast("double")


def staged_date(cell: Column, format: str = StagedFile.field_date_format) -> Column:
    """A cell as a time stamp; null where it does not have the format."""
    return F.try_to_timestamp(F.trim(cell), F.lit(format))


# Records -------------------------------------------------------------------------------------


def quoted_records(lines: DataFrame) -> DataFrame:
    """`path, line, record, value`: records whose quoted cells may hold line breaks, from `path, block, id, value`.

    Blocks of a path and ids in a block are in the order of the file. line is the number of a record's first
    line in its file, record its own number, both from 1. The lines of a block meet in one task, of a path only
    a row for each block. A record that would be longer than MOST_RECORD_LINES is its first line only; its
    further lines are dropped, like those after a quote that is never closed.
    """
    block = W.partitionBy("path", "block").orderBy("id")
    so_far = block.rowsBetween(W.unboundedPreceding, W.currentRow)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = lines.withColumn("value", F.regexp_replace("value", r"\r$", ""))
    counted = lines.select("path", "block", "id", "value", (quotes % 2).alias("odd")).withColumns(
        {
            "no": F.row_number().over(block),
            "before": F.coalesce(F.sum("odd").over(block.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) % 2,
        }
    )
    # A line starts a record if what stands before it in the block has the parity of what the blocks before leave.
    even, odd = F.col("before") == 0, F.col("before") == 1
    counted = counted.withColumns(
        {
            "start0": F.max(F.when(even, F.col("no"))).over(so_far), "start1": F.max(F.when(odd, F.col("no"))).over(so_far),
            "records0": F.count_if(even).over(so_far), "records1": F.count_if(odd).over(so_far),
        }
    )
    whole = ("start0", "start1", "records0", "records1")
    blocks = counted.groupBy("path", "block").agg(
        F.max("no").alias("lines"), (F.sum("odd") % 2).alias("left"), *[F.max(c).alias(c) for c in whole]
    )
    order = W.partitionBy("path").orderBy("block")
    prior = order.rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("open", F.coalesce(F.sum("left").over(prior), F.lit(0)) % 2)
    start = F.when(F.col("open") == 0, F.col("start0")).otherwise(F.col("start1"))
    n_records = F.when(F.col("open") == 0, F.col("records0")).otherwise(F.col("records1"))
    blocks = blocks.withColumn("lines_before", F.coalesce(F.sum("lines").over(prior), F.lit(0))).select(
        "path", "block", "open", "lines_before",
        F.last(F.when(start.isNotNull(), F.col("lines_before") + start), ignorenulls=True).over(prior).alias("from_before"),
        F.coalesce(F.sum(n_records).over(prior), F.lit(0)).alias("records_before"),
    )
    own = counted.join(blocks, ["path", "block"])
    is_even = F.col("open") == 0
    line = F.coalesce(F.col("lines_before") + F.when(is_even, F.col("start0")).otherwise(F.col("start1")), F.col("from_before"))
    record = F.col("records_before") + F.when(is_even, F.col("records0")).otherwise(F.col("records1"))
    starts = (F.col("before") == F.col("open"))
    placed = own.select(
        "path", line.alias("line"), record.alias("record"), "value", (F.col("lines_before") + F.col("no")).alias("own_line"),
        (starts & (F.col("odd") == 0)).alias("alone"),
    )
    alone = placed.where("alone").select("path", "line", "record", "value")
    several = placed.where("not alone")
    endless = several.groupBy("path", "line").count().where(F.col("count") > MOST_RECORD_LINES).drop("count")
    endless = endless.withColumn("endless", F.lit(True))
    several = several.join(endless, ["path", "line"], "left").where("endless is null or line = own_line")
    gathered = several.groupBy("path", "line", "record").agg(F.sort_array(F.collect_list(F.struct("own_line", "value"))).alias("parts"))
    joined = gathered.select("path", "line", "record", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    return alone.unionByName(joined)


def _records(spark: SparkSession, file: StagedFile) -> DataFrame:
    """`path, id, value` of a file's records after those to be skipped; blank lines are none."""
    reader = spark.read.option("lineSep", "\n") if file.multi_line else spark.read
    text = reader.text(file.path).select("value", "_metadata")
    lines = text.select(
        "value",
        F.monotonically_increasing_id().alias("id"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    if file.multi_line:
        found = quoted_records(lines).where(F.col("record") > file.rows_skip).withColumnRenamed("line", "id")
        return found.where(F.trim("value") != "").select("path", "id", "value")
    if file.rows_skip > 0:
        # Numbers run on within a split, so the first lines of a file are those that follow
        # the first number of its first split.
        head = lines.where(F.col("block") == 0).groupBy("path").agg(F.min("id").alias("first_no"))
        if len(text.inputFiles()) <= MOST_BROADCAST_FILES:
            head = F.broadcast(head)  # one row a file
        lines = lines.join(head, "path").where((F.col("block") > 0) | (F.col("id") >= F.col("first_no") + file.rows_skip))
    return lines.where(F.trim("value") != "").select("path", "id", "value")


def with_problem(rows: DataFrame, file: StagedFile) -> DataFrame:
    """Records with their `cells` and `problem`, why the record is bad; null if it is not."""
    cells = F.col("cells")

    def unread(letters: str, what: str, read) -> list[Column]:
        found = []
        for letter in [c.strip().upper() for c in letters.split(",") if c.strip()]:
            cell = staged_cell(cells, letter)
            bad = (F.trim(cell) != "") & read(cell).isNull()
            found.append(F.when(bad, F.concat(F.lit(f"no {what} in column {letter}: "), cell)))
        return found

    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    problems = [
        F.when(quotes % 2 == 1, F.lit(OPEN_QUOTE)),
        F.when(F.size(cells) > len(LETTERS), F.lit(TOO_WIDE)),
        *unread(file.field_date, "date", lambda c: staged_date(c, file.field_date_format)),
        *unread(file.numbers, "number", staged_number),
    ]
    return rows.withColumn("cells", staged_cells(F.col("value"), file.separator)).withColumn("problem", F.coalesce(*problems))


def _staged(rows: DataFrame, file: StagedFile, session: str, *more: str) -> DataFrame:
    """Records with cells in the layout of staged rows; cells past the last kept letter are not looked at."""
    kept = {c.strip().upper() for c in file.fields.split(",") if c.strip()} or set(LETTERS)
    date = F.lit(None).cast("timestamp")
    if file.field_date:
        date = staged_date(staged_cell(F.col("cells"), file.field_date), file.field_date_format)
    columns = {
        "id": F.col("id"),
        "date": date,
        "source": F.lit(file.source),
        "import_id": F.lit(None),
        "activity_id": F.lit(file.activity_id),
        "forecast_id": F.lit(file.forecast_id),
        "file_id": F.lit(file.file_id),
        "site_id": F.lit(file.site_id),
        "session": F.lit(session),
        **{c: staged_cell(F.col("cells"), c) if c in kept else F.lit(None) for c in LETTERS},
    }
    return rows.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in SOURCE_FILE.fields], *more)


# Files ---------------------------------------------------------------------------------------


def read_staged_files(spark: SparkSession, files: Sequence[StagedFile], session: str = "") -> DataFrame:
    """All files as staged rows. A line with more columns than the layout has is an error; cells that are no
    date or number are null."""

    def one(file: StagedFile) -> DataFrame:
        rows = _records(spark, file).withColumn("cells", staged_cells(F.col("value"), file.separator))
        wide = F.raise_error(F.concat(F.lit(f"{TOO_WIDE} in "), F.col("path"))).cast("boolean")
        return _staged(rows.where(F.when(F.size("cells") > len(LETTERS), wide).otherwise(True)), file, session)

    return union_all(one(f) for f in files)


class Staged(NamedTuple):
    """Staged rows without those set aside, the latter (BAD_LINES), their number by file, and the files left out."""

    rows: DataFrame
    bad: DataFrame
    errors: dict[int, int]
    rejected: list[int]


def stage_files(spark: SparkSession, files: Sequence[StagedFile], path: str, session: str = "") -> Staged:
    """Reads all files once and writes their good rows and their bad lines beside each other under `path`.

    A line is bad if it is too wide, leaves a quote open, or holds a cell of the date column or of a number
    column that is neither blank nor a date or number. A file with more bad lines than its `most_errors`
    is left out as a whole; its bad lines are kept. Their places in the file are counted only if there are any.
    """
    folder = f"{path.rstrip('/')}/staged-{uuid.uuid4().hex}"

    def one(file: StagedFile) -> DataFrame:
        rows = with_problem(_records(spark, file), file).withColumn("value", F.when(F.col("problem").isNotNull(), F.col("value")))
        return _staged(rows, file, session, "path", "problem", "value").withColumn("bad", F.col("problem").isNotNull())

    union_all(one(f) for f in files).write.partitionBy("bad").parquet(folder)
    # Declared, as a folder without any file tells no columns.
    stored = T.StructType([*SOURCE_FILE.fields, *schema_of("path string, problem string, value string, bad boolean").fields])
    written = spark.read.schema(stored).parquet(folder)
    bad = written.where("bad")
    # One row a file.
    errors = dict(sorted(bad.groupBy("file_id").count().collect()))
    rejected = [f.file_id for f in files if errors.get(f.file_id, 0) > f.most_errors]
    rows = written.where("not bad")
    if rejected:
        left_out = local_table(spark, [{"file_id": f} for f in rejected], "file_id int")
        rows = rows.join(left_out, "file_id", "left_anti")
    placed = _with_lines(spark, [f for f in files if f.file_id in errors], bad)
    return Staged(rows.select(*SOURCE_FILE.names), placed, errors, rejected)


def _with_lines(spark: SparkSession, files: Sequence[StagedFile], bad: DataFrame) -> DataFrame:
    """Bad lines with the number of their line in the file."""
    found = bad.select("file_id", "path", "id", F.col("problem").alias("reason"), "value")
    parts = [found.where(F.col("file_id").isin([f.file_id for f in files if f.multi_line])).withColumn("line", F.col("id"))]
    for file in files:
        if file.multi_line:
            continue
        lines = spark.read.text(file.path).select(
            F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
        )
        blocks = lines.groupBy("path", "block").agg(F.min("at").alias("first"), F.max("at").alias("last"))
        prior = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
        blocks = blocks.withColumn("lines_before", F.coalesce(F.sum(F.col("last") - F.col("first") + 1).over(prior), F.lit(0)))
        own = found.where(F.col("file_id") == file.file_id).join(blocks, "path").where(F.col("id").between(F.col("first"), F.col("last")))
        parts.append(own.withColumn("line", F.col("lines_before") + F.col("id") - F.col("first") + 1))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in BAD_LINES.fields])
