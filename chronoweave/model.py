"""Table schemas of the data model, and the resolved import that operators work from."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VALUES = [f"value{i}" for i in range(1, 11)]
SERIES = ["site_id", "activity_id", "forecast_id"]

# Dates that stand for "no bound" in a resolved import.
OPEN_FROM = dt.date(1900, 1, 1)
OPEN_UNTIL = dt.date(9999, 1, 1)


# Column types of the tables: Spark type and, for driver-held rows, Arrow type.
_TYPES = {
    "int": (T.IntegerType(), pa.int32()),
    "bigint": (T.LongType(), pa.int64()),
    "smallint": (T.ShortType(), pa.int16()),
    "double": (T.DoubleType(), pa.float64()),
    "size": (T.DecimalType(10, 2), pa.decimal128(10, 2)),
    "string": (T.StringType(), pa.string()),
    "boolean": (T.BooleanType(), pa.bool_()),
    "ints": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "date": (T.DateType(), pa.date32()),
    "timestamp": (T.TimestampType(), pa.timestamp("us", tz="UTC")),
}


def schema_of(columns: str) -> T.StructType:
    """`name type, name type not null, ..` as a schema; needs no session."""
    fields = []
    for column in columns.split(","):
        name, kind, *rest = column.split()
        fields.append(T.StructField(name, _TYPES[kind][0], rest != ["not", "null"]))
    return T.StructType(fields)


_VALUES_DDL = ", ".join(f"{v} double" for v in VALUES)

FACT_DAY = schema_of(
    f"date date not null, activity_id int not null, forecast_id int not null, {_VALUES_DDL}, "
    "site_id int, import_id int, date_updated timestamp"
)
FACT_INTRADAY = schema_of(
    f"date date not null, interval_id smallint not null, activity_id int not null, "
    f"forecast_id int not null, {_VALUES_DDL}, duration_min smallint, site_id int, "
    "import_id int, date_updated timestamp"
)
DIM_ACTIVITY = schema_of(
    "activity_id int, activity_name string, activity_set string, activity_code string, "
    "description string, segment string, domain string, region string, template_id int, "
    "slicer1 string, slicer2 string, slicer3 string, sort_order smallint, resource string, "
    "channel string, reference string, parent string, status string, plantype string, "
    "category string, site_id int, activity_guid string, active boolean, tags string, "
    "color string, font_awesome string, date_updated timestamp, date_created timestamp"
)
DIM_FORECAST = schema_of(
    "forecast_id int, forecast_name string, forecast_code string, forecast_guid string, "
    "description string, domain string, category string, status string, active boolean, "
    "sort_order int, site_id int, date_updated timestamp, date_created timestamp"
)
DIM_TEMPLATE = schema_of(
    "template_id int, template_name string, template_guid string, description string, "
    "category string, domain string, status string, "
    + ", ".join(f"{v} string, {v}_description string" for v in VALUES)
    + ", date_updated timestamp, site_id int, active boolean"
)
_RUN_SETTINGS = (
    "source string, fields_source string, fields_target string, filter string, "
    "group_by string, schedule string, days_back string, days_forward string, "
    "date_import_from timestamp, date_import_until timestamp, "
    "p1 string, p2 string, p3 string, p4 string, p5 string, commands string, version string, "
    "sort_order int, active boolean, domain string, category string, status string, "
    "description string, site_id int, date_updated timestamp, date_created timestamp"
)
IMPORT_PROCEDURE = schema_of(
    "procedure_id int, procedure_name string, procedure_guid string, procedure_code string, "
    "app string, " + _RUN_SETTINGS
)
IMPORT = schema_of(
    "import_id int, import_code string, procedure_id int, procedure_code string, "
    "activity_id int, forecast_id int, template_id int, import_guid string, file_id int, "
    + _RUN_SETTINGS
)
IMPORT_FILE = schema_of(
    "file_id int, file_name string, source string, attributes string, file_created string, "
    "file_updated string, file_last_access string, size size, field_date string, "
    "field_date_format string, rows_skip int, fields string, session string, domain string, "
    "category string, description string, status string, site_id int, active boolean, "
    "file_guid string, tab string, records int, date_created timestamp, date_updated timestamp, "
    "forecast_id int, activity_set string, activity_id int, field_interval string, "
    "field_interval_format string, date_min date, date_max date, filter_delete string, "
    "filter_update string, swap_dot_comma boolean, commands string, file_reader string, "
    "days_back string, days_forward string, date_run timestamp, file_data string, "
    "file_date_min date, file_date_max date, file_records int, region string, slicer1 string, "
    "slicer2 string, slicer3 string, metadata string, service_id int, type string"
)

# Spreadsheet column letters A..Z, AA..AZ, BA..BZ.
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = [p + c for p in ("", "A", "B") for c in _ALPHABET]

SOURCE_FILE = schema_of(
    "id bigint, date timestamp, source string, import_id int, activity_id int, "
    "forecast_id int, file_id int, "
    + ", ".join(f"{c} string" for c in LETTERS)
    + ", site_id int, session string"
)
SOURCE_CALENDAR = schema_of(
    "calendar_id int, category string, domain string, segment string, subject string, "
    "start_date timestamp, end_date timestamp, timezone string, recurence string, "
    "allday boolean, region string, resource string, description string, type string, "
    "path string, value1 double, value2 double, value3 double, text1 string, text2 string, "
    "text3 string, status string, p1 string, p2 string, p3 string, date_updated timestamp, "
    "site_id int not null"
)
RUN_LOG = schema_of(
    "logged timestamp, category string, session string, site int, object string, "
    "object_sub string, object_id int, step string, data string, result string, "
    "duration double, value bigint"
)


@dataclass(frozen=True)
class Run:
    """One import with procedure defaults applied: what to read and which series to write."""

    import_id: int
    activity_id: int
    forecast_id: int
    site_id: int = 1
    date_from: dt.date = OPEN_FROM
    date_until: dt.date = OPEN_UNTIL
    source: str = ""
    filter: str = ""
    group_by: str = ""
    fields_source: str = ""
    fields_target: str = ""
    p1: str = ""
    p2: str = ""
    p3: str = ""
    p4: str = ""
    p5: str = ""
    parent: str = ""
    schedule: str = ""
    commands: str = ""
    procedure_name: str = ""
    sort_order: int = 1101
    flags: frozenset[str] = field(default_factory=frozenset)

    def has(self, flag: str) -> bool:
        return flag in self.flags

    def with_window(self, date_from: dt.date, date_until: dt.date) -> Run:
        return replace(self, date_from=date_from, date_until=date_until)

    def closed(self, calendar: tuple[dt.date, dt.date] | None = None) -> Run:
        """The run with open bounds taken from a calendar; bounds that are given never change."""
        first, last = calendar or (OPEN_FROM, OPEN_UNTIL)
        run = self.with_window(
            first if self.date_from == OPEN_FROM else self.date_from,
            last if self.date_until == OPEN_UNTIL else self.date_until,
        )
        if OPEN_FROM == run.date_from or OPEN_UNTIL == run.date_until:
            raise ValueError(f"import {self.import_id}: the window is open and there is no calendar to close it")
        return run


def local_table(
    spark: SparkSession, rows: Sequence[dict], columns: str | T.StructType
) -> DataFrame:
    """A driver-held table as a local relation.

    Its exact size is in the plan's statistics, so Spark itself decides whether the
    table is small enough to broadcast; no hint is set.
    """
    schema = schema_of(columns) if isinstance(columns, str) else columns
    arrow_types = dict(_TYPES.values())
    arrow = pa.schema([pa.field(f.name, arrow_types[f.dataType], f.nullable) for f in schema.fields])
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), schema=arrow), schema)


def literal_rows(rows: Sequence[dict], columns: str) -> Column:
    """Driver-held rows as one constant: an array of structs."""
    kind = T.ArrayType(T.StructType.fromDDL(columns))
    return F.from_json(F.lit(json.dumps(list(rows), default=str)), kind)


# Size up to which a dimension or id table is sent to every task instead of being shuffled.
BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_if_small(rows: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """`rows` marked for broadcast if they are measured to take at most `most` bytes.

    Estimates for joined or filtered tables are often far too high, and then the facts would be
    shuffled to meet a few thousand rows. Larger tables stay unmarked: Spark shuffles both
    sides and splits skewed keys.
    """
    return F.broadcast(rows) if measured_bytes(rows) <= most else rows


def measured_bytes(rows: DataFrame) -> int:
    """Size of a flat table: 8 bytes per value and the length of its texts."""
    texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]
    found = rows.agg(
        F.count(F.lit(1)), *[F.coalesce(F.sum(F.octet_length(F.col(c))), F.lit(0)) for c in texts]
    ).first()
    return found[0] * 8 * len(rows.columns) + sum(found[1:])


def run_time(when: dt.datetime | None) -> Column:
    """The run's time stamp; the clock of the session when none is given."""
    return F.current_timestamp() if when is None else F.lit(when)


def as_fact_day(rows: DataFrame, when: dt.datetime | None = None) -> DataFrame:
    """Rows with the fact columns in order; value columns that are missing become null."""
    return _as_fact(rows, FACT_DAY, when)


def as_fact_intraday(rows: DataFrame, when: dt.datetime | None = None) -> DataFrame:
    return _as_fact(rows, FACT_INTRADAY, when)


def _as_fact(rows: DataFrame, schema: T.StructType, when: dt.datetime | None) -> DataFrame:
    have = set(rows.columns)
    out = []
    for f in schema.fields:
        if f.name in have:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name == "date_updated":
            out.append(run_time(when).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return rows.select(*out)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
