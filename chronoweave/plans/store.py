"""Fact tables on a shared file system, where an import replaces exactly its range.

Plain parquet has no row-level delete, so the partitions an import touches are written anew,
each time under a new version directory; other partitions stay as they are. Which version of a
partition is in force stands in a small Parquet table of places, one row a partition. Facts are read
by partition discovery and a join with the places, so Spark lists, prunes and filters. A replacement
counts once the next table of places has its name: a writer lost before has changed nothing, and
afterwards nothing is left to finish. What the replacement before has replaced stays on disk, so that
plans made earlier can still run; what is older is removed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.model import FACT_DAY, FACT_INTRADAY, local_table, schema_of
from chronoweave.operators.replace import HEAD, TAIL, Scope, replacement

PARTITIONS = ["site_id", "forecast_id", "year_month", "bucket"]
#: Activities of a month are spread over so many partitions; an import of one rewrites one.
ACTIVITY_BUCKETS = 8
#: Files of a table of places.
PLACE_FILES = 4
PLACES = schema_of("version string, site_id int, forecast_id int, year_month int, bucket int")
_PLACES = "_places"  # Spark does not read names that start with _


class FactStore:
    """Day or 15-minute facts under `path`, partitioned by site, forecast, month and activities.

    One writer at a time. `replace` is safe to repeat: running an import twice equals once.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = FACT_DAY):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at(self.path).getFileSystem(conf)

    @classmethod
    def intraday(cls, spark: SparkSession, path: str) -> FactStore:
        return cls(spark, path, FACT_INTRADAY)

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    # --- reading --------------------------------------------------------------------

    def read(self) -> DataFrame:
        """All facts."""
        return self._rows(self.places())

    def read_by_month(self) -> DataFrame:
        """All facts with `year`, `month` and `year_month` taken from the partitions, so that
        conditions on them in a filter leave the other months unread."""
        rows = self._rows(self.places(), ["year_month"])
        month = F.col("year_month")
        return rows.withColumns({"year": F.expr("year_month div 100").cast("int"), "month": F.pmod(month, F.lit(100))})

    def where_days(self, first: dt.date, last: dt.date) -> DataFrame:
        """Facts of a date range, reading only its months."""
        months = F.col("year_month").between(_month(first), _month(last))
        rows = self._rows(self.places().where(months), ["year_month"]).where(months).drop("year_month")
        return rows.where(F.col("date").between(F.lit(first), F.lit(last)))

    def days(self) -> tuple[dt.date, dt.date] | None:
        """First day of the first month with facts and last day of the last one."""
        first, last = self.places().agg(F.min("year_month"), F.max("year_month")).first()
        if first is None:
            return None
        following = dt.date(last // 100 + last % 100 // 12, last % 100 % 12 + 1, 1) if last < 999912 else dt.date.max
        return dt.date(first // 100, first % 100, 1), following - dt.timedelta(1)

    def places(self, number: int | None = None) -> DataFrame:
        """The partitions and their versions, in force or of an earlier number."""
        number = number or max(self._numbers(), default=0)
        if not number:
            return self.spark.createDataFrame([], PLACES)
        return self.spark.read.schema(PLACES).parquet(f"{self.path}/{_PLACES}/{number:012}")

    def _rows(self, places: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        """The rows of some places, with some columns of theirs."""
        if not self._numbers():
            extra = [T.StructField(c, T.IntegerType()) for c in more]
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, *extra]))
        stored = T.StructType([*self.schema.fields, PLACES["version"]])
        for name in ("year_month", "bucket"):
            stored = stored.add(name, T.IntegerType())
        facts = self.spark.read.schema(stored).parquet(self.path)
        same = [facts[c].eqNullSafe(places[c]) if c == "site_id" else facts[c] == places[c] for c in ("version", *PARTITIONS)]
        # The comparison tells Spark that places may leave out partitions, so that it prunes by them.
        return facts.join(places.where("year_month > 0"), same, "left_semi").select(*self.schema.names, *more)

    # --- writing --------------------------------------------------------------------

    def append(self, rows: DataFrame) -> None:
        version, _ = self._write(_undeleted(rows.select(*self.schema.names)))
        self._commit(self.places().unionByName(self._written(version)))

    def replace(
        self,
        new: DataFrame,
        scopes: Sequence[Scope],
        activity: DataFrame | None = None,
        dates: DataFrame | None = None,
    ) -> tuple[dict[int, int], dict[int, int]]:
        """Removes the scopes' rows, adds `new`, and returns rows deleted and inserted per import.

        Both are counted as the rows are written, so the old ones are read once. New rows have to lie in
        the months of the scopes.
        """
        places = self._touched(scopes).persist()
        old = self._rows(places.where("touched"))
        rows = replacement(old, new.select(*self.schema.names), scopes, activity, dates)
        version, counts = self._write(rows, len(scopes))
        written, spared = self._written(version).persist(), places.where("not touched").drop("touched")
        same = [written[c].eqNullSafe(spared[c]) for c in PARTITIONS]
        outside = written.join(spared, same, "left_semi").limit(5).collect()
        if outside:
            self._fs.delete(self._at(f"{self.path}/version={version}"), True)
            raise ValueError(f"new rows outside the months to replace: {[tuple(r)[1:] for r in outside]}")
        self._commit(spared.unionByName(written))
        places.unpersist(), written.unpersist()
        return counts

    def update(self, change: Callable[[DataFrame], DataFrame], first: dt.date, last: dt.date) -> None:
        """Writes the months from `first` to `last` anew with `change` applied to their rows."""
        months = F.col("year_month").between(_month(first), _month(last))
        places = self.places()
        version, _ = self._write(_undeleted(change(self._rows(places.where(months))).select(*self.schema.names)))
        self._commit(places.where(~months).unionByName(self._written(version)))

    def _touched(self, scopes: Sequence[Scope]) -> DataFrame:
        """The places in force, `touched` if they hold rows that are replaced or will get new ones."""
        spans = [
            dict(zip(("_site", "_forecast", "_bucket", "_first", "_last"), (s.site_id, s.forecast_id, b, *_months(s))))
            for s in scopes
            for b in (range(ACTIVITY_BUCKETS) if s.activity_id is None else [s.activity_id % ACTIVITY_BUCKETS])
        ]
        table = local_table(self.spark, spans, "_site int, _forecast int, _bucket int, _first int, _last int")
        places = self.places()
        on = [F.col("site_id") == F.col("_site"), F.col("forecast_id") == F.col("_forecast"), F.col("bucket") == F.col("_bucket")]
        met = places.join(table, on).where(F.col("year_month").between(F.col("_first"), F.col("_last")))
        met = met.select(*[F.col(c).alias(f"_{c}") for c in PLACES.names]).distinct()
        same = [F.col(c) == F.col(f"_{c}") for c in PLACES.names]
        return places.join(met, same, "left").select(*PLACES.names, F.col("_version").isNotNull().alias("touched"))

    def _write(self, rows: DataFrame, imports: int = 0) -> tuple[str, tuple[dict[int, int], dict[int, int]]]:
        """The version under which the rows that stay are written, and the rows deleted and inserted per import.

        Deleted rows come along as far as the task that writes their partition, empty but for their keys: there
        each row is counted once, whichever tasks before had to run again.
        """
        version, seen = uuid.uuid4().hex, Observation()
        keys = {"date", *PARTITIONS, "activity_id"}
        gone = F.col("deleted_by").isNotNull()
        light = [c if c in keys else F.when(~gone, F.col(c)).alias(c) for c in self.schema.names]
        # A histogram of as many values as it has bins is exact: a count per import, however many there are.
        bins = F.lit(4 * imports + 8)
        counts = [F.histogram_numeric(F.col(c).cast("double"), bins).alias(c) for c in ("deleted_by", "inserted_by")]
        # The rebalance keeps one partition's rows together but splits a month that is too
        # large for one task; sorted files let activity and date filters skip row groups.
        dealt = (
            rows.select(*light, "deleted_by", "inserted_by")
            .withColumn("year_month", F.year("date") * 100 + F.month("date"))
            .withColumn("bucket", F.pmod(F.coalesce("activity_id", F.lit(0)), F.lit(ACTIVITY_BUCKETS)))
            .hint("rebalance", *PARTITIONS)
            .sortWithinPartitions(*PARTITIONS, "activity_id", "date")
        )
        if imports:
            dealt = dealt.observe(seen, *counts)
        kept = dealt.where(~gone).drop("deleted_by", "inserted_by")
        kept.write.partitionBy(*PARTITIONS).parquet(f"{self.path}/version={version}")
        found = seen.get if imports else {}
        return version, tuple(_by_import(found.get(c)) for c in ("deleted_by", "inserted_by"))

    def _written(self, version: str) -> DataFrame:
        """The places of a version, found by partition discovery."""
        stored = T.StructType([f for f in PLACES.fields if f.name != "version"])
        found = self.spark.read.schema(T.StructType([self.schema["date"], *stored.fields])).parquet(f"{self.path}/version={version}")
        return found.select(F.lit(version).alias("version"), *PARTITIONS).distinct()

    # --- places ---------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        """Numbers of the tables of places that are complete: two at most, but while one is written."""
        found = self._fs.globStatus(self._at(f"{self.path}/{_PLACES}/[0-9]*")) or []
        return sorted(int(s.getPath().getName()) for s in found)

    def _commit(self, places: DataFrame) -> None:
        """Makes `places` the partitions in force, in one step."""
        numbers = self._numbers()
        number = max(numbers, default=0) + 1
        # Written under another name first: a table counts only once it is complete.
        draft = f"{self.path}/{_PLACES}/.{uuid.uuid4().hex}"
        places.select(*PLACES.names).coalesce(PLACE_FILES).write.parquet(draft)
        target = self._at(f"{self.path}/{_PLACES}/{number:012}")
        if self._fs.exists(target) or not self._fs.rename(self._at(draft), target):
            raise OSError(f"could not write {target}; is there another writer?")
        self._forget(numbers)

    def _forget(self, before: Sequence[int]) -> None:
        """Drops what only places older than those before the newest hold: what one replacement replaced."""
        if len(before) < 2:
            return
        held = self.places().unionByName(self.places(before[-1]))
        for number in before[:-1]:
            old = self.places(number)
            same = [old[c].eqNullSafe(held[c]) for c in PLACES.names]
            for r in old.join(held, same, "left_anti").collect():
                place = self._at(f"{self.path}/" + "/".join(f"{c}={_shown(r[c])}" for c in PLACES.names))
                self._fs.delete(place, True)
                for _ in PARTITIONS:  # and what is left empty above it
                    place = place.getParent()
                    if self._fs.exists(place) and not self._fs.listStatus(place):
                        self._fs.delete(place, False)
            self._fs.delete(self._at(f"{self.path}/{_PLACES}/{number:012}"), True)

    def recover(self) -> None:
        """Removes versions that a lost writer left and no table of places names. Readers need no
        recovery; call it while nothing writes."""
        held = {r.version for n in self._numbers() for r in self.places(n).select("version").distinct().collect()}
        for status in self._fs.globStatus(self._at(f"{self.path}/version=*")) or []:
            if status.getPath().getName().removeprefix("version=") not in held:
                self._fs.delete(status.getPath(), True)
        for status in self._fs.globStatus(self._at(f"{self.path}/{_PLACES}/.*")) or []:
            if not status.getPath().getName().endswith(".crc"):
                self._fs.delete(status.getPath(), True)


def _undeleted(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.lit(None).cast("int") for c in ("deleted_by", "inserted_by")})


def _by_import(bins) -> dict[int, int]:
    """Counts per import from a histogram: at most one value per import of the run."""
    out: dict[int, int] = {}
    for x, y in bins or ():
        out[int(x)] = out.get(int(x), 0) + int(y)
    return out


def _shown(value) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


def _month(d: dt.date) -> int:
    return d.year * 100 + d.month


def _months(scope: Scope) -> tuple[int, int]:
    first = 0 if scope.mode == HEAD else _month(scope.date_from)
    last = 999912 if scope.mode == TAIL else _month(scope.date_until)
    return first, last
