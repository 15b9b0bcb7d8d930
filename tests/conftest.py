import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from chronoweave.model import VALUES, as_fact_day, local_table  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def day_facts(spark):
    """(date, activity, forecast, value1[, value2[, site]]) tuples as day facts."""

    def build(rows):
        records = [
            {
                "date": dt.date.fromisoformat(r[0]),
                "activity_id": r[1],
                "forecast_id": r[2],
                "value1": r[3],
                "value2": r[4] if len(r) > 4 else None,
                "site_id": r[5] if len(r) > 5 else 1,
                "import_id": 1,
            }
            for r in rows
        ]
        ddl = (
            "date date, activity_id int, forecast_id int, value1 double, value2 double, "
            "site_id int, import_id int"
        )
        return as_fact_day(local_table(spark, records, ddl), dt.datetime(2020, 1, 1))

    return build


@pytest.fixture(scope="session")
def tuples():
    def build(df, *columns, digits=6):
        shown = [c for c in (columns or df.columns)]
        rows = df.select(*[F.col(c) for c in shown]).collect()
        return sorted(
            tuple(
                str(v) if isinstance(v, dt.date) else round(v, digits) if isinstance(v, float) else v
                for v in r
            )
            for r in rows
        )

    return build


ALL_VALUES = VALUES
