"""The run log: one row per step, import and run."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import SparkSession

from chronoweave.model import RUN_LOG, local_table
from chronoweave.plans.config import to_json

SUCCEEDED, WARNING, FAILED, DEBUG = "Succeeded", "Warning", "Failed", "Debug"


class RunLog:
    """Collects the rows of one session and appends them to `path`."""

    def __init__(self, spark: SparkSession, session: str, path: str | None = None):
        self.spark, self.session, self.path = spark, session, path
        self.rows: list[dict] = []
        self._pending: list[dict] = []

    def add(
        self,
        category: str,
        step: str,
        result: str = SUCCEEDED,
        *,
        site: int | None = None,
        object: str = "",
        object_sub: str = "",
        object_id: int | None = None,
        data: str | dict = "",
        duration: float | None = None,
        value: int | None = None,
    ) -> None:
        row = {
            "logged": dt.datetime.now(dt.timezone.utc),
            "category": category,
            "session": self.session,
            "site": site,
            "object": object,
            "object_sub": object_sub,
            "object_id": object_id,
            "step": step,
            "data": data if isinstance(data, str) else to_json(data),
            "result": result,
            "duration": None if duration is None else round(duration, 3),
            "value": value,
        }
        self.rows.append(row)
        self._pending.append(row)

    def flush(self) -> None:
        """Appends what came since the last flush."""
        if self.path and self._pending:
            local_table(self.spark, self._pending, RUN_LOG).coalesce(1).write.mode(
                "append"
            ).parquet(self.path)
        self._pending = []


class Timer:
    def __init__(self):
        self._start = time.monotonic()

    def seconds(self) -> float:
        return time.monotonic() - self._start
