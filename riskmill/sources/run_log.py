"""What ran when, and how it ended: a table with one row per start and end of a job."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "run string, job string, state string, at timestamp, seconds double, message string"


class RunLog:
    """Runs of jobs, kept as Parquet in ``path``. Each entry is a file of its own, added and never changed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(ENTRY).parquet(self.path)
        except Exception as error:  # noqa: BLE001 - only a missing log is answered
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], ENTRY)

    def _add(self, run: str, job: str, state: str, seconds: float | None = None, message: str | None = None) -> None:
        row = (run, job, state, datetime.now(timezone.utc), seconds, message)
        self.spark.createDataFrame([row], ENTRY).coalesce(1).write.mode("append").parquet(self.path)

    def last_states(self) -> DataFrame:
        """job, state, at of the newest entry of each job."""
        newest = self.entries().groupBy("job").agg(F.max_by(F.struct("state", "at"), "at").alias("e"))
        return newest.select("job", "e.state", "e.at")

    def require_success(self, jobs: Sequence[str]) -> None:
        """Error unless the last run of each of these jobs has succeeded."""
        states = {r["job"]: r["state"] for r in self.last_states().filter(F.col("job").isin(*jobs)).collect()}
        for job in jobs:
            if states.get(job) != "success":
                raise RuntimeError(f"the last run of {job} is {states.get(job, 'missing')}")

    @contextmanager
    def run(self, job: str, after: Sequence[str] = ()) -> Iterator[None]:
        """Log the start and end of a job; it does not start unless the last runs of ``after`` have succeeded."""
        if after:
            self.require_success(after)
        run, start = uuid.uuid4().hex, time.monotonic()
        self._add(run, job, "running")
        try:
            yield
        except BaseException as error:
            self._add(run, job, "failed", time.monotonic() - start, str(error)[:500])
            raise
        self._add(run, job, "success", time.monotonic() - start)
