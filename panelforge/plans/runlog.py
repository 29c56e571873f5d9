"""Run log: one row per layer run (id, layer, rows, status, runtime, error,
time), appended to a Parquet table.  Each append is a single small file;
``compact`` rewrites the log into a few files."""

from __future__ import annotations

import contextlib
import decimal
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RUN_LOG_SCHEMA, RUN_STATUSES
from ..session import drop_path
from ..sources.ingest import path_exists


#: Fixed value: characters of an error text that the log keeps.
ERROR_CHARS = 2000


class RunLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def create(self) -> None:
        if not path_exists(self.spark, self.path):
            self.spark.createDataFrame([], RUN_LOG_SCHEMA).write.mode("overwrite").parquet(self.path)

    def append(self, run_id: str, layer: str, status: str, runtime: float | None,
               rows: int | None = None, error=None, executed_at=None) -> None:
        if status not in RUN_STATUSES:
            raise ValueError(f"status must be one of {RUN_STATUSES}")
        rt = None if runtime is None else decimal.Decimal(f"{runtime:.6f}")
        text = None if error is None else str(error)
        row = [(run_id, layer, None if rows is None else int(rows), status, rt,
                text[:ERROR_CHARS] if text else None, executed_at)]
        df = self.spark.createDataFrame(row, RUN_LOG_SCHEMA)
        if executed_at is None:
            df = df.withColumn("executed_at", F.current_timestamp())
        df.coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG_SCHEMA).parquet(self.path).dropDuplicates()

    def compact(self, files: int = 1) -> None:
        """Rewrite the log into ``files`` files.  The compacted rows are added
        before the old files go, and ``read`` drops repeated rows, so a crash in between loses and repeats nothing."""
        old = self._files()
        self.spark.read.schema(RUN_LOG_SCHEMA).parquet(*old).dropDuplicates().coalesce(files).write.mode(
            "append").parquet(self.path) if old else None
        for name in old:
            drop_path(self.spark, name)

    def _files(self) -> list[str]:
        return list(self.spark.read.schema(RUN_LOG_SCHEMA).parquet(self.path).inputFiles())


class LayerRun:
    """One run of a layer: its id, and what the log will say of it."""

    def __init__(self, run_id: str | None = None):
        self.run_id = run_id or uuid.uuid4().hex
        self.rows: int | None = None
        self.status = "success"
        self.message: str | None = None
        self._began = time.monotonic()

    @property
    def seconds(self) -> float:
        return time.monotonic() - self._began


@contextlib.contextmanager
def run_layer(log: RunLog, layer: str, run_id: str | None = None):
    """Time a layer and log its ``rows``, ``status`` and ``message``; on an
    exception log 'failure' with the error text (no rows) and re-raise."""
    run = LayerRun(run_id)
    try:
        yield run
    except Exception as e:
        log.append(run.run_id, layer, "failure", run.seconds, None, e)
        raise
    log.append(run.run_id, layer, run.status, run.seconds, run.rows, run.message)
