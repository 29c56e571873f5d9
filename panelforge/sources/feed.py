"""The raw feed as a Spark data source: landing files of seasons, read with
retries, whose failures are rows instead of exceptions.

``spark.read.format("landing_feed")`` gives a task per file.  A task opens its
file with bounded retries and exponential back-off; when it cannot be read to
its end, also because of a broken page deep inside, the task gives a row that
says so.  A season counts as loaded when all of its files were.  The date bounds
of a lookback load are options of the reader, which skips row groups outside them.
"""

from __future__ import annotations

import json
import random
import sys
import time
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Executors need not have this package installed: its classes travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Attempts per file, and seconds before the second one (doubled each time, and up to one more).
ATTEMPTS, BASE_SLEEP = 4, 2.0
SEASON, ERROR, TRIES = "SEASON", "_error", "_attempts"


@dataclass
class FeedFile(InputPartition):
    season: str
    path: str | None  # None: the season has no folder

    def __init__(self, season, path):
        self.season, self.path = season, path


def attempt(read, attempts: int = ATTEMPTS, base_sleep: float = BASE_SLEEP, sleep=time.sleep):
    """(result, attempts made, last error): calls ``read`` until it succeeds."""
    error = None
    for k in range(1, attempts + 1):
        try:
            return read(), k, None
        except Exception as e:  # noqa: BLE001 - any failure counts as one
            error = e
            if k < attempts:
                sleep(base_sleep * 2 ** (k - 1) + random.uniform(0, min(1.0, base_sleep)))
    return None, attempts, error


class LandingFeed(DataSource):
    """Options: ``path`` (root of ``SEASON=...`` folders), ``seasons`` (JSON list),
    ``columns`` (schema of the files as JSON), ``from`` and ``to`` (ISO dates, both
    included) on ``date_col``, ``attempts``, ``base_sleep``."""

    @classmethod
    def name(cls):
        return "landing_feed"

    def schema(self):
        columns = T.StructType.fromJson(json.loads(self.options["columns"]))
        return T.StructType([*columns.fields, T.StructField(SEASON, T.StringType()),
                             T.StructField(TRIES, T.IntegerType()), T.StructField(ERROR, T.StringType())])

    def reader(self, schema):
        return LandingFeedReader(dict(self.options), schema)


class LandingFeedReader(DataSourceReader):
    def __init__(self, options, schema):
        self.options, self.wanted = options, schema

    def _fs(self, path):
        from pyarrow import fs
        return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)

    def partitions(self):
        from pyarrow import fs
        out = []
        for season in json.loads(self.options["seasons"]):
            system, folder = self._fs(f"{self.options['path'].rstrip('/')}/{SEASON}={season}")
            found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            files = [f.path for f in found if f.is_file and not f.base_name.startswith(("_", "."))]
            out += [FeedFile(season, f) for f in sorted(files)] or [FeedFile(season, None)]
        return out

    def _opened(self, path):
        """Batches of the file; its first one is read already."""
        import pyarrow.dataset as ds
        system, _ = self._fs(self.options["path"])
        date_col, low, high = self.options.get("date_col", "GAME_DATE"), self.options.get("from"), self.options.get("to")
        table = ds.dataset(path, filesystem=system, format="parquet")
        condition = None
        if low is not None:
            condition = ds.field(date_col) >= low
        if high is not None:  # a time may follow the date in the text
            below = ds.field(date_col) < high + "~"
            condition = below if condition is None else condition & below
        columns = [f.name for f in self.wanted.fields if f.name in table.schema.names]
        batches = iter(table.scanner(columns=columns, filter=condition).to_batches())
        return next(batches, None), batches

    def _batch(self, rows, season, tries, error=None):
        n = 1 if error is not None else rows.num_rows
        types = {T.StringType: pa.string(), T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64()}
        arrays = []
        for f in self.wanted.fields:
            kind = types[type(f.dataType)]
            if f.name == SEASON:
                arrays.append(pa.array([season] * n, kind))
            elif f.name == TRIES:
                arrays.append(pa.array([tries] * n, kind))
            elif f.name == ERROR:
                arrays.append(pa.array([error] * n, kind))
            elif rows is not None and error is None and f.name in rows.schema.names:
                arrays.append(rows.column(f.name).cast(kind))
            else:
                arrays.append(pa.nulls(n, kind))
        return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in self.wanted.fields])

    def read(self, partition):
        if partition.path is None:
            yield self._batch(None, partition.season, 1, "no files")
            return
        opened, tries, error = attempt(lambda: self._opened(partition.path), int(self.options.get("attempts", ATTEMPTS)),
                                       float(self.options.get("base_sleep", BASE_SLEEP)))
        if error is None:
            first, rest = opened
            try:
                while first is not None:
                    yield self._batch(first, partition.season, tries)
                    first = next(rest, None)
            except Exception as e:  # noqa: BLE001 - rows are out, so no retry: the season fails
                error = e
        if error is not None:
            yield self._batch(None, partition.season, tries, f"{type(error).__name__}: {error}"[:2000])


def read_feed(spark: SparkSession, root: str, seasons: Sequence[str], schema: T.StructType, first: str | None = None,
              last: str | None = None, attempts: int = ATTEMPTS, base_sleep: float = BASE_SLEEP) -> DataFrame:
    """The feed's rows and failures: the files' columns, ``SEASON``, ``_attempts``,
    ``_error``.  Columns are text, whole numbers or doubles.  One that a file lacks
    is NULL; a text date is compared as text, so it must be ISO."""
    spark.dataSource.register(LandingFeed)
    r = spark.read.format("landing_feed").options(
        path=root, seasons=json.dumps(list(seasons)), columns=schema.json(), attempts=str(attempts), base_sleep=str(base_sleep))
    for name, value in (("from", first), ("to", last)):
        if value is not None:
            r = r.option(name, value)
    return r.load()


def feed_load(spark: SparkSession, root: str, seasons: Sequence[str], schema: T.StructType, batch_ts: str | None = None,
              first: str | None = None, last: str | None = None, attempts: int = ATTEMPTS, base_sleep: float = BASE_SLEEP):
    """A :class:`~panelforge.sources.ingest.LoadResult` of one reading of the feed,
    which is stored: the rows of the seasons all of whose files were read to their end."""
    from ..operators.positions import materialize
    from .ingest import LoadResult
    got = materialize(read_feed(spark, root, seasons, schema, first, last, attempts, base_sleep), "feed")
    errors = {r[SEASON]: r[ERROR] for r in got.where(F.col(ERROR).isNotNull()).groupBy(SEASON).agg(
        F.min(ERROR).alias(ERROR)).collect()}  # a row per failed season
    res = LoadResult(None, [s for s in seasons if s not in errors], [s for s in seasons if s in errors], errors)
    if res.loaded:
        frame = got.where(F.col(ERROR).isNull()).drop(ERROR, TRIES)
        if errors:
            frame = frame.where(~F.col(SEASON).isin(list(errors)))
        res.frame = frame if batch_ts is None else frame.withColumn("INGESTED_AT", F.lit(batch_ts))
    return res
