"""Raw-log sources: per-season landing files, multi-season unions, the
lookback window, failure-isolated loads and file round trips.

Landing layout: ``<root>/SEASON=<season>/part-*.{parquet,csv,json}`` - one
folder per season, the way a scheduled fetch would drop them.  Reading with
an explicit schema keeps ids such as ``0022400001`` as text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: default lookback of the incremental load, in days.
LOOKBACK_DAYS = 14
# Options of the package's own CSV sink and source.
CSV_OPTIONS = {"header": True, "nullValue": "\\N"}


def _reader(spark: SparkSession, fmt: str, schema: T.StructType | None):
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    return r


def write_landing(df: DataFrame, root: str, season_col: str = "SEASON", fmt: str = "parquet",
                  drop_cols: Sequence[str] = ("INGESTED_AT",), mode: str = "overwrite") -> str:
    """Drop a raw batch as one folder per season (the feed has no SEASON or
    INGESTED_AT column; they are added at ingestion)."""
    w = df.drop(*drop_cols).write.mode(mode).option(
        "partitionOverwriteMode", "static").partitionBy(season_col).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(root)
    return root


def read_season(spark: SparkSession, root: str, season: str, schema: T.StructType | None = None,
                fmt: str = "parquet", batch_ts: str | None = None,
                season_col: str = "SEASON") -> DataFrame:
    """One season's rows tagged with ``SEASON`` and (optionally) one
    ``INGESTED_AT`` instant for the whole batch, fixed on the driver."""
    df = _reader(spark, fmt, schema).load(f"{root.rstrip('/')}/{season_col}={season}")
    df = df.withColumn(season_col, F.lit(season))
    if batch_ts is not None:
        df = df.withColumn("INGESTED_AT", F.lit(batch_ts))
    return df


def read_seasons(spark: SparkSession, root: str, seasons: Sequence[str],
                 schema: T.StructType | None = None, fmt: str = "parquet",
                 batch_ts: str | None = None, season_col: str = "SEASON") -> DataFrame:
    """Several seasons in one scan; the season folder is a partition column,
    so the season filter prunes folders instead of reading them."""
    s = schema
    if s is not None and season_col not in s.fieldNames():
        s = T.StructType(list(s.fields) + [T.StructField(season_col, T.StringType())])
    r = _reader(spark, fmt, s).option("basePath", root)
    df = r.load(root).where(F.col(season_col).isin(list(seasons)))
    if batch_ts is not None:
        df = df.withColumn("INGESTED_AT", F.lit(batch_ts))
    return df


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Append frames by column name; a column missing from a frame is NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def incremental(df: DataFrame, as_of: str, lookback_days: int = LOOKBACK_DAYS,
                full_refresh: bool = False, date_col: str = "GAME_DATE") -> DataFrame:
    """Rows dated in [as_of - lookback_days, as_of] (both ends included), or
    all rows on a full refresh.  ``as_of`` is an argument, not today's date, so
    reruns are reproducible.  A text column holds ISO dates (a time may follow);
    bounds on the text itself reach the scan, which skips files and row groups
    outside them, and the parsed date decides."""
    if full_refresh:
        return df
    last = dt.date.fromisoformat(as_of)
    first = last - dt.timedelta(days=lookback_days)
    c = F.col(date_col)
    if isinstance(df.schema[date_col].dataType, T.StringType):
        next_day = (last + dt.timedelta(days=1)).isoformat()
        df = df.where((c >= first.isoformat()) & (c < next_day))
    return df.where(F.to_date(c).between(F.lit(first), F.lit(last)))


@dataclass
class LoadResult:
    frame: DataFrame | None
    loaded: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    errors: dict = field(default_factory=dict)


def isolated_load(spark: SparkSession, root: str, seasons: Sequence[str],
                  schema: T.StructType | None = None, fmt: str = "parquet",
                  batch_ts: str | None = None) -> LoadResult:
    """Read each season on its own; a season that cannot be read (missing
    folder, unreadable files, schema mismatch) is recorded as failed and the
    others proceed.  The check per season counts its rows, which for Parquet
    opens every file's footer and no data, and decodes one row."""
    frames, res = [], LoadResult(None)
    for s in seasons:
        try:
            df = read_season(spark, root, s, schema, fmt, batch_ts)
            df.count()
            df.limit(1).collect()
            frames.append(df)
            res.loaded.append(s)
        except Exception as e:  # noqa: BLE001 - any read failure isolates the season
            res.failed.append(s)
            res.errors[s] = str(e)[:2000]
    res.frame = union_by_name(frames) if frames else None
    return res


def bronze_status(requested: Sequence[str], failed: Sequence[str]) -> tuple[str, str | None]:
    """(status, message) of a bronze run: all seasons failed -> 'warning';
    some -> 'partial'; none -> 'success'."""
    if requested and len(failed) >= len(requested):
        return "warning", f"no season could be read: {', '.join(failed)}"
    if failed:
        return "partial", f"unreadable seasons: {', '.join(failed)}"
    return "success", None


def roundtrip(df: DataFrame, path: str, fmt: str = "parquet",
              schema: T.StructType | None = None) -> DataFrame:
    """Write with replace semantics and read back (CSV with header and an
    explicit schema: inference would strip leading zeros from ids)."""
    spark = df.sparkSession
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt)
    r = spark.read.format(fmt).schema(schema or df.schema)
    if fmt == "csv":
        # NULL is written as \N so it stays distinct from the empty string
        w = w.options(**CSV_OPTIONS)
        r = r.options(**CSV_OPTIONS)
    w.save(path)
    return r.load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))
