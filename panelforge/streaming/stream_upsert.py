"""Incremental bronze load as a Structured Streaming query.

Landing files are read with a file source; every micro-batch is upserted
into the bronze table with ``foreachBatch``.  The upsert is idempotent on
the key, so a batch replayed after a failure (same ``batch_id``) leaves the
table unchanged.  A lookback load lands rows again that an earlier file holds;
when both files fall into one micro-batch, the row of the newest file counts
(later modification time, then larger path).  A key twice in one file stays an
error.  ``availableNow`` processes what has landed and stops, the
way a scheduled job runs; the checkpoint location (in the shared checkpoint
folder unless given) remembers which files were done.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import DEFAULT_UPDATE, read_table, upsert_table, with_own_group
from ..session import scratch_path


def newest_file(batch: DataFrame, keys: Sequence[str], file_col: str = "_pf_file") -> DataFrame:
    """Per key the rows of its newest file; rows with a NULL key part all stay."""
    newest = F.max(file_col).over(Window.partitionBy(*keys, "_pf_own"))
    return with_own_group(batch, keys).withColumn("_pf_newest", newest).where(
        F.col(file_col) == F.col("_pf_newest")).drop("_pf_newest", "_pf_own")


def stream_upsert(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                  keys: Sequence[str], update_cols: Sequence[str] | None = DEFAULT_UPDATE,
                  fmt: str = "parquet", batch_ts: str | None = None,
                  checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                  partition_col: str = "SEASON") -> DataFrame:
    """Run the stream to completion and return the target table."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(landing).withColumn("_pf_file", F.struct(
        F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")))
    if batch_ts is not None:
        src = src.withColumn("INGESTED_AT", F.lit(batch_ts))
    cols = [f.name for f in schema.fields if f.name != "INGESTED_AT"] + (
        ["INGESTED_AT"] if batch_ts is not None or "INGESTED_AT" in schema.fieldNames() else [])

    def merge(batch: DataFrame, batch_id: int) -> None:
        # the micro-batch's own session; replaying a batch_id is harmless
        upsert_table(batch.sparkSession, target, newest_file(batch, keys).select(*cols), keys,
                     update_cols, partition_col)

    q = (src.writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_table(spark, target).select(*cols)
