"""Dense row positions in a total order, without a single-task window.

``row_number() OVER (ORDER BY ...)`` without a partition runs in one task,
and ``row_number() OVER (PARTITION BY entity ...)`` puts a hot entity (say a
third of all rows) into one task.  Instead:

1. range-partition on the full order key.  Range bounds are sampled over the
   whole composite key, so one hot entity is split over many partitions;
2. sort within each partition and tag rows with (partition id, local index)
   via ``monotonically_increasing_id``;
3. write the tagged rows once to a Parquet table in the shared checkpoint
   folder.  This cuts the lineage (no recomputation of the sort after an
   executor loss, and every later use - the offsets below, the callers'
   several branches - scans the same files with its own column pruning
   instead of re-running the range shuffle);
4. count rows per partition (one row per partition), turn the counts into
   offsets with a running sum over that tiny table, broadcast it (its size is
   the partition count, a proven bound) and add the offset.

The order must be total (end it with unique key columns) so the sort inside
each partition is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

PID = "_pf_pid"
MID = "_pf_mid"
OFF = "_pf_off"


def _sort_col(c, nulls_last: bool = True) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc_nulls_first()


def materialize(df: DataFrame, name: str = "stage", **options) -> DataFrame:
    """Write ``df`` to a fresh Parquet folder in the shared checkpoint
    location and return a scan of it (a lineage cut that survives executor
    loss).  ``options``: of the Parquet writer."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.parquet(path)


def with_position(df: DataFrame, order, pos_col: str = "_pos",
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``pos_col``: 0-based dense position of each row in ``order``.

    ``order`` is a list of column names (ascending, NULLS LAST) or sort
    Columns.  Rows of one entity are contiguous when the entity leads the
    order.  Runs one write job (the range sort); the result scans it.
    """
    keys = [_sort_col(c) for c in order]
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    tagged = materialize(
        ranged.sortWithinPartitions(*keys).select(
            "*", F.spark_partition_id().alias(PID),
            F.monotonically_increasing_id().alias(MID)),
        "positions")
    sizes = tagged.groupBy(PID).agg(F.count(F.lit(1)).alias("_pf_n"))
    # The window below runs over one row per partition (bounded by the
    # partition count), so its single task is small by construction.
    offsets = sizes.select(
        PID, (F.sum("_pf_n").over(Window.orderBy(PID)) - F.col("_pf_n")).alias(OFF))
    local_index = F.col(MID) - F.shiftleft(F.col(PID).cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), PID)
            .withColumn(pos_col, F.col(OFF) + local_index)
            .drop(PID, MID, OFF))
