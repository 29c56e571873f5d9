"""Joins whose broadcast side has a checked size.

The small side is written once to a fresh folder of the shared scratch
location and its rows and stored bytes are measured there.  Below both bounds
the scan of that copy is broadcast; above, the join stays a shuffle join of the
same copy, whose skewed partitions AQE splits.  Nothing is cached: the side is
as fresh as the call, and nothing stays in executor memory after the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .positions import materialize

#: Bounds of a side that may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 16 * 1024 ** 2


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that a plain scan reads."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for name in df.inputFiles():
        p = jvm.org.apache.hadoop.fs.Path(name)
        total += p.getFileSystem(conf).getFileStatus(p).getLen()
    return total


def checked_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS,
                      max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """(a scan of ``small`` as written now, whether it may be broadcast)."""
    side = materialize(small, "join-side")
    if stored_bytes(side) > max_bytes:
        return side, False
    return side, side.count() <= max_rows  # the count reads file footers only


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``big.join(small, on, how)`` broadcasting ``small`` only below the bounds.

    ``on``: column names, or pairs (column of ``big``, column of ``small``)."""
    side, fits = checked_broadcast(small, max_rows, max_bytes)
    pairs = [on] if isinstance(on, tuple) else on
    if not isinstance(pairs, str) and any(isinstance(p, tuple) for p in pairs):
        cond = F.lit(True)
        for a, b in pairs:
            cond = cond & (big[a] == side[b])
        on = cond
    return big.join(F.broadcast(side) if fits else side, on, how)
