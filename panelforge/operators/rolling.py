"""Row-frame window features per entity: trailing means and next values.

Semantics (both strategies):

* ``mean``: ``avg(x) OVER (PARTITION BY entity ORDER BY order
  ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW)``; NULLs skipped, NULL when the
  frame holds no value (same as a pandas rolling mean with ``min_periods=1``).
* ``lead``: ``lead(x, k) OVER (PARTITION BY entity ORDER BY order)``.

Order columns sort ascending with NULLS LAST; end the order with a unique
column so ties are resolved the same way everywhere.

Strategies:

``"positions"`` (default): rows get a dense position in the total
order (entity, order) from :func:`with_position` (range-partitioned, so a hot
entity spreads over many tasks; written once to the shared folder).  The
positions are cut into blocks of at most ``BLOCK_ROWS`` rows; each block
also receives a small halo (the previous block's last n-1 rows, the next
block's first k rows), and the Window runs per (entity, block).  Every
window buffer is bounded by the block size, a hot entity is spread over its
blocks, and results are exact because each row's frame lies within its
block plus halo.

``"window"``: Spark's Window operator.  One shuffle on the entity, but an
entity's whole history is sorted and buffered by one task; choose it only where
the size of every entity is known to be small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .positions import with_position

POS = "_pf_pos"
STRATEGIES = ("positions", "window")


def _order_cols(partition_by, order_by):
    return [F.col(c).asc_nulls_last() for c in list(partition_by) + list(order_by)]


def rolling_features(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                     means: Sequence[tuple[str, str, int]] = (),
                     leads: Sequence[tuple[str, str, int]] = (),
                     strategy: str = "positions",
                     num_partitions: int | None = None) -> DataFrame:
    """Add trailing means and lead values.

    ``means``: (output, input column, frame length n); ``leads``:
    (output, input column, offset k >= 1).
    """
    partition_by, order_by = list(partition_by), list(order_by)
    for _, _, n in means:
        if n < 1:
            raise ValueError("frame length must be >= 1")
    for _, _, k in leads:
        if k < 1:
            raise ValueError("lead offset must be >= 1")
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "window":
        return _with_window(df, partition_by, order_by, means, leads)
    return _with_positions(df, partition_by, order_by, means, leads, num_partitions)


def _with_window(df, partition_by, order_by, means, leads):
    w = Window.partitionBy(*partition_by).orderBy(
        *[F.col(c).asc_nulls_last() for c in order_by])
    cols = []
    for out, c, n in means:
        cols.append(F.avg(c).over(w.rowsBetween(-(n - 1), 0)).alias(out))
    for out, c, k in leads:
        cols.append(F.lead(c, k).over(w).alias(out))
    return df.select("*", *cols)


def _with_positions(df, partition_by, order_by, means, leads, num_partitions):
    positioned = position_rows(df, partition_by, order_by, num_partitions)
    return rolling_over_positions(positioned, partition_by, means, leads)


def position_rows(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                  num_partitions: int | None = None) -> DataFrame:
    """Materialise ``df`` with a dense position in (partition_by, order_by)
    order (column ``POS``).  Callers that need other aggregates of the same
    rows should compute them from this frame: it is a scan of a written
    table, so the upstream plan runs once."""
    return with_position(df, _order_cols(partition_by, order_by), POS, num_partitions)


# Rows per block of the positions plan: the most a single window buffer
# holds (plus the halo), whatever the size of an entity.
BLOCK_ROWS = 1_000_000


def rolling_over_positions(positioned: DataFrame, partition_by: Sequence[str],
                           means: Sequence[tuple[str, str, int]] = (),
                           leads: Sequence[tuple[str, str, int]] = (),
                           keep_pos: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Trailing means / leads over rows carrying ``POS`` from
    :func:`position_rows`.

    Positions are cut into blocks of ``block_rows``.  A block also receives
    a halo: copies of the last ``n-1`` rows of the block before it (history
    for its first rows) and of the first ``k`` rows of the block after it
    (for ``lead``).  The Window then runs per (entity, block) ordered by
    position, and only each block's own rows are kept.  Every window buffer
    holds at most ``block_rows`` plus the halo, a hot entity is spread over
    its blocks, and the payload is shuffled once (no join back)."""
    partition_by = list(partition_by)
    back = max([n - 1 for _, _, n in means] + [0])
    fwd = max([k for _, _, k in leads] + [0])
    if block_rows <= max(back, fwd):
        raise ValueError("block_rows must exceed the frame length and lead offset")
    pos = F.col(POS)
    blk = F.floor(pos / F.lit(block_rows))
    off = pos - blk * F.lit(block_rows)
    # (target block, own row?) for each copy: own block always; halo copies
    # only for rows at the block edges
    tags = F.array(
        F.struct(blk.alias("b"), F.lit(True).alias("own")),
        F.when(off >= F.lit(block_rows - back),
               F.struct((blk + 1).alias("b"), F.lit(False).alias("own"))),
        F.when(off < F.lit(fwd),
               F.struct((blk - 1).alias("b"), F.lit(False).alias("own"))))
    copies = (positioned
              .select("*", F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("_pf_tag"))
              .select("*", F.col("_pf_tag.b").alias("_pf_blk"), F.col("_pf_tag.own").alias("_pf_own"))
              .drop("_pf_tag"))
    w = Window.partitionBy(*partition_by, "_pf_blk").orderBy(POS)
    cols = []
    for out, c, n in means:
        cols.append(F.avg(c).over(w.rowsBetween(-(n - 1), 0)).alias(out))
    for out, c, k in leads:
        cols.append(F.lead(c, k).over(w).alias(out))
    out = copies.select("*", *cols).where(F.col("_pf_own")).drop("_pf_blk", "_pf_own")
    return out if keep_pos else out.drop(POS)
