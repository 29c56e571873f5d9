"""Keyed upsert (insert new keys, update chosen columns of existing keys).

The merge is one full outer join on the key, so target and batch are each
shuffled once by key; keys are unique on both sides, so there is no hot
join key.  A batch of a checked size is broadcast instead and the target is not
shuffled at all.  A key present twice in the batch is an error (as a unique
constraint would refuse it): a window count inside the job, or, for a table's staged
batch, a count of the keys alone before the merge.  Rows with a NULL key part never match (SQL equality) and
are always inserted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import drop_path, scratch_path
from .joins import BROADCAST_BYTES, BROADCAST_ROWS, stored_bytes
from .versioned import VersionedTable

DEFAULT_UPDATE = ("INGESTED_AT",)


def _all_keys_present(keys):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (rows with a NULL key part are
    exempt).  Columns: keys..., n."""
    return (df.where(_all_keys_present(keys)).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def _duplicate_message(keys):
    return "upsert batch has a duplicate key on (" + ", ".join(keys) + ")"


def refuse_duplicates(batch: DataFrame, keys: Sequence[str]) -> None:
    """Fail now if a (non-NULL) key occurs twice in a stored ``batch``: one job
    that moves the keys only, counted before the shuffle."""
    duplicate_keys(batch, keys).select(F.raise_error(F.lit(_duplicate_message(keys)))).collect()  # no rows, or the error


def guard_unique(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job if a (non-NULL) key occurs twice in ``batch``.  A row with a
    NULL key part is a group of its own, so such rows never meet in one window."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys, "_pf_own"))
    return with_own_group(batch, keys).withColumn("_pf_kn", n).where(
        F.when(F.col("_pf_kn") > 1, F.raise_error(F.lit(_duplicate_message(keys)))).otherwise(F.lit(True))).drop("_pf_kn", "_pf_own")


def with_own_group(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_pf_own``: NULL, or a number of its own for a row with a NULL key part."""
    return batch.withColumn("_pf_own", F.when(~_all_keys_present(keys), F.monotonically_increasing_id()))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = DEFAULT_UPDATE,
           check_duplicates: bool = True, allow_missing: bool = False,
           broadcast_batch: bool = False) -> DataFrame:
    """Merged rows: target rows without a batch match unchanged; matched
    rows take ``update_cols`` from the batch (``None`` = every non-key
    column) and keep the rest; batch rows with new keys are inserted.

    Columns are matched by name; the result has the target's columns.  With
    ``allow_missing`` a column absent from the batch is NULL there.

    ``broadcast_batch`` (for a batch of a checked size) gives the same rows without a
    shuffle of the target: its rows are updated in place by a broadcast join, and
    the batch's new rows are those whose key a second scan, of the target's key
    columns only, does not find.
    """
    cols = target.columns
    missing = [c for c in cols if c not in batch.columns]
    if missing and not allow_missing:
        raise ValueError(f"batch lacks columns {missing}")
    b = batch.select(*[(F.col(c) if c in batch.columns else F.lit(None).cast(target.schema[c].dataType)).alias(c)
                       for c in cols])
    if check_duplicates:
        b = guard_unique(b, keys)
    upd = set(cols) - set(keys) if update_cols is None else set(update_cols)
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t_in"))
    new = b
    b = b.select(*[F.col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias("_b_in"))
    cond = None
    for k in keys:
        e = F.col(f"_t_{k}") == F.col(f"_b_{k}")
        cond = e if cond is None else cond & e
    if broadcast_batch:
        wanted = F.broadcast(b.select(*[f"_b_{k}" for k in keys]))
        # the target's keys are unique: at most the batch's rows
        seen = t.join(wanted, cond, "left_semi").select(*[F.col(f"_t_{k}").alias(k) for k in keys])
        new = new.join(F.broadcast(seen), list(keys), "left_anti").select(*cols)
        j = t.join(F.broadcast(b), cond, "left")
    else:
        j = t.join(b, cond, "full_outer")
    t_in, b_in = F.col("_t_in").isNotNull(), F.col("_b_in").isNotNull()
    out = []
    for c in cols:
        tc, bc = F.col(f"_t_{c}"), F.col(f"_b_{c}")
        if c in keys:
            out.append(F.when(t_in, tc).otherwise(bc).alias(c))
        elif c in upd:
            out.append(F.when(b_in, bc).otherwise(tc).alias(c))
        else:
            out.append(F.when(t_in, tc).otherwise(bc).alias(c))
    merged = j.select(*out)
    return merged.unionByName(new) if broadcast_batch else merged


def create_like(spark: SparkSession, path: str, like: DataFrame) -> bool:
    """Create an empty table at ``path`` with ``like``'s schema unless one
    exists (``CREATE TABLE IF NOT EXISTS ... AS SELECT ... WHERE 1=0``).
    Returns True when created."""
    return VersionedTable(spark, path).create(like)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The live rows of a table made by :func:`create_like` / :func:`upsert_table`
    with its recorded schema (partition folder values keep the recorded type)."""
    return VersionedTable(spark, path).read()


#: Partition values of a batch that are written into the scan as literals at most.
MAX_TOUCHED = 10_000


def touched_values(batch: DataFrame, partition_col: str) -> list | None:
    """The batch's partition values, NULL included; None beyond ``MAX_TOUCHED``."""
    values = [r[0] for r in batch.select(F.col(partition_col).cast("string")).distinct().limit(MAX_TOUCHED + 1).collect()]
    return None if len(values) > MAX_TOUCHED else values


def touched_partitions(batch: DataFrame, partition_col: str) -> Column | None:
    """A condition that selects the batch's partitions, NULL included, with
    literals, so that a scan reads only those folders.  None beyond
    ``MAX_TOUCHED`` values (then a join selects them)."""
    values = touched_values(batch, partition_col)
    if values is None:
        return None
    some = [v for v in values if v is not None]
    cond = F.col(partition_col).isin(some) if some else F.lit(False)
    return cond | F.col(partition_col).isNull() if None in values else cond


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str] | None = DEFAULT_UPDATE,
                 partition_col: str = "SEASON", check=None, keep: int = 2) -> DataFrame:
    """Upsert ``batch`` into the versioned table at ``path`` (partitioned by
    ``partition_col``, which must be one of the keys), in one commit.

    The table's columns decide: a column that the batch lacks keeps its stored
    value in matched rows and is NULL in inserted ones; a column that only the
    batch has is an error.  A batch below the bounds of ``joins`` is broadcast.  The batch is computed once, into a staging table that
    is dropped at the end.  Only the partitions the batch touches, the NULL
    partition included, are read, merged and written, as new folders beside the
    old ones; one manifest then switches all of them.  A failure before that,
    also one that ``check`` (a function of the table as it would be) raises,
    leaves the table as it was.  Reruns with the same batch give the same table,
    but for rows with a NULL key part, which are always inserted.  The newest
    ``keep`` versions stay readable."""
    if partition_col not in keys:
        raise ValueError("the partition column must be part of the key")
    table = VersionedTable(spark, path, partition_col)
    table.create(batch)
    schema = table.schema()
    extra = [c for c in batch.columns if c not in schema.names]
    if extra:
        raise ValueError(f"the table has no columns {extra}")
    update = [c for c in (batch.columns if update_cols is None else update_cols)
              if c in batch.columns and c not in keys]
    staging = scratch_path(spark, "upsert-batch")
    try:
        batch.select(*[(F.col(c) if c in batch.columns else F.lit(None).cast(schema[c].dataType)).alias(c)
                       for c in schema.names]).write.parquet(staging)
        batch = spark.read.schema(schema).parquet(staging)
        values, live = touched_values(batch, partition_col), table.manifest()["parts"]
        if values is None:
            seasons = batch.select(F.col(partition_col).alias("_pf_p")).distinct()
            target = table.read()
            old = target.join(seasons, target[partition_col].eqNullSafe(seasons["_pf_p"]), "left_semi") if live else None
        else:
            touched = [f for f in map(table.folder, values) if f in live]
            old = table.read(touched) if touched else None
        refuse_duplicates(batch, keys)
        # Without old rows the merge is the batch itself, written as it was staged.
        small = stored_bytes(batch) <= BROADCAST_BYTES and batch.count() <= BROADCAST_ROWS  # file footers only
        rows = batch if old is None else upsert(old, batch, keys, update, check_duplicates=False, broadcast_batch=small)
        table.replace(rows, check=check)
    finally:
        drop_path(spark, staging)
    table.vacuum(keep)
    return table.read()
