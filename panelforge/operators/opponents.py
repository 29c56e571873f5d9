"""Group averages and per-partition dense ranks.

Aggregation is a partial + final hash aggregate, so a hot group key is
combined map-side before the shuffle.  The ranks then run over the
*aggregated* table (one row per group), whose size is the number of distinct
groups, not the number of log rows; where that is large, too, positions of a
range sort give the ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import checked_broadcast
from .positions import materialize, with_position


def group_averages(df: DataFrame, group_cols: Sequence[tuple[str, str]],
                   metrics: Sequence[tuple[str, str]],
                   drop_null_groups: bool = False) -> DataFrame:
    """``SELECT g AS alias, ..., avg(m) AS out ... GROUP BY g, ...``.

    ``group_cols``: (input column, output name); ``metrics``: (output name,
    input column).  With ``drop_null_groups`` rows with a NULL in any group
    column are removed first (pandas ``groupby`` default).
    """
    if drop_null_groups:
        cond = F.lit(True)
        for c, _ in group_cols:
            cond = cond & F.col(c).isNotNull()
        df = df.where(cond)
    return (df.groupBy(*[F.col(c).alias(a) for c, a in group_cols])
            .agg(*[F.avg(c).alias(o) for o, c in metrics]))


#: Rows that one task may rank; above, ranks come from a range sort.
WINDOW_ROWS = 500_000


def dense_ranks(df: DataFrame, partition_by: Sequence[str],
                ranks: Sequence[tuple[str, str]], null_rank: str = "last",
                rank_type: str = "long", window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Add ``dense_rank() OVER (PARTITION BY p ORDER BY x ASC NULLS LAST)``.

    ``null_rank="last"``: a NULL value takes the place after all values (SQL);
    ``null_rank="null"``: a NULL value gets a NULL rank (pandas ``rank``).
    ``ranks``: (output name, input column).  ``df`` is written once and its rows
    are counted there: a table of at most ``window_rows`` rows is ranked by
    Spark's window, a larger one by :func:`ranks_by_position`; the rows are the same.
    """
    if null_rank not in ("last", "null"):
        raise ValueError(f"unknown null_rank {null_rank!r}")
    df = materialize(df, "rank-input")
    if df.count() > window_rows:
        for out, c in ranks:
            df = ranks_by_position(df, partition_by, out, c, null_rank, rank_type)
        return df
    cols = []
    for out, c in ranks:
        w = Window.partitionBy(*partition_by).orderBy(F.col(c).asc_nulls_last())
        r = F.dense_rank().over(w)
        if null_rank == "null":
            r = F.when(F.col(c).isNotNull(), r)
        cols.append(r.cast(rank_type).alias(out))
    return df.select("*", *cols)


def ranks_by_position(df: DataFrame, partition_by: Sequence[str], out: str, col: str,
                      null_rank: str = "last", rank_type: str = "long") -> DataFrame:
    """A dense rank without a task that holds a whole partition: the distinct
    (partition, value) pairs get dense positions from a range sort, whose tasks
    may share a partition, and a value's rank is its distance from the
    partition's first position.  A partition's first position and number of
    values are one row each; a big side's hot partition is split by AQE."""
    keys = list(partition_by)
    values = df.where(F.col(col).isNotNull()).select(*keys, col).distinct()
    placed = with_position(values, [*keys, col], "_pf_p")
    starts, fits = checked_broadcast(placed.groupBy(*[F.col(c).alias(f"_s_{c}") for c in keys]).agg(
        F.min("_pf_p").alias("_pf_start"), F.count(F.lit(1)).alias("_pf_n")))
    side = F.broadcast(starts) if fits else starts

    def of_partition(frame):
        on = F.lit(True)
        for c in keys:
            on = on & frame[c].eqNullSafe(starts[f"_s_{c}"])
        return frame.join(side, on, "left").drop(*[f"_s_{c}" for c in keys])

    ranked = of_partition(placed).select(
        *[F.col(c).alias(f"_r_{c}") for c in keys], F.col(col).alias("_r_value"),
        (F.col("_pf_p") - F.col("_pf_start") + 1).alias("_pf_rank"))
    on = F.col(col) == F.col("_r_value")
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    joined = of_partition(df).join(ranked, on, "left")
    last = F.coalesce(F.col("_pf_n"), F.lit(0)) + 1 if null_rank == "last" else F.lit(None)
    rank = F.when(F.col(col).isNull(), last).otherwise(F.col("_pf_rank"))
    return joined.select(*[F.col(c) for c in df.columns], rank.cast(rank_type).alias(out))


# --- warehouse lineage (lower-case names) ----------------------------------

W_ALLOWED = [("opp_pts_allowed", "pts"), ("opp_reb_allowed", "reb"),
             ("opp_ast_allowed", "ast")]
W_RANKS = [("opp_pts_allowed_rank", "opp_pts_allowed"),
           ("opp_reb_allowed_rank", "opp_reb_allowed"),
           ("opp_ast_allowed_rank", "opp_ast_allowed")]


def opponent_allowed(silver: DataFrame, season_col: str = "season",
                     opponent_col: str = "opponent_team") -> DataFrame:
    """Average points/rebounds/assists allowed per (season, opponent).
    NULL and '' opponents are groups of their own."""
    return group_averages(silver, [(season_col, "season"), (opponent_col, "team")],
                          W_ALLOWED)


def opponent_ranks(allowed: DataFrame) -> DataFrame:
    """Dense ranks per season, 1 = lowest average allowed; bigint."""
    return dense_ranks(allowed, ["season"], W_RANKS, null_rank="last",
                       rank_type="long")


# --- older local lineage (upper-case names) --------------------------------

L_ALLOWED = [("OPP_PTS_ALLOWED", "PTS"), ("OPP_REB_ALLOWED", "REB"),
             ("OPP_AST_ALLOWED", "AST")]
L_RANKS = [("OPP_PTS_ALLOWED_RANK", "OPP_PTS_ALLOWED"),
           ("OPP_REB_ALLOWED_RANK", "OPP_REB_ALLOWED"),
           ("OPP_AST_ALLOWED_RANK", "OPP_AST_ALLOWED")]


def opponent_defense(df: DataFrame) -> DataFrame:
    """Per (SEASON, OPPONENT_TEAM) averages with NULL groups dropped, and
    dense ranks as double (NULL average -> NULL rank)."""
    allowed = group_averages(df, [("SEASON", "SEASON"), ("OPPONENT_TEAM", "OPPONENT_TEAM")],
                             L_ALLOWED, drop_null_groups=True)
    return dense_ranks(allowed, ["SEASON"], L_RANKS, null_rank="null",
                       rank_type="double")
