"""Datasets behind the dashboard and the plots (drawing itself is not built)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.upsert import read_table
from ..schemas import RECENT_GAME_COLS


def player_list(features: DataFrame, name_col: str = "player_name") -> DataFrame:
    """Distinct entity names, ordered (NULL last)."""
    return features.select(name_col).distinct().orderBy(F.col(name_col).asc_nulls_last())


def recent_games(features: DataFrame, player: str, n: int = 50,
                 name_col: str = "player_name", cols=RECENT_GAME_COLS) -> DataFrame:
    """Last ``n`` games of one player, newest first (missing dates first, as
    a descending SQL sort puts them); game_id breaks date ties.  The name is
    bound as a literal parameter, never spliced into SQL text."""
    return (features.where(F.col(name_col) == F.lit(player))
            .orderBy(F.col("game_date").desc_nulls_first(), F.col("game_id").desc_nulls_last())
            .limit(n).select(*cols))


def recent_games_from_silver(silver: DataFrame, player: str, n: int = 50,
                             strategy: str = "positions") -> DataFrame:
    """Recent games computed from silver for one player: the name is
    resolved to player ids first, so only those players' windows are
    computed (the ranks still cover all rows)."""
    from .features import player_features
    ids = silver.where(F.col("player_name") == F.lit(player)).select("player_id")
    return recent_games(player_features(silver, strategy, only_players=ids), player, n)


def recent_games_from_table(spark, gold_path: str, player: str, n: int = 50) -> DataFrame:
    """Recent games read from the stored gold table: the name filter is pushed
    to the Parquet scan (row groups outside the name's min/max range are skipped)."""
    return recent_games(read_table(spark, gold_path), player, n)


def recent_games_sql(spark, table: str, player: str, n: int = 50) -> DataFrame:
    """Same report through Spark SQL with a bound named parameter."""
    cols = ", ".join(RECENT_GAME_COLS)
    return spark.sql(
        f"SELECT {cols} FROM {table} WHERE player_name = :p "
        f"ORDER BY game_date DESC NULLS FIRST, game_id DESC LIMIT {int(n)}",
        args={"p": player})


# The four series of the trend chart.
TREND_SERIES = ["pts", "pts_last3", "minutes", "min_last3"]


def trend_series(recent: DataFrame, series=TREND_SERIES) -> DataFrame:
    """Long form (game_date, series, value) of the recent games, ascending by
    date, for a line chart."""
    return (recent.select("game_date", *series)
            .unpivot("game_date", list(series), "series", "value")
            .orderBy(F.col("game_date").asc_nulls_last(), "series"))


def recent_runs(run_log: DataFrame, n: int = 20) -> DataFrame:
    """Newest ``n`` run-log rows (missing times first, as in a descending SQL
    sort), run_id descending as the tie-breaker."""
    return (run_log.orderBy(F.col("executed_at").desc_nulls_first(),
                            F.col("run_id").desc_nulls_last())
            .limit(n)
            .select(F.col("run_id").cast("string").alias("run_id"), "layer", "rows_processed",
                    "status", "runtime_seconds", "error_message", "executed_at"))
