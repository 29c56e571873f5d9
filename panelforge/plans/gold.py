"""gold.player_features as a stored table that follows silver by change sets.

A new or changed row moves few values of gold: the trailing means of its player's
next rows, the target of the row before it, and its season's ranks.
:func:`refresh_gold` finds the changed rows by comparing silver's remade seasons
with the columns that gold holds of them, recomputes the windows of the players
concerned, and rewrites the seasons in which a value differs, in one commit.

Gold is partitioned by season; a season's files are range-partitioned and sorted by
(player_name, game_date, game_id), so a filter on a player skips most of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import checked_broadcast
from ..operators.opponents import opponent_allowed, opponent_ranks
from ..operators.positions import materialize
from ..operators.rolling import position_rows, rolling_over_positions
from ..operators.versioned import VersionedTable
from ..schemas import PLAYER_FEATURE_COLS
from .features import W_LEADS, W_MEANS, W_ORDER, join_ranks, player_features
from .quality import Check, observed_write

RANK_COLS = [c for c in PLAYER_FEATURE_COLS if c.endswith("_rank")]
#: What the windows give and the columns that come from silver as they are.
WINDOW_COLS = [c for c in PLAYER_FEATURE_COLS if c not in RANK_COLS]
BASE_COLS = [c for c in WINDOW_COLS if c not in [out for out, _, _ in W_MEANS + W_LEADS]]
#: Order of the rows in gold's files.
FILE_ORDER = ["season", "player_name", "game_date", "game_id"]


def row_changes(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows that one side has more often than the other, NULLs being equal:
    ``cols`` and ``change`` (copies in ``after`` less copies in ``before``)."""
    both = before.select(*cols, F.lit(-1).alias("_pf_n")).unionAll(after.select(*cols, F.lit(1).alias("_pf_n")))
    return both.groupBy(*cols).agg(F.sum("_pf_n").alias("change")).where(F.col("change") != 0)


def _in_file_order(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange(*FILE_ORDER).sortWithinPartitions(*FILE_ORDER)


def _of_players(rows: DataFrame, players: DataFrame, fits: bool, how: str) -> DataFrame:
    """Semi or anti join by player, a NULL id being a player as in the windows."""
    p = players.select(F.col("player_id").alias("_pf_player"))
    return rows.join(F.broadcast(p) if fits else p, rows["player_id"].eqNullSafe(p["_pf_player"]), how)


def refresh_gold(spark: SparkSession, silver_path: str, gold_path: str,
                 checks: Callable[[DataFrame], Sequence[Check]] | None = None) -> tuple[DataFrame, list[int] | None]:
    """Bring gold up to date with the versioned silver table; the table, and the
    values of ``checks`` where the write has measured them over all rows (a first
    build), else None.

    Gold's manifest notes from which folder of silver each season was made, so a
    run that died is made good by the next one, and an unchanged silver costs
    nothing.  A season that was remade with the same values is noted, not rewritten.
    The rows equal a full build's; changed values, removed rows and seasons, NULL
    seasons and players count too.  Besides the remade seasons, the columns of the
    windows are scanned in silver and gold for the players concerned."""
    s, g = VersionedTable(spark, silver_path, "season"), VersionedTable(spark, gold_path, "season")
    live, made, held = s.manifest()["parts"], g.manifest()["sources"], g.manifest()["parts"]
    stale = [p for p, v in live.items() if made.get(p) != v]
    gone = [p for p in made if p not in live]
    if not held:
        feats = player_features(s.read())
        g.create(feats)
        if not live:
            return g.read(), None
        # measured after the sort: the sampling for it would count its rows twice
        _, values = observed_write(_in_file_order(feats), lambda df: g.replace(df, [], live), checks(feats) if checks else [])
        return g.read(), values
    if not stale and not gone:
        return g.read(), None

    changed = materialize(row_changes(g.read(stale + gone), s.read(stale), BASE_COLS), "gold-changes")
    players, fits = checked_broadcast(changed.select("player_id").distinct())
    theirs = _of_players(s.read().select(*BASE_COLS), players, fits, "left_semi")
    rolled = materialize(rolling_over_positions(position_rows(theirs, ["player_id"], W_ORDER), ["player_id"],
                                                W_MEANS, W_LEADS).select(*WINDOW_COLS), "gold-windows")
    stored = _of_players(g.read().select(*WINDOW_COLS), players, fits, "left_semi")
    # at most as many values as the manifest has seasons
    touched = [r[0] for r in row_changes(stored, rolled, WINDOW_COLS).select("season").distinct().collect()]
    folders = [g.folder(v) for v in touched]
    ranks = opponent_ranks(opponent_allowed(s.read([f for f in folders if f in live])))
    kept = _of_players(g.read(folders).select(*WINDOW_COLS), players, fits, "left_anti")
    here = F.col("season").isin([v for v in touched if v is not None])
    if None in touched:
        here = here | F.col("season").isNull()
    rows = join_ranks(kept.unionByName(rolled.where(here)), ranks)
    g.replace(_in_file_order(rows) if touched else g.read([]), folders, live)
    g.vacuum()
    return g.read(), None
