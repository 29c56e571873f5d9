"""Gold features of the two lineages.

* warehouse (W): :func:`player_features` over silver: 3-row trailing means,
  next-game points, opponent ranks joined on (season, opponent).
* older local pipeline (L): :func:`features_last5` over the raw log: last
  token opponent, opponent averages and ranks (NULL groups dropped), 5-row
  trailing means, PRA, next-game points; rows without a target removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import nan_to_null, opponent_last_token
from ..operators.joins import join_small
from ..operators.opponents import L_ALLOWED, opponent_allowed, opponent_defense, opponent_ranks
from ..operators.rolling import position_rows, rolling_features, rolling_over_positions
from ..schemas import MEASURE_COLS, PLAYER_FEATURE_COLS

W_MEANS = [("pts_last3", "pts", 3), ("reb_last3", "reb", 3),
           ("ast_last3", "ast", 3), ("min_last3", "minutes", 3)]
W_LEADS = [("pts_next_game", "pts", 1)]
# game_id resolves date ties; season last keeps the order total even if a
# game id were reused across seasons.
W_ORDER = ["game_date", "game_id", "season"]

L_MEASURES = ["PTS", "REB", "AST", "MIN"]
# Two players of one name share a group, so the id completes the order.
L_ORDER = ["GAME_DATE", "GAME_ID", "PLAYER_ID", "SEASON"]


def rolling_last3(silver: DataFrame, strategy: str = "positions") -> DataFrame:
    """Silver rows plus the four 3-row means and the next-game target."""
    return rolling_features(silver, ["player_id"], W_ORDER, W_MEANS, W_LEADS, strategy)


def player_features(silver: DataFrame, strategy: str = "positions",
                    window: int = 3, only_players: DataFrame | None = None) -> DataFrame:
    """gold.player_features (19 columns).

    ``only_players`` (a frame with a ``player_id`` column) restricts the
    rows whose windows are computed - all of each chosen player's rows, so
    the windows are unchanged - while the opponent ranks still use every
    row.  A name filter cannot be pushed below the per-player window by the
    optimizer; resolving names to ids first and semi-joining does that."""
    means = [(o.replace("last3", f"last{window}") if window != 3 else o, c, window)
             for o, c, _ in W_MEANS]
    base = silver.select("season", "game_id", "game_date", "player_id", "player_name",
                         "team", "opponent_team", "minutes", "pts", "reb", "ast")
    if only_players is not None:
        ranks_src = silver
        base = join_small(base, only_players.select("player_id").distinct(), "player_id",
                          "left_semi")
        if strategy == "positions":
            base = position_rows(base, ["player_id"], W_ORDER)
            rolled = rolling_over_positions(base, ["player_id"], means, W_LEADS)
        else:
            rolled = rolling_features(base, ["player_id"], W_ORDER, means, W_LEADS, "window")
        return join_ranks(rolled, opponent_ranks(opponent_allowed(ranks_src)), window)
    if strategy == "positions":
        # one materialisation of the rows; ranks and windows both scan it
        base = position_rows(base, ["player_id"], W_ORDER)
        ranks = opponent_ranks(opponent_allowed(base))
        rolled = rolling_over_positions(base, ["player_id"], means, W_LEADS)
    else:
        ranks = opponent_ranks(opponent_allowed(silver))
        rolled = rolling_features(base, ["player_id"], W_ORDER, means, W_LEADS, strategy)
    return join_ranks(rolled, ranks, window)


def join_ranks(rolled: DataFrame, ranks: DataFrame, window: int = 3) -> DataFrame:
    """gold.player_features from its rows with windows and the opponents' ranks."""
    r = ranks.select(F.col("season").alias("_r_season"), F.col("team").alias("_r_team"),
                     "opp_pts_allowed_rank", "opp_reb_allowed_rank", "opp_ast_allowed_rank")
    joined = join_small(rolled, r, [("season", "_r_season"), ("opponent_team", "_r_team")], "left")
    cols = PLAYER_FEATURE_COLS if window == 3 else [
        c.replace("last3", f"last{window}") for c in PLAYER_FEATURE_COLS]
    return joined.select(*cols)


def typed_raw(bronze: DataFrame) -> DataFrame:
    """Raw log with numeric measures, as the older lineage's local table
    holds them (upper-case names kept)."""
    return bronze.select(*[F.col(c).cast("double").alias(c) if c in MEASURE_COLS else F.col(c)
                           for c in bronze.columns])


def with_opponent(raw: DataFrame) -> DataFrame:
    """Raw log with dates parsed and OPPONENT_TEAM = last token (or NULL)."""
    return (raw.withColumn("GAME_DATE", F.to_date("GAME_DATE"))
            .withColumn("OPPONENT_TEAM", opponent_last_token("MATCHUP")))


def _join_defense(df: DataFrame) -> DataFrame:
    defense = opponent_defense(df)
    joined = join_small(df, defense, ["SEASON", "OPPONENT_TEAM"], "left")
    extra = [c for c in defense.columns if c not in ("SEASON", "OPPONENT_TEAM")]
    return joined.select(*df.columns, *extra)


def opponent_def_features(raw: DataFrame) -> DataFrame:
    """Raw rows left-joined with the opponent averages and ranks."""
    return _join_defense(with_opponent(raw))


def features_last5(raw: DataFrame, strategy: str = "positions", window: int = 5,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """features.csv of the older pipeline, or only its ``columns``: then only
    what they need is sorted, written and joined."""
    wanted = None if columns is None else set(columns)

    def want(*names):
        return wanted is None or not wanted.isdisjoint(names)

    pra = [f"{m}_LAST{window}" for m in ("PTS", "REB", "AST")]
    means = [(f"{m}_LAST{window}", m, window) for m in L_MEASURES
             if want(f"{m}_LAST{window}") or f"{m}_LAST{window}" in pra and want(f"PRA_LAST{window}")]
    defense = [o for m in L_ALLOWED for o in (m[0], f"{m[0]}_RANK")]
    with_defense = want(*defense)
    if wanted is not None:
        needed = wanted | {"PLAYER_NAME", "PTS", *L_ORDER, *[c for _, c, _ in means]}
        if with_defense or "OPPONENT_TEAM" in wanted:
            needed |= {"MATCHUP"}
        if with_defense:
            needed |= {"SEASON", *[c for _, c in L_ALLOWED]}
        raw = raw.select(*[c for c in raw.columns if c in needed])
    df = raw.select(*[nan_to_null(c).alias(c) if c in L_MEASURES else F.col(c)
                      for c in raw.columns])
    df = with_opponent(df) if "MATCHUP" in raw.columns else df.withColumn("GAME_DATE", F.to_date("GAME_DATE"))
    leads = [("PTS_NEXT_GAME", "PTS", 1)]
    joined = _join_defense if with_defense else (lambda d: d)
    if strategy == "positions":
        # one materialisation; the opponent averages and the windows scan it
        df = position_rows(df, ["PLAYER_NAME"], L_ORDER)
        df = rolling_over_positions(joined(df), ["PLAYER_NAME"], means, leads)
    else:
        df = rolling_features(joined(df), ["PLAYER_NAME"], L_ORDER, means, leads, strategy)
    ordered = [F.col(c) for c in df.columns if c != "PTS_NEXT_GAME"]
    if want(f"PRA_LAST{window}"):
        ordered.append((F.col(pra[0]) + F.col(pra[1]) + F.col(pra[2])).alias(f"PRA_LAST{window}"))
    # Rows without a player name form no group in the original and end
    # without a target; the filter comes after the windows on purpose.
    out = (df.select(*ordered, "PTS_NEXT_GAME")
           .where(F.col("PLAYER_NAME").isNotNull() & F.col("PTS_NEXT_GAME").isNotNull()))
    return out if columns is None else out.select(*columns)
