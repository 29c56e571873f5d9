"""Named queries over the test tables: one callable ``(spark, sf_dir)`` per
operator of the inventory.  The results are DataFrames; building most of them
already runs jobs (statistics, positions, written tables).  Outputs with
time-zone timestamps are rendered as text so they compare across engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import opponent_last_token, opponent_split_part
from ..operators.opponents import opponent_allowed, opponent_defense, opponent_ranks
from ..sources.fixtures import bronze_log
from . import features as feat
from .silver import silver

Query = Callable[[SparkSession, str], DataFrame]


def _silver(spark, sf):
    return silver(bronze_log(spark, sf))


def _raw(spark, sf):
    return feat.typed_raw(bronze_log(spark, sf))


def q_silver_logs(spark, sf):
    s = _silver(spark, sf)
    return s.withColumn("ingested_at", F.col("ingested_at").cast("string"))


def q_opponent_allowed(spark, sf):
    return opponent_allowed(_silver(spark, sf))


def q_opponent_ranks(spark, sf):
    return opponent_ranks(opponent_allowed(_silver(spark, sf)))


def q_player_features(spark, sf):
    return feat.player_features(_silver(spark, sf))


def q_opponent_split_part(spark, sf):
    return bronze_log(spark, sf).select("SEASON", "GAME_ID", "PLAYER_ID", "MATCHUP",
                                      opponent_split_part("MATCHUP").alias("opponent_team"))


def q_opponent_last_token(spark, sf):
    return bronze_log(spark, sf).select("SEASON", "GAME_ID", "PLAYER_ID", "MATCHUP",
                                      opponent_last_token("MATCHUP").alias("OPPONENT_TEAM"))


def q_rolling_last3(spark, sf):
    return feat.rolling_last3(_silver(spark, sf)).select(
        "season", "game_id", "player_id", "pts_last3", "reb_last3", "ast_last3", "min_last3")


def q_next_game_target(spark, sf):
    return feat.rolling_last3(_silver(spark, sf)).select(
        "season", "game_id", "player_id", "pts", "pts_next_game")


def q_opponent_defense(spark, sf):
    return opponent_defense(feat.with_opponent(_raw(spark, sf)))


def q_opponent_def_features(spark, sf):
    return feat.opponent_def_features(_raw(spark, sf))


def q_rolling_last5(spark, sf):
    from ..operators.rolling import rolling_features
    df = feat.with_opponent(_raw(spark, sf))
    return rolling_features(df, ["PLAYER_NAME"], feat.L_ORDER,
                            [(f"{m}_LAST5", m, 5) for m in feat.L_MEASURES]).select(
        "SEASON", "GAME_ID", "PLAYER_ID", "PTS_LAST5", "REB_LAST5", "AST_LAST5", "MIN_LAST5")


def q_features_last5(spark, sf):
    return feat.features_last5(_raw(spark, sf))


QUERIES: dict[str, Query] = {
    "silver_logs": q_silver_logs,
    "opponent_allowed": q_opponent_allowed,
    "opponent_ranks": q_opponent_ranks,
    "player_features": q_player_features,
    "opponent_split_part": q_opponent_split_part,
    "opponent_last_token": q_opponent_last_token,
    "rolling_last3": q_rolling_last3,
    "next_game_target": q_next_game_target,
    "opponent_defense": q_opponent_defense,
    "opponent_def_features": q_opponent_def_features,
    "rolling_last5": q_rolling_last5,
    "features_last5": q_features_last5,
}


# --- reports ----------------------------------------------------------------

from ..operators import anomalies as an  # noqa: E402
from ..operators import histogram as hist  # noqa: E402
from ..operators.split import ordered_split  # noqa: E402
from . import quality as dq  # noqa: E402
from . import reports as rep  # noqa: E402
from .model import SPLIT_ORDER, regression_metrics  # noqa: E402

# Report parameters used by the registered queries.
REPORT_PLAYER = "Customer#000000605"
AS_OF = "2001-08-01"
BATCH_TS = "2024-01-02 00:00:00"
KEY_COLS = ["SEASON", "GAME_ID", "PLAYER_ID"]


def _features(spark, sf):
    return feat.player_features(_silver(spark, sf))


def q_player_list(spark, sf):
    return rep.player_list(_silver(spark, sf))  # features have the rows of silver


def q_recent_games(spark, sf):
    return rep.recent_games_from_silver(_silver(spark, sf), REPORT_PLAYER)


def q_recent_games_limited(spark, sf):
    """The same report cut where the player has more games."""
    return rep.recent_games_from_silver(_silver(spark, sf), REPORT_PLAYER, 7)


def q_trend_series(spark, sf):
    return rep.trend_series(rep.recent_games_from_silver(_silver(spark, sf), REPORT_PLAYER))


def events_run_log(spark, sf):
    """The events table read as a run log."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return ev.select(F.col("event_id").cast("string").alias("run_id"),
                     F.col("event_type").alias("layer"),
                     F.col("user_id").cast("int").alias("rows_processed"),
                     F.lit("success").alias("status"),
                     F.col("value").alias("runtime_seconds"),
                     F.lit(None).cast("string").alias("error_message"),
                     F.col("ts").alias("executed_at"))


def q_recent_runs(spark, sf):
    return rep.recent_runs(events_run_log(spark, sf)).withColumn(
        "executed_at", F.col("executed_at").cast("string"))


# --- anomalies and model scoring (deterministic predictor: PTS_LAST5) -----

ANOM_TIES = ["SEASON", "GAME_ID", "PLAYER_ID"]


def _anomalies(spark, sf):
    f5 = feat.features_last5(_raw(spark, sf))
    return an.compute_anomalies(f5, "PTS", "PTS_LAST5", ANOM_TIES)


def q_anomalies(spark, sf):
    return _anomalies(spark, sf).withColumn("RESIDUAL_ZSCORE", F.round("RESIDUAL_ZSCORE", 6))


def _f5(spark, sf, *cols):
    """Only the named columns of the last-five features."""
    return feat.features_last5(_raw(spark, sf), columns=list(dict.fromkeys(cols)))


def q_residual_zscore(spark, sf):
    narrow = _f5(spark, sf, *ANOM_TIES, "PTS", "PTS_LAST5")
    return an.scored_residuals(narrow, "PTS", "PTS_LAST5").select(*ANOM_TIES, "RESIDUAL",
                                        F.round("RESIDUAL_ZSCORE", 6).alias("RESIDUAL_ZSCORE"))


def q_anomaly_label(spark, sf):
    f5 = _f5(spark, sf, *ANOM_TIES, "PTS", "PTS_LAST5")
    return an.with_label(an.with_residual(f5, "PTS", "PTS_LAST5")).select(
        *ANOM_TIES, "RESIDUAL", "ANOMALY_TYPE")


def q_residual_stats(spark, sf):
    f5 = _f5(spark, sf, "PTS", "PTS_LAST5")
    st = an.residual_stats(an.with_residual(f5, "PTS", "PTS_LAST5"))
    return st.select("n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def q_top_anomalies(spark, sf):
    narrow = _f5(spark, sf, *ANOM_TIES, "PLAYER_NAME", "PTS", "PTS_LAST5")
    labelled = an.with_label(an.with_residual(narrow, "PTS", "PTS_LAST5"))
    return an.top_anomalies(labelled, 20, ANOM_TIES).select(
        *ANOM_TIES, "PLAYER_NAME", "ABS_RESIDUAL", "ANOMALY_TYPE")


def q_residual_histogram(spark, sf):
    f5 = _f5(spark, sf, "PTS", "PTS_LAST5")
    return hist.histogram(an.with_residual(f5, "PTS", "PTS_LAST5"), "RESIDUAL", 40)


def q_residual_kde(spark, sf):
    f5 = _f5(spark, sf, "PTS", "PTS_LAST5")
    return hist.kde(an.with_residual(f5, "PTS", "PTS_LAST5"), "RESIDUAL")


def q_pred_actual_grid(spark, sf):
    f5 = _f5(spark, sf, "PTS", "PTS_LAST5")
    return hist.grid_counts(f5, "PTS_LAST5", "PTS", 20)


def q_ordered_split(spark, sf):
    f5 = _f5(spark, sf, *ANOM_TIES, "PLAYER_NAME", "GAME_DATE")
    return ordered_split(f5, SPLIT_ORDER, 0.2).select(
        *ANOM_TIES, "SPLIT")


def q_regression_metrics(spark, sf):
    f5 = _f5(spark, sf, *SPLIT_ORDER, "PTS_NEXT_GAME", "PTS_LAST5")
    test = ordered_split(f5, SPLIT_ORDER, 0.2).where(
        F.col("SPLIT") == "test")
    m = regression_metrics(test, "PTS_NEXT_GAME", "PTS_LAST5")
    return m.select("n", F.round("mae", 6).alias("mae"), F.round("r2", 6).alias("r2"))


# --- data quality and layer counts -------------------------------------------

def _counted(s):
    """The gold features for aggregates that use no window column: then the plan
    holds no window, so no rows need be placed and written for it."""
    return feat.player_features(s, strategy="window")


def _checks(spark, sf):
    s = _silver(spark, sf)
    return dq.run_checks(dq.warehouse_checks(s, _counted(s)))


def q_dq_report(spark, sf):
    return _checks(spark, sf)


def q_dq_has_rows(spark, sf):
    s = _silver(spark, sf)
    f = _counted(s)
    return dq.run_checks([dq.Check("gold.player_features has rows", f, dq.has_rows(),
                                   lambda v: v > 0)])


def q_dq_null_keys(spark, sf):
    s = _silver(spark, sf)
    return dq.run_checks([dq.Check("silver keys not null", s,
                                   dq.null_keys(["season", "game_id", "player_id"]),
                                   lambda v: v == 0)])


def q_dq_null_keys_found(spark, sf):
    """The same check on rows of which some lack a key."""
    s = _silver(spark, sf).withColumn("season", F.when(F.col("player_id") % 11 != 0, F.col("season")))
    return dq.run_checks([dq.Check("silver keys not null", s,
                                   dq.null_keys(["season", "game_id", "player_id"]),
                                   lambda v: v == 0)])


def q_dq_rank_range_found(spark, sf):
    """The same check on ranks of which some are too large."""
    c = "opp_pts_allowed_rank"
    f = _counted(_silver(spark, sf)).withColumn(c, F.col(c) * 2)
    return dq.run_checks([dq.Check(f"{c} within 1..30", f, dq.out_of_range(c), lambda v: v == 0)])


def q_dq_rank_range(spark, sf):
    f = _counted(_silver(spark, sf))
    return dq.run_checks([dq.Check(f"{c} within 1..30", f, dq.out_of_range(c), lambda v: v == 0)
                          for c in ["opp_pts_allowed_rank", "opp_reb_allowed_rank",
                                    "opp_ast_allowed_rank"]])


def q_layer_counts(spark, sf):
    b = bronze_log(spark, sf)
    s = silver(b)
    allowed = opponent_allowed(s)
    parts = [("bronze", b), ("silver", s), ("opponent_allowed", allowed),
             ("opponent_ranks", opponent_ranks(allowed)),
             ("player_features", _counted(s))]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


QUERIES.update({
    "player_list": q_player_list,
    "recent_games": q_recent_games,
    "trend_series": q_trend_series,
    "recent_runs": q_recent_runs,
    "anomalies": q_anomalies,
    "residual_zscore": q_residual_zscore,
    "anomaly_label": q_anomaly_label,
    "residual_stats": q_residual_stats,
    "top_anomalies": q_top_anomalies,
    "residual_histogram": q_residual_histogram,
    "residual_kde": q_residual_kde,
    "pred_actual_grid": q_pred_actual_grid,
    "ordered_split": q_ordered_split,
    "regression_metrics": q_regression_metrics,
    "dq_report": q_dq_report,
    "dq_has_rows": q_dq_has_rows,
    "dq_null_keys": q_dq_null_keys,
    "dq_rank_range": q_dq_rank_range,
    "layer_counts": q_layer_counts,
    "recent_games_limited": q_recent_games_limited,
    "dq_null_keys_found": q_dq_null_keys_found,
    "dq_rank_range_found": q_dq_rank_range_found,
})


# --- ingestion, upsert, sinks (each writes to a fresh folder in the shared
# checkpoint location and returns what it reads back) -------------------------

from ..operators import upsert as ups  # noqa: E402
from ..schemas import BRONZE_TEXT_SCHEMA  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources import ingest  # noqa: E402
from ..sources.fixtures import FIXTURE_INGESTED_AT  # noqa: E402

FEED_SCHEMA = type(BRONZE_TEXT_SCHEMA)(
    [f for f in BRONZE_TEXT_SCHEMA.fields if f.name not in ("SEASON", "INGESTED_AT")])
BRONZE_COLS = [f.name for f in BRONZE_TEXT_SCHEMA.fields]
# Fixed value: a season requested but never landed.
MISSING_SEASON = "1900"


def landing_seasons(spark, root):
    """Season folders present under a landing root (a file listing)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("SEASON="))


_MADE: dict[tuple, str] = {}


def _once(spark, sf, name, make):
    """A folder that ``make(path)`` writes once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"), name)
    if key not in _MADE or not ingest.path_exists(spark, _MADE[key]):
        path = scratch_path(spark, name)
        make(path)
        _MADE[key] = path
    return _MADE[key]


def _landing(spark, sf):
    return _once(spark, sf, "landing", lambda root: ingest.write_landing(bronze_log(spark, sf), root))


def q_bronze_read(spark, sf):
    root = _landing(spark, sf)
    frames = [ingest.read_season(spark, root, s, FEED_SCHEMA, batch_ts=FIXTURE_INGESTED_AT)
              for s in landing_seasons(spark, root)]
    return ingest.union_by_name(frames).select(*BRONZE_COLS)


def q_multi_season_union(spark, sf):
    root = _landing(spark, sf)
    seasons = landing_seasons(spark, root)
    frames = []
    for s in seasons:
        df = ingest.read_season(spark, root, s, FEED_SCHEMA, batch_ts=FIXTURE_INGESTED_AT)
        # the oldest season's feed has no TOV column
        frames.append(df.drop("TOV") if s == seasons[0] else df)
    return ingest.union_by_name(frames)


def _all_seasons(spark, sf):
    root = _landing(spark, sf)
    return ingest.read_seasons(spark, root, landing_seasons(spark, root), FEED_SCHEMA,
                               batch_ts=FIXTURE_INGESTED_AT).select(*BRONZE_COLS)


def q_incremental_window(spark, sf):
    return ingest.incremental(_all_seasons(spark, sf), AS_OF, 14)


def q_full_refresh(spark, sf):
    return ingest.incremental(_all_seasons(spark, sf), AS_OF, 14, full_refresh=True)


def _isolated(spark, sf):
    root = _landing(spark, sf)
    seasons = landing_seasons(spark, root) + [MISSING_SEASON]
    return seasons, ingest.isolated_load(spark, root, seasons, FEED_SCHEMA,
                                         batch_ts=FIXTURE_INGESTED_AT)


def q_isolated_load(spark, sf):
    _, res = _isolated(spark, sf)
    return res.frame.select(*BRONZE_COLS)


def q_bronze_status(spark, sf):
    seasons, res = _isolated(spark, sf)
    status, msg = ingest.bronze_status(seasons, res.failed)
    return res.frame.agg(F.count(F.lit(1)).alias("rows_processed")).select(
        F.lit(status).alias("status"), "rows_processed",
        F.lit(msg).cast("string").alias("error_message"))


def q_feed_read(spark, sf):
    """The lookback window as the feed's data source gives it."""
    from ..sources.feed import feed_load
    root = _landing(spark, sf)
    res = feed_load(spark, root, landing_seasons(spark, root), FEED_SCHEMA, FIXTURE_INGESTED_AT, "2001-07-18", AS_OF)
    return res.frame.select(*BRONZE_COLS)


def q_feed_retry(spark, sf):
    """Files and failures per season of a feed with an unreadable and a missing one."""
    from ..sources.feed import read_feed
    root = scratch_path(spark, "landing-junk")
    ingest.write_landing(bronze_log(spark, sf), root)
    spark.createDataFrame([("not a table",)], "value string").coalesce(1).write.text(f"{root}/SEASON={MISSING_SEASON}")
    got = read_feed(spark, root, landing_seasons(spark, root) + ["1901"], FEED_SCHEMA, attempts=3, base_sleep=0.05)
    return got.groupBy("SEASON").agg(F.count_if(F.col("_error").isNull()).alias("rows"), F.max("_attempts").alias("attempts"),
                                     F.max(F.col("_error").isNotNull()).alias("failed"))


def q_create_like(spark, sf):
    path = scratch_path(spark, "bronze-like")
    ups.create_like(spark, path, bronze_log(spark, sf))
    ups.create_like(spark, path, bronze_log(spark, sf))  # second call: no-op
    return ups.read_table(spark, path)


# The loaded range ends before TARGET_END; the new batch
# re-reads from BATCH_START on, so the year in between is loaded twice.
TARGET_END = "1999-01-01"
BATCH_START = "1998-01-01"


def upsert_inputs(spark, sf):
    """Target: games before TARGET_END; batch: games from BATCH_START on,
    with points + 1 and a later ingestion time.  The overlap year is the
    re-read of a lookback load; together they cover every row."""
    gl = bronze_log(spark, sf)
    d = F.to_date("GAME_DATE")
    target = gl.where(d < F.to_date(F.lit(TARGET_END)))
    batch = gl.where(d >= F.to_date(F.lit(BATCH_START))).withColumn(
        "PTS", (F.col("PTS").cast("bigint") + 1).cast("string")).withColumn(
        "INGESTED_AT", F.lit(BATCH_TS))
    return target, batch


def q_duplicate_keys(spark, sf):
    target, batch = upsert_inputs(spark, sf)
    return ups.duplicate_keys(target.unionByName(batch), KEY_COLS)


def q_upsert(spark, sf):
    target, batch = upsert_inputs(spark, sf)
    return ups.upsert(target, batch, KEY_COLS)


def q_upsert_all_columns(spark, sf):
    target, batch = upsert_inputs(spark, sf)
    return ups.upsert(target, batch, KEY_COLS, update_cols=None)


def q_upsert_table(spark, sf):
    target, batch = upsert_inputs(spark, sf)
    path = scratch_path(spark, "bronze")
    ups.upsert_table(spark, path, target, KEY_COLS)
    return ups.upsert_table(spark, path, batch, KEY_COLS)


def q_upsert_table_null_season(spark, sf):
    """Rows without a season, in the table and in the batch, are never lost."""
    path = scratch_path(spark, "bronze")
    for df in upsert_inputs(spark, sf):
        out = ups.upsert_table(spark, path, df.withColumn(
            "SEASON", F.when(F.col("PLAYER_ID") % 11 != 0, F.col("SEASON"))), KEY_COLS)
    return out


def q_upsert_table_missing_column(spark, sf):
    """A batch without a stored column leaves the stored values alone."""
    target, batch = upsert_inputs(spark, sf)
    path = scratch_path(spark, "bronze")
    ups.upsert_table(spark, path, target, KEY_COLS)
    return ups.upsert_table(spark, path, batch.drop("TOV"), KEY_COLS)


def q_stream_upsert(spark, sf):
    """Two loads whose dates overlap by the lookback: the rows in between land twice."""
    from ..streaming.stream_upsert import stream_upsert
    root = scratch_path(spark, "landing")
    gl = bronze_log(spark, sf)
    for part in (gl.where(F.col("GAME_DATE") < TARGET_END),
                 gl.where(F.col("GAME_DATE") >= F.date_sub(F.lit(TARGET_END), 14).cast("string"))):
        # one landed file per season (a daily fetch drops one file per season)
        ingest.write_landing(part.repartition("SEASON"), root, mode="append")
    schema = type(FEED_SCHEMA)(list(FEED_SCHEMA.fields)
                               + [f for f in BRONZE_TEXT_SCHEMA.fields if f.name == "SEASON"])
    out = stream_upsert(spark, root, schema, scratch_path(spark, "bronze-stream"), KEY_COLS,
                        batch_ts=FIXTURE_INGESTED_AT, max_files_per_trigger=3)
    return out.select(*BRONZE_COLS)


def q_overwrite_roundtrip(spark, sf):
    gl = bronze_log(spark, sf)
    path = scratch_path(spark, "game_logs")
    ingest.roundtrip(gl, path)  # first load
    return ingest.roundtrip(gl, path)  # replace


def q_csv_roundtrip(spark, sf):
    return ingest.roundtrip(bronze_log(spark, sf), scratch_path(spark, "csv"), "csv",
                            BRONZE_TEXT_SCHEMA)


def _warehouse(spark, sf):
    """Folder of a warehouse that one full run built."""
    from .jobs import warehouse_job

    def make(root):
        landing = _landing(spark, sf)
        warehouse_job(spark, landing, landing_seasons(spark, landing), root, AS_OF, full_refresh=True,
                      batch_ts=FIXTURE_INGESTED_AT)
    return _once(spark, sf, "warehouse", make)


def q_catalog_exists(spark, sf):
    """The layers' relations as another session finds them by name."""
    from .catalog import create_views, init_namespaces, register_versioned, table_exists
    root = _warehouse(spark, sf)
    gold = ups.read_table(spark, f"{root}/gold_player_features")
    init_namespaces(spark)
    register_versioned(spark, {"silver.player_game_logs": f"{root}/silver",
                               "gold.player_features": f"{root}/gold_player_features"}, "season")
    create_views(spark)
    other, out = spark.newSession(), None
    # the misspelled name is looked up on purpose: it does not exist
    for name in ["silver.player_game_logs", "gold.opponents_ranks", "gold.opponent_allowed", "gold.opponent_ranks",
                 "gold.player_features"]:
        present = table_exists(other, name)
        one = (spark.table(name) if present else gold.limit(0)).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(present).alias("present"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def q_stored_view_ranks(spark, sf):
    """The ranks as the stored view gives them."""
    q_catalog_exists(spark, sf)
    return spark.newSession().table("gold.opponent_ranks")


def q_warehouse_job_resumed(spark, sf):
    """Rows per layer after a run died between bronze and silver, leaving files
    in silver's folder, and a later run loaded only the last season."""
    from .jobs import warehouse_job
    root, landing = scratch_path(spark, "warehouse-resumed"), _landing(spark, sf)
    seasons = landing_seasons(spark, landing)
    ups.upsert_table(spark, f"{root}/bronze", _all_seasons(spark, sf), KEY_COLS)
    silver(bronze_log(spark, sf)).limit(10).write.partitionBy("season").parquet(f"{root}/silver")
    run = warehouse_job(spark, landing, seasons[-1:], root, AS_OF, full_refresh=True)
    frames = [("silver", ups.read_table(spark, run["silver"])), ("gold", ups.read_table(spark, run["gold"]))]
    out = None
    for layer, df in frames:
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("season").alias("seasons"),
                     F.sum("pts").alias("points")).select(F.lit(layer).alias("layer"), "rows", "seasons", "points")
        out = one if out is None else out.unionByName(one)
    return out


def _incremental_gold(spark, sf):
    """Folder of a warehouse whose gold was built from the games before TARGET_END,
    those from BATCH_START on with a point too much, and then followed an upsert of
    all games from BATCH_START on as they are in the log."""
    from .gold import refresh_gold
    from .jobs import refresh_silver

    def make(root):
        gl = bronze_log(spark, sf)
        late = F.to_date("GAME_DATE") >= F.to_date(F.lit(BATCH_START))
        early = gl.where(F.to_date("GAME_DATE") < F.to_date(F.lit(TARGET_END))).withColumn(
            "PTS", F.when(late, (F.col("PTS").cast("bigint") + 1).cast("string")).otherwise(F.col("PTS")))
        for batch in (early, gl.where(late)):
            ups.upsert_table(spark, f"{root}/bronze", batch, KEY_COLS, update_cols=None)
            refresh_silver(spark, f"{root}/bronze", f"{root}/silver")
            refresh_gold(spark, f"{root}/silver", f"{root}/gold")
    return _once(spark, sf, "warehouse-incremental", make)


def q_gold_incremental(spark, sf):
    """Gold after a change set: the rows of a full build."""
    return ups.read_table(spark, f"{_incremental_gold(spark, sf)}/gold")


def q_gold_incremental_seasons(spark, sf):
    """Rows per season of that table, and whether the change set rewrote the season."""
    from ..operators.versioned import VersionedTable
    t = VersionedTable(spark, f"{_incremental_gold(spark, sf)}/gold", "season")
    live = t.manifest()
    before = t.manifest(live["version"] - 1)["parts"]
    stayed = [p for p, v in live["parts"].items() if before.get(p) == v]
    stayed = t.read(stayed).select("season").distinct().withColumn("stayed", F.lit(True))
    return (t.read().groupBy("season").agg(F.count(F.lit(1)).alias("rows")).join(stayed, "season", "left")
            .select("season", "rows", F.col("stayed").isNull().alias("rewritten")))


def q_upsert_rejected(spark, sf):
    """The table after a change of several partitions that was written but not committed."""
    def reject(_):
        raise ValueError("rejected before the commit")

    target, batch = upsert_inputs(spark, sf)
    path = scratch_path(spark, "bronze")
    ups.upsert_table(spark, path, target, KEY_COLS)
    try:
        ups.upsert_table(spark, path, batch, KEY_COLS, check=reject)
    except ValueError:
        return ups.read_table(spark, path)
    raise RuntimeError("the change was committed")


def q_run_log_append(spark, sf):
    from .runlog import RunLog, run_layer
    log = RunLog(spark, scratch_path(spark, "run_log"))
    log.create()
    b = bronze_log(spark, sf)
    with run_layer(log, "bronze", "run-bronze") as h:
        h.rows = b.count()
    s = silver(b)
    with run_layer(log, "silver", "run-silver") as h:
        h.rows = s.count()
    with run_layer(log, "gold", "run-gold") as h:
        h.rows = opponent_ranks(opponent_allowed(s)).count() + feat.player_features(s).count()
    try:
        with run_layer(log, "quality", "run-quality"):
            raise RuntimeError("x" * 3000)  # an over-long error text is cut to 2000
    except RuntimeError:
        pass
    return log.read().select("run_id", "layer", "rows_processed", "status",
                             F.length("error_message").alias("error_length"))


def q_warehouse_job(spark, sf):
    """The run log of three runs: all seasons good, one unreadable, all unreadable."""
    from .jobs import warehouse_job

    def landing(name, good, bad):
        def make(root):
            if good:
                ingest.write_landing(bronze_log(spark, sf), root)
            for season in bad:
                spark.createDataFrame([("not a table",)], "value string").coalesce(1).write.text(
                    f"{root}/SEASON={season}")
        return _once(spark, sf, name, make)

    out = None
    for case, root in (("good", _landing(spark, sf)),
                       ("one unreadable", landing("landing-junk", True, [MISSING_SEASON])),
                       ("all unreadable", landing("landing-bad", False, [MISSING_SEASON]))):
        run = warehouse_job(spark, root, landing_seasons(spark, root), scratch_path(spark, "warehouse"),
                            AS_OF, full_refresh=True, attempts=2, base_sleep=0.05)
        log = spark.read.parquet(run["run_log"]).select(
            F.lit(case).alias("case"), "layer", "status", "rows_processed")
        out = log if out is None else out.unionByName(log)
    return out


# --- model: one fit per data folder, shared by its queries.  Predictions of a
# bootstrapped forest cannot be had from SQL, so those queries return what must
# hold of them; a tree over all rows (rf_tree_fit) can -------

def _fitted(spark, sf):
    """Folders of the fitted model, the test rows with predictions and the features."""
    from .model import save_artifacts, train_model
    names = ("model", "test_with_preds", "feature_columns")

    def make(root):
        model, preds, cols = train_model(feat.features_last5(_raw(spark, sf)))
        save_artifacts(model, preds, cols, root)

    root = _once(spark, sf, "model", make)
    return [f"{root}/{n}" for n in names]


def q_rf_predict(spark, sf):
    """Test rows, and whether the forest stays in the range of the training labels."""
    rows = ordered_split(_f5(spark, sf, *SPLIT_ORDER, "PTS_NEXT_GAME"), SPLIT_ORDER, 0.2)
    low, high = rows.where(F.col("SPLIT") == "train").agg(
        F.min("PTS_NEXT_GAME"), F.max("PTS_NEXT_GAME")).first()
    return spark.read.parquet(_fitted(spark, sf)[1]).select(
        *ANOM_TIES, "PTS_NEXT_GAME",
        F.coalesce(F.col("PRED_PTS_NEXT_GAME").between(low, high), F.lit(False)).alias("in_range"))


def q_rf_metrics(spark, sf):
    """Test rows, and whether the reported MAE is that of the stored predictions."""
    preds = spark.read.parquet(_fitted(spark, sf)[1])
    m = regression_metrics(preds, "PTS_NEXT_GAME", "PRED_PTS_NEXT_GAME").first()
    miss = F.greatest("PTS_NEXT_GAME", "PRED_PTS_NEXT_GAME") - F.least("PTS_NEXT_GAME", "PRED_PTS_NEXT_GAME")
    return preds.agg(F.count("*").alias("n"), F.sum(miss).alias("s")).select(
        "n", (F.abs(F.col("s") / F.col("n") - m["mae"]) < 1e-9).alias("mae_agrees"))


def q_model_roundtrip(spark, sf):
    """Whether the loaded model predicts each stored test row as the fitted one did."""
    from .model import load_model
    model, preds, _ = _fitted(spark, sf)
    stored = spark.read.parquet(preds).withColumnRenamed("PRED_PTS_NEXT_GAME", "_pf_stored")
    return load_model(spark, model).transform(stored).select(
        *ANOM_TIES, F.col("PRED_PTS_NEXT_GAME").eqNullSafe(F.col("_pf_stored")).alias("same"))


def q_rf_tree_fit(spark, sf):
    """A full tree over all rows, once each, in prediction of those rows: it parts
    all rows that any feature tells apart, so a row gets the mean label of its equals."""
    from ..operators.forest import fit_forest, predict_forest
    from .model import _features as encoded
    names = ["PTS_LAST5", "REB_LAST5", "AST_LAST5", "MIN_LAST5", "OPP_PTS_ALLOWED_RANK"]
    rows = ordered_split(_f5(spark, sf, *SPLIT_ORDER, *names, "PTS_NEXT_GAME"), SPLIT_ORDER, 0.2, pos_col="_pos")
    rows = encoded(rows, names, "sentinel", -1.0)
    cols = [f"_f_{c}" for c in names]
    tree = fit_forest(rows, cols, "PTS_NEXT_GAME", "_pos", 1, bootstrap=False)
    fitted = predict_forest(tree, rows, cols, "_pos", "fitted")
    return rows.join(fitted, "_pos").select(*ANOM_TIES, F.round("fitted", 6).alias("fitted"))


def q_ml_job(spark, sf):
    """Whether each anomaly's label agrees with the sign of its residual."""
    from .jobs import ml_job
    rows = ml_job(_raw(spark, sf), preds=spark.read.parquet(_fitted(spark, sf)[1]))
    over = F.col("PTS") > F.col("PRED_PTS_NEXT_GAME")
    return rows.select(*ANOM_TIES, F.when(F.coalesce(over, F.lit(False)), F.col("ANOMALY_TYPE") == "OVERPERFORM")
                       .otherwise(F.col("ANOMALY_TYPE") == "UNDERPERFORM").alias("label_agrees"))


QUERIES.update({
    "bronze_read": q_bronze_read,
    "multi_season_union": q_multi_season_union,
    "incremental_window": q_incremental_window,
    "full_refresh": q_full_refresh,
    "isolated_load": q_isolated_load,
    "bronze_status": q_bronze_status,
    "feed_read": q_feed_read,
    "feed_retry": q_feed_retry,
    "create_like": q_create_like,
    "duplicate_keys": q_duplicate_keys,
    "upsert": q_upsert,
    "upsert_all_columns": q_upsert_all_columns,
    "upsert_table": q_upsert_table,
    "upsert_table_null_season": q_upsert_table_null_season,
    "upsert_table_missing_column": q_upsert_table_missing_column,
    "warehouse_job": q_warehouse_job,
    "stream_upsert": q_stream_upsert,
    "overwrite_roundtrip": q_overwrite_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "catalog_exists": q_catalog_exists,
    "stored_view_ranks": q_stored_view_ranks,
    "warehouse_job_resumed": q_warehouse_job_resumed,
    "gold_incremental": q_gold_incremental,
    "gold_incremental_seasons": q_gold_incremental_seasons,
    "upsert_rejected": q_upsert_rejected,
    "run_log_append": q_run_log_append,
    "rf_predict": q_rf_predict,
    "rf_metrics": q_rf_metrics,
    "model_roundtrip": q_model_roundtrip,
    "rf_tree_fit": q_rf_tree_fit,
    "ml_job": q_ml_job,
})


# --- the block plan named explicitly (it is the default) ----

def q_player_features_skew_safe(spark, sf):
    return feat.player_features(_silver(spark, sf), strategy="positions")


def q_features_last5_skew_safe(spark, sf):
    return feat.features_last5(_raw(spark, sf), strategy="positions")


QUERIES.update({
    "player_features_skew_safe": q_player_features_skew_safe,
    "features_last5_skew_safe": q_features_last5_skew_safe,
})
