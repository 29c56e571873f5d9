"""End-to-end jobs.

* :func:`warehouse_job` (bronze -> silver -> gold -> checks): the landing
  batch is upserted into bronze, silver is derived, the gold features are
  materialised (the dashboard then reads the table, so a filter on a player
  prunes files instead of recomputing every window), checks run, and every
  layer writes a run-log row.
* :func:`ml_job` (features -> split -> forest -> anomalies): stops at the
  first failure (an exception propagates).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.anomalies import compute_anomalies
from ..operators.opponents import opponent_allowed, opponent_ranks
from ..operators.upsert import read_table, upsert_table
from ..operators.versioned import VersionedTable
from ..schemas import BRONZE_KEYS, BRONZE_TEXT_SCHEMA
from ..sources.feed import ATTEMPTS, BASE_SLEEP, feed_load
from ..sources.ingest import bronze_status, incremental, path_exists
from . import quality as dq
from .catalog import create_views, init_namespaces, register_versioned
from .features import features_last5, typed_raw
from .gold import refresh_gold
from .model import MAX_DEPTH, NUM_TREES, train_model
from .runlog import RunLog, run_layer
from .silver import silver


def now_text() -> str:
    """The present second in UTC, as the feed writes instants."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def warehouse_job(spark: SparkSession, landing: str, seasons: Sequence[str], root: str,
                  as_of: str, lookback_days: int = 14, full_refresh: bool = False,
                  batch_ts: str | None = None, attempts: int = ATTEMPTS, base_sleep: float = BASE_SLEEP) -> dict:
    """Run the warehouse layers; returns the paths and the check report.

    ``batch_ts`` is the batch's ingestion instant (default: now).  A season that
    cannot be read after ``attempts`` attempts is recorded and the others proceed.  Without any readable
    season and without a bronze table the run ends after bronze, with a
    'warning' row; with a bronze table the later layers run on it.  Silver is
    partitioned by season and only seasons that changed since it was made are
    rewritten, by this run or by an earlier one that died; of gold, only seasons in
    which a value changes."""
    init_namespaces(spark)
    log = RunLog(spark, f"{root}/run_log")
    log.create()
    paths = {"bronze": f"{root}/bronze", "silver": f"{root}/silver",
             "gold": f"{root}/gold_player_features", "run_log": log.path}
    feed_schema = type(BRONZE_TEXT_SCHEMA)([f for f in BRONZE_TEXT_SCHEMA.fields
                                            if f.name not in ("SEASON", "INGESTED_AT")])
    with run_layer(log, "bronze") as run:
        first = None if full_refresh else (dt.date.fromisoformat(as_of) - dt.timedelta(days=lookback_days)).isoformat()
        res = feed_load(spark, landing, seasons, feed_schema, batch_ts or now_text(), first, None if full_refresh else as_of,
                        attempts, base_sleep)
        run.status, run.message = bronze_status(list(seasons), res.failed)
        run.rows = 0
        if res.frame is not None:
            batch = incremental(res.frame, as_of, lookback_days, full_refresh)
            batch = batch.select(*[f.name for f in BRONZE_TEXT_SCHEMA.fields])  # the feed was stored when read
            run.rows = batch.count()
            upsert_table(spark, paths["bronze"], batch, BRONZE_KEYS)
    out = {**paths, "checks": None, "failed_seasons": res.failed}
    if not path_exists(spark, f"{paths['bronze']}/_schema"):
        return out

    with run_layer(log, "silver") as run:
        s = refresh_silver(spark, paths["bronze"], paths["silver"])
        run.rows = s.count()  # file footers only
    with run_layer(log, "gold") as run:
        ranks = opponent_ranks(opponent_allowed(s))
        # Only seasons in which a value changes are rewritten.  A first build
        # evaluates gold's checks while it writes, later runs over the rank columns.
        def on_gold(df):
            return [c for c in dq.warehouse_checks(s, df) if c.table is df]

        gold, values = refresh_gold(spark, paths["silver"], paths["gold"], on_gold)
        run.rows = ranks.count() + gold.count()  # gold: file footers only
    register_versioned(spark, {"silver.player_game_logs": paths["silver"], "gold.player_features": paths["gold"]}, "season")
    create_views(spark)
    with run_layer(log, "quality"):
        n_bronze = read_table(spark, paths["bronze"]).count()
        on_silver = [c for c in dq.warehouse_checks(s, gold) if c.table is s] + [
            dq.Check("silver has bronze's rows", s, dq.has_rows(), lambda v: v == F.lit(n_bronze))]
        row = s.agg(*[c.value.cast("bigint").alias(f"v{i}") for i, c in enumerate(on_silver)]).first()
        checks = on_gold(gold)
        if values is None:
            values = gold.agg(*[c.value.cast("bigint").alias(f"v{i}") for i, c in enumerate(checks)]).first()
        out["checks"] = dq.assert_checks(dq.measured_report(spark, [*zip(checks, values), *zip(on_silver, row)]))
    return out


def refresh_silver(spark: SparkSession, bronze_path: str, silver_path: str) -> DataFrame:
    """Bring silver up to date with bronze and return it.

    Silver's manifest notes from which folder of bronze each season was made.
    Seasons whose folder is another one now are made again, whichever run changed
    them, and vanished ones go, so silver equals bronze after every run, also
    after runs that died."""
    b = VersionedTable(spark, bronze_path, "SEASON")
    t = VersionedTable(spark, silver_path, "season")
    live, made = b.manifest()["parts"], t.manifest()["sources"]
    t.create(silver(b.read([])))
    stale = [p for p, v in live.items() if made.get(p) != v]
    gone = [p for p in made if p not in live]
    if stale or gone:
        t.replace(silver(b.read(stale)), [p.replace("SEASON=", "season=", 1) for p in stale + gone], live)
        t.vacuum()
    return t.read()


def ml_job(raw: DataFrame, num_trees: int = NUM_TREES, max_depth: int | None = MAX_DEPTH,
           actual_col: str = "PTS", preds: DataFrame | None = None) -> DataFrame:
    """features -> ordered split -> forest -> predictions -> anomalies.  Stored
    predictions of an earlier fit (``preds``) are used instead of a new one."""
    if preds is None:
        _, preds, _ = train_model(features_last5(raw), num_trees=num_trees, max_depth=max_depth)
    return compute_anomalies(preds, actual_col, "PRED_PTS_NEXT_GAME",
                             ["SEASON", "GAME_ID", "PLAYER_ID"])


def main(argv=None) -> None:
    """Command line for spark-submit:

    warehouse --landing DIR --root DIR --seasons A,B --as-of YYYY-MM-DD
              [--lookback 14] [--full-refresh]
    ml --bronze DIR --out DIR [--trees 300] [--depth N]
    """
    import argparse

    from ..session import build_session
    ap = argparse.ArgumentParser(prog="panelforge.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    w = sub.add_parser("warehouse")
    w.add_argument("--landing", required=True)
    w.add_argument("--root", required=True)
    w.add_argument("--seasons", required=True, help="comma list, as given (not trimmed)")
    w.add_argument("--as-of", default=dt.date.today().isoformat())
    w.add_argument("--lookback", type=int, default=14)
    w.add_argument("--full-refresh", action="store_true")
    m = sub.add_parser("ml")
    m.add_argument("--bronze", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--trees", type=int, default=NUM_TREES)
    m.add_argument("--depth", type=int, default=MAX_DEPTH)
    a = ap.parse_args(argv)
    spark = build_session()
    if a.job == "warehouse":
        out = warehouse_job(spark, a.landing, a.seasons.split(","), a.root, a.as_of,
                            a.lookback, a.full_refresh)
        if out["checks"] is not None:
            out["checks"].show(truncate=False)
    else:
        anomalies = ml_job(typed_raw(read_table(spark, a.bronze)), a.trees, a.depth)
        anomalies.write.mode("overwrite").parquet(a.out)


if __name__ == "__main__":
    main()
