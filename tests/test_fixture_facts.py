"""End-to-end facts of the game-log fixture at sf0.001 (FIXTURES.md §2), the
driver contract, and oracle agreement for a sample of keys."""

import os

import pytest
from pyspark.sql import functions as F

from panelforge.plans import features as feat
from panelforge.plans.silver import silver
from panelforge.plans.features import typed_raw
from panelforge.sources.fixtures import game_log

from .conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="test tables missing")


@pytest.fixture(scope="module")
def gl(spark):
    return game_log(spark, SF_SMALL).cache()


def test_bronze_facts(gl):
    assert gl.count() == 1500
    assert gl.select("SEASON", "GAME_ID", "PLAYER_ID").distinct().count() == 1500
    assert gl.where(F.col("MATCHUP").isNull()).count() == 15
    assert gl.where(F.col("PTS").isNull()).count() == 27
    assert gl.where(~F.col("MATCHUP").contains(" ")).count() == 15


def test_l_features_and_lookback(spark, gl):
    f5 = feat.features_last5(typed_raw(gl))
    assert f5.count() == 1324
    from panelforge.sources.ingest import incremental
    assert incremental(gl, "2001-08-01", 14).count() == 20
    from panelforge.operators.anomalies import with_label, with_residual
    lab = with_label(with_residual(f5, "PTS", "PTS_LAST5")).groupBy("ANOMALY_TYPE").count()
    assert dict(map(tuple, lab.collect())) == {"OVERPERFORM": 532, "UNDERPERFORM": 792}


def test_l_ranks_max(spark, gl):
    from panelforge.operators.opponents import opponent_defense
    d = opponent_defense(feat.with_opponent(typed_raw(gl)))
    assert d.count() == 175
    assert d.agg(F.max("OPP_PTS_ALLOWED_RANK")).first()[0] == 25


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert len(df.columns) == 19 and df.count() == 1500
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    from panelforge.plans.registry import QUERIES
    assert set(QUERIES) <= set(orc)  # every query of the game log has its SQL
    assert {"player_features_skew_safe", "features_last5_skew_safe"} <= set(orc)


@pytest.mark.parametrize("key", ["player_features", "features_last5", "upsert", "dq_report",
                                 "residual_histogram", "ordered_split"])
def test_oracle_agreement(spark, key):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ["nation", "customer", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = E.queries()[key](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    norm = lambda v: repr(float(v)) if isinstance(v, float) else repr(v)
    srows = sorted(tuple(norm(r[c]) for c in sorted(ocols)) for r in sdf.collect())
    idx = {c: i for i, c in enumerate(ocols)}
    orows = sorted(tuple(norm(r[idx[c]]) for c in sorted(ocols)) for r in res.fetchall())
    assert srows == orows


def test_recent_games_id_filter_equals_full(spark):
    from panelforge.plans.reports import recent_games, recent_games_from_silver
    s = silver(game_log(spark, SF_SMALL))
    full = recent_games(feat.player_features(s), "Customer#000000019")
    fast = recent_games_from_silver(s, "Customer#000000019")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, fast.collect()))
    assert fast.count() == 18


def test_warehouse_job(spark):
    from panelforge.plans.jobs import warehouse_job
    from panelforge.plans.runlog import RunLog
    from panelforge.session import scratch_path
    from panelforge.sources.ingest import write_landing
    landing = scratch_path(spark, "t-wh-landing")
    write_landing(game_log(spark, SF_SMALL), landing)
    root = scratch_path(spark, "t-wh")
    seasons = [str(y) for y in range(1995, 2002)] + ["1900"]
    out = warehouse_job(spark, landing, seasons, root, "2001-08-01", full_refresh=True,
                        batch_ts="2024-01-01 00:00:00")
    assert out["failed_seasons"] == ["1900"]
    assert spark.read.parquet(out["gold"]).count() == 1500
    from panelforge.plans.reports import recent_games_from_table
    rg = recent_games_from_table(spark, out["gold"], "Customer#000000019")
    assert rg.count() == 18
    plan = rg._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(player_name), EqualTo(player_name,Customer#000000019)]" in plan
    log = {r["layer"]: r for r in RunLog(spark, out["run_log"]).read().collect()}
    assert log["bronze"]["status"] == "partial" and log["bronze"]["rows_processed"] == 1500
    assert log["silver"]["rows_processed"] == 1500 and log["quality"]["status"] == "success"
    # a second incremental run only touches the lookback window and keeps all rows
    warehouse_job(spark, landing, seasons[:-1], root, "2001-08-01", batch_ts="2024-01-02 00:00:00")
    from panelforge.operators.upsert import read_table
    b = read_table(spark, out["bronze"])
    assert b.count() == 1500
    assert b.where(F.col("INGESTED_AT") == "2024-01-02 00:00:00").count() == 20


def test_namespaces_and_views(spark):
    from panelforge.plans.catalog import create_views, init_namespaces, register_tables, table_exists
    from panelforge.plans.silver import silver
    from panelforge.session import scratch_path
    init_namespaces(spark)
    s = silver(game_log(spark, SF_SMALL))
    path = scratch_path(spark, "t-silver-named")
    s.write.parquet(path)
    register_tables(spark, {"silver.player_game_logs": path}, {"silver.player_game_logs": s.schema})
    create_views(spark)
    other = spark.newSession()
    assert table_exists(other, "gold.opponent_ranks") and not table_exists(other, "gold.opponents_ranks")
    assert other.table("gold.opponent_ranks").count() == other.table("gold.opponent_allowed").count() > 0


def test_forest_beats_mean_predictor(spark, gl):
    from panelforge.plans.model import regression_metrics, train_model
    f5 = feat.features_last5(typed_raw(gl))
    _, preds, cols = train_model(f5, num_trees=10, max_depth=5)
    assert preds.count() == 265 and len(cols) == 8
    m = regression_metrics(preds, "PTS_NEXT_GAME", "PRED_PTS_NEXT_GAME").first()
    mean_y = preds.agg(F.avg("PTS_NEXT_GAME")).first()[0]
    base = regression_metrics(preds.withColumn("mu", F.lit(mean_y)), "PTS_NEXT_GAME", "mu").first()
    assert m["n"] == 265 and m["mae"] < base["mae"] * 1.05


def test_order_measures_move_lineitem_once(spark):
    from panelforge.sources.fixtures import order_measures
    li = spark.createDataFrame([(1, 5.0, 1, 2, 3), (1, 6.0, 1, 2, 4), (1, 7.0, 2, None, 4), (2, 1.0, 1, None, None),
                                (None, 9.0, 1, 1, 1)],
                               "l_orderkey long, l_quantity double, l_linenumber int, l_suppkey long, l_partkey long")
    got = order_measures(li)
    assert got._jdf.queryExecution().sparkPlan().toString().count("Expand") == 0
    assert {(r["l_orderkey"], r["q"], r["n"], r["ns"], r["np"]) for r in got.collect()} == {(1, 18, 3, 1, 2), (2, 1, 1, 0, 0)}
