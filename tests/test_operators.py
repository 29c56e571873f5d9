"""Ranks, anomalies, histogram, split, quality checks, reports (G1-G9)."""

import pytest
from pyspark.sql import functions as F

from panelforge.operators.anomalies import compute_anomalies, with_label, with_zscore
from panelforge.operators.histogram import histogram, kde
from panelforge.operators.opponents import dense_ranks
from panelforge.operators.split import ordered_split, n_test_rows
from panelforge.plans import quality as dq
from panelforge.plans.model import regression_metrics
from panelforge.plans.reports import recent_games, trend_series

from .conftest import rows


def _avgs(spark):
    return spark.createDataFrame([("s", "a", 5.0), ("s", "b", 5.0), ("s", "c", 7.0), ("s", "d", None)],
                                 "season string, team string, x double")


def test_dense_rank_sql_nulls_last(spark):
    out = dense_ranks(_avgs(spark), ["season"], [("r", "x")], "last", "long").orderBy("team")
    assert rows(out, "r") == [1, 1, 2, 3]
    assert dict(out.dtypes)["r"] == "bigint"


def test_dense_rank_pandas_null(spark):
    out = dense_ranks(_avgs(spark), ["season"], [("r", "x")], "null", "double").orderBy("team")
    assert rows(out, "r") == [1.0, 1.0, 2.0, None]
    assert dict(out.dtypes)["r"] == "double"


def test_label(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 0.0, -1.0, None, float("nan")])],
                               "i int, RESIDUAL double")
    out = with_label(df).orderBy("i")
    assert rows(out, "ANOMALY_TYPE") == ["OVERPERFORM", "UNDERPERFORM", "UNDERPERFORM",
                                         "UNDERPERFORM", "UNDERPERFORM"]


def test_zscore_population(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "RESIDUAL double")
    assert sorted(rows(with_zscore(df), "RESIDUAL_ZSCORE")) == [-1.0, 1.0]


def test_zscore_no_spread(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "RESIDUAL double")
    assert rows(with_zscore(df), "RESIDUAL_ZSCORE") == [None, None]


def test_anomaly_sort_nan_last(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, float("nan"), 1.0), (3, 9.0, 1.0)],
                               "k int, PTS double, PRED double")
    out = compute_anomalies(df, "PTS", "PRED", ["k"])
    assert rows(out, "k") == [3, 1, 2]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in range(41)], "x double")
    h = histogram(df, "x", 40).orderBy("bin")
    counts = rows(h, "count")
    assert len(counts) == 40 and sum(counts) == 41
    assert counts[-1] == 2 and counts[0] == 1


def test_histogram_constant_and_missing(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    h = histogram(df, "x", 4)
    assert sum(rows(h, "count")) == 2


def test_kde_integrates_to_one(spark):
    df = spark.createDataFrame([(float(v % 17),) for v in range(300)], "x double")
    k = kde(df, "x", gridsize=200, cut=3).orderBy("point").collect()
    step = k[1]["x"] - k[0]["x"]
    assert abs(sum(r["density"] for r in k) * step - 1.0) < 0.01


def test_ordered_split_11(spark):
    df = spark.createDataFrame([(i,) for i in range(11)], "k int")
    s = ordered_split(df, ["k"], 0.2)
    assert rows(s.where(F.col("SPLIT") == "test").orderBy("k"), "k") == [8, 9, 10]
    assert s.where(F.col("SPLIT") == "train").count() == 8
    assert n_test_rows(13271, 0.2) == 2655


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "y double, p double")
    r = regression_metrics(df, "y", "p").first()
    assert r["n"] == 3 and abs(r["mae"] - 1 / 3) < 1e-12
    assert abs(r["r2"] - (1 - 1 / 2)) < 1e-12


def test_rank_range_check(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (30,), (31,)], "r int")
    rep = dq.run_checks([dq.Check("range", df, dq.out_of_range("r"), lambda v: v == 0)]).first()
    assert rep["value"] == 2 and rep["ok"] is False


def test_checks_all_evaluated_then_raise(spark):
    df = spark.createDataFrame([(None, 1), (2, 3)], "a int, b int")
    checks = [dq.Check("rows", df, dq.has_rows(), lambda v: v > 0),
              dq.Check("a not null", df, dq.null_keys(["a"]), lambda v: v == 0),
              dq.Check("b range", df, dq.out_of_range("b", 1, 2), lambda v: v == 0)]
    rep = dq.run_checks(checks)
    assert rows(rep, "check", "ok") == [("rows", True), ("a not null", False), ("b range", False)]
    with pytest.raises(dq.QualityError) as e:
        dq.assert_checks(rep)
    assert "a not null" in str(e.value) and "b range" in str(e.value)


def test_recent_games_null_date_first(spark):
    import datetime as dt
    cols = ["game_date", "team", "opponent_team", "minutes", "pts", "reb", "ast", "pts_last3",
            "reb_last3", "ast_last3", "min_last3", "opp_pts_allowed_rank",
            "opp_reb_allowed_rank", "opp_ast_allowed_rank"]
    base = dict.fromkeys(cols)
    data = []
    for gid, d in [("1", dt.date(2020, 1, 1)), ("2", None), ("3", dt.date(2020, 1, 3))]:
        r = dict(base, game_date=d, pts=1.0, pts_last3=1.0, minutes=1.0, min_last3=1.0)
        data.append((gid, "x", *[r[c] for c in cols]))
    schema = ("game_id string, player_name string, game_date date, team string, "
              "opponent_team string, minutes double, pts double, reb double, ast double, "
              "pts_last3 double, reb_last3 double, ast_last3 double, min_last3 double, "
              "opp_pts_allowed_rank bigint, opp_reb_allowed_rank bigint, opp_ast_allowed_rank bigint")
    feats = spark.createDataFrame(data, schema)
    rg = recent_games(feats, "x", 2)
    assert rows(rg, "game_date") == [None, dt.date(2020, 1, 3)]
    assert trend_series(rg).count() == 8


def test_checked_broadcast(spark):
    from panelforge.operators import joins
    side, fits = joins.checked_broadcast(spark.range(10), max_rows=100)
    assert fits and side.count() == 10
    assert not joins.checked_broadcast(spark.range(1000), max_rows=100)[1]
    assert not joins.checked_broadcast(spark.range(100_000), max_bytes=1000)[1]
    out = joins.join_small(spark.range(5), spark.range(3), "id", "inner")
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    out = joins.join_small(spark.range(5), spark.range(3), "id", "inner", max_rows=2)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 3


def test_small_side_is_fresh_and_not_cached(spark):
    from panelforge.operators import joins
    from panelforge.session import scratch_path
    path = scratch_path(spark, "t-side")
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    spark.range(3).write.parquet(path)
    big = spark.range(10)
    assert joins.join_small(big, spark.read.parquet(path), "id", "inner").count() == 3
    spark.range(3, 6).write.mode("append").parquet(path)
    assert joins.join_small(big, spark.read.parquet(path), "id", "inner").count() == 6
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_recent_games_sql_bound_parameter(spark):
    import datetime as dt

    from panelforge.plans.reports import recent_games_sql
    from panelforge.schemas import RECENT_GAME_COLS
    cols = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in RECENT_GAME_COLS
                     if c not in ("game_date", "team", "opponent_team"))
    spark.sql(f"SELECT 'x''; DROP' AS player_name, 'g1' AS game_id, DATE'2020-01-02' AS game_date, "
              f"'T' AS team, 'O' AS opponent_team, {cols}").createOrReplaceTempView("t_pf")
    out = recent_games_sql(spark, "t_pf", "x'; DROP", 50).collect()
    assert len(out) == 1 and out[0]["game_date"] == dt.date(2020, 1, 2)
    assert recent_games_sql(spark, "t_pf", "nobody").count() == 0
