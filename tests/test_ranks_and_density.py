"""Ranks by positions, the binned density, and plans that write only what is asked for."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import histogram as hist
from panelforge.operators.opponents import dense_ranks
from panelforge.plans import features as feat
from panelforge.sources.fixtures import bronze_log

from .conftest import SF_SMALL
from .test_plans import plan_text


@pytest.mark.parametrize("null_rank,rank_type", [("last", "long"), ("null", "double")])
def test_ranks_by_position_are_dense_ranks(spark, null_rank, rank_type):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 5 + ["a", "b", None]), i, rng.choice([None, float("nan"), 0.0, -0.0, *range(9)]),
             rng.choice([None, 1.5, 2.5])) for i in range(600)] + [("empty", 999, None, None)]
    df = spark.createDataFrame([(p, i, None if x is None else float(x), y) for p, i, x, y in rows],
                               "p string, i int, x double, y double")
    spec = ([("rx", "x"), ("ry", "y")], null_rank, rank_type)
    small = dense_ranks(df, ["p"], *spec)
    large = dense_ranks(df, ["p"], *spec, window_rows=10)
    assert "dense_rank(" not in plan_text(large)
    assert small.dtypes == large.dtypes
    key = lambda r: r["i"]
    same = [(a["rx"], a["ry"]) == (b["rx"], b["ry"]) for a, b in zip(sorted(small.collect(), key=key), sorted(large.collect(), key=key))]
    assert len(same) == 601 and all(same)


def direct_density(x, points):
    bw = x.std(ddof=1) * len(x) ** -0.2
    return np.exp(-0.5 * ((points[:, None] - x[None, :]) / bw) ** 2).sum(axis=1) / (len(x) * bw * np.sqrt(2 * np.pi))


def test_binned_density_is_the_direct_one(spark):
    rng = np.random.default_rng(2)
    for x in (rng.normal(0, 5, 3000), np.r_[rng.gamma(2, 3, 2000), 400.0], np.r_[np.zeros(50), 1e6 + np.arange(50)]):
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double")
        out = hist.kde(df, "x").orderBy("point").collect()
        points = np.linspace(x.min(), x.max(), 200)
        want = direct_density(x, points)
        assert [r["point"] for r in out] == list(range(200))
        assert np.abs(np.array([r["density"] for r in out]) - want).max() <= 5.1e-7
        scale = len(x) * (x.max() - x.min()) / 40
        assert np.allclose([r["count_density"] for r in out], want * scale, rtol=1e-9, atol=1e-6)
    text = plan_text(hist.kde(df, "x"))
    assert "Python" not in text and "MapInArrow" not in text and "CartesianProduct" not in text


def test_only_what_is_asked_for_is_written(spark):
    raw = feat.typed_raw(bronze_log(spark, SF_SMALL))
    narrow = feat.features_last5(raw, columns=["GAME_ID", "PTS_LAST5"])
    text = plan_text(narrow)
    scanned = " ".join(ln.split("ReadSchema:")[1] for ln in text.splitlines() if "ReadSchema" in ln)
    assert "PTS" in scanned and "FG3A" not in scanned and "MATCHUP" not in scanned
    whole = feat.features_last5(raw)
    for columns in (["GAME_ID", "PRA_LAST5"], ["GAME_ID", "OPP_AST_ALLOWED_RANK", "OPPONENT_TEAM"], ["SEASON", "PTS_NEXT_GAME", "FG3A"]):
        part = feat.features_last5(raw, columns=columns)
        assert part.columns == columns
        assert part.exceptAll(whole.select(*columns)).count() == 0 and part.count() == whole.count()


def test_counts_need_no_window(spark):
    from panelforge.plans.registry import _counted, _silver
    plan = _counted(_silver(spark, SF_SMALL)).agg(F.count(F.lit(1)), F.max("opp_pts_allowed_rank"))
    text = plan_text(plan)
    assert "lead(" not in text and "windowspecdefinition(player_id" not in text and "hashpartitioning(player_id" not in text
