"""Physical-plan shape: pruning, exchanges, broadcasts (read from explain)."""

import os

import pytest
from pyspark.sql import functions as F

from panelforge.plans import features as feat
from panelforge.plans.silver import silver
from panelforge.sources.fixtures import bronze_log

from .conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="test tables missing")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def s(spark):
    return silver(bronze_log(spark, SF_SMALL))


def test_window_plan_one_exchange_and_checked_broadcast(s):
    txt = plan_text(feat.player_features(s, strategy="window"))
    # rows side: one hash exchange on player_id feeding one shared Window
    assert txt.count("hashpartitioning(player_id") == 1
    assert "BroadcastHashJoin" in txt and "CartesianProduct" not in txt
    assert "SortMergeJoin" not in txt


def test_positions_plan_range_partitioned(spark, s):
    from panelforge.operators.rolling import position_rows
    base = s.select("player_id", "game_date", "game_id", "season", "pts")
    p = position_rows(base, ["player_id"], feat.W_ORDER)
    # the materialised rows come from a range exchange on the full order key
    ranged = base.repartitionByRange(F.col("player_id").asc_nulls_last(),
                                     F.col("game_date").asc_nulls_last())
    assert "rangepartitioning(player_id" in plan_text(ranged)
    # after the lineage cut the positions are a scan plus a tiny broadcast
    txt = plan_text(p)
    assert "FileScan parquet" in txt and "BroadcastHashJoin" in txt
    assert "rangepartitioning" not in txt


def test_scan_reads_only_needed_columns(s):
    from panelforge.operators.opponents import opponent_allowed
    txt = plan_text(opponent_allowed(s))
    read = [ln for ln in txt.splitlines() if "ReadSchema" in ln][0]
    schema = read.split("ReadSchema:")[1]
    for col in ["SEASON", "MATCHUP", "PTS", "REB", "AST"]:
        assert col in schema
    for col in ["PLAYER_NAME", "FG3A", "INGESTED_AT"]:
        assert col not in schema
    assert "partial_avg" in txt  # map-side combine before the shuffle


def test_player_filter_pushed_to_scan(spark, s):
    df = feat.player_features(s, strategy="window").where(F.col("player_id") == 7)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    win = next(i for i, ln in enumerate(lines) if "Window [" in ln)
    flt = next(i for i, ln in enumerate(lines) if "PLAYER_ID" in ln and "= 7)" in ln)
    # the filter sits below the Window, right above the scan
    assert flt > win and "Relation" in lines[flt + 1]


def test_no_cartesian_products(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for key in ["residual_zscore", "residual_kde", "residual_histogram", "regression_metrics",
                "upsert", "dq_report"]:
        txt = plan_text(qs[key](spark, SF_SMALL))
        assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt, key
