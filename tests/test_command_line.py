"""The jobs as started by spark-submit."""

import pytest
from pyspark.sql import functions as F

from panelforge.operators.upsert import read_table
from panelforge.plans import jobs
from panelforge.session import scratch_path
from panelforge.sources.fixtures import game_log
from panelforge.sources.ingest import write_landing

from .conftest import SF_SMALL


def test_warehouse_then_ml(spark, capsys):
    landing, root, out = (scratch_path(spark, f"t-cli-{n}") for n in ("landing", "root", "out"))
    log = game_log(spark, SF_SMALL)
    write_landing(log, landing)
    common = ["warehouse", "--landing", landing, "--root", root, "--as-of", "1997-06-30"]
    jobs.main([*common, "--seasons", "1995,1996", "--full-refresh"])
    assert "silver keys not null" in capsys.readouterr().out  # the report of the checks
    per = {r["SEASON"]: r["count"] for r in log.groupBy("SEASON").count().collect()}
    bronze = read_table(spark, f"{root}/bronze")
    assert {r["SEASON"]: r["count"] for r in bronze.groupBy("SEASON").count().collect()} == {
        s: per[s] for s in ("1995", "1996")}
    gold = f"{root}/gold_player_features"
    assert read_table(spark, gold).count() == per["1995"] + per["1996"]

    jobs.main([*common, "--seasons", "1997", "--lookback", "30"])  # the games of June follow
    june = log.where(F.col("GAME_DATE").between("1997-05-31", "1997-06-30")).count()
    assert june > 0 and read_table(spark, gold).where(F.col("season") == "1997").count() == june

    jobs.main(["ml", "--bronze", f"{root}/bronze", "--out", out, "--trees", "2", "--depth", "3"])
    ranked = spark.read.parquet(out)
    assert ranked.count() > 0 and {"PRED_PTS_NEXT_GAME"} <= set(ranked.columns)


@pytest.mark.parametrize("args", [[], ["warehouse"], ["ml", "--bronze", "x"], ["other"]])
def test_missing_arguments_end_the_program(args):
    with pytest.raises(SystemExit):
        jobs.main(args)
