"""The feed's data source: retries, failures as rows, pushed date bounds."""

import pytest
from pyspark.sql import types as T

from panelforge.session import scratch_path
from panelforge.sources import feed
from panelforge.sources.ingest import write_landing

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("GAME_ID", "GAME_DATE")] + [T.StructField("PLAYER_ID", T.LongType())])


def landing(spark, seasons="ab"):
    root = scratch_path(spark, "t-feed")
    rows = [(s, f"{i:04d}", f"2001-01-{i % 28 + 1:02d}", i) for s in seasons for i in range(60)]
    write_landing(spark.createDataFrame(rows, "SEASON string, GAME_ID string, GAME_DATE string, PLAYER_ID long"), root)
    return root


def test_attempts_and_back_off():
    slept, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("not yet")
        return "rows"

    assert feed.attempt(flaky, 4, 2.0, slept.append) == ("rows", 3, None)
    assert [int(s // 2 * 2) for s in slept] == [2, 4] and all(0 <= s - b <= 1 for s, b in zip(slept, (2, 4)))
    result, n, error = feed.attempt(lambda: 1 / 0, 4, 0.5, slept.append)
    assert (result, n) == (None, 4) and isinstance(error, ZeroDivisionError) and len(slept) == 5


def test_rows_missing_columns_and_bounds(spark):
    root = landing(spark)
    wide = T.StructType([*SCHEMA.fields, T.StructField("TOV", T.StringType())])
    got = feed.read_feed(spark, root, ["a", "b"], wide, "2001-01-03", "2001-01-04").collect()
    assert {r["GAME_DATE"] for r in got} == {"2001-01-03", "2001-01-04"} and {r["SEASON"] for r in got} == {"a", "b"}
    assert all(r["TOV"] is None and r["_attempts"] == 1 and r["_error"] is None for r in got)
    assert feed.read_feed(spark, root, ["a"], SCHEMA).count() == 60


def test_a_broken_page_fails_only_its_season(spark):
    root = landing(spark, "abc")
    jvm = spark.sparkContext._jvm
    names = [str(f) for f in spark.read.parquet(f"{root}/SEASON=b").inputFiles()]
    path = names[0].replace("file://", "").replace("file:", "")
    data = bytearray(open(path, "rb").read())
    data[4:len(data) // 3] = b"\xff" * (len(data) // 3 - 4)  # pages, not the footer
    open(path, "wb").write(data)
    assert jvm is not None
    res = feed.feed_load(spark, root, ["a", "b", "c", "none"], SCHEMA, "t0", attempts=2, base_sleep=0.01)
    assert res.loaded == ["a", "c"] and res.failed == ["b", "none"] and set(res.errors) == {"b", "none"}
    assert res.frame.count() == 120 and res.frame.columns[-1] == "INGESTED_AT"
    assert feed.feed_load(spark, root, ["none"], SCHEMA, attempts=1).frame is None


@pytest.mark.parametrize("files", [3])
def test_a_task_per_file(spark, files):
    root = scratch_path(spark, "t-feed-files")
    spark.range(90).selectExpr("cast(id as string) GAME_ID", "'2001-01-01' GAME_DATE", "id PLAYER_ID").repartition(files).write.parquet(f"{root}/SEASON=a")
    df = feed.read_feed(spark, root, ["a"], SCHEMA)
    assert df.rdd.getNumPartitions() == files and df.count() == 90
