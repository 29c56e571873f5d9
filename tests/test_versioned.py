"""Tables whose changes become visible at once, and what is built on them."""

import pytest
from pyspark.sql import functions as F

from panelforge.operators import upsert as ups
from panelforge.operators.versioned import CommitConflict, VersionedTable
from panelforge.session import scratch_path

from .conftest import rows

KEYS = ["SEASON", "GAME_ID", "PLAYER_ID"]


def batch(spark, data):
    return spark.createDataFrame(data, "SEASON string, GAME_ID string, PLAYER_ID bigint, PTS string, INGESTED_AT string")


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_failure_between_two_partitions_changes_nothing(spark):
    path = scratch_path(spark, "t-atomic")
    ups.upsert_table(spark, path, batch(spark, [(s, "1", 1, "1", "t0") for s in "abc"]), KEYS)
    before = content(ups.read_table(spark, path))
    # season b fails while a's new folder is being written
    bad = batch(spark, [("a", "1", 1, "2", "t1"), ("b", "9", 1, "2", "t1")])
    table = VersionedTable(spark, path, "SEASON")
    broken = ups.upsert(table.read(), bad, KEYS).withColumn(
        "PTS", F.when(F.col("GAME_ID") == "9", F.raise_error(F.lit("lost"))).otherwise(F.col("PTS")))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    # all folders are there, but the commit does not happen
    with pytest.raises(ZeroDivisionError):
        ups.upsert_table(spark, path, bad, KEYS, check=lambda t: 1 / 0)
    assert content(ups.read_table(spark, path)) == before
    out = ups.upsert_table(spark, path, bad, KEYS)
    assert sorted(rows(out, "SEASON", "GAME_ID", "INGESTED_AT")) == [
        ("a", "1", "t1"), ("b", "1", "t0"), ("b", "9", "t1"), ("c", "1", "t0")]
    assert len(table.vacuum(keep=2)) == 0  # the upsert has dropped what died


def test_two_writers_conflict(spark):
    path = scratch_path(spark, "t-conflict")
    table = VersionedTable(spark, path, "SEASON")
    first = batch(spark, [("a", "1", 1, "1", "t0")])
    table.create(first)

    def other_writer(_):
        VersionedTable(spark, path, "SEASON").replace(batch(spark, [("b", "1", 1, "1", "t0")]))

    with pytest.raises(CommitConflict):
        table.replace(first, check=other_writer)
    assert rows(table.read(), "SEASON") == ["b"]


def test_old_versions_stay_readable_until_vacuum(spark):
    path = scratch_path(spark, "t-vacuum")
    table = VersionedTable(spark, path, "SEASON")
    table.create(batch(spark, []))
    for i in range(4):
        table.replace(batch(spark, [("a/b", str(i), 1, "1", "t0"), (None, str(i), 1, "1", "t0")]))
    assert rows(table.read(version=2), "GAME_ID") == ["1", "1"]
    assert len(table.vacuum(keep=1)) == 6
    assert sorted(rows(table.read(), "SEASON", "GAME_ID"), key=str) == [("a/b", "3"), (None, "3")]
    assert rows(table.read([table.folder("a/b")]), "GAME_ID") == ["3"]
    table.replace(batch(spark, []), drop=[table.folder(None)])
    assert rows(table.read(), "SEASON") == ["a/b"]
    assert table.read(version=0).count() == 0


def test_new_seasons_do_not_read_old_folders(spark):
    path = scratch_path(spark, "t-touched")
    ups.upsert_table(spark, path, batch(spark, [(s, "1", 1, "1", "t0") for s in "ab"]), KEYS)
    table = VersionedTable(spark, path, "SEASON")
    before = table.manifest()["parts"]
    ups.upsert_table(spark, path, batch(spark, [("b", "2", 1, "1", "t1"), ("c", "1", 1, "1", "t1")]), KEYS)
    after = table.manifest()["parts"]
    assert after["SEASON=a"] == before["SEASON=a"] and after["SEASON=b"] != before["SEASON=b"]
    assert all("SEASON=a" not in f for f in table.read(["SEASON=b"]).inputFiles())


def test_silver_follows_bronze_whatever_died(spark):
    from panelforge.plans.jobs import refresh_silver
    from panelforge.schemas import BRONZE_KEYS, BRONZE_TEXT_SCHEMA
    root = scratch_path(spark, "t-silver")

    def bronze(season, games, pts="3"):
        d = {f.name: None for f in BRONZE_TEXT_SCHEMA.fields}
        return spark.createDataFrame(
            [tuple(dict(d, SEASON=season, GAME_ID=str(g), PLAYER_ID=1, GAME_DATE="2020-01-01", PTS=pts)[f.name]
                   for f in BRONZE_TEXT_SCHEMA.fields) for g in range(games)], BRONZE_TEXT_SCHEMA)

    ups.upsert_table(spark, f"{root}/bronze", bronze("a", 3).union(bronze("b", 2)), BRONZE_KEYS)
    spark.range(3).write.parquet(f"{root}/silver/season=a")  # left by a run that died
    assert refresh_silver(spark, f"{root}/bronze", f"{root}/silver").groupBy("season").count().count() == 2
    ups.upsert_table(spark, f"{root}/bronze", bronze("c", 4), BRONZE_KEYS)  # this run dies here
    ups.upsert_table(spark, f"{root}/bronze", bronze("b", 5), BRONZE_KEYS)
    silver = VersionedTable(spark, f"{root}/silver", "season")
    made = silver.manifest()["parts"]
    s = refresh_silver(spark, f"{root}/bronze", f"{root}/silver")
    assert sorted(rows(s.groupBy("season").count(), "season", "count")) == [("a", 3), ("b", 5), ("c", 4)]
    assert silver.manifest()["parts"]["season=a"] == made["season=a"]  # unchanged seasons are not rewritten
    version = silver.manifest()["version"]
    refresh_silver(spark, f"{root}/bronze", f"{root}/silver")
    assert silver.manifest()["version"] == version


def test_checks_measured_by_the_write(spark):
    from panelforge.plans import quality as dq
    df = spark.createDataFrame([(1, "x"), (50, None), (None, "y")], "r int, k string")
    checks = [dq.Check("range", df, dq.out_of_range("r"), lambda v: v == 0), dq.Check("keys", df, dq.null_keys(["k"]), lambda v: v == 1)]
    path = scratch_path(spark, "t-observed")
    n, values = dq.observed_write(df, lambda d: d.write.parquet(path), checks)
    assert (n, values) == (3, [1, 1]) and spark.read.parquet(path).count() == 3
    assert [tuple(r) for r in dq.measured_report(spark, list(zip(checks, values))).collect()] == [
        tuple(r) for r in dq.run_checks(checks).collect()]
    assert dq.observed_write(df.limit(0), lambda d: d.write.mode("overwrite").parquet(path), checks) == (0, [0, 0])
