"""Keyed upsert, table upsert with partition overwrite, ingestion helpers,
run log and run status."""

import pytest

from panelforge.operators import upsert as ups
from panelforge.plans.runlog import RunLog, run_layer
from panelforge.session import scratch_path
from panelforge.sources import ingest

from .conftest import rows

KEYS = ["SEASON", "GAME_ID", "PLAYER_ID"]
SCHEMA = "SEASON string, GAME_ID string, PLAYER_ID bigint, PTS string, INGESTED_AT string"


def _t(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_upsert_default_updates_only_ingested_at(spark):
    tgt = _t(spark, [("s", "1", 1, "10", "t0"), ("s", "2", 1, "20", "t0")])
    bat = _t(spark, [("s", "2", 1, "99", "t1"), ("s", "3", 1, "30", "t1")])
    out = ups.upsert(tgt, bat, KEYS).orderBy("GAME_ID")
    assert rows(out, "GAME_ID", "PTS", "INGESTED_AT") == [
        ("1", "10", "t0"), ("2", "20", "t1"), ("3", "30", "t1")]
    allc = ups.upsert(tgt, bat, KEYS, update_cols=None).orderBy("GAME_ID")
    assert rows(allc, "PTS") == ["10", "99", "30"]


def test_upsert_duplicate_key_in_batch_fails(spark):
    tgt = _t(spark, [("s", "1", 1, "10", "t0")])
    bat = _t(spark, [("s", "2", 1, "1", "t1"), ("s", "2", 1, "2", "t1")])
    with pytest.raises(Exception) as e:
        ups.upsert(tgt, bat, KEYS).collect()
    assert "duplicate key" in str(e.value)


def test_upsert_null_keys_always_inserted(spark):
    tgt = _t(spark, [("s", None, 1, "10", "t0")])
    bat = _t(spark, [("s", None, 1, "11", "t1"), ("s", None, 1, "12", "t1")])
    assert ups.upsert(tgt, bat, KEYS).count() == 3


def test_upsert_idempotent_and_unique(spark):
    tgt = _t(spark, [("s", str(i), i % 3, str(i), "t0") for i in range(30)])
    bat = _t(spark, [("s", str(i), i % 3, str(i + 1), "t1") for i in range(20, 40)])
    once = ups.upsert(tgt, bat, KEYS)
    twice = ups.upsert(once, bat, KEYS)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert ups.duplicate_keys(once, KEYS).count() == 0 and once.count() == 40


def test_upsert_table_touches_only_batch_partitions(spark):
    path = scratch_path(spark, "t-bronze")
    ups.upsert_table(spark, path, _t(spark, [("a", "1", 1, "1", "t0"), ("b", "2", 1, "2", "t0")]), KEYS)
    out = ups.upsert_table(spark, path, _t(spark, [("b", "2", 1, "5", "t1"), ("b", "3", 1, "3", "t1")]),
                           KEYS).orderBy("SEASON", "GAME_ID")
    assert rows(out, "SEASON", "GAME_ID", "PTS", "INGESTED_AT") == [
        ("a", "1", "1", "t0"), ("b", "2", "2", "t1"), ("b", "3", "3", "t1")]


def test_create_like_empty_and_idempotent(spark):
    path = scratch_path(spark, "t-like")
    like = _t(spark, [("s", "1", 1, "10", "t0")])
    assert ups.create_like(spark, path, like) is True
    assert ups.create_like(spark, path, like) is False
    t = ups.read_table(spark, path)
    assert t.count() == 0 and t.columns == like.columns


def test_incremental_bounds_inclusive(spark):
    df = spark.createDataFrame([("2001-07-17",), ("2001-07-18",), ("2001-08-01",), ("2001-08-02",)],
                               "GAME_DATE string")
    got = rows(ingest.incremental(df, "2001-08-01", 14), "GAME_DATE")
    assert got == ["2001-07-18", "2001-08-01"]
    assert ingest.incremental(df, "2001-08-01", 14, full_refresh=True).count() == 4


def test_union_missing_column_is_null(spark):
    a = spark.createDataFrame([(1, 2)], "k int, TOV int")
    b = spark.createDataFrame([(3,)], "k int")
    out = ingest.union_by_name([a, b]).orderBy("k")
    assert rows(out, "TOV") == [2, None]


def test_isolated_load_records_failures(spark):
    root = scratch_path(spark, "t-landing")
    df = spark.createDataFrame([("x", "1"), ("y", "2")], "SEASON string, v string")
    ingest.write_landing(df, root, drop_cols=())
    res = ingest.isolated_load(spark, root, ["x", "missing", "y"], batch_ts="t")
    assert res.loaded == ["x", "y"] and res.failed == ["missing"]
    assert res.frame.count() == 2


@pytest.mark.parametrize("failed,status", [([], "success"), (["b"], "partial"),
                                           (["a", "b"], "warning")])
def test_bronze_status(failed, status):
    st, msg = ingest.bronze_status(["a", "b"], failed)
    assert st == status
    assert (msg is None) == (not failed)


def test_run_log_layers(spark):
    log = RunLog(spark, scratch_path(spark, "t-runlog"))
    log.create()
    with run_layer(log, "silver", "r1") as h:
        h.rows = 5_000_000_000  # more than 32 bits hold
    with pytest.raises(ValueError):
        with run_layer(log, "gold", "r2"):
            raise ValueError("boom" * 1000)
    got = {r["run_id"]: r for r in log.read().collect()}
    assert got["r1"]["status"] == "success" and got["r1"]["rows_processed"] == 5_000_000_000
    assert got["r2"]["status"] == "failure" and got["r2"]["rows_processed"] is None
    assert len(got["r2"]["error_message"]) == 2000
    log.append("r3", "quality", "warning", None, error="")
    assert log.read().where("run_id = 'r3'").first()["error_message"] is None


def test_upsert_table_keeps_null_season_rows(spark):
    path = scratch_path(spark, "t-null-season")
    ups.upsert_table(spark, path, _t(spark, [(None, "1", 1, "1", "t0"), ("2000", "2", 1, "2", "t0")]), KEYS)
    out = ups.upsert_table(spark, path, _t(spark, [(None, "3", 1, "3", "t1"), ("2000", "4", 1, "4", "t1")]), KEYS)
    assert sorted(rows(out, "GAME_ID")) == ["1", "2", "3", "4"]
    out = ups.upsert_table(spark, path, _t(spark, [(None, "5", 1, "5", "t2")]), KEYS)
    assert sorted(rows(out, "GAME_ID")) == ["1", "2", "3", "4", "5"]


def test_upsert_table_batch_without_a_column(spark):
    path = scratch_path(spark, "t-missing-col")
    ups.upsert_table(spark, path, _t(spark, [("a", "1", 1, "9", "t0")]), KEYS)
    batch = _t(spark, [("a", "1", 1, "0", "t1"), ("a", "2", 1, "0", "t1")]).drop("PTS")
    out = ups.upsert_table(spark, path, batch, KEYS).orderBy("GAME_ID")
    assert rows(out, "GAME_ID", "PTS", "INGESTED_AT") == [("1", "9", "t1"), ("2", None, "t1")]
    with pytest.raises(ValueError, match="EXTRA"):
        ups.upsert_table(spark, path, batch.selectExpr("*", "1 AS EXTRA"), KEYS)


def test_upsert_table_reads_only_touched_partitions(spark):
    path = scratch_path(spark, "t-pruned")
    ups.upsert_table(spark, path, _t(spark, [(s, "1", 1, "1", "t0") for s in "abc"]), KEYS)
    batch = _t(spark, [("b", "2", 1, "1", "t1"), (None, "3", 1, "1", "t1")])
    plan = ups.read_table(spark, path).where(ups.touched_partitions(batch, "SEASON"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    filters = text[text.index("PartitionFilters"):text.index("PushedFilters")]
    assert "b" in filters and "isnull" in filters


def test_lookback_bounds_reach_the_scan(spark):
    path = scratch_path(spark, "t-lookback")
    spark.createDataFrame([("2001-07-17",), ("2001-07-18",), ("2001-08-01 20:00:00",), ("2001-08-02",), (None,)],
                          "GAME_DATE string").write.parquet(path)
    df = ingest.incremental(spark.read.parquet(path), "2001-08-01")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(GAME_DATE,2001-07-18)" in text and "LessThan(GAME_DATE,2001-08-02)" in text
    assert sorted(rows(df, "GAME_DATE")) == ["2001-07-18", "2001-08-01 20:00:00"]


def test_partitioned_replace_replaces(spark):
    root = scratch_path(spark, "t-replace")
    feed = _t(spark, [(s, str(i), 1, "1", "t0") for s in "ab" for i in range(5)])
    ingest.write_landing(feed, root)
    ingest.write_landing(feed.where("SEASON = 'b'").limit(2), root)
    assert spark.read.parquet(root).count() == 2


def test_unreadable_file_fails_only_its_season(spark):
    root = scratch_path(spark, "t-junk")
    ingest.write_landing(_t(spark, [("a", "1", 1, "1", "t0")]), root)
    spark.createDataFrame([("junk",)], "v string").coalesce(1).write.text(f"{root}/SEASON=z")
    res = ingest.isolated_load(spark, root, ["a", "z"], _t(spark, []).drop("SEASON", "INGESTED_AT").schema)
    assert res.loaded == ["a"] and res.failed == ["z"] and res.frame.count() == 1


def test_stream_takes_the_newest_file_of_a_key(spark):
    from panelforge.streaming.stream_upsert import newest_file
    df = spark.sql("""SELECT * FROM VALUES ('a', '1', 1, 'old', named_struct('t', 1, 'f', 'x')),
        ('a', '1', 1, 'new', named_struct('t', 2, 'f', 'x')), ('a', null, 1, 'n1', named_struct('t', 1, 'f', 'x')),
        ('a', null, 1, 'n2', named_struct('t', 2, 'f', 'y')) AS v(SEASON, GAME_ID, PLAYER_ID, PTS, _pf_file)""")
    assert sorted(rows(newest_file(df, KEYS), "PTS")) == ["n1", "n2", "new"]


def test_stream_upsert_replay_is_idempotent(spark):
    from pyspark.sql import types as T

    from panelforge.streaming.stream_upsert import stream_upsert
    root = scratch_path(spark, "t-stream-landing")
    feed = spark.createDataFrame(
        [("a", "0001", 1, "5"), ("a", "0002", 1, "6"), ("b", "0003", 2, "7")],
        "SEASON string, GAME_ID string, PLAYER_ID bigint, PTS string")
    ingest.write_landing(feed, root, drop_cols=())
    schema = T.StructType([T.StructField("GAME_ID", T.StringType()),
                           T.StructField("PLAYER_ID", T.LongType()),
                           T.StructField("PTS", T.StringType()),
                           T.StructField("SEASON", T.StringType())])
    target, ckpt = scratch_path(spark, "t-stream-target"), scratch_path(spark, "t-stream-ckpt")
    out = stream_upsert(spark, root, schema, target, KEYS, batch_ts="t0", checkpoint=ckpt,
                        max_files_per_trigger=1)
    assert sorted(rows(out, "GAME_ID")) == ["0001", "0002", "0003"]
    first = sorted(map(tuple, out.collect()))  # collect before the table is rewritten
    # a fresh checkpoint replays every file: the table is unchanged
    again = stream_upsert(spark, root, schema, target, KEYS, batch_ts="t0",
                          checkpoint=scratch_path(spark, "t-stream-ckpt2"))
    assert sorted(map(tuple, again.collect())) == first


def test_csv_roundtrip_keeps_leading_zeros(spark):
    df = spark.createDataFrame([("0022400001", None, "")], "GAME_ID string, A string, B string")
    back = ingest.roundtrip(df, scratch_path(spark, "t-csv"), "csv").first()
    assert back["GAME_ID"] == "0022400001" and back["A"] is None and back["B"] == ""


def test_silver_lenient_and_rejects(spark):
    from panelforge.plans.silver import silver, silver_rejects
    from panelforge.schemas import BRONZE_TEXT_SCHEMA
    good = {f.name: None for f in BRONZE_TEXT_SCHEMA.fields}
    row_ok = dict(good, SEASON="s", GAME_ID="1", PLAYER_ID=1, GAME_DATE="2020-01-01", PTS="10")
    row_bad = dict(good, SEASON="s", GAME_ID="2", PLAYER_ID=1, GAME_DATE="2020-13-45", PTS="x")
    df = spark.createDataFrame([tuple(r[f.name] for f in BRONZE_TEXT_SCHEMA.fields)
                                for r in (row_ok, row_bad)], BRONZE_TEXT_SCHEMA)
    with pytest.raises(Exception):
        silver(df).collect()  # strict cast fails the job
    lenient = silver(df, strict=False).orderBy("game_id").collect()
    assert lenient[1]["pts"] is None and lenient[1]["game_date"] is None
    rej = silver_rejects(df).collect()
    assert len(rej) == 1 and sorted(rej[0]["_bad_columns"]) == ["GAME_DATE", "PTS"]


def test_upsert_table_new_partition_appends(spark):
    path = scratch_path(spark, "t-bronze-append")
    ups.upsert_table(spark, path, _t(spark, [("a", "1", 1, "1", "t0")]), KEYS)
    out = ups.upsert_table(spark, path, _t(spark, [("c", "9", 1, "9", "t1")]), KEYS)
    assert sorted(rows(out, "SEASON", "GAME_ID")) == [("a", "1"), ("c", "9")]
    with pytest.raises(Exception):  # the duplicate guard also holds on the append path
        ups.upsert_table(spark, path, _t(spark, [("d", "1", 1, "1", "t2"),
                                                 ("d", "1", 1, "2", "t2")]), KEYS)


def test_purge_scratch_dry_run(spark):
    from panelforge.session import purge_scratch
    path = scratch_path(spark, "t-purge")
    spark.range(3).write.parquet(path)
    listed = purge_scratch(spark, older_than_hours=-1, prefix="t-purge", dry_run=True)
    assert any(p.endswith(path.rsplit("/", 1)[1]) for p in listed)
    assert purge_scratch(spark, older_than_hours=1000, prefix="t-purge", dry_run=True) == []
    assert spark.read.parquet(path).count() == 3  # dry run deleted nothing


def test_read_seasons_prunes_folders(spark):
    from pyspark.sql import types as T
    root = scratch_path(spark, "t-prune-landing")
    df = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", "3")], "SEASON string, v string")
    ingest.write_landing(df, root, drop_cols=())
    out = ingest.read_seasons(spark, root, ["x", "z"], T.StructType([T.StructField("v", T.StringType())]))
    assert sorted(rows(out, "v")) == ["1", "3"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "SEASON" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_run_log_compact_keeps_rows(spark):
    log = RunLog(spark, scratch_path(spark, "t-runlog-compact"))
    log.create()
    for i in range(3):
        log.append(f"r{i}", "silver", "success", 0.5, i)
    before = sorted(rows(log.read(), "run_id"))
    log.compact(1)
    assert sorted(rows(log.read(), "run_id")) == before == ["r0", "r1", "r2"]
