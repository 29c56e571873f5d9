"""A batch of a checked size is merged without a shuffle of the target."""

import random

import pytest
from pyspark.sql import functions as F

from panelforge.operators import upsert as ups
from panelforge.session import scratch_path

KEYS = ["SEASON", "GAME_ID"]
COLS = "SEASON string, GAME_ID bigint, PTS double, NOTE string, INGESTED_AT string"


def table(spark, rnd, keys, stamp):
    data = [(s, g, rnd.choice([None, float(rnd.randrange(50))]), rnd.choice([None, "", "x"]), stamp) for s, g in keys]
    return spark.createDataFrame(data, COLS)


def some_keys(rnd, n):
    keys = {(rnd.choice("abc"), rnd.randrange(40)) for _ in range(n)}
    # rows with a NULL key part match nothing and may repeat
    return sorted(keys) + [("a", None)] * rnd.randrange(3) + [(None, 1)] * rnd.randrange(3)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("update", [("INGESTED_AT",), None])
def test_both_plans_give_the_same_rows(spark, seed, update):
    rnd = random.Random(seed)
    target = table(spark, rnd, some_keys(rnd, 60 * (seed > 0)), "t0")
    batch = table(spark, rnd, some_keys(rnd, 25), "t1")
    one, two = (ups.upsert(target, batch, KEYS, update, broadcast_batch=b) for b in (False, True))
    assert one.columns == two.columns and content(one) == content(two)
    assert content(ups.upsert(target, batch.limit(0), KEYS, update, broadcast_batch=True)) == content(target)


def test_columns_that_the_batch_lacks(spark):
    rnd = random.Random(9)
    target, batch = table(spark, rnd, some_keys(rnd, 60), "t0"), table(spark, rnd, some_keys(rnd, 25), "t1").drop("PTS")
    one, two = (ups.upsert(target, batch, KEYS, allow_missing=True, broadcast_batch=b) for b in (False, True))
    assert content(one) == content(two)


def test_a_repeated_key_fails(spark):
    rnd = random.Random(1)
    target, batch = table(spark, rnd, [("a", 1)], "t0"), table(spark, rnd, [("a", 2), ("a", 2)], "t1")
    with pytest.raises(Exception, match="duplicate key"):
        ups.upsert(target, batch, KEYS, broadcast_batch=True).collect()


def test_the_target_is_not_shuffled(spark):
    path = scratch_path(spark, "t-no-shuffle")
    spark.range(5000).select(F.lit("a").alias("SEASON"), F.col("id").alias("GAME_ID"), F.lit(1.0).alias("PTS"),
                             F.lit("x").alias("NOTE"), F.lit("t0").alias("INGESTED_AT")).write.parquet(path)
    target = spark.read.parquet(path)
    batch = table(spark, random.Random(2), [("a", 3), ("a", 9000)], "t1")
    for small, exchanged in ((True, False), (False, True)):
        out = ups.upsert(target, batch, KEYS, broadcast_batch=small)
        out.collect()
        lines = out._jdf.queryExecution().executedPlan().toString().split("\n== Initial Plan ==")[0].splitlines()
        # the nodes above each scan of the target: those before it that stand farther left
        found = False
        for i, line in enumerate(lines):
            if "FileScan parquet" not in line:
                continue
            depth = len(line)
            for above in reversed(lines[:i + 1]):
                indent = len(above) - len(above.lstrip(" :+-*()0123456789"))
                if indent < depth:
                    depth, found = indent, found or above.lstrip(" :+-*()0123456789").startswith("Exchange hashpartitioning")
        assert found == exchanged
    assert out.count() == 5001


def test_a_large_batch_is_joined_by_a_shuffle(spark, monkeypatch):
    rnd, used = random.Random(4), []
    merge = ups.upsert
    monkeypatch.setattr(ups, "upsert", lambda *a, **k: used.append(k["broadcast_batch"]) or merge(*a, **k))
    tables = []
    first, second = some_keys(rnd, 60), some_keys(rnd, 25)
    for bound in (500_000, 3):
        monkeypatch.setattr(ups, "BROADCAST_ROWS", bound)
        path = scratch_path(spark, "t-bound")
        for keys, stamp in ((first, "t0"), (second, "t1")):
            ups.upsert_table(spark, path, table(spark, random.Random(7), keys, stamp), KEYS, None)
        tables.append(content(ups.read_table(spark, path)))
    assert used == [True, False] and tables[0] == tables[1]


def test_a_first_load_shuffles_keys_only(spark, tmp_path, monkeypatch):
    """A duplicate is refused, and the rows of a first load are written as they were staged."""
    import pytest
    from panelforge.operators import upsert as ups
    monkeypatch.setattr(ups, "guard_unique", lambda *a: pytest.fail("whole rows are shuffled for the check"))
    good = spark.createDataFrame([("1", "a", 1, "x"), ("1", "b", 1, "y"), (None, "b", 1, "z"), (None, "b", 1, "z")],
                                 "SEASON string, GAME_ID string, PLAYER_ID int, INGESTED_AT string")
    out = ups.upsert_table(spark, str(tmp_path / "t"), good, ["SEASON", "GAME_ID", "PLAYER_ID"])
    assert out.count() == 4
    with pytest.raises(Exception, match="duplicate key"):
        ups.upsert_table(spark, str(tmp_path / "t"), good.unionAll(good), ["SEASON", "GAME_ID", "PLAYER_ID"])
    assert out.count() == 4
