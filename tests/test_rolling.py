"""Trailing means and next values: hand-computed micro-fixtures, and the
skew-safe plan against Spark's Window and against a brute-force self-join."""

import random

import pytest
from pyspark.sql import functions as F

from panelforge.operators.positions import with_position
from panelforge.operators.rolling import rolling_features

from .conftest import rows

STRATEGIES = ["positions", "window"]


def _series(spark, values, entity="p"):
    data = [(entity, i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "e string, t int, v double")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_rolling3(spark, strategy):
    out = rolling_features(_series(spark, [10, 20, 30, 40]), ["e"], ["t"],
                           [("m", "v", 3)], strategy=strategy).orderBy("t")
    assert rows(out, "m") == [10, 15, 20, 30]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_rolling3_missing(spark, strategy):
    out = rolling_features(_series(spark, [10, None, 30]), ["e"], ["t"],
                           [("m", "v", 3)], strategy=strategy).orderBy("t")
    assert rows(out, "m") == [10, 10, 20]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_rolling_all_missing(spark, strategy):
    out = rolling_features(_series(spark, [None, None]), ["e"], ["t"],
                           [("m", "v", 3)], strategy=strategy).orderBy("t")
    assert rows(out, "m") == [None, None]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_rolling5(spark, strategy):
    out = rolling_features(_series(spark, [1, 2, 3, 4, 5, 6]), ["e"], ["t"],
                           [("m", "v", 5)], strategy=strategy).orderBy("t")
    assert rows(out, "m") == [1, 1.5, 2, 2.5, 3, 4]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_next_value(spark, strategy):
    out = rolling_features(_series(spark, [10, 20, 30]), ["e"], ["t"],
                           leads=[("n", "v", 1)], strategy=strategy).orderBy("t")
    assert rows(out, "n") == [20, 30, None]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_window_crosses_season(spark, strategy):
    df = spark.createDataFrame([("p", "A", 1, 10.0), ("p", "B", 2, 30.0)],
                               "e string, season string, t int, v double")
    out = rolling_features(df, ["e"], ["t"], [("m", "v", 3)], strategy=strategy).orderBy("t")
    assert rows(out, "m") == [10, 20]


def _random_frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        # one hot entity holds about a third of the rows; NULL entity present
        r = rnd.random()
        e = "hot" if r < 0.34 else (None if r < 0.36 else f"e{rnd.randint(0, 40)}")
        d = rnd.randint(0, 200) if rnd.random() > 0.02 else None
        v = None if rnd.random() < 0.1 else float(rnd.randint(0, 50))
        data.append((e, d, i, v))
    return spark.createDataFrame(data, "e string, d int, id int, v double")


def test_positions_equal_window(spark):
    df = _random_frame(spark)
    spec = dict(means=[("m3", "v", 3), ("m5", "v", 5)], leads=[("n1", "v", 1), ("n2", "v", 2)])
    a = rolling_features(df, ["e"], ["d", "id"], strategy="positions", **spec)
    b = rolling_features(df, ["e"], ["d", "id"], strategy="window", **spec)
    cols = ["id", "m3", "m5", "n1", "n2"]
    assert sorted(rows(a.select(*cols), *cols)) == sorted(rows(b.select(*cols), *cols))


def test_rolling_equals_self_join_average(spark):
    df = _random_frame(spark, 800, seed=3).where(F.col("e").isNotNull())
    out = rolling_features(df, ["e"], ["d", "id"], [("m3", "v", 3)])
    # brute force: rank rows per entity, average the value over ranks r-2..r
    from pyspark.sql import Window
    w = Window.partitionBy("e").orderBy(F.col("d").asc_nulls_last(), "id")
    ranked = df.withColumn("r", F.row_number().over(w))
    a, b = ranked.alias("a"), ranked.alias("b")
    brute = (a.join(b, (F.col("a.e") == F.col("b.e")) & F.col("b.r").between(F.col("a.r") - 2, F.col("a.r")))
             .groupBy(F.col("a.id").alias("id")).agg(F.avg("b.v").alias("m3")))
    assert sorted(rows(out.select("id", "m3"), "id", "m3")) == sorted(rows(brute, "id", "m3"))


def test_positions_dense_and_hot_key_split(spark):
    df = _random_frame(spark, 4000, seed=11)
    p = with_position(df, ["e", "d", "id"], "pos", num_partitions=8)
    got = sorted(rows(p, "pos"))
    assert got == list(range(4000))
    # the hot entity is spread over several range partitions
    hot = p.where(F.col("e") == "hot").select((F.col("pos") / 500).cast("int").alias("blk"))
    assert hot.distinct().count() > 1
    # positions follow the order
    ordered = p.orderBy("pos").collect()
    keys = [(r["e"] is None, r["e"] or "", r["d"] is None, r["d"] or 0, r["id"]) for r in ordered]
    assert keys == sorted(keys)


def test_unknown_strategy_is_refused(spark):
    with pytest.raises(ValueError):
        rolling_features(_random_frame(spark, 10, seed=5), ["e"], ["d"], strategy="auto")


@pytest.mark.parametrize("block_rows", [5, 7, 64])
def test_small_blocks_equal_window(spark, block_rows):
    from panelforge.operators.rolling import position_rows, rolling_over_positions
    df = _random_frame(spark, 1500, seed=13)
    spec = dict(means=[("m3", "v", 3), ("m5", "v", 5)], leads=[("n1", "v", 1), ("n2", "v", 2)])
    p = position_rows(df, ["e"], ["d", "id"])
    a = rolling_over_positions(p, ["e"], block_rows=block_rows, **spec)
    b = rolling_features(df, ["e"], ["d", "id"], strategy="window", **spec)
    cols = ["id", "m3", "m5", "n1", "n2"]
    assert sorted(rows(a.select(*cols), *cols)) == sorted(rows(b.select(*cols), *cols))
    assert a.count() == 1500
