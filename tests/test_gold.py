"""Gold that follows silver by change sets equals a full build."""

import random

import pytest
from pyspark.sql import functions as F

from panelforge.operators.versioned import VersionedTable
from panelforge.plans import gold as gd
from panelforge.plans import quality as dq
from panelforge.plans.features import player_features
from panelforge.session import scratch_path

SILVER = ("season string, game_id string, game_date date, player_id bigint, player_name string, team string, "
          "opponent_team string, minutes double, pts double, reb double, ast double, note string")


def frame(spark, data):
    text = SILVER.replace("game_date date", "game_date string")
    return spark.createDataFrame(list(data.values()), text).withColumn("game_date", F.to_date("game_date"))


def game(season, number, player, rnd, opponent=None):
    return (season, f"{number:04d}", f"20{number // 300:02d}-{number // 28 % 12 + 1:02d}-{number % 28 + 1:02d}", player,
            None if player is None else f"P{player}", "T0", opponent or f"T{rnd.randrange(4)}", rnd.choice([None, 30.0]),
            rnd.choice([None, 1.0, 7.5, 20.25]), float(rnd.randrange(9)), float(rnd.randrange(5)), "x")


def store(spark, table, data, seasons):
    """Make the seasons of silver again from ``data``; seasons without rows go."""
    rows = frame(spark, {k: r for k, r in data.items() if r[0] in seasons})
    table.create(rows)
    table.replace(rows, [table.folder(s) for s in seasons])


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def season_folders(spark, path):
    return VersionedTable(spark, path, "season").manifest()["parts"]


@pytest.fixture()
def warehouse(spark):
    rnd, root = random.Random(5), scratch_path(spark, "t-gold")
    # player 1 has a third of all rows; players 90 and 91 play in season a only
    data = {n: game("ab"[n // 60], n, rnd.choice([1, 2, 3, None]) if n % 3 else 1, rnd) for n in range(120)}
    data |= {n: game("a", n % 60, 90 + n % 2, rnd) for n in range(200, 210)}
    data |= {n: game(None, n, rnd.choice([1, 7]), rnd) for n in range(300, 306)}
    silver = VersionedTable(spark, f"{root}/silver", "season")
    store(spark, silver, data, ["a", "b", None])
    gold, values = gd.refresh_gold(spark, f"{root}/silver", f"{root}/gold",
                                   lambda df: [dq.Check("rows", df, dq.has_rows(), lambda v: v > 0)])
    assert values == [136] and content(gold) == content(player_features(silver.read(), "window"))
    return root, silver, data, rnd


def refresh(spark, root, silver):
    got, values = gd.refresh_gold(spark, f"{root}/silver", f"{root}/gold")
    assert values is None
    assert content(got) == content(player_features(silver.read(), "window"))
    assert VersionedTable(spark, f"{root}/gold", "season").manifest()["sources"] == silver.manifest()["parts"]


def test_new_rows_reach_back_only_where_a_value_moves(spark, warehouse):
    root, silver, data, rnd = warehouse
    before = season_folders(spark, f"{root}/gold")
    data[400] = game("c", 700, 55, rnd)  # a new player: no other season moves
    store(spark, silver, data, ["c"])
    refresh(spark, root, silver)
    after = season_folders(spark, f"{root}/gold")
    assert {k: after[k] for k in before} == before and "season=c" in after
    data[401] = game("c", 701, 90, rnd)[:8] + (3.0, 1.0, 1.0, "x")  # the next game of one whose last was in season a
    store(spark, silver, data, ["c"])
    refresh(spark, root, silver)
    last = season_folders(spark, f"{root}/gold")
    assert last["season=a"] != after["season=a"] and last["season=b"] == after["season=b"]


def test_changed_removed_and_repeated_rows(spark, warehouse):
    root, silver, data, rnd = warehouse
    data[70] = data[70][:8] + (99.0, 1.0, 1.0, "x")  # other points: ranks of season b may move
    del data[75]
    data[500] = data[90]  # the same row twice
    data[80] = data[80][:2] + ("1999-01-01",) + data[80][3:]  # it moves to the front of its player
    store(spark, silver, data, ["b"])
    refresh(spark, root, silver)


def test_a_season_goes_and_the_null_season_changes(spark, warehouse):
    root, silver, data, rnd = warehouse
    data = {k: r for k, r in data.items() if r[0] != "b"}
    data[302] = data[302][:8] + (50.0, 0.0, 0.0, "x")
    store(spark, silver, data, ["b", None])
    refresh(spark, root, silver)
    assert "season=b" not in season_folders(spark, f"{root}/gold")


def test_same_values_again_rewrite_nothing(spark, warehouse):
    root, silver, data, _ = warehouse
    before = season_folders(spark, f"{root}/gold")
    store(spark, silver, {k: r[:-1] + ("y",) for k, r in data.items()}, ["a", "b", None])  # a column gold lacks
    refresh(spark, root, silver)
    assert season_folders(spark, f"{root}/gold") == before
    version = VersionedTable(spark, f"{root}/gold", "season").manifest()["version"]
    refresh(spark, root, silver)  # silver has not changed: no new version
    assert VersionedTable(spark, f"{root}/gold", "season").manifest()["version"] == version


def test_a_run_that_died_is_made_good(spark, warehouse, monkeypatch):
    root, silver, data, rnd = warehouse
    before = content(VersionedTable(spark, f"{root}/gold", "season").read())
    data[600] = game("b", 650, 1, rnd)
    store(spark, silver, data, ["b"])

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(VersionedTable, "_write_new", lost)  # all files are written, the commit fails
    with pytest.raises(OSError):
        gd.refresh_gold(spark, f"{root}/silver", f"{root}/gold")
    monkeypatch.undo()
    assert content(VersionedTable(spark, f"{root}/gold", "season").read()) == before
    data[601] = game("c", 651, 2, rnd)
    store(spark, silver, data, ["c"])
    refresh(spark, root, silver)


def test_empty_silver(spark):
    root = scratch_path(spark, "t-gold-empty")
    silver = VersionedTable(spark, f"{root}/silver", "season")
    store(spark, silver, {}, [])
    got, values = gd.refresh_gold(spark, f"{root}/silver", f"{root}/gold")
    assert got.count() == 0 and values is None and len(got.columns) == 19
    store(spark, silver, {1: game("a", 1, 1, random.Random(1))}, ["a"])
    got, _ = gd.refresh_gold(spark, f"{root}/silver", f"{root}/gold")
    assert got.count() == 1
