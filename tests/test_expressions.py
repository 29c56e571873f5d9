"""Opponent parsing and NaN handling (G3, G7, B6)."""

from panelforge.functions.expressions import nan_to_null, opponent_last_token, opponent_split_part

from .conftest import rows

MATCHUPS = ["LAL @ DEN", "LAL vs. DEN", "LAL", None, "LAL  @ DEN"]


def _frame(spark):
    return spark.createDataFrame([(i, m) for i, m in enumerate(MATCHUPS)], "i int, m string")


def test_opponent_positional(spark):
    out = _frame(spark).select("i", opponent_split_part("m").alias("o")).orderBy("i")
    assert rows(out, "o") == ["DEN", "DEN", "", None, "@"]


def test_opponent_last_token(spark):
    out = _frame(spark).select("i", opponent_last_token("m").alias("o")).orderBy("i")
    assert rows(out, "o") == ["DEN", "DEN", None, None, "DEN"]


def test_last_token_leading_tab_and_two_tokens(spark):
    df = spark.createDataFrame([("\tLAL @ DEN",), ("LAL DEN",), ("  ",)], "m string")
    assert rows(df.select(opponent_last_token("m").alias("o")), "o") == ["DEN", None, None]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    out = df.select((nan_to_null("x") > 0).alias("pos"), nan_to_null("x").alias("x"))
    assert rows(out, "pos") == [True, None, None]
    assert rows(out, "x")[1] is None
