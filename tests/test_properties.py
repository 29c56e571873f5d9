"""Property tests: rank gap-freeness, split sizes, histogram
totals, rolling means against a plain-Python reference."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelforge.operators.histogram import histogram
from panelforge.operators.opponents import dense_ranks
from panelforge.operators.rolling import rolling_features
from panelforge.operators.split import ordered_split

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.one_of(st.none(), st.integers(0, 20).map(float)), min_size=1, max_size=30)


@SETTINGS
@given(vals=values)
def test_dense_rank_gap_free(spark, vals):
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(vals)], "p string, i int, x double")
    ranks = sorted({r["r"] for r in dense_ranks(df, ["p"], [("r", "x")], "last").collect()})
    assert ranks == list(range(1, len(ranks) + 1))
    assert len(ranks) == len({v for v in vals if v is not None}) + (1 if None in vals else 0)


@SETTINGS
@given(n=st.integers(1, 60), frac=st.sampled_from([0.1, 0.2, 0.25, 0.5]))
def test_split_sizes(spark, n, frac):
    s = ordered_split(spark.range(n).withColumnRenamed("id", "k"), ["k"], frac)
    test = [r["k"] for r in s.where(F.col("SPLIT") == "test").collect()]
    assert len(test) == math.ceil(frac * n) and s.count() == n
    assert sorted(test) == list(range(n - len(test), n))


@SETTINGS
@given(vals=values)
def test_histogram_total(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = histogram(df, "x", 7).collect()
    assert len(h) == 7 and sum(r["count"] for r in h) == sum(v is not None for v in vals)


def _py_rolling(seq, n):
    out = []
    for i in range(len(seq)):
        win = [v for v in seq[max(0, i - n + 1): i + 1] if v is not None]
        out.append(sum(win) / len(win) if win else None)
    return out


@SETTINGS
@given(vals=values, n=st.integers(1, 6))
def test_rolling_matches_python(spark, vals, n):
    df = spark.createDataFrame([("e", i, v) for i, v in enumerate(vals)], "e string, t int, v double")
    for strategy in ("positions", "window"):
        got = [r["m"] for r in rolling_features(df, ["e"], ["t"], [("m", "v", n)],
                                                [("nx", "v", 1)], strategy).orderBy("t").collect()]
        exp = _py_rolling(vals, n)
        assert all((a is None and b is None) or abs(a - b) < 1e-12 for a, b in zip(got, exp))


keys = st.tuples(st.sampled_from(["a", "b"]), st.one_of(st.none(), st.integers(0, 6).map(str)))


@SETTINGS
@given(target=st.lists(st.tuples(keys, st.integers(0, 9)), max_size=12),
       batch=st.lists(st.tuples(keys, st.integers(10, 19)), max_size=12),
       all_cols=st.booleans())
def test_upsert_matches_dict_model(spark, target, batch, all_cols):
    from panelforge.operators.upsert import upsert
    # unique non-NULL keys on each side (the batch rule); NULL keys repeat freely
    def dedup(rows):
        seen, out = set(), []
        for (s, g), v in rows:
            if g is not None and (s, g) in seen:
                continue
            seen.add((s, g))
            out.append((s, g, v, f"t{v}"))
        return out
    t, b = dedup(target), dedup(batch)
    schema = "SEASON string, GAME_ID string, PTS int, INGESTED_AT string"
    out = upsert(spark.createDataFrame(t, schema), spark.createDataFrame(b, schema),
                 ["SEASON", "GAME_ID"], None if all_cols else ["INGESTED_AT"])
    # model: NULL keys never match; matched rows take the update columns
    bmap = {(s, g): (v, ts) for s, g, v, ts in b if g is not None}
    exp = []
    for s, g, v, ts in t:
        if g is not None and (s, g) in bmap:
            nv, nts = bmap[(s, g)]
            exp.append((s, g, nv if all_cols else v, nts))
        else:
            exp.append((s, g, v, ts))
    tkeys = {(s, g) for s, g, _, _ in t if g is not None}
    exp += [r for r in b if r[1] is None or (r[0], r[1]) not in tkeys]
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(exp, key=key)
