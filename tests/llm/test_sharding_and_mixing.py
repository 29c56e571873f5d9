import random
from collections import Counter, defaultdict

import duckdb
import pytest

from panelforge.llm.mixing import MIX_SQL, in_mixed_order, mix_sources, schedule
from panelforge.llm.sharding import SHARD_BYTES, SHARD_SQL, assign_shards, write_shards

from .data import awkward, frame


def test_shards_against_sql(spark):
    rng = random.Random(1)
    pdf = spark.createDataFrame([(i, "é" * rng.randint(0, 60_000)) for i in range(300)] + [(900, None), (901, "")],
                                "doc_id long, text string")
    documents = pdf.toPandas()  # noqa: F841 - DuckDB reads it by name
    want = duckdb.sql(SHARD_SQL.replace("FROM documents", "FROM documents")).limit(10_000).fetchall()
    got = [tuple(r) for r in assign_shards(pdf).collect()]
    assert sorted(got) == sorted(want)
    sizes = Counter()
    for _, size, _, shard in got:
        sizes[shard] += size
    assert len(sizes) > 20 and max(sizes.values()) <= SHARD_BYTES


def test_repeated_rows_of_one_id_split_too(spark):
    rows = [(7, "x" * 1000)] * 400 + [(8, "y" * 5000), (None, None)]
    got = assign_shards(frame(spark, rows).repartition(4), shard_bytes=20_000).collect()
    assert len(got) == 402
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.bytes
        assert len(r.shard) == r.depth
    assert max(sizes.values()) <= 20_000
    names = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))  # no shard inside another


def test_a_row_above_the_limit_is_alone(spark):
    got = assign_shards(frame(spark, [(i, "x" * (50 if i else 5000)) for i in range(200)]), shard_bytes=1000).collect()
    big = next(r for r in got if r.bytes == 5000)
    assert sum(r.shard == big.shard for r in got) == 1
    assert assign_shards(frame(spark, [])).count() == 0


def test_written_shards(spark, tmp_path):
    df = frame(spark, [(i, "x" * 500) for i in range(60)])
    directory = write_shards(df, str(tmp_path / "out"), shard_bytes=4000).collect()
    assert sum(r.rows for r in directory) == 60 and max(r.bytes for r in directory) <= 4000
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60


def test_mix_against_sql(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a"] * 60 + ["b"] * 6 + ["c", "dd"] + [None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    documents = df.toPandas().astype({"source": "object"})  # noqa: F841
    documents.loc[documents["source"].isna(), "source"] = None
    want = duckdb.sql(MIX_SQL).limit(10_000).fetchall()
    # a NULL source is its own group in both
    got = [tuple(r) for r in mix_sources(df).collect()]
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in (r[0],))
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1}, {"a": 97, "b": 2, "c": 1}, {"a": 5, "b": 3, "c": 7, "d": 11}])
def test_less_than_one_block_away(spark, weights):
    rows = [(1000 * k + i, s) for k, s in enumerate(weights) for i in range(8 * weights[s])]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    w = spark.createDataFrame(list(weights.items()), "source string, weight long")
    got = mix_sources(df, w, block_rows=2).collect()
    total = sum(weights.values())
    slots = {r.slot: r.source for r in got}
    assert sorted(slots) == list(range(4 * total))  # every slot is used, once
    done = Counter()
    for t in range(4 * total):
        done[slots[t]] += 1
        assert all(abs(done[s] - (t + 1) * q / total) < 1 for s, q in weights.items())
    assert all(r.release <= r.slot < r.deadline for r in got)
    per_slot = defaultdict(list)
    for r in got:
        per_slot[r.slot].append(r.place)
    assert all(sorted(p) == list(range(len(p))) for p in per_slot.values())


def test_mix_keeps_every_row(spark):
    df = frame(spark, awkward())
    out = in_mixed_order(df)
    assert out.schema == df.schema
    assert sorted(map(repr, out.collect())) == sorted(map(repr, df.collect()))
    assert mix_sources(frame(spark, [])).count() == 0
    w = spark.createDataFrame([("s1", 3), ("s2", 0)], "source string, weight long")
    s = schedule(df, w, keep=["doc_id", "source"])
    assert s.count() == df.count()
    assert s.filter("source = 's1' and _slot is null").count() == 0
    assert s.filter("source <> 's1' and _slot is not null").count() == 0
    assert in_mixed_order(df, w).count() == df.count()


def test_shards_of_repeated_ids_are_refused(spark, tmp_path):
    for ids in ((1, 2, 1), (None, 3, None)):
        df = spark.createDataFrame([(i, "x") for i in ids], "doc_id long, text string")
        with pytest.raises(ValueError, match="unique"):
            write_shards(df, str(tmp_path / "refused"))
        assert not (tmp_path / "refused").exists()
