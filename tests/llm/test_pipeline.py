import random

import corpus_pipeline
from panelforge.llm.jaccard_join import jaccard_components
from panelforge.llm.mixing import mix_sources
from panelforge.llm.quality_knn import quality_scores
from panelforge.llm.quality_rules import quality_verdicts

from .data import prose
from .test_classifiers import junk


def folder(spark, path, seed=5):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(260):
        bad = rng.random() < 0.25
        t = junk(rng, 90) if bad else prose(rng, rng.randint(60, 140))
        if not bad and i % 6 == 0 and rows:
            t = rows[rng.randrange(len(rows))][1] + " twice"
        rows.append((i, t, "en", f"s{i % 3 if i % 2 else 0}", len(t)))
        if i % 2:
            labels.append((i, int(not bad), 0))
    rows += [(500, None, "en", None, 0), (501, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_stages_against_the_operators(spark, tmp_path):
    d = str(tmp_path)
    folder(spark, d)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    left = {r.doc_id for r in docs.collect()}
    for name, function in corpus_pipeline.STAGES:
        if name == "quality rules":
            left = {r.doc_id for r in quality_verdicts(docs).filter("kept").collect()}
        elif name == "quality classifier":
            left &= {r.doc_id for r in quality_scores(
                spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
                .filter("predicted = 1").collect()}
        elif name == "n-gram Jaccard join":
            before = len(left)
            left &= {r.component_id for r in jaccard_components(docs).collect()}
            assert len(left) < before
        out = function(spark, docs, d)
        out.write.parquet(f"{d}/{name.replace(' ', '-')}")
        docs = spark.read.parquet(f"{d}/{name.replace(' ', '-')}")
        assert {r.doc_id for r in docs.select("doc_id").collect()} == left, name
        if name != "packing":
            assert docs.columns == columns
    tokens = {r.doc_id: r.doc_tokens for r in docs.collect()}
    assert {r.doc_id: r.n for r in docs.groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()} == tokens


def test_run_gives_the_last_stage(spark, tmp_path):
    folder(spark, str(tmp_path), 6)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert "sequence_id" in out.columns and out.count() > 50
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, tmp_path):
    folder(spark, str(tmp_path / "full"), 7)
    full = spark.read.parquet(str(tmp_path / "full/documents.parquet"))
    full.limit(0).write.parquet(str(tmp_path / "none/documents.parquet"))
    spark.read.parquet(str(tmp_path / "full/labels.parquet")).write.parquet(str(tmp_path / "none/labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_sequences_follow_the_mixed_order(spark, tmp_path):
    """Over every prefix of the sequences each source has its share, whatever its documents' lengths."""
    rng, n = random.Random(8), {"long": 2800, "short": 2800, "few": 300}
    rows = [(i, prose(rng, {"long": 60, "short": 6, "few": 25}[s]), s)
            for i, s in enumerate(s for s in n for _ in range(n[s]))]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    stages = dict(corpus_pipeline.STAGES)
    stages["mixing sources"](spark, docs, "").write.parquet(str(tmp_path / "mixed"))
    packed = stages["packing"](spark, spark.read.parquet(str(tmp_path / "mixed")), "")
    source = {i: s for i, _, s in rows}
    first = {}
    for r in packed.select("doc_id", "sequence_id", "offset").orderBy("sequence_id", "offset").collect():
        first.setdefault(r.doc_id, len(first))
    assert set(first) == set(source)
    slot = {r.doc_id: (r.slot, r.place) for r in mix_sources(docs).collect()}
    mixed = sorted(slot, key=slot.get)
    want, got = dict.fromkeys(n, 0), dict.fromkeys(n, 0)
    for a, b in zip(mixed, sorted(first, key=first.get)):
        want[source[a]] += 1
        got[source[b]] += 1
        assert all(abs(want[s] - got[s]) <= corpus_pipeline.RUN_ROWS for s in n)
