import random
import zlib

import numpy as np

from panelforge.llm.quality_knn import good_rows, quality_scores, vote
from panelforge.llm.toxicity import noisy_or, sentence_odds, spans, toxicity_scores, Weights

from .data import awkward, frame, prose


def junk(rng, n):
    kind = rng.randrange(3)
    w = prose(rng, n).split()
    return (" | ".join(w), " ".join(x.upper() + "!!" for x in w), " ".join(x + "###" for x in w))[kind]


def labelled(spark, seed, toxic=False):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(400):
        bad = rng.random() < 0.3
        t = prose(rng, rng.randint(30, 120))
        if toxic:
            if bad:
                s = t.split(". ")
                s[rng.randrange(len(s))] += f" you {rng.choice(['clodpole', 'numpty', 'wazzock'])}"
                t = ". ".join(s)
            labels.append((i, int(not bad), int(bad)))
        else:
            if bad:
                t = junk(rng, 60)
            labels.append((i, int(not bad), 0))
        rows.append((i, t))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def accuracy(got, want, mod, held):
    test = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == held) for r in got)
    return sum(r.predicted == want[r.doc_id] for r in test) / len(test)


def test_quality_on_held_out_rows(spark):
    df, labels, _ = labelled(spark, 1)
    got = quality_scores(df, labels).collect()
    assert accuracy(got, {r.doc_id: r.quality for r in labels.collect()}, 3, 1) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    out = good_rows(df, labels, df)
    assert out.schema == df.schema and out.count() == sum(r.predicted for r in got)


def test_vote_against_brute_force():
    rng = np.random.default_rng(3)
    x, known = rng.random((20, 6)), rng.random((50, 6))
    y = rng.integers(0, 2, 50).astype(float)
    unit = known / np.linalg.norm(known, axis=1, keepdims=True)
    got = vote(x, (np.ones(6), np.eye(6), unit, y, 0.4), 7, 3)
    for row, score in zip(x, got):
        cos = unit @ row / np.linalg.norm(row)
        near = np.argsort(-cos)[:7]
        w = cos[near] ** 3
        assert abs(score - ((w * y[near]).sum() + 1e-3 * 0.4) / (w.sum() + 1e-3)) < 1e-9


def test_toxicity_on_held_out_rows(spark):
    df, labels, rows = labelled(spark, 2, toxic=True)
    got = toxicity_scores(df, labels).collect()
    assert accuracy(got, {r.doc_id: r.toxic for r in labels.collect()}, 5, 0) > 0.97
    text = dict(rows)
    for r in got:
        assert bool(r.sentences) == bool(r.predicted)
        if r.predicted:  # the sentence that has the word is named
            assert any(w in text[r.doc_id][s.start:s.end] for s in r.sentences
                       for w in ("clodpole", "numpty", "wazzock"))


def test_sentences_and_spans_agree():
    w = Weights(np.zeros(1 << 18, np.float32))
    for t in ["", " \n ", "One. Two! Three", "a\nb.\n\nc", "no end", "x." * 3, "Dr. A\x0bb?"]:
        odds = sentence_odds(t, w, -1.0)
        assert len(odds) == len(spans(t))
        assert all(t[a:b].strip() == t[a:b] for a, b in spans(t))
    assert noisy_or(np.empty(0)) == 0.0
    assert abs(noisy_or(np.log(np.array([0.25, 1.0]))) - (1 - 0.8 * 0.5)) < 1e-12


def test_awkward_rows_and_no_labels(spark):
    df = frame(spark, awkward())
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for got in (quality_scores(df, none).collect(), toxicity_scores(df, none).collect()):
        assert len(got) == df.count()
        assert all(0 <= r.score <= 1 for r in got)
        assert len({(r.score, r.held_out) for r in got if r.doc_id == 1}) == 1
    _, labels, _ = labelled(spark, 4)
    empty = frame(spark, [])
    assert quality_scores(empty, labels).count() == 0 == toxicity_scores(empty, labels).count()
