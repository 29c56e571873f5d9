import re

import numpy as np

from panelforge.llm.quality_rules import FACTS, RULES, em, good_rows, quality_verdicts

from .data import awkward, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")) if words else 0,
            sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated))


def test_counts_against_brute_force(spark):
    rows = awkward(normal=12)[:-7] + [(100, "a b c a b c\nx\n\nx\n x"), (101, "a | b *** # <p>"), (102, "w " * 30)]
    got = quality_verdicts(frame(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, *(r[c] for c in FACTS[:5])) for r in got) == sorted(
        (i is None, i or 0, *brute(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_long_repeated_and_null_rows(spark):
    rows = awkward()
    got = quality_verdicts(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(not r.kept for r in got if r.n_words == 0)
    twins = [r for r in got if r.doc_id == 1]
    assert len(twins) == 3 and len({tuple(r) for r in twins}) == 1
    assert quality_verdicts(frame(spark, [])).count() == 0


def test_em_finds_the_bad_class():
    rng = np.random.default_rng(5)
    n, rules = 20_000, len(RULES)
    bad = rng.random(n) < 0.15
    votes = np.where(rng.random((n, rules)) < 0.5, 1, 0)
    kind = rng.integers(0, 3, n)  # three kinds of junk, each seen by one rule
    for k in range(3):
        votes[:, k] = np.where(bad & (kind == k), -1, 0)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post = em(patterns, counts.astype(float))[0][inverse.ravel()]
    assert ((post < 0.5) == bad).mean() > 0.999


def test_stage_keeps_all_columns(spark):
    df = frame(spark, awkward())
    out = good_rows(df)
    assert out.schema == df.schema
    kept = quality_verdicts(df).filter("kept").count()
    assert out.count() == kept > 0


def test_posterior_against_brute_force():
    """One text at a time, one rule at a time, plain floats."""
    rng = np.random.default_rng(8)
    rows = [tuple(int(v) for v in r) for r in rng.choice([-1, 0, 1], (300, 4), p=[0.1, 0.5, 0.4])]
    post = {r: (0.98, 0.2)[r.count(-1)] if r.count(-1) < 2 else 0.01 for r in rows}
    for _ in range(40):
        like = {r: [1.0, 1.0] for r in post}
        good = sum(post[r] for r in rows)
        for rule in range(4):
            rate = []
            for cls, prior in enumerate([(0.01, 0.5, 1.5), (0.5, 1.0, 0.5)]):
                sums = list(prior)
                for r in rows:
                    sums[r[rule] + 1] += post[r] if cls == 0 else 1 - post[r]
                rate.append([x / sum(sums) for x in sums])
            over = max(rate[0][0] - 0.002, 0)
            rate[0] = [rate[0][0] - over, rate[0][1], rate[0][2] + over]
            for r in like:
                for cls in range(2):
                    like[r][cls] *= rate[cls][r[rule] + 1]
        share = (good + 9) / (len(rows) + 10)
        post = {r: share * a / (share * a + (1 - share) * b) for r, (a, b) in like.items()}
        post = {r: p if -1 in r else max(p, 0.98) for r, p in post.items()}
    patterns, counts = np.unique(rows, axis=0, return_counts=True)
    got = em(patterns, counts.astype(float), rounds=40, tol=0)[0]
    assert all(abs(g - post[tuple(p)]) < 1e-9 for g, p in zip(got, patterns.tolist()))
