import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from panelforge.llm.components import connected_components
from panelforge.llm import jaccard_join as J
from panelforge.llm.common import Powers, two
from panelforge.llm.jaccard_join import jaccard_components, one_per_class

from .data import awkward, frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d is None, d or 0, len(sets[i]), low.get(find(i), -1)) for i, (d, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    rows = awkward(seed, 10)[:-4]
    passage = prose(rng, 60)  # many documents share it
    for k in range(25):
        rows.append((200 + k, prose(rng, rng.randint(10, 80)) + " " + passage))
    base = prose(rng, 120).split()
    for k in range(40):  # near copies around the threshold
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(1000)}"
        rows.append((300 + k, " ".join(w[rng.randint(0, 6):])))
    rows += [(400, "One two three"), (401, "one TWO three"), (402, "one two"), (403, "É two"), (404, "é two")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,settings", [(1, {}), (2, {"hot_entries": 3, "block": 4, "frequent": 50}),
                                           (3, {"frequent": 0, "task_entries": 200})])
def test_against_brute_force(spark, seed, settings):
    rows = corpus(seed)
    got = jaccard_components(frame(spark, rows).repartition(3), **settings).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, -1 if r.component_id is None else r.component_id)
                  for r in got) == brute(rows)


def test_empty_and_wordless(spark):
    assert jaccard_components(frame(spark, [])).count() == 0
    got = jaccard_components(frame(spark, [(2, None), (1, ""), (None, " ")])).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(2, 0, 2), (1, 0, 1), (None, 0, None)}


def test_one_document_of_each_group_stays(spark):
    rows = corpus(4)
    df = frame(spark, rows)
    out = one_per_class(df)
    assert out.schema == df.schema
    want = {r.component_id for r in jaccard_components(df).filter("n_shingles > 0").collect()}
    kept = out.collect()
    assert sorted(str(r.doc_id) for r in kept if shingles(r.text)) == sorted(map(str, want))
    assert sum(not shingles(r.text) for r in kept) == sum(not shingles(t) for _, t in rows)


def test_components(spark):
    rng = random.Random(6)
    pairs = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(pairs + [(5, 5), (None, 3)], "a long, b long"), "a", "b").collect()}
    root = {}
    for a, b in pairs:
        x, y = root.get(a, a), root.get(b, b)
        for k in {a, b, *root}:
            if root.get(k, k) in (x, y):
                root[k] = min(x, y)
    assert got == {k: v for k, v in root.items() if k != v}


def template_rows(n, own, seed=7):
    """Texts with one template, between two runs of their own words: none of them link."""
    rng = random.Random(seed)
    template = prose(rng, 200 - own)
    return [(i, " ".join(f"longword{i}x{k}" for k in range(own)) + " " + template) for i in range(n)]


def test_texts_around_a_template_are_not_compared(spark):
    rows = template_rows(80, 40)  # similarity about 2/3
    every = np.sort(np.concatenate([s for s, _ in J.shingle_sets([t for _, t in rows], Powers(), 5)]))
    keys, counts = np.unique(every, return_counts=True)
    keys, counts = keys[counts >= 12], counts[counts >= 12]
    tiles = J.prefix_tiles(two(frame(spark, rows), "doc_id", "text"), 5, 75, keys, counts, 4, 10**6)
    sizes = tiles.selectExpr("node", "200L AS n").distinct()
    _, dealt = J.dealt(tiles, spark.createDataFrame([], "node long, component long"), sizes, 75, 8)
    assert dealt.count() < 10
    got = jaccard_components(frame(spark, rows), block=8).collect()
    assert all(r.component_id == r.doc_id for r in got)


@pytest.mark.parametrize("spread", [[200], [100, 120, 133, 150, 178, 400, 533], range(50, 2000)])
def test_no_group_is_larger_than_its_blocks(spark, spread):
    rng, block = random.Random(9), 10
    size = {i: rng.choice(spread) for i in range(240)}
    leads = {i: int(rng.random() < 0.5) for i in range(240)}
    part = {i: 0 if i < 50 else i for i in leads}  # the main component, and nodes without a link
    tiles = spark.createDataFrame([(1, i, k) for i, k in leads.items()], "tile long, node long, leads long")
    parts = spark.createDataFrame([(i, 0) for i in range(50)], "node long, component long")
    sizes = spark.createDataFrame(list(size.items()), "node long, n long")
    counts, dealt = J.dealt(tiles, parts, sizes, 75, block)
    groups, of_row = defaultdict(list), Counter()
    for r in dealt.collect():
        groups[r.kind, r.low_band, r.high_band, r.low, r.high].append(r)
        of_row[r.node] += 1
    assert sum(of_row.values()) == sum(r["rows"] for r in counts.collect())
    assert max(map(len, groups.values())) <= 5 * block and max(of_row.values()) <= 1 + 240 // block + 6
    if len(spread) > 100:  # most blocks are too far apart in size
        assert sum(of_row.values()) < 0.6 * 240 * 240 // block
    met = Counter()
    for (kind, low_band, high_band, low, high), rows in groups.items():
        for a in rows:
            for b in rows:
                alone = kind == 0 and (low, low_band) == (high, high_band)
                if (a.node < b.node if alone else a.side < b.side) and part[a.node] != part[b.node]:
                    met[frozenset((a.node, b.node))] += 1
    want = {frozenset((a, b)) for a in leads for b in leads if part[a] != part[b] and leads[a] + leads[b]}
    similar = {p for p in want if 4 * min(size[x] for x in p) >= 3 * max(size[x] for x in p)}
    assert similar <= {p for p in met if sum(leads[x] for x in p)} <= want and max(met.values()) == 1


@pytest.mark.parametrize("own", [8, 16, 22])
def test_template_with_links_against_brute_force(spark, own):
    rows = template_rows(60, own) + [(100 + i, t + f" tail{i}") for i, t in template_rows(20, own)]
    rows += [(200 + i, t) for i, t in template_rows(40, own // 3, seed=7)]
    got = jaccard_components(frame(spark, rows), block=6, hot_entries=30, frequent=100).collect()
    assert sorted((False, r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)
