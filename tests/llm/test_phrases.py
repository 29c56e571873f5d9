import random
import re
from collections import Counter

import numpy as np

from panelforge.llm import phrases as P
from panelforge.llm.common import Powers
from panelforge.llm.phrases import chunk_dictionary, exact_counts, hashed_counts, mine_phrases

from .data import awkward

SCHEMA = "doc_id long, text string, lang string, n string, score string, phrase long, words string, chunk string"


def table(spark, rows):
    """(text, lang) rows with columns whose names clash with those of the operator."""
    return spark.createDataFrame([(i, t, la, "n", "s", i, "w", "c") for i, (t, la) in enumerate(rows)], SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def counted(rows):
    """Every phrase of one to four words, counted one by one."""
    f = Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f["und" if lang is None else lang, tuple(w[i:i + k])] += 1
    return f


def brute_force(rows, min_count, top):
    f = counted(rows)
    n = Counter()
    for (lang, p), c in f.items():
        n[lang] += c * (len(p) == 1)
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    out = {}
    for (lang, p), a in cand.items():
        if any(la == lang and len(q) > len(p) and 100 * b >= 80 * a
               and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (la, q), b in cand.items()):
            continue
        score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), " ".join(p), a, f[lang, p[:k]],
                                         f[lang, p[k:]], n[lang], score))
    return sorted((lang, i, *r[3:]) for lang, rs in out.items() for i, r in enumerate(sorted(rs)[:top], 1))


def mined(frame, **options):
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in mine_phrases(frame, **options).select(*cols).collect())


def random_rows(rng, n, vocabulary):
    words = [rng.choice(["a", "B", "é", "日", "x-y"]) + str(i) for i in range(vocabulary)]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ", ", "\n", "!! ", " ? ", "\r\n"]
    stock = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(3, 30))) for _ in range(8)]
    return [("".join(rng.choice(stock) if rng.random() < 0.3 else rng.choice(words) + rng.choice(gaps)
                     for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None, "und", ""])) for _ in range(n)]


def test_against_brute_force(spark):
    for seed, trigger, top in ((1, 2, 1000), (2, 16, 5), (3, 1, 1000)):
        rows = random_rows(random.Random(seed), 120, 25)
        assert mined(table(spark, rows), min_count=4, top=top, trigger=trigger) == brute_force(rows, 4, top)


ALL = P.Bitmap(np.full(4, -1, np.int64).view(np.uint64))


def test_each_occurrence_is_owned_once(spark):
    rows = random_rows(random.Random(7), 60, 12) + [("w " * 400, "en"), (" ".join(map(str, range(3000))), "en")]
    want = counted(rows)
    for trigger in (1, 3, 16):
        d = chunk_dictionary(table(spark, rows), trigger=trigger)
        got = {(r["lang"], tuple(r["phrase"].split(" "))): r["f"]
               for r in exact_counts(d, ALL, ALL).filter("words > 0").collect()}
        assert got == want
        for k in (1, 2):
            hashed = [r["f"] for r in hashed_counts(d, k).collect()]
            assert sorted(hashed) == sorted(c for key, c in want.items() if len(key[1]) == k)


def test_chunks_overlap_by_the_trigger_words():
    rng = random.Random(3)
    words = [str(rng.randrange(40)) for _ in range(2000)]
    chunks, head = P.parse([" ".join(words)], Powers(), 4)
    assert len(chunks) > 100 and list(np.flatnonzero(head)) == [0]
    back = chunks[0].split()
    for c in chunks[1:]:
        assert back[-P.OVERLAP:] == c.split()[:P.OVERLAP]
        back += c.split()[P.OVERLAP:]
    assert [b.decode() for b in back] == words
    # the places depend on content: the same passage elsewhere is cut alike
    other, _ = P.parse(["new start " + " ".join(words)], Powers(), 4)
    assert len(set(chunks) - set(other)) <= 2


def test_a_bitmap_never_loses_a_hash(spark):
    rng = np.random.default_rng(1)
    h = rng.integers(-2**63, 2**63 - 1, 5000)
    bitmap = P.bitmap_of(spark.createDataFrame([(int(x),) for x in h], "h long"))
    assert bitmap.may_hold(h.view(np.uint64)).all()
    assert bitmap.may_hold(rng.integers(0, 2**63 - 1, 5000).astype(np.uint64)).mean() < 0.2


def test_sql_and_awkward_rows(spark):
    import duckdb
    base = [(t, la) for (_, t), la in zip(awkward(), ["en", None, "und", "de"] * 20)]
    rows = base * 6 + random_rows(random.Random(4), 400, 9)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = mined(table(spark, rows))
    assert len(got) > 100
    assert got == sorted(con.execute(P.PHRASE_SQL).fetchall())


def test_exact_beyond_64_bits(spark):
    # the score's formula on counts whose products pass 64 bits
    big = 9_000_000_000_000_000
    row = spark.createDataFrame([(big, big + 1, big + 3)], "a long, l long, r long")
    got = row.selectExpr(P.score_sql()).first()[0]
    assert got == 2_000_000 * big // (2 * big + 4)


def test_empty_tables(spark):
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(None, "en"), ("", None), (" .,\n", "en")])) == []
