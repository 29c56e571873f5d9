import hashlib
import random
import re
import time

from panelforge.llm import pii
from panelforge.llm.pii import KINDS, all_spans, find_identifiers, plain_spans, span_digests

from .data import awkward, frame

NAIVE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _checksum(digits):
    total = 0
    for i, d in enumerate(digits[::-1]):
        v = int(d) * (1 + i % 2)
        total += v // 10 + v % 10
    return total % 10 == 0


def brute_force(text):
    """The patterns as they are given, each match tested afterwards."""
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(NAIVE[kind], text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and _checksum(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def _random_text(rng):
    parts = ["@", ".", "a", "b-", "x.y", "1", "12", "255", "256", "4111 1111 1111 1111", "+", " ", "-", "(", ")",
             "00", "7", "a@b.c", "1.2.3.4", "..", "é", "日"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))


def test_plain_spans_are_those_of_the_patterns():
    rng = random.Random(5)
    for _ in range(20_000):
        text = _random_text(rng)
        assert plain_spans(text) == brute_force(text), text


DISGUISED = [
    ("mail jo.doe (at) example [dot] com now", "email", "jo.doe (at) example [dot] com", "jo.doe@example.com"),
    ("write to jo dot doe at example dot com please", "email", "jo dot doe at example dot com", "jo.doe@example.com"),
    ("joe AT mail DOT example DOT co DOT uk. Then", "email", "joe AT mail DOT example DOT co DOT uk",
     "joe@mail.example.co.uk"),
    ("ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ ok", "email", "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "joe@example.com"),
    ("an jоe@exаmple.com an", "email", "jоe@exаmple.com", "joe@example.com"),
    ("see j​oe@ex­ample.com", "email", "j​oe@ex­ample.com", "joe@example.com"),
    ("call plus one five five five one two three four five six seven", "phone",
     "plus one five five five one two three four five six seven", "+15551234567"),
    ("vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", "card",
     "vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", "4" + "1" * 15),
    ("+1 (O17) 555-77l3", "phone", "+1 (O17) 555-77l3", "+1 (017) 555-7713"),
    ("٤١١١ ١١١١ ١١١١ ١١١١", "card", "٤١١١ ١١١١ ١١١١ ١١١١", "4111 1111 1111 1111"),
    ("at one nine two dot one six eight dot one dot one ok", "ip",
     "one nine two dot one six eight dot one dot one", "192.168.1.1"),
]


def test_disguises_are_traced_back_to_the_source():
    for text, kind, source, form in DISGUISED:
        (a, k, b, found, plain), = all_spans(text)
        assert (KINDS[k], text[a:b], found, plain) == (kind, source, form, False)


def test_hints_miss_nothing():
    import pyarrow as pa
    rng = random.Random(8)
    odd = [t for t, *_ in DISGUISED] + ["joe[at]mail.example", "joe _at_ mail _dot_ com", "joe @ mail dot com", "joe@ mail (dot) com",
                                        "joe at mail. dot com", "+١٢٣ 456 7890", "1l.2.3.4", "ONE-TWO-THREE, four five six seven eight nine"]
    texts = [_random_text(rng) for _ in range(3000)] + odd + [
        "".join(rng.choice([" at ", "(at)", " dot ", "[dot]", "a", "b.c", " ", "@", "com", "one ", "zwei-", "+", "7", "l", "O", ".", "​"])
                for _ in range(rng.randint(1, 14))) for _ in range(6000)]
    assert pii.spans_of(pa.array(texts)) == [all_spans(t) for t in texts]


def test_prose_stays():
    for text in ["I looked at the dot matrix at noon", "meet me at example.com", "one two three", "иса@mail.ru",
                 "at one point five of us were at a dot", "Wir sind um acht an Punkt drei.", "été–hiver 2020·2021"]:
        assert all_spans(text) == [], text


def test_plain_spans_stay_beside_disguised_ones():
    text = "a@b.example and c (at) d.example; 10.0.0.1, 1O.0.0.2, a@b.c​om"
    spans = all_spans(text)
    assert [(s[0], s[1], s[2]) for s in spans if s[4]] == brute_force(text)
    assert {text[a:b] for a, _, b, _, plain in spans if not plain} == {"c (at) d.example", "1O.0.0.2"}
    assert spans == sorted(spans)


def test_offsets_of_a_transducer_map_back():
    rng = random.Random(2)
    for _ in range(500):
        source = "".join(rng.choice("abcd") for _ in range(30))
        cuts = sorted(rng.sample(range(30), 6))
        edits = [(cuts[i], cuts[i + 1], rng.choice(["", "X", "YZ"])) for i in (0, 2, 4)]
        step = pii.Rewritten(source, edits)
        for i, c in enumerate(step.text):
            a, b, changed = step.back(i, i + 1)
            assert (c in "XYZ") == changed
            assert changed or source[a:b] == c


def test_long_texts_take_linear_time():
    n = 300_000
    for text in ["a" * n + "@" + "b" * n, "1" * n, "1." * n, "+1" + "(" * n, "at " * n, "one " * n, "@" * n, "а" * n,
                 " " * n, "a at b " * n, "1O" * n, "​" * n, "a (at) " * n]:
        began = time.monotonic()
        all_spans(text)
        assert time.monotonic() - began < 20, text[:20]


def test_every_row_gets_a_result(spark):
    rows = awkward() + [(90, "card 4111 1111 1111 1111, a@b.example"), (91, "a@b.example 1.2.3.4")]
    got = span_digests(find_identifiers(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        spans = brute_force(t or "")
        digest = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        want.append((i, *[sum(k == kind for _, k, _ in spans) for kind in range(4)],
                     hashlib.sha256(digest.encode()).hexdigest()))
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted(want, key=key)
    assert span_digests(find_identifiers(frame(spark, []))).count() == 0


def test_the_query_agrees_with_the_patterns_on_the_test_table(spark):
    from panelforge.llm.common import table
    from panelforge.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in QUERIES["op11_pii"](spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        spans = brute_force(d["text"] or "")
        joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        r = got[d["doc_id"]]
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[1] == i for x in spans) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r["spans"].split(","))
