import hashlib
import itertools
import random
import re
import zlib

from panelforge.llm.audits import CUT, GONE, Audits, Pieces, cheapest_audit, piece_scripts
from panelforge.llm.conversations import damaged, digests, repair_conversations

GOOD = re.compile("(s?(ua)+)?")


def shown(text):
    return text.rstrip(" \t\n\x0b\x0c\r")


def brute_force_rows(rows):
    """Damage by its definition: (turn, role, text) per conversation, in order."""
    out = {}
    for conv, turn, role, text in rows:
        name = " " if conv is None else conv
        kind = zlib.crc32(f"{name}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        here = out.setdefault(conv, [])
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        here += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {c: sorted(rs, key=key) for c, rs in out.items()}


def all_scripts(rows):
    """Every script with up to two inserts in a row: (cost, audit, repaired rows)."""
    gone, cut, seen = [], [], set()
    for _, role, text in rows:
        gone.append(not shown(text) or (role, text) in seen)
        cut.append(bool(shown(text)) and not gone[-1] and shown(text)[-1] not in ".!?")
        seen.add((role, text))
    choices = []
    for (_, role, text), g, c in zip(rows, gone, cut):
        options = [(3, "D", None)]
        if not g:
            options += [(c, "K", (role, text))] + [(2 + c, "R", (r, text)) for r in ("user", "assistant")]
        choices.append(options)
    inserts = [()] + [tuple((2, "I", (r, "")) for r in rs) for n in (1, 2) for rs in itertools.product(("user", "assistant"), repeat=n)]
    for picks in itertools.product(*choices):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            line = list(gaps[0])
            for p, g in zip(picks, gaps[1:]):
                line += [p, *g]
            kept = [e[2] for e in line if e[2]]
            initials = "".join((r[:1] if r[:1] in "sua" and r[:1] else "?") for r, _ in kept)
            if GOOD.fullmatch(initials):
                yield sum(e[0] for e in line), "".join(e[1] for e in line), kept, gone, cut


def brute_force(rows):
    out = []
    for conv, here in brute_force_rows(rows).items():
        cost, audit, kept, gone, cut = min(all_scripts(here), key=lambda s: s[:2])
        turns = [t for t, _, _ in here if t is not None]
        blank = sum(not shown(t) for _, _, t in here)
        initials = [r[:1] for _, r, _ in here]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, blank, sum(gone) - blank, sum(cut),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return out


def random_rows(rng, convs, longest):
    rows = []
    for c in range(convs):
        for _ in range(rng.randint(1, longest)):
            rows.append((None if c == 0 else c, rng.choice([None, 0, 1, 2, 3, 9, rng.randrange(10**6)]),
                         rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool"]),
                         rng.choice(["Hi.", "Yes!", "No", "and so on ", "", " \t", None, "Why?\n"])))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, edit string, at string, pos string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "e", "a", "p") for r in rows], SCHEMA)


def repaired(spark, rows, **options):
    t = table(spark, rows)
    return sorted((tuple(r) for r in digests(repair_conversations(damaged(t), names=t, **options)).collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0))


def test_against_brute_force(spark):
    rows = random_rows(random.Random(1), 60, 3)
    key = lambda r: (r[0] is not None, r[0] or 0)
    want = sorted(brute_force(rows), key=key)
    assert repaired(spark, rows) == want
    # block by block: every conversation of more than one row is a long one
    assert repaired(spark, rows, whole_rows=1, block=2) == want


def test_blocks_agree_with_whole_conversations(spark):
    rows = random_rows(random.Random(2), 12, 80) + [(99, i, "tool", f"{i}") for i in range(300)] + [
        (98, None, "user", "same.")] * 200
    whole = repaired(spark, rows)
    for block in (1, 7, 64):
        assert repaired(spark, rows, whole_rows=5, block=block) == whole
    assert repaired(spark, rows, whole_chars=40, block=16) == whole


def naive_audit(codes):
    """The same programme on plain strings."""
    def close(best):
        for a, b in ((0, 2), (1, 2), (3, 2), (2, 3)):
            if a in best:
                c = (best[a][0] + 2, best[a][1] + "I")
                best[b] = min(best.get(b, c), c)
        return best
    best = close({0: (0, "")})
    for code in codes:
        now = {}
        for s, (c, t) in best.items():
            options = [(s, c + 3, "D")]
            if not code & GONE:
                to, more = (3 if s == 2 else 2), int(code & CUT > 0)
                options.append((to, c + 2 + more, "R"))
                if code & 3 == to - 1:
                    options.append((to, c + more, "K"))
                if s == 0 and code & 3 == 0:
                    options.append((1, c + more, "K"))
            for to, cost, letter in options:
                new = (cost, t + letter)
                now[to] = min(now.get(to, new), new)
        best = close(now)
    return min(best[s] for s in (0, 3) if s in best)


def random_codes(rng, n):
    return bytes(rng.choice([0, 1, 1, 2, 2, 3]) + rng.choice([0, 0, 0, GONE, CUT]) for _ in range(n))


def test_persistent_scripts_agree_with_plain_strings():
    rng = random.Random(3)
    for _ in range(1500):
        codes = random_codes(rng, rng.randint(0, 30))
        want = naive_audit(codes)
        assert cheapest_audit(codes) == want
        pieces, at = Pieces(), 0
        while at < len(codes):
            n = rng.randint(1, 9)
            pieces.append(piece_scripts(codes[at:at + n]))
            at += n
        cost, scripts = pieces.result()
        assert (cost, "".join(scripts)) == want


def test_comparison_and_collisions():
    rng = random.Random(4)
    for hash_of in (hash, lambda s: 1):  # with the second one all scripts of a length collide
        audits = Audits(hash_of)
        nodes, scripts = [0], [""]
        for _ in range(400):
            i = rng.randrange(len(nodes))
            letter = rng.choice("DK")
            nodes.append(audits.add(nodes[i], letter))
            scripts.append(scripts[i] + letter)
        for _ in range(6000):
            i, j = rng.randrange(401), rng.randrange(401)
            assert audits.less(nodes[i], nodes[j]) == (scripts[i] < scripts[j])
        assert (audits.collisions > 0) == (hash_of is not hash)
        for i in range(401):
            d = rng.randint(0, len(scripts[i]))
            assert audits.script(audits.ancestor(nodes[i], d)) == scripts[i][:d]


def test_empty_table_and_dropped_conversations(spark):
    assert repaired(spark, []) == []
    gone = [t for t in range(500) if zlib.crc32(f"7:{t}".encode()) % 20 == 0]
    empty = hashlib.sha256(b"").hexdigest()
    assert repaired(spark, [(7, t, "user", "x.") for t in gone]) == [(7, 0, 0, 0, 0, 0, 0, "", empty)]
