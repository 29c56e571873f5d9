import itertools
import random
import zlib

import numpy as np
import pytest

from panelforge.llm.packing import Encoder, Packer, fill, pack_documents

from .data import awkward, frame

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


def test_fill_is_the_best_subset_sum():
    rng = random.Random(3)
    for _ in range(200):
        lengths = [rng.randint(1, 12) for _ in range(rng.randint(0, 9))]
        counts, cap = [lengths.count(n) for n in range(13)], rng.randint(1, 12)
        present = sum(1 << n for n in set(lengths))
        taken = fill(counts, present, cap)
        assert all(0 < k <= counts[n] for n, k in taken.items())
        best = max(sum(c) for r in range(len(lengths) + 1) for c in itertools.combinations(lengths, r)
                   if sum(c) <= cap)
        assert sum(n * k for n, k in taken.items()) == best


def test_no_padding_and_no_token_lost():
    rng = random.Random(4)
    packer, total = Packer(64, 0), 0
    for i in range(500):
        n = rng.choice([1, 40, rng.randint(1, 200)])
        packer.add(i, np.arange(n, dtype="<u4").tobytes())
        total += n
        if packer.size > 50:
            packer.pack(25)
    packer.pack(0)
    sizes = {}
    for _, _, n, _, _, seq, offset in packer.rows:
        assert sizes.get(seq, 0) == offset
        sizes[seq] = offset + n
    assert sum(sizes.values()) == total
    assert all(s == 64 or s & (s - 1) == 0 for s in sizes.values())


def test_encoder_equals_the_whole_tokenizer():
    from tokenizers import Tokenizer
    tok, enc = Tokenizer.from_file(PATH), Encoder(PATH, limit=7)
    for t in ["", "Don't STOP!! l’été ÅNGström 12ab ½ ß ẞ ſ ﬁ é ÷× <|endoftext|>x a\x1cb", "Then, then.   then",
              *(t or "" for _, t in awkward())]:
        assert enc.encode(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_pieces_give_the_documents_back(spark):
    from tokenizers import Tokenizer
    tok, rows = Tokenizer.from_file(PATH), awkward()
    got = pack_documents(frame(spark, rows).coalesce(1), PATH).collect()
    want = [(i, np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")) for i, t in rows]
    pieces = sorted((-1 if r.doc_id is None else r.doc_id, r.doc_tokens, r.start, r.length, r.ids_crc32) for r in got)
    for i, ids in want:  # every row's pieces tile its ids
        at = 0
        while at < len(ids):
            mine = [p for p in pieces if p[:3] == (-1 if i is None else i, len(ids), at)
                    and zlib.crc32(ids[at:at + p[3]].tobytes()) == p[4]]
            assert mine
            pieces.remove(mine[0])
            at += mine[0][3]
    assert not pieces


def test_empty_table(spark):
    assert pack_documents(frame(spark, []), PATH).count() == 0
