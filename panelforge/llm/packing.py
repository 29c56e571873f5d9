"""Packing token sequences by minimum bin slack.

Every document is turned into token ids plus one end id.  Whole windows of
``window`` ids are cut off first; the rest of each document, shorter than a
window, goes to a pool.  A window takes the longest piece of the pool and then
the multiset of remaining lengths that fills it closest to capacity: a
subset-sum dynamic program whose reachable sums are the bits of one integer.
Per length it keeps the bits before that length, so that walking back gives
how many pieces of each length were taken.  Where no multiset meets the
capacity, the next piece is cut to fill the gap; what is left at the end of a
partition is cut into sequences whose lengths are powers of two, which need no
padding.

Each partition of the input packs its own documents, batch by batch, with a
bounded pool: no shuffle, and no partition depends on another.  Where the order
of the documents counts, the pool is emptied after every run of so many rows;
what is left of a run, less than a window, starts the next window.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import slices, two

WINDOW = 2048
POOL = 4096
END_ID = 1
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


#: A word of letters that keep their form under normalisation, and the punctuation after it.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


def byte_letters() -> list[str]:
    """Byte-level vocabularies write byte b as chr(b) where that prints, else as
    the next letter from 256 on."""
    prints = [33 <= b <= 126 or 161 <= b <= 255 and b != 173 for b in range(256)]
    return [chr(b) if p else chr(256 + b - sum(prints[:b])) for b, p in enumerate(prints)]


class Encoder(dict):
    """Texts -> little-endian unsigned 32-bit ids, as bytes; a dictionary of
    the chunks seen, of at most ``limit`` entries.

    The vocabulary's pieces never span white space, so a text's ids are those
    of its chunks between ASCII white space, in order.  A plain word goes to
    the vocabulary's merges directly, without the regular expressions before
    them; every other chunk takes the whole tokenizer."""

    def __init__(self, path: str, limit: int = 300_000):
        from tokenizers import Tokenizer
        super().__init__()
        self.tok = Tokenizer.from_file(path)
        self.merges, self.letters, self.limit = self.tok.model, byte_letters(), limit
        self.words: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {"": b""}

    def whole(self, chunk: str) -> bytes:
        return array("I", self.tok.encode(chunk, add_special_tokens=False).ids).tobytes()

    def word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            spelled = word if word.isascii() else "".join(self.letters[b] for b in word.encode())
            got = array("I", [t.id for t in self.merges.tokenize(spelled)]).tobytes()
            if len(self.words) >= self.limit:
                self.words.clear()
            self.words[word] = got
        return got

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        plain = PLAIN.fullmatch(text)
        if plain:
            tail = self.others.get(plain[2])
            if tail is None:
                tail = self.whole(plain[2])
                if len(self.others) < self.limit:
                    self.others[plain[2]] = tail
            got = self.word(plain[1].lower()) + tail
        else:
            got = self.whole(text)
        if len(chunk) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[chunk] = got
        return got

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode().split()))


def fill(counts: list[int], present: int, capacity: int) -> dict[int, int]:
    """The multiset of lengths with the largest sum up to ``capacity``.

    ``counts[n]`` pieces have length n; ``present`` has bit n set where
    ``counts[n]`` > 0.  Returns {length: pieces taken}."""
    reach, mask, steps = 1, (1 << (capacity + 1)) - 1, []
    left = present & mask & ~1
    while left and not reach >> capacity & 1:
        n = left.bit_length() - 1
        left ^= 1 << n
        many, part = min(counts[n], capacity // n), 1
        while many:
            part = min(part, many)
            steps.append((n, part, reach))
            reach |= reach << n * part & mask
            many -= part
            part *= 2
    total, taken = reach.bit_length() - 1, defaultdict(int)
    for n, part, before in reversed(steps):
        if not before >> total & 1:
            taken[n] += part
            total -= n * part
    return taken


class Packer:
    """Pieces in, rows of ``SCHEMA`` out, for one partition."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.next = window, first_sequence
        self.pool: dict[int, list] = defaultdict(list)
        self.counts, self.present, self.size = [0] * (window + 1), 0, 0
        self.rows: list[tuple] = []
        self.first: list[tuple] = []  # left of the run before: the next window starts with them

    def add(self, doc, raw: bytes) -> None:
        total = len(raw) // 4
        whole = total - total % self.window
        for start in range(0, whole, self.window):
            self.emit([(doc, start, raw[4 * start:4 * (start + self.window)], total)])
        if total > whole:
            self.keep((doc, whole, raw[4 * whole:], total))

    def keep(self, piece: tuple) -> None:
        n = len(piece[2]) // 4
        self.pool[n].append(piece)
        self.counts[n] += 1
        self.present |= 1 << n
        self.size += 1

    def take(self, n: int) -> tuple:
        piece = self.pool[n].pop()
        self.counts[n] -= 1
        self.size -= 1
        if not self.counts[n]:
            self.present ^= 1 << n
        return piece

    def cut(self, room: int) -> tuple:
        """Up to ``room`` ids off the longest piece; the rest of it goes back."""
        doc, start, raw, total = self.take(self.present.bit_length() - 1)
        if len(raw) > 4 * room:
            self.keep((doc, start + room, raw[4 * room:], total))
        return doc, start, raw[:4 * room], total

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, raw, total in pieces:
            n = len(raw) // 4
            self.rows.append((doc, start, n, zlib.crc32(raw), total, self.next, offset))
            offset += n
        self.next += 1

    def fill_windows(self, until: int) -> int:
        """Whole windows while more than ``until`` pieces remain; the number of ids left."""
        held = sum(n * c for n, c in enumerate(self.counts) if c) + sum(len(x[2]) // 4 for x in self.first)
        while self.size > until and held >= self.window:
            pieces, self.first = self.first or [self.take(self.present.bit_length() - 1)], []
            room = self.window - sum(len(x[2]) // 4 for x in pieces)
            for n, k in fill(self.counts, self.present, room).items():
                pieces += [self.take(n) for _ in range(k)]
                room -= n * k
            while room:
                pieces.append(self.cut(room))
                room -= len(pieces[-1][2]) // 4
            self.emit(pieces)
            held -= self.window
        return held

    def end_run(self) -> None:
        """Every piece so far goes into windows; less than a window is left for the next one."""
        self.fill_windows(0)
        while self.size:
            self.first.append(self.take(self.present.bit_length() - 1))

    def pack(self, until: int) -> None:
        """Fill windows until at most ``until`` pieces remain (0: all of them)."""
        held = self.fill_windows(until)
        if until == 0:
            while held:
                room = 1 << held.bit_length() - 1
                held -= room
                pieces = []
                while room:
                    pieces.append(self.cut(room))
                    room -= len(pieces[-1][2]) // 4
                self.emit(pieces)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                   text_col: str = "text", window: int = WINDOW, pool: int = POOL,
                   run_rows: int | None = None) -> DataFrame:
    """One row per piece: where it starts in its document's ids, its length and
    crc32, its document's ids, and its sequence and place there.

    A NULL text counts as empty: one piece that holds the end id.  Rows are
    packed one by one, so repeated rows and ids give their own pieces; a NULL
    id stays NULL.  Sequence ids are unique, not dense: the partition's number
    is in the bits from 40 up.  ``pool`` bounds the pieces that wait in a
    partition, not what is packed.  A very long text is encoded whole and
    cut into whole windows.  An empty table gives no rows; other columns are ignored.

    With ``run_rows``, sequence ids follow the order of the rows: each run of so
    many rows of a partition is packed before the next one, so that a row's
    pieces never stand before those of a row ``2 * run_rows`` earlier."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    end = array("I", [END_ID]).tobytes()

    def run(batches):
        encoder = Encoder(tokenizer)
        packer, read = Packer(window, TaskContext.get().partitionId() << 40), 0

        def out():
            cols = list(zip(*packer.rows)) or [()] * len(names)
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

        for ids, texts in slices(batches, "_id", "_text"):
            for doc, text in zip(ids, texts):
                packer.add(doc, encoder.encode(text) + end)
                read += 1
                if run_rows and read % run_rows == 0:
                    packer.end_run()
                elif packer.size >= pool:
                    packer.pack(pool // 2)
            yield out()
        if run_rows:
            packer.end_run()
            for piece in packer.first:
                packer.keep(piece)
            packer.first = []
        packer.pack(0)
        yield out()

    return two(docs, id_col, text_col).mapInArrow(run, SCHEMA)
