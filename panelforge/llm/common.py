"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import materialize
from ..session import ensure_checkpoint_dir, scratch_path

#: Characters of text that a Python task handles at once, whatever the size of an Arrow batch.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later uses
    do not recompute it, also after a lost executor."""
    return materialize(df, name, **options)


def two(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id as ``_id`` and the text as ``_text`` (NULL: empty), nothing else."""
    return df.select(F.col(id_col).cast("long").alias("_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))


def whole_rows(docs: DataFrame, text_col: str) -> DataFrame:
    """Each row as the struct ``_id``, whatever its columns are called, and its
    text as ``_text`` (NULL: empty); ``select("_id.*")`` gives the row back."""
    quoted = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*quoted).alias("_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))


def remainder(id_col, mod: int):
    """crc32 of the id written as text, modulo ``mod``; a NULL id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod


def slices(batches, *columns: str):
    """Per Arrow batch, lists of the columns' values of at most ``SLICE_CHARS``
    characters of the last column, or one row."""
    for piece, last in parts(batches, columns[-1]):
        yield (*(piece.column(c).to_pylist() for c in columns[:-1]), last)


def give_back() -> None:
    """Return freed memory to the system: a Python worker is kept after a task, and
    what its allocators hold would count beside the memory of the next stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def parts(batches, column: str = "_text", chars: int = SLICE_CHARS):
    """Pieces of Arrow batches with the column's values as a list, of at most
    ``chars`` characters or one row."""
    give_back()
    for b in batches:
        ends = np.cumsum(pc.utf8_length(b.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + chars, "right")))
            piece = b.slice(start, stop - start)
            yield piece, piece.column(column).to_pylist()
            start = stop


def with_columns(rows: DataFrame, fn, columns: str, chars: int = SLICE_CHARS) -> DataFrame:
    """``rows`` without ``_text``, and the columns that ``fn()(texts)`` gives as
    lists or arrays.  ``fn`` is called once per task, so it may keep a state."""
    from pyspark.sql.types import StructType
    names = [c for c in rows.columns if c != "_text"]
    added = StructType.fromDDL(columns)
    out = StructType([*rows.drop("_text").schema.fields, *added.fields])

    def run(batches):
        of = fn()
        for piece, texts in parts(batches, chars=chars):
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names), *of(texts)],
                                             names=[*names, *added.names])

    return rows.mapInArrow(run, out)


class WordHash(dict):
    """Word (UTF-8 bytes) -> 64-bit hash, remembered for up to ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = h
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


SPACES = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


class Powers:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            def powers(x):
                out = np.full(n, x, np.uint64)
                out[0] = 1
                return np.cumprod(out, dtype=np.uint64)
            self.up, self.down = powers(_STEP), powers(_BACK)
        return self.up[:n], self.down[:n]


class Tokens:
    """The lower-cased (A-Z) words of some texts, in order, as arrays.

    ``raw``: the texts' bytes; ``start`` and ``end`` of each word there; ``doc``:
    which text it is of; ``h``: its 64-bit hash, a polynomial in its bytes,
    taken from running sums, so that no word becomes a Python object."""

    def __init__(self, texts: list[str], powers: Powers):
        parts = [t.encode() for t in texts]
        self.bytes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.raw = b"\n".join(parts).lower() + b"\n"
        b = np.frombuffer(self.raw, np.uint8)
        edge = np.diff(np.r_[True, SPACES[b]].astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = powers.of(len(b))
        term = (b.astype(np.uint64) + np.uint64(1)) * up
        total = np.cumsum(term, dtype=np.uint64)
        h = (total[self.end - 1] - total[self.start] + term[self.start]) * down[self.start]
        self.h = mixed(h + (self.end - self.start).astype(np.uint64))
        first = np.cumsum(self.bytes + 1) - self.bytes - 1
        self.first_word = np.searchsorted(self.start, first)
        self.words = np.diff(np.r_[self.first_word, len(self.start)])
        self.doc = np.repeat(np.arange(len(parts)), self.words)

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]]


class Numbers:
    """Numbers of known hashes (their places in ``known``), -1 for others."""

    def __init__(self, known: np.ndarray):
        bits = max(int(len(known)).bit_length() + 1, 4)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key, self.number = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1)
        todo, slot = np.arange(len(known)), (known >> self.shift).astype(np.int64)
        while len(todo):  # linear probing, all at once: the first of each free slot gets it
            free = self.number[slot] < 0
            at, first = np.unique(np.where(free, slot, -1), return_index=True)
            first = first[at >= 0]
            self.key[slot[first]], self.number[slot[first]] = known[todo[first]], todo[first]
            left = np.ones(len(todo), bool)
            left[first] = False
            todo, slot = todo[left], (slot[left] + 1) & self.mask

    def of(self, h: np.ndarray) -> np.ndarray:
        slot = (h >> self.shift).astype(np.int64)
        out = self.number[slot]
        wrong = np.flatnonzero((out >= 0) & (self.key[slot] != h))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & self.mask
            out[wrong] = self.number[slot[wrong]]
            wrong = wrong[(out[wrong] >= 0) & (self.key[slot[wrong]] != h[wrong])]
        return out
