"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are the shapes of its words (letters, capitals, digits and
signs, runs shortened), pairs of neighbouring shapes, words equal to the one
or two before, repeated lines and its length.  Term weights of a bounded
sample of labelled texts give a latent-semantic space (the strongest
directions of the weighted term matrix) and the sample's vectors there.  Both
are broadcast; each document's cosine with every labelled vector is computed
exactly, in blocks, and the nearest ones vote, weighted by similarity.
"""

from __future__ import annotations

import re
import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, slices, two, whole_rows, with_columns
from .labelled import training_rows

#: Terms: hashed shapes, hashed pairs of shapes, then the others.
SHAPES, PAIRS, OTHERS = 480, 480, 64
TERMS = SHAPES + PAIRS + OTHERS
EQUAL1, EQUAL2, LINES, EMPTY, LENGTH = (SHAPES + PAIRS + k for k in (0, 1, 2, 3, 8))
RUNS = re.compile(r"(.)\1+")
#: Labelled rows in the sample, directions kept, neighbours that vote, power of the similarity.
SAMPLE, DIRECTIONS, NEIGHBOURS, POWER = 6000, 48, 25, 8
BLOCK = 1024


def shape(word: str) -> str:
    """``Then!!`` -> ``Aa!``: what a word looks like, whatever it says."""
    out = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
                  for c in word[:40])
    return RUNS.sub(r"\1", out)[:6]


class Shapes(dict):
    """Word -> number of its hashed shape, for up to ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        k = zlib.crc32(shape(word.decode()).encode()) % SHAPES
        if len(self) >= self.limit:
            self.clear()
        self[word] = k
        return k


def terms(text: str, shapes: Shapes) -> np.ndarray:
    """Square roots of the terms' shares of the whole text."""
    out = np.zeros(TERMS, np.float32)
    raw = text.encode()
    words = raw.split()
    n = len(words)
    if not n:
        out[EMPTY] = 1
        return out
    s = np.fromiter(map(shapes.__getitem__, words), np.int64, n)
    out[:SHAPES] = np.bincount(s, minlength=SHAPES)
    if n > 1:
        pair = (s[:-1] * 31 + s[1:] * 7919) % PAIRS
        out[SHAPES:SHAPES + PAIRS] = np.bincount(pair, minlength=PAIRS)
        out[EQUAL1] = 4 * sum(map(eq, words[1:], words))
        out[EQUAL2] = 4 * sum(map(eq, words[2:], words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    out /= n
    out[LINES] = 1 - len(set(lines)) / max(len(lines), 1)
    out[LENGTH + min(n.bit_length(), 20)] = 0.01
    return np.sqrt(out)


def fit(x: np.ndarray, y: np.ndarray, directions: int):
    """Term weights, directions, unit vectors of the sample, labels, share of label 1."""
    weights = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + np.float32(0.3)
    z = x * weights
    _, basis = np.linalg.eigh((z.T @ z).astype(np.float64))
    basis = np.ascontiguousarray(basis[:, ::-1][:, :directions], dtype=np.float32)
    return weights, basis, unit(z @ basis), y.astype(np.float32), float(y.mean()) if len(y) else 0.5


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def vote(x: np.ndarray, model, neighbours: int, power: int) -> np.ndarray:
    """Scores of a block of term vectors; ``neighbours`` nearest, ties all by weight."""
    weights, basis, known, y, share = model
    if not len(y):
        return np.full(len(x), share)
    cosine = unit((x * weights) @ basis) @ known.T
    k = min(neighbours, len(y))
    near = np.argpartition(cosine, len(y) - k, axis=1)[:, len(y) - k:]
    w = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** power
    return (np.where(y[near] > 0, w, 0).sum(axis=1) + 1e-3 * share) / (w.sum(axis=1) + 1e-3)


def _matrix(texts: list[str], shapes: Shapes) -> np.ndarray:
    return np.stack([terms(t, shapes) for t in texts])


def quality_scores(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None,
                   id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
                   mod: int = 3, held: int = 1, sample: int = SAMPLE, directions: int = DIRECTIONS,
                   neighbours: int = NEIGHBOURS, power: int = POWER) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``score`` (0 to 1, higher:
    label 1 likelier) and ``predicted`` (score >= 0.5).

    Labels come from rows whose crc32(id as text) mod ``mod`` is not ``held``,
    at most ``sample`` of them, with the texts of ``train_docs`` (default:
    ``docs``).  A NULL text counts as empty and is scored like any other.
    Equal texts get equal scores.  Texts are scored whole.  Without labels the
    score is 0.5; an empty table gives no rows; other columns are ignored."""
    model = fit_quality(docs if train_docs is None else train_docs, labels, id_col, text_col, label,
                        mod, held, sample, directions)
    rows = two(docs, id_col, text_col).withColumn("_held", remainder("_id", mod) == held)
    return scored(rows, model, neighbours, power).select(
        F.col("_id").alias("doc_id"), F.col("_held").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def scored(rows: DataFrame, model, neighbours: int, power: int) -> DataFrame:
    """``rows`` without ``_text``, and its ``score``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # at most sample x directions floats

    def fn():
        shapes = Shapes()
        return lambda texts: [pa.array(np.concatenate(
            [vote(_matrix(texts[i:i + BLOCK], shapes), shared.value, neighbours, power)
             for i in range(0, len(texts), BLOCK)]), pa.float64())]

    return with_columns(rows, fn, "score double")


def good_rows(docs: DataFrame, labels: DataFrame, train_docs: DataFrame, id_col: str = "doc_id",
              text_col: str = "text", label: str = "quality", mod: int = 3, held: int = 1,
              sample: int = SAMPLE, directions: int = DIRECTIONS, neighbours: int = NEIGHBOURS,
              power: int = POWER) -> DataFrame:
    """The rows of ``docs`` with a score of 0.5 or more, all columns."""
    model = fit_quality(train_docs, labels, id_col, text_col, label, mod, held, sample, directions)
    return scored(whole_rows(docs, text_col), model, neighbours, power).filter(
        "score >= 0.5").select("_id.*")


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label: str = "quality", mod: int = 3, held: int = 1, sample: int = SAMPLE,
                directions: int = DIRECTIONS):
    """The model of ``vote``: term vectors of at most ``sample`` rows come to the driver."""

    def run(batches):
        shapes = Shapes()
        for y, texts in slices(batches, "y", "_text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(y, pa.int32()),
                 pa.array([terms(t, shapes).astype(np.float16).tobytes() for t in texts], pa.binary())],
                names=["y", "x"])

    rows = training_rows(docs, labels, label, sample, mod, held, id_col, text_col).select("y", "_text")
    got = sorted((r.x, r.y) for r in rows.mapInArrow(run, "y int, x binary").collect())  # the same order each time
    x = np.frombuffer(b"".join(x for x, _ in got), np.float16).reshape(-1, TERMS).astype(np.float32)
    return fit(x, np.array([y for _, y in got], int), directions)
