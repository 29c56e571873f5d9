"""Toxicity by multiple-instance learning.

A document is a bag of sentences; only the bag has a label.  A sentence's score
is a logistic function of its words (whole and by their first letters), and a
document is toxic unless none of its sentences is (noisy-or).  Gradients of
the document labels reach the sentences through the noisy-or, so training
finds the offending sentences by itself; scoring then names them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, slices, two
from .labelled import training_rows

FEATURE_BITS, PREFIX = 18, 5
#: Labelled rows in the sample, per class.
SAMPLE = 3000
#: A feature counts if at least so many toxic rows of the sample have it, and so many more than
#: their share that chance is unlikely (chi squared).
LEAST_ROWS, LEAST_CHI2 = 3, 15.0
ROUNDS, RATE, LASSO = 200, 0.5, 2e-4
STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
LINE = b"\x00"
#: Added to a word's weight where a sentence ends after it.
END = 4096.0
TOKEN = re.compile(r"[^\x20\x09-\x0D]+|\n")


def features(word: str) -> list[int]:
    """Hashed features of a word without the signs around it, in lower case."""
    core = word.lower().strip(STRIP)
    if not core:
        return []
    out = [xxhash.xxh32_intdigest("w" + core) >> 32 - FEATURE_BITS]
    if len(core) > PREFIX:
        out.append(xxhash.xxh32_intdigest("p" + core[:PREFIX]) >> 32 - FEATURE_BITS)
    return out


def ends(word: str) -> bool:
    return word[-1] in ".!?" or word == "\x00"


def split_words(text: str) -> list[bytes]:
    """Words in order, with a mark for each line end."""
    return text.encode().replace(b"\n", b" \x00 ").split()


class Weights(dict):
    """Word -> its weight, plus ``END`` where it ends a sentence."""

    def __init__(self, weights: np.ndarray, limit: int = 300_000):
        super().__init__()
        self.weights, self.limit = weights, limit

    def __missing__(self, word: bytes) -> float:
        text = word.decode()
        v = float(sum(self.weights[f] for f in features(text))) + END * ends(text)
        if len(self) >= self.limit:
            self.clear()
        self[word] = v
        return v


def sentence_odds(text: str, weights: Weights, bias: float) -> np.ndarray:
    """Log odds of each sentence."""
    words = split_words(text)
    if not words:
        return np.empty(0)
    v = np.fromiter(map(weights.__getitem__, words), np.float64, len(words))
    end = v > END / 2
    v[end] -= END
    starts = np.r_[0, np.flatnonzero(end[:-1]) + 1]
    return np.add.reduceat(v, starts) + bias


def noisy_or(odds: np.ndarray) -> float:
    return float(-np.expm1(-np.logaddexp(0, odds).sum())) if len(odds) else 0.0


def spans(text: str) -> list[tuple[int, int]]:
    """Where the sentences of ``sentence_odds`` start and end in the text."""
    out, first, last = [], None, 0
    for m in TOKEN.finditer(text):
        line = m[0] == "\n"
        if first is None:
            first = m.start()
        if not line:
            last = m.end()
        if line or ends(m[0]):
            out.append((first, max(last, first)))
            first = None
    if first is not None:
        out.append((first, max(last, first)))
    return out


def train(bags: list[tuple[int, list[np.ndarray]]], weight: dict[int, float], rounds: int = ROUNDS):
    """(weights, bias) from (label, features per sentence) bags: adaptive
    gradients on the noisy-or likelihood, with an L1 penalty."""
    size = 1 << FEATURE_BITS
    found = np.zeros((2, size))  # rows of each class with the feature, as in all labelled rows
    toxic = np.zeros(size, np.int64)
    for y, bag in bags:
        if bag:
            f = np.unique(np.concatenate(bag))
            found[y, f] += weight[y]
            toxic[f] += y
    rows = np.array([sum(y == k for y, _ in bags) * weight[k] for k in (0, 1)])
    expected = found.sum(axis=0) * rows[1] / max(rows.sum(), 1e-9)
    more = (found[1] - expected) / max(weight[1], 1e-9)  # in rows of the sample
    chi2 = more ** 2 / np.maximum(expected / max(weight[1], 1e-9), 1e-9)
    usable = (toxic >= LEAST_ROWS) & (more > 0) & (chi2 >= LEAST_CHI2)
    feats, sentence_of, doc_of, n = [], [], [], 0
    for d, (_, bag) in enumerate(bags):
        for s in bag:
            s = s[usable[s]]
            feats.append(s)
            sentence_of.append(np.full(len(s), n))
            doc_of.append(d)
            n += 1
    w, bias = np.zeros(size), -6.0
    if not n or not any(y for y, _ in bags):
        return w.astype(np.float32), bias
    feats, sentence_of, doc_of = np.concatenate(feats), np.concatenate(sentence_of), np.array(doc_of)
    y = np.array([y for y, _ in bags])
    share = np.array([weight[k] for k in y], float)
    share /= share.sum()
    grad2, bias2 = np.full(size, 1e-10), 1e-10
    for _ in range(rounds):
        z = (np.bincount(sentence_of, w[feats], n) + bias).clip(-30, 30)
        p = 1 / (1 + np.exp(-z))
        clean = np.exp(-np.bincount(doc_of, np.logaddexp(0, z), len(y)))
        pull = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) * share
        g_s = pull[doc_of] * p
        g = np.bincount(feats, g_s[sentence_of], size)
        grad2 += g * g
        rate = RATE / np.sqrt(grad2)
        w -= rate * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate * LASSO * np.abs(g).max(), 0) * usable
        gb = g_s.sum()
        bias2 += gb * gb
        bias = min(bias - 0.1 * gb / np.sqrt(bias2), -3.0)
    return w.astype(np.float32), float(bias)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label: str = "toxic", mod: int = 5, held: int = 0, sample: int = SAMPLE):
    """The trained (weights, bias); at most 2 x ``sample`` rows' features come to the driver."""

    def run(batches):
        for y, texts in slices(batches, "y", "_text"):
            known: dict[str, tuple] = {}
            bags = []
            for t in texts:
                flat, stops = [], []
                for w in split_words(t):
                    w = w.decode()
                    if w not in known:
                        known[w] = features(w), ends(w)
                    f, end = known[w]
                    flat += f
                    if end:
                        stops.append(len(flat))
                bags.append((np.array(flat, np.int32).tobytes(), np.array(stops, np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(y, pa.int32()), *(pa.array([b[k] for b in bags], pa.binary()) for k in (0, 1))],
                names=["y", "flat", "stops"])

    rows = training_rows(docs, labels, label, sample, mod, held, id_col, text_col, per_class=True)
    got = rows.select("y", "_text").mapInArrow(run, "y int, flat binary, stops binary").collect()
    bags = [(int(y), [s for s in np.split(np.frombuffer(f, np.int32), np.frombuffer(e, np.int32)) if len(s)])
            for y, f, e in sorted((r.y, r.flat, r.stops) for r in got)]
    counts = {r[0]: r[1] for r in labels.filter(remainder(id_col, mod) != held).groupBy(
        F.col(label).cast("int")).count().collect()}  # one row per label
    weight = {k: counts.get(k, 1) / max(sum(y == k for y, _ in bags), 1) for k in (0, 1)}
    return train(bags, weight)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label: str = "toxic", mod: int = 5, held: int = 0, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``score`` (0 to 1),
    ``predicted`` (score >= 0.5), and ``sentences``: of documents predicted
    toxic, where the offending sentences start and end, with their scores.

    Labels come from rows whose crc32(id as text) mod ``mod`` is not ``held``,
    at most ``sample`` of each class.  A NULL or empty text has no sentence and
    scores 0.  Equal texts get equal scores.  Without labels nothing is toxic;
    an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(
        fit_toxicity(docs, labels, id_col, text_col, label, mod, held, sample))  # 2 ** FEATURE_BITS floats
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        w, bias = shared.value
        weights = Weights(w)
        for ids, held_out, texts in slices(batches, "_id", "_held", "_text"):
            scores, found = [], []
            for t in texts:
                z = sentence_odds(t, weights, bias)
                scores.append(noisy_or(z))
                named = []
                if scores[-1] >= 0.5:
                    p = 1 / (1 + np.exp(-z.clip(-30, 30)))
                    named = [{"start": a, "end": b, "score": float(q)} for (a, b), q in zip(spans(t), p)
                             if q >= min(0.5, p.max())]
                found.append(named)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(held_out, pa.bool_()), pa.array(scores, pa.float64()),
                 pa.array(found, span)], names=["doc_id", "held_out", "score", "sentences"])

    rows = two(docs, id_col, text_col).withColumn("_held", remainder("_id", mod) == held)
    scored = rows.select("_id", "_held", "_text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, "
             "sentences array<struct<start: int, end: int, score: double>>")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).select(
        "doc_id", "held_out", "score", "predicted", "sentences")
