"""Quality rules combined by weak supervision.

Each rule looks at counts of a text and votes good (1), bad (-1) or abstains
(0).  Expectation-maximisation over the vote patterns estimates, without
labels, how often each rule votes good and bad among good and among bad
texts; the posterior probability of "good" then replaces an all-must-pass
filter.  The rules' votes are counted by pattern first: 3 ** (number of rules)
patterns at most, whatever the number of documents, so the estimate needs one
small aggregate and covers all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, mixed, two, whole_rows, with_columns

#: Counts of a text, all whole numbers.
FACTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_lines", "n_distinct", "n_adjacent", "n_upper", "n_letters", "n_pipes", "n_shouts"]

SPACE, SYMBOL, LETTER, UPPER = 1, 2, 4, 8
#: What a code point is; those from 0x500 up count as letters without case.
KINDS = np.array([SPACE * (chr(c) in " \t\n\v\f\r") + SYMBOL * (chr(c) in "#*$%&|<>")
                  + LETTER * chr(c).isalpha() + UPPER * chr(c).isupper()
                  for c in range(0x500)] + [LETTER], np.uint8)


def _above(num: str, den: str, bad: float, least: int = 0):
    """Votes bad where ``num`` exceeds ``bad`` times ``den`` and is ``least`` or more."""
    return F.when((F.col(num) > bad * F.col(den)) & (F.col(num) >= least), -1).otherwise(0)


#: The rules: name and vote.  Signs of junk vote bad or abstain; signs of prose vote good or
#: abstain, and bad only far outside prose.
RULES = {
    "symbols": lambda: _above("n_symbols", "n_words", 0.2),
    "pipes": lambda: _above("n_pipes", "n_words", 0.1),
    "shouts": lambda: _above("n_shouts", "n_words", 0.15),
    "capitals": lambda: _above("n_upper", "n_letters", 0.5, 20),
    "adjacent": lambda: _above("n_adjacent", "n_words", 0.15, 3),
    "repeats": lambda: _above("n_repeat_words", "n_words", 0.45),
    "lines": lambda: _above("n_dup_lines", "n_lines", 0.3, 4),
    "length": lambda: F.when(F.col("n_words") >= 100, 1).otherwise(0),
    "variety": lambda: F.when(F.col("n_distinct") * 20 < F.col("n_words"), -1)
        .when((F.col("n_distinct") * 3 > F.col("n_words")) | (F.col("n_distinct") > 500), 1)
        .otherwise(0),
    "word_length": lambda: F.when(F.col("word_chars") > 20 * F.col("n_words"), -1)
        .when(F.col("word_chars").between(3 * F.col("n_words"), 10 * F.col("n_words")), 1)
        .otherwise(0),
}


def _text_facts(text: str, hashes: WordHash) -> tuple:
    raw = text.encode()
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * len(FACTS)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kinds = np.bincount(KINDS[np.minimum(points, 0x500)], minlength=16)

    def of(bit: int) -> int:
        return int(sum(k for i, k in enumerate(kinds) if i & bit))

    h = hashes.array(words)
    repeat = 0
    if n > 3:
        w = mixed(mixed(mixed(h[:-2]) + h[1:-1]) + h[2:])
        _, inverse, times = np.unique(w, return_inverse=True, return_counts=True)
        at = np.zeros(n, bool)
        found = times[inverse] > 1
        for k in range(3):
            at[k:n - 2 + k] |= found
        repeat = int(at.sum())
    seen, lines, dup = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.split(None, 1):
            lines += 1
            if line in seen:
                dup += 1
            seen.add(line)
    return (n, len(text) - of(SPACE), of(SYMBOL), dup, repeat, lines, len(np.unique(h)),
            int((h[1:] == h[:-1]).sum()), of(UPPER), of(LETTER), words.count(b"|"),
            raw.count(b"!!"))


def text_facts(rows: DataFrame) -> DataFrame:
    """``FACTS`` of each whole ``_text``, beside ``_id``, in one pass.

    Words are runs other than space and U+0009 to U+000D.  ``n_repeat_words``:
    words inside a window of three that occurs twice or more in the text."""

    def fn():
        hashes = WordHash()
        return lambda texts: [pa.array(c, pa.int64()) for c in zip(*(_text_facts(t, hashes) for t in texts))]

    return with_columns(rows, fn, ", ".join(f"{c} long" for c in FACTS))


def em(votes: np.ndarray, counts: np.ndarray, rounds: int = 300, tol: float = 1e-9,
       false_alarm: float = 0.002):
    """Two-class model of the votes: P(vote | class) per rule, and the class share.

    ``votes``: patterns x rules in {-1, 0, 1}; ``counts``: rows per pattern.
    It starts from the patterns themselves (a text with a bad vote is probably
    bad) and alternates: accuracies from the posteriors, posteriors from the
    accuracies.  Three priors name the classes and settle small or one-sided
    tables: pseudo-counts; rules that are written to be precise, so a good text
    draws a bad vote of a rule at most ``false_alarm`` of the time; and a text
    without any bad vote is good.
    Returns (posterior of good per pattern, share of good,
    accuracies[class, vote + 1, rule] for the classes good and bad)."""
    is_vote = np.stack([votes == v for v in (-1, 0, 1)]).astype(float)  # vote x pattern x rule
    bad_votes = (votes == -1).sum(axis=1)
    post = np.select([bad_votes == 0, bad_votes == 1], [0.98, 0.2], 0.01)
    prior = np.array([[0.01, 0.5, 1.5], [0.5, 1.0, 0.5]])[:, :, None] * np.ones(votes.shape[1])
    for _ in range(rounds):
        weight = np.stack([counts * post, counts * (1 - post)])  # class x pattern
        acc = np.einsum("cp,vpr->cvr", weight, is_vote) + prior
        acc /= acc.sum(axis=1, keepdims=True)
        over = np.maximum(acc[0, 0] - false_alarm, 0)
        acc[0, 0] -= over
        acc[0, 2] += over
        share = (weight[0].sum() + 9) / (counts.sum() + 10)
        logs = np.einsum("vpr,cvr->cp", is_vote, np.log(acc))
        new = 1 / (1 + np.exp(np.clip(logs[1] - logs[0] + np.log((1 - share) / share), -500, 500)))
        new = np.where(bad_votes == 0, np.maximum(new, 0.98), new)
        moved, post = np.abs(new - post).max(initial=0), new
        if moved < tol:
            break
    return post, share, acc


def verdicts(rows: DataFrame, min_words: int, max_repeat_percent: int, threshold: float) -> DataFrame:
    """``_id`` of ``rows``, ``FACTS``, ``base_failed``, ``p_good``, ``kept``."""
    facts = text_facts(rows).select(
        "*", *(vote().cast("int").alias(f"v_{name}") for name, vote in RULES.items()))
    # One digit per rule: a pattern is one number below 3 ** len(RULES).
    code = sum(((F.col(f"v_{name}") + 1) * 3 ** i for i, name in enumerate(RULES)), F.lit(0))
    facts = facts.withColumn("_code", code)
    seen = facts.groupBy("_code").count().collect()  # at most 3 ** len(RULES) rows
    codes = np.array([r[0] for r in seen], int)
    votes = np.array([[c // 3 ** i % 3 - 1 for i in range(len(RULES))] for c in codes], int)
    post = em(votes.reshape(-1, len(RULES)), np.array([r[1] for r in seen], float))[0]
    known = rows.sparkSession.createDataFrame([(int(c), float(p)) for c, p in zip(codes, post)],
                                              "_code int, p_good double")
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return (facts.join(F.broadcast(known), "_code", "left")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.coalesce(F.col("p_good"), F.lit(1.0)) >= threshold))
            .select("_id", *FACTS, "base_failed", "p_good", "kept"))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     min_words: int = 50, max_repeat_percent: int = 50,
                     threshold: float = 0.5) -> DataFrame:
    """Per row: the id as ``doc_id``, ``FACTS``, ``base_failed``, ``p_good`` (the
    posterior) and ``kept``.

    A NULL text counts as empty: no words, so it fails the base.  Every row
    gets a verdict of its own text, so repeated rows agree; NULL ids stay NULL.
    An empty table gives no rows.  Two passes over the texts: one counts the
    vote patterns, one applies the verdicts."""
    return verdicts(two(docs, id_col, text_col), min_words, max_repeat_percent,
                    threshold).withColumnRenamed("_id", "doc_id")


def good_rows(docs: DataFrame, text_col: str = "text", min_words: int = 50,
              max_repeat_percent: int = 50, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose texts are kept, all columns."""
    return verdicts(whole_rows(docs, text_col), min_words, max_repeat_percent, threshold).filter(
        "kept").select("_id.*")
