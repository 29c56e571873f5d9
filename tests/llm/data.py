"""Small tables with the awkward cases every operator must bear."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("n_words", T.StringType()), T.StructField("node", T.LongType())])

WORDS = ("the of and to in is on that for was with as by at are from this be it an "
         "river stone garden window letter market winter bridge forest silver").split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "ed"]) for _ in range(n))


def prose(rng, n):
    out = []
    while n > 0:
        k = min(n, rng.randint(5, 14))
        out.append(sentence(rng, k).capitalize() + ".")
        n -= k
    return " ".join(out)


def awkward(seed=1, normal=30):
    """(id, text) rows: NULLs, empty and blank texts, ties, repeated rows, a long text."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(1, 150))) for i in range(normal)]
    rows += [(normal, None), (normal + 1, ""), (normal + 2, " \t\n\x0b\x0c\r "), (None, prose(rng, 40)),
             (normal + 3, rows[0][1]), rows[1], rows[1], (normal + 4, prose(rng, 20_000)),
             (normal + 5, "x" * 50_000), (normal + 6, "Ünï cødé   日本語 🙂"), (None, None)]
    return rows


def frame(spark, rows):
    """With columns whose names clash with those the operators make."""
    return spark.createDataFrame([(i, t, f"s{k % 3}" if k % 5 else None, 1.0, "clash", k)
                                  for k, (i, t) in enumerate(rows)], SCHEMA)
