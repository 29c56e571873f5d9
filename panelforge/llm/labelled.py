"""Bounded training samples from a label table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, two


def training_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int, mod: int, held: int,
                  id_col: str = "doc_id", text_col: str = "text", per_class: bool = False) -> DataFrame:
    """(_id, _text, y) of at most ``bound`` labelled ids (of each class with
    ``per_class``), those with the smallest hash of the id.

    Ids whose crc32(id as text) mod ``mod`` is ``held`` are never among them,
    nor are NULL labels.  An id with several different labels counts by the
    larger one.  The sample's size is bounded, so it is broadcast."""
    y = (labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull())
         .filter(remainder(id_col, mod) != held)
         .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(F.col(label).cast("int")).alias("y")))
    order = [F.xxhash64("_id"), F.col("_id")]
    if per_class:
        picked = y.filter("y = 1").orderBy(*order).limit(bound).unionByName(
            y.filter("y = 0").orderBy(*order).limit(bound))
    else:
        picked = y.orderBy(*order).limit(bound)
    # Repeated rows of an id are one example: its smallest text.
    return (two(docs, id_col, text_col).join(F.broadcast(picked), "_id")
            .groupBy("_id", "y").agg(F.min("_text").alias("_text")))
