"""Connected components of a link table by alternating large-star and small-star.

Every round is two grouped minima and two joins; a table in the shared scratch
folder cuts the lineage after each round.  Only (node, smallest neighbour)
pairs are ever grouped, so a node with very many links costs no memory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("x"), F.least("u", "m").alias("m"))
    return both.join(low, F.col("u") == F.col("x")).filter("v > u").select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), "m")
    hung = e.join(low, F.col("u") == F.col("x")).filter("v > m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(low.select("x", "m")).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of a link other than the smallest of
    its component, which is its component's name.  Repeated links, links in
    both directions and self-links are allowed; links with a NULL are not
    links.  No links give an empty table."""
    e = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e, last = stage(e, "links"), None
    while True:
        now = e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if not now[0] or now == last:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        last = now
        e = stage(_small_star(_large_star(e)), "links")
