"""Distribution summaries: equal-width histogram, Gaussian kernel density
and a 2-D binned count.  Bounds/statistics are one-row aggregates fetched as
scalars; the per-row work is a built-in expression followed by a partial +
final aggregation, so only (partitions x bins) rows are shuffled."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .positions import materialize


#: Cells of the density's fine grid per bandwidth, and how far a kernel reaches.
CELLS_PER_BANDWIDTH, REACH = 128, 12
#: Places of the six grid points around a cell's start.
NODES = (-2, -1, 0, 1, 2, 3)


def _basis(node: int) -> np.ndarray:
    """Coefficients (lowest power first) of the polynomial that is 1 at ``node``
    and 0 at the other nodes."""
    others = [j for j in NODES if j != node]
    return np.polynomial.polynomial.polyfromroots(others) / np.prod([node - j for j in others], dtype=float)


def _bounds(lo, hi):
    # Equal bounds get a unit-wide range around the value (as numpy does).
    if lo is None:
        return 0.0, 1.0
    if lo == hi:
        return lo - 0.5, hi + 0.5
    return float(lo), float(hi)


def bin_index(x, lo: float, hi: float, bins: int):
    """0-based bin of x in [lo, hi] cut into ``bins`` equal bins; the last
    bin is closed so hi falls into it."""
    raw = F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))).cast("bigint")
    return F.least(raw, F.lit(bins - 1))


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Columns: bin (1..bins), bin_lo, bin_hi, count.  Missing values are
    dropped; empty bins are present with count 0."""
    spark = df.sparkSession
    # one narrow written column serves both passes (bounds, then counts)
    vals = materialize(df.select(F.col(col).alias("x"))
                       .where(F.col("x").isNotNull() & ~F.isnan("x")), "hist")
    st = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    lo, hi = _bounds(st["lo"], st["hi"])
    counts = (vals.groupBy((bin_index(F.col("x"), lo, hi, bins) + 1).alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))
    step = (hi - lo) / bins
    # both sides hold at most ``bins`` rows
    return (spark.range(1, bins + 1).withColumnRenamed("id", "bin")
            .join(F.broadcast(counts), "bin", "left")
            .select("bin",
                    F.round(F.lit(lo) + (F.col("bin") - 1).cast("double") * F.lit(step), 6).alias("bin_lo"),
                    F.round(F.when(F.col("bin") == bins, F.lit(hi))
                            .otherwise(F.lit(lo) + F.col("bin").cast("double") * F.lit(step)), 6)
                    .alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def kde(df: DataFrame, col: str, gridsize: int = 200, cut: float = 0.0,
        bw_adjust: float = 1.0, bins: int = 40) -> DataFrame:
    """Gaussian KDE on an evenly spaced grid over [min - cut*bw, max + cut*bw]
    with Scott's bandwidth (sample std * n^(-1/5) * bw_adjust).

    Columns: point (0..gridsize-1), x, density, and ``count_density`` (the
    density scaled by n * bin width, the curve drawn over a count histogram
    of ``bins`` bins).

    Work grows with rows + cells, all in built-in functions.  A value's kernel is
    replaced by the kernels of the six grid points around it, a hundred-odd per
    bandwidth, with Lagrange weights.  The error of one kernel (whose peak is 1)
    is at most 15 / 720 * 3.52 * (1 / ``CELLS_PER_BANDWIDTH``)^6, about 2e-14,
    and what lies beyond ``REACH`` bandwidths, below 1e-31, is left out."""
    vals = materialize(df.select(F.col(col).alias("x"))
                       .where(F.col("x").isNotNull() & ~F.isnan("x")), "kde")
    st = vals.agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"),
                  F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    n, sd, lo, hi = st["n"], st["sd"], st["lo"], st["hi"]
    spark = df.sparkSession
    if not n or sd is None or sd == 0:
        return spark.createDataFrame([], "point bigint, x double, density double, count_density double")
    bw = sd * n ** (-1.0 / 5.0) * bw_adjust
    g_lo, g_hi = lo - cut * bw, hi + cut * bw
    step = (g_hi - g_lo) / (gridsize - 1)
    # Rows -> moments of their places within fine cells -> weights of the cells'
    # neighbouring grid points -> kernels between grid points and output points.
    delta = bw / CELLS_PER_BANDWIDTH
    u = (F.col("x") - F.lit(lo)) / F.lit(delta)
    placed = vals.select(F.floor(u).alias("cell"), (u - F.floor(u)).alias("t1"))
    for k in range(2, len(NODES)):
        placed = placed.withColumn(f"t{k}", F.col(f"t{k - 1}") * F.col("t1"))
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).cast("double").alias("m0"),
                                       *[F.sum(f"t{k}").alias(f"m{k}") for k in range(1, len(NODES))])

    def weight(node):
        return sum((F.col(f"m{k}") * F.lit(float(c)) for k, c in enumerate(_basis(node))), F.lit(0.0))

    spread = cells.select(F.explode(F.array(*[F.struct((F.col("cell") + j).alias("g"), weight(j).alias("w"))
                                              for j in NODES])).alias("s")).select("s.*")
    grid = spread.groupBy("g").agg(F.sum("w").alias("w")).select("w", (F.lit(lo) + F.col("g") * F.lit(delta)).alias("v"))
    reach = REACH * bw
    first = F.greatest(F.lit(0), F.ceil((F.col("v") - F.lit(reach + g_lo)) / F.lit(step)))
    last = F.least(F.lit(gridsize - 1), F.floor((F.col("v") + F.lit(reach - g_lo)) / F.lit(step)))
    near = grid.select("*", first.alias("a"), last.alias("b")).where("a <= b").select(
        "w", "v", F.explode(F.sequence("a", "b")).alias("point"))
    z = (F.lit(g_lo) + F.col("point").cast("double") * F.lit(step) - F.col("v")) / F.lit(bw)
    sums = near.groupBy("point").agg(F.sum(F.col("w") * F.exp(F.lit(-0.5) * z * z)).alias("s"))
    # both sides hold at most ``gridsize`` rows
    contrib = spark.range(gridsize).withColumnRenamed("id", "point").join(F.broadcast(sums), "point", "left").select(
        "point", F.greatest(F.coalesce("s", F.lit(0.0)), F.lit(0.0)).alias("s"))
    norm = n * bw * math.sqrt(2 * math.pi)
    h_lo, h_hi = _bounds(lo, hi)
    binwidth = (h_hi - h_lo) / bins
    return (contrib
            .select(F.col("point").cast("bigint").alias("point"),
                    F.round(F.lit(g_lo) + F.col("point").cast("double") * F.lit(step), 6).alias("x"),
                    F.round(F.col("s") / F.lit(norm), 6).alias("density"),
                    F.round(F.col("s") / F.lit(norm) * F.lit(n * binwidth), 6).alias("count_density")))


def grid_counts(df: DataFrame, x_col: str, y_col: str, bins: int = 20) -> DataFrame:
    """2-D equal-width binned counts of (x, y) pairs (the data behind a
    scatter plot at any row count).  Columns: x_bin, y_bin (1-based), count."""
    pairs = materialize(df.select(F.col(x_col).alias("x"), F.col(y_col).alias("y")).where(
        F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")), "grid")
    st = pairs.agg(F.min("x").alias("xl"), F.max("x").alias("xh"),
                   F.min("y").alias("yl"), F.max("y").alias("yh")).first()
    xl, xh = _bounds(st["xl"], st["xh"])
    yl, yh = _bounds(st["yl"], st["yh"])
    return (pairs.groupBy((bin_index(F.col("x"), xl, xh, bins) + 1).alias("x_bin"),
                          (bin_index(F.col("y"), yl, yh, bins) + 1).alias("y_bin"))
            .agg(F.count(F.lit(1)).alias("count")))
