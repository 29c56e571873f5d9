"""A bronze-shaped game log derived from the TPC-H-like test tables.

orders x customer x nation, left join lineitem aggregated per order.  Each
order is one (season, game, player) row; measures are whole numbers written
as text, the way the raw feed delivers them.  (l_orderkey, l_linenumber) is
not unique in the test data, so lineitem is always aggregated per order
first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import join_small

# Fixed value: the ingestion instant stamped on every fixture row.
FIXTURE_INGESTED_AT = "2024-01-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_measures(lineitem: DataFrame) -> DataFrame:
    """Per-order whole-number measures from one shuffle of the narrow rows.

    The two exact distinct counts are sums of marks on the first row of each
    supplier and part in an order; both sorts and the aggregate keep the order
    key's partitions.  Rows without an order key belong to no order."""
    def first_of(c):
        w = Window.partitionBy("l_orderkey").orderBy(c)
        return (F.col(c).isNotNull() & ~F.lag(c).over(w).eqNullSafe(F.col(c))).cast("int")

    marked = (lineitem.where(F.col("l_orderkey").isNotNull())
              .withColumn("_s", first_of("l_suppkey")).withColumn("_p", first_of("l_partkey")))
    return marked.groupBy("l_orderkey").agg(
        F.sum("l_quantity").cast("bigint").alias("q"),
        F.sum("l_linenumber").cast("bigint").alias("ln"),
        F.count(F.lit(1)).alias("n"),
        F.max("l_quantity").cast("bigint").alias("mx"),
        F.min("l_quantity").cast("bigint").alias("mn"),
        F.sum(F.col("l_partkey") % 7).cast("bigint").alias("m7"),
        F.sum(F.col("l_suppkey") % 5).cast("bigint").alias("m5"),
        F.sum(F.col("l_partkey") % 3).cast("bigint").alias("m3"),
        F.sum("_s").alias("ns"),
        F.sum("_p").alias("np"),
    )


def _txt(c):
    return c.cast("bigint").cast("string")


def game_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze game log ``gl`` (see FIXTURES.md §2)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    li = order_measures(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_linenumber", "l_suppkey", "l_partkey"))

    # Dimension sides are broadcast only after a check of their size.
    cust = join_small(customer, nation, ("c_nationkey", "n_nationkey"), "inner")
    base = join_small(orders, cust, ("o_custkey", "c_custkey"), "inner")
    # order measures are one row per order: a shuffle join on a unique key.
    g = base.join(li, base.o_orderkey == li.l_orderkey, "left")

    k = F.col("o_orderkey")
    sep = F.when(k % 2 == 0, F.lit(" @ ")).otherwise(F.lit(" vs. "))
    matchup = (F.when(k % 101 == 0, F.lit(None).cast("string"))
               .when(k % 97 == 0, F.col("n_name"))
               .otherwise(F.concat(F.col("n_name"), sep, F.lit("NATION_"), _txt(k % 25))))
    return g.select(
        F.year("o_orderdate").cast("string").alias("SEASON"),
        F.lpad(k.cast("string"), 10, "0").alias("GAME_ID"),
        F.to_date("o_orderdate").cast("string").alias("GAME_DATE"),
        F.col("o_custkey").alias("PLAYER_ID"),
        F.col("c_name").alias("PLAYER_NAME"),
        F.col("n_name").alias("TEAM_ABBREVIATION"),
        matchup.alias("MATCHUP"),
        _txt(F.col("n") * 8).alias("MIN"),
        _txt(F.col("q")).alias("PTS"),
        _txt(F.col("ln")).alias("REB"),
        _txt(F.col("n")).alias("AST"),
        _txt(F.col("mx")).alias("FGM"),
        _txt(F.col("mx") + F.col("mn")).alias("FGA"),
        _txt(F.col("m7")).alias("FG3M"),
        _txt(F.col("m7") + F.col("m5")).alias("FG3A"),
        _txt(F.col("m3")).alias("FTM"),
        _txt(F.col("m3") + F.col("np")).alias("FTA"),
        _txt(F.col("ns")).alias("TOV"),
        F.lit(FIXTURE_INGESTED_AT).alias("INGESTED_AT"),
    )


_BRONZE_CACHE: dict[tuple[str, str], str] = {}


def bronze_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The game log stored as a bronze table, the way the warehouse keeps
    it: derived from the test tables once per application and data folder,
    written as Parquet to the shared checkpoint folder, then scanned.  Later
    layers (silver, gold, reports) are computed from this table."""
    from ..session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    path = _BRONZE_CACHE.get(key)
    if path is not None:
        from .ingest import path_exists
        if not path_exists(spark, f"{path}/_SUCCESS"):  # scratch was purged
            path = None
    if path is None:
        path = scratch_path(spark, "bronze-gl")
        game_log(spark, sf_dir).write.mode("overwrite").parquet(path)
        _BRONZE_CACHE[key] = path
    return spark.read.parquet(path)
