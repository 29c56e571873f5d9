"""Namespaces and views of the layers in the session catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from ..operators.versioned import VersionedTable

# The three layer namespaces.
NAMESPACES = ("bronze", "silver", "gold")


def init_namespaces(spark: SparkSession, names: Sequence[str] = NAMESPACES) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` for each layer."""
    for n in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{n}`")


def register_tables(spark: SparkSession, paths: dict[str, str], schemas: dict[str, StructType],
                    partitions: dict[str, dict[str, str]] | None = None) -> None:
    """Make stored Parquet folders readable as ``layer.name``.  The catalog
    entry is replaced, so it follows a changed schema; the files stay.
    ``partitions``: per table the folder of each partition (``column=value``)."""
    for name, path in paths.items():
        layer, table = name.split(".")
        places = (partitions or {}).get(name, {})
        by = sorted({p.split("=", 1)[0] for p in places})
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas[name].fields)
        spark.sql(f"DROP TABLE IF EXISTS `{layer}`.`{table}`")
        spark.sql(f"CREATE TABLE `{layer}`.`{table}` ({fields}) USING parquet "
                  + (f"PARTITIONED BY ({', '.join(f'`{c}`' for c in by)}) " if by else "")
                  + "LOCATION :path", args={"path": path})
        unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        for place, folder in places.items():
            column, value = place.split("=", 1)
            spark.sql(f"ALTER TABLE `{layer}`.`{table}` ADD PARTITION (`{column}` = :value) LOCATION :folder",
                      args={"value": unescape(value), "folder": folder})


def register_versioned(spark: SparkSession, paths: dict[str, str], partition_col: str) -> None:
    """Make the live versions of versioned tables readable as ``layer.name``."""
    tables = {name: VersionedTable(spark, path, partition_col) for name, path in paths.items()}
    register_tables(spark, paths, {n: t.schema() for n, t in tables.items()},
                    {n: {p: f"{t.path}/{p}/{v}" for p, v in t.manifest()["parts"].items()} for n, t in tables.items()})


#: Stored views over ``silver.player_game_logs``, in dependency order.
VIEWS = {
    "gold.opponent_allowed": """
        SELECT season, opponent_team AS team, avg(pts) AS opp_pts_allowed,
               avg(reb) AS opp_reb_allowed, avg(ast) AS opp_ast_allowed
        FROM silver.player_game_logs GROUP BY season, opponent_team""",
    "gold.opponent_ranks": "SELECT *, " + ", ".join(
        f"CAST(dense_rank() OVER (PARTITION BY season ORDER BY opp_{m}_allowed NULLS LAST) AS BIGINT) "
        f"AS opp_{m}_allowed_rank" for m in ("pts", "reb", "ast")) + " FROM gold.opponent_allowed",
}


def create_views(spark: SparkSession) -> None:
    """Define or replace the stored views; every session of the catalog sees them.

    Only their text is stored, so they are never stale.  A reader who asks for
    ranks sorts the averages (a row per season and opponent); jobs use
    ``operators.opponents``, which spreads a season over tasks."""
    for name, text in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")


def table_exists(spark: SparkSession, name: str) -> bool:
    """Table-or-view existence in the session catalog."""
    return bool(spark.catalog.tableExists(name))
