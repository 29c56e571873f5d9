"""Data-quality checks: every check is evaluated, then the run fails with
the complete list of failures.

Checks on the same table are computed in one aggregate pass over it.
Check predicates are Column functions, so the result table (name, value,
ok) is computed by Spark; only that small result is fetched to decide
whether to raise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.expressions import count_where


@dataclass(frozen=True)
class Check:
    name: str
    table: DataFrame
    value: Column                       # an aggregate over ``table``
    ok: Callable[[Column], Column]      # predicate on the value


class QualityError(RuntimeError):
    pass


def has_rows() -> Column:
    return F.count(F.lit(1))


def null_keys(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return count_where(cond)


def out_of_range(col: str, lo: int = 1, hi: int = 30) -> Column:
    """Rows whose value lies outside [lo, hi]; NULL values never count."""
    return count_where(~F.col(col).between(lo, hi))


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """DataFrame (check, value bigint, ok boolean), one row per check, in
    the given order."""
    groups: dict[int, list[tuple[int, Check]]] = {}
    for i, c in enumerate(checks):
        groups.setdefault(id(c.table), []).append((i, c))
    parts = []
    for members in groups.values():
        table = members[0][1].table
        agg = table.agg(*[c.value.cast("bigint").alias(f"v{i}") for i, c in members])
        stack = F.explode(F.array(*[
            F.struct(F.lit(i).alias("idx"), F.lit(c.name).alias("check"),
                     F.col(f"v{i}").alias("value"), c.ok(F.col(f"v{i}")).alias("ok"))
            for i, c in members]))
        parts.append(agg.select(stack.alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("idx").select("check", "value",
                                     F.coalesce(F.col("ok"), F.lit(False)).alias("ok"))


def observed_write(df: DataFrame, write: Callable[[DataFrame], object], checks: Sequence[Check] = ()) -> tuple[int, list[int]]:
    """Write ``df`` and measure it on the way: its rows and the checks' values."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[
        F.coalesce(c.value.cast("bigint"), F.lit(0)).alias(f"v{i}") for i, c in enumerate(checks)]))
    got = seen.get
    return got["rows"], [got[f"v{i}"] for i in range(len(checks))]


def measured_report(spark, measured: Sequence[tuple[Check, int]]) -> DataFrame:
    """The report of :func:`run_checks` for values that are known already."""
    rows = spark.createDataFrame([(i, c.name, v) for i, (c, v) in enumerate(measured)], "idx int, check string, value bigint")
    ok = F.coalesce(*[F.when(F.col("idx") == i, c.ok(F.col("value"))) for i, (c, _) in enumerate(measured)])
    return rows.orderBy("idx").select("check", "value", F.coalesce(ok, F.lit(False)).alias("ok"))


def assert_checks(report: DataFrame) -> DataFrame:
    """Raise :class:`QualityError` listing every failed check."""
    rows = report.collect()  # one row per check
    failed = [(r["check"], r["value"]) for r in rows if not r["ok"]]
    if failed:
        raise QualityError(f"Quality checks failed: {failed}")
    return report


def warehouse_checks(silver: DataFrame, features: DataFrame, all_ranks: bool = True) -> list[Check]:
    """The warehouse checks: gold has rows, silver keys are not NULL, the
    points rank lies in 1..30 (plus the rebound and assist ranks)."""
    checks = [
        Check("gold.player_features has rows", features, has_rows(), lambda v: v > 0),
        Check("silver keys not null", silver, null_keys(["season", "game_id", "player_id"]),
              lambda v: v == 0),
        Check("opp_pts_allowed_rank within 1..30", features,
              out_of_range("opp_pts_allowed_rank"), lambda v: v == 0),
    ]
    if all_ranks:
        checks += [
            Check("opp_reb_allowed_rank within 1..30", features,
                  out_of_range("opp_reb_allowed_rank"), lambda v: v == 0),
            Check("opp_ast_allowed_rank within 1..30", features,
                  out_of_range("opp_ast_allowed_rank"), lambda v: v == 0),
        ]
    return checks
