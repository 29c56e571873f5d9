"""Bronze -> silver: typed, renamed projection plus the opponent column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import opponent_split_part
from ..schemas import SILVER_MAPPING


def _typed(col: str, typ: str | None, strict: bool):
    c = F.col(f"`{col}`")
    if typ is None:
        return c
    # strict: a malformed value fails the job (ANSI cast); lenient: NULL.
    return c.cast(typ) if strict else c.try_cast(typ)


def silver(bronze: DataFrame, strict: bool = True, mapping=SILVER_MAPPING,
           matchup_col: str = "MATCHUP") -> DataFrame:
    """Silver view: 19 renamed/cast columns plus ``opponent_team`` =
    third blank-separated token of the matchup ('' if absent)."""
    cols = []
    for src, dst, typ in mapping:
        cols.append(_typed(src, typ, strict).alias(dst))
        if src == matchup_col:
            cols.append(opponent_split_part(F.col(f"`{src}`")).alias("opponent_team"))
    return bronze.select(*cols)


def silver_rejects(bronze: DataFrame, mapping=SILVER_MAPPING) -> DataFrame:
    """Bronze rows whose values do not cast (the quarantine of lenient mode),
    with the list of offending columns."""
    bad = [F.when(F.col(f"`{src}`").isNotNull() & F.col(f"`{src}`").try_cast(typ).isNull(),
                  F.lit(src))
           for src, _, typ in mapping if typ is not None]
    flagged = bronze.withColumn("_bad_columns", F.filter(F.array(*bad), lambda x: x.isNotNull()))
    return flagged.where(F.size("_bad_columns") > 0)
