"""Column expressions (all built-in, JVM-side; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's ``str.split()`` treats as blanks in
# ASCII/Latin text (Unicode white space plus the four separators 0x1c-0x1f).
PY_WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def opponent_split_part(matchup, sep: str = " ", position: int = 3) -> Column:
    """Positional token: ``split_part(matchup, ' ', 3)``; '' when absent."""
    return F.split_part(_c(matchup), F.lit(sep), F.lit(position))


def opponent_last_token(matchup, min_tokens: int = 3) -> Column:
    """Last whitespace-separated token when there are >= ``min_tokens``
    tokens, else NULL (also NULL for NULL input)."""
    toks = F.filter(F.split(_c(matchup), PY_WHITESPACE_RUN), lambda t: t != F.lit(""))
    return F.when(F.size(toks) >= min_tokens, F.element_at(toks, -1))


def nan_to_null(c) -> Column:
    """Normalise NaN to NULL: Spark orders NaN above every number and treats
    NaN > 0 as true, while missing values must compare false and sort last."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def count_where(cond: Column) -> Column:
    """Rows where ``cond`` is true; NULL conditions do not count."""
    return F.count_if(F.coalesce(cond, F.lit(False)))
