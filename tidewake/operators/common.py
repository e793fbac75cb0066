"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than that many."""
    return df.limit(max_rows + 1).count() <= max_rows


def violation_list(*checks: tuple[Column, str]) -> Column:
    """Texts of the checks that fail, in the given order; a NULL condition passes, as in SQL."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(text)) for bad, text in checks]))


def first_violation(violations: Column) -> Column:
    return F.get(violations, F.lit(0))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) by the ``violations`` column."""
    bad = F.size("violations") > 0
    return df.filter(~bad), df.filter(bad)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of frames with equal columns, joined pairwise: a long chain of unions is slow to analyse."""
    level = list(parts)
    while len(level) > 1:
        pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
        level = [p[0].union(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return level[0]
