"""Totals at several levels at once; a total is marked by grouping, so a NULL key keeps its own row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.operators.common import union_all


def labelled_rollup(df: DataFrame, key: str, label: str, total: str, aggs: Sequence[Column]) -> DataFrame:
    """Rollup over ``key``; call it on pre-aggregated rows, because rollup doubles its input."""
    rolled = df.rollup(key).agg(F.grouping(key).alias("_is_total"), *aggs)
    names = [c for c in rolled.columns if c not in (key, "_is_total")]
    return rolled.select(
        F.when(F.col("_is_total") == 1, F.lit(total)).otherwise(F.col(key)).alias(label), *names
    )


def grouping_sets(
    df: DataFrame, sets: Sequence[Sequence[str]], sums: dict[str, Column], distinct: str | None = None, distinct_as: str = "Distinct"
) -> DataFrame:
    """Sums, and the exact number of distinct values of a column, for several sets of keys in one pass.

    Columns: all keys (NULL where the set leaves one out), ``Level`` (the grouping id: bit k from the
    right is set where the k-th key from the right is left out), the sums and the distinct count.

    Rows are summed to the finest keys and the counted column first. Each set is then summed from the
    narrowest one at hand that holds its keys, so that a task keeps the groups of one set at a time and
    not those of all; the counted column rides along as a key, so that no set holds a collection of
    values and a total over everything is counted in parallel.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    fine = [*keys, *([distinct] if distinct else [])]
    base = df.groupBy(*fine).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    again = [F.sum(name).alias(name) for name in sums]
    if distinct is None:
        wanted = [[F.col(k) for k in s] for s in sets]
        return base.groupingSets(wanted, *keys).agg(F.grouping_id(*keys).alias("Level"), *again).select(*keys, "Level", *sums)
    # One type for all sets, however many sums lie between a set and the rows.
    kinds = base.agg(*again).agg(*again).schema
    totals = [F.sum(name).cast(kinds[name].dataType).alias(name) for name in sums]
    made, parts = [(keys, base)], []
    for mine in sorted(sets, key=len, reverse=True):
        source, each = min((m for m in made if set(mine) <= set(m[0])), key=lambda m: len(m[0]))
        if set(source) != set(mine):
            each = each.groupBy(*mine, distinct).agg(*again)
            made.append((mine, each))
        # A set with the counted column holds each of its values once; counting them is a plain sum.
        level = F.lit(sum(1 << i for i, k in enumerate(reversed(keys)) if k not in mine)).cast("bigint").alias("Level")
        counted = each.groupBy(*mine, level).agg(*totals, F.count(distinct).alias(distinct_as))
        blank = [F.col(k) if k in mine else F.lit(None).cast(base.schema[k].dataType).alias(k) for k in keys]
        parts.append(counted.select(*blank, "Level", *sums, distinct_as))
    return union_all(parts)
