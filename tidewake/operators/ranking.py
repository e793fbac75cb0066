"""Exact global rank without putting the whole result into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.operators.running import Running, running


def global_rank(df: DataFrame, value: str, rank: str) -> DataFrame:
    """``rank() over (order by value desc)`` for a column of a staged or cheap frame.

    A plain global window sends every row to one task. Here rows are first counted per distinct value,
    so ties, however many, become one row; the counts run downward over ranges of the values, whose
    number and size follow the data. The last step has one row per range.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    above = running(counts, [], [F.desc_nulls_last(value)], {"_above": Running(F.col("_n"), with_row=False)})
    ranks = above.select(F.col(value).alias("_value"), (F.lit(1) + F.coalesce("_above", F.lit(0))).alias(rank))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")
