"""Running totals in groups of any size, without sorting a group in one task.

Rows are dealt into ranges of (keys, order); a group that holds a third of all rows simply covers many
ranges. Totals run inside a range, and each range gets what its group has gathered in the ranges before.
Only a range's first group can have begun earlier, so what is carried over is one row per range at most.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.session import stage


class Running(NamedTuple):
    """A column to run over a group: its sum or its maximum, with the row itself or only those before it."""

    value: Column
    how: str = "sum"
    with_row: bool = True


def _fold(how: str):
    return {"sum": F.sum, "max": F.max}[how]


def _both(how: str, a: Column, b: Column) -> Column:
    """The fold of two folds; NULL stands for no rows."""
    return F.greatest(a, b) if how == "max" else F.coalesce(a + b, a, b)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[Column], totals: dict[str, Running]) -> DataFrame:
    """``df`` with the running ``totals`` per ``keys`` in the given order, which must be total within a group.

    NULL keys are a group of their own, as in a window. No keys: one group of all rows. The ranges are
    staged, because a range's number has to be the same for every pass that reads it.
    """
    keys = list(keys)
    valued = df.select("*", *[t.value.alias(f"_of_{name}") for name, t in totals.items()])
    ranged = valued.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    ranged = stage(ranged, "ranges")
    first = Window.unboundedPreceding
    inside = Window.partitionBy("_range", *keys).orderBy(*order)
    local = {
        name: _fold(t.how)(f"_of_{name}").over(inside.rowsBetween(first, Window.currentRow if t.with_row else -1))
        for name, t in totals.items()
    }
    pieces = ranged.groupBy("_range", *keys).agg(*[_fold(t.how)(f"_of_{name}").alias(f"_in_{name}") for name, t in totals.items()])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(first, -1)
    carried = pieces.select(
        F.col("_range").alias("_to"),
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
        F.count(F.lit(1)).over(earlier).alias("_pieces"),
        *[_fold(t.how)(f"_in_{name}").over(earlier).alias(f"_over_{name}") for name, t in totals.items()],
    ).filter("_pieces > 0")
    same = F.col("_range") == F.col("_to")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    # One row per range at most.
    rows = ranged.withColumns(local).join(F.broadcast(carried), same, "left")
    done = {name: _both(t.how, F.col(name), F.col(f"_over_{name}")) for name, t in totals.items()}
    return rows.withColumns(done).select(*df.columns, *totals)
