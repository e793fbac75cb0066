"""Periods of one key that overlap, without comparing all pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.operators.running import Running, running


def overlapping_periods(
    df: DataFrame, keys: Sequence[str], row_id: str, start: str, end: str, never: str, closed: bool = True
) -> DataFrame:
    """Rows whose period begins before an earlier one of the same key has ended, with the one it meets.

    Per key by start, then id, a running maximum of the ends is kept with its row: a period overlaps some
    earlier one exactly if it overlaps the one that ends last. So every overlap shows as one row, and a
    key with any number of periods is split over tasks. ``never`` is the end of open periods; ``closed``
    periods include their last day, others end before their end.
    """
    last = F.coalesce(F.col(end), F.lit(never).cast(df.schema[end].dataType))
    # Of several equal ends the lowest id is named.
    reach = F.struct(last.alias("end"), (-F.col(row_id)).alias("less"))
    seen = running(df.select(*keys, row_id, start, end), keys, [F.asc(start), F.asc(row_id)], {"_reach": Running(reach, "max", with_row=False)})
    meets = F.col(start) <= F.col("_reach.end") if closed else F.col(start) < F.col("_reach.end")
    return seen.filter(meets).select(*keys, row_id, start, end, (-F.col("_reach.less")).alias(f"Overlaps{row_id}"))


def overlapping_fares(t) -> DataFrame:
    """Fare rules of one voyage, category and age band that are in force together."""
    keys = ["VoyageID", "CabinCategoryID", "AgeCategoryID"]
    return overlapping_periods(t["FareRule"], keys, "FareRuleID", "EffectiveFrom", "EffectiveTo", "9999-12-31")


def overlapping_baggage_rules(t) -> DataFrame:
    """Baggage rules of one operator that are in force together."""
    return overlapping_periods(t["BaggageRule"], ["OperatorID"], "BaggageRuleID", "EffectiveFrom", "EffectiveTo", "9999-12-31")


def overlapping_voyages(t) -> DataFrame:
    """Voyages of one ship that sail at the same time; cancelled ones do not sail."""
    sailing = t["CruiseVoyage"].filter(F.col("VoyageStatus") != "Cancelled")
    return overlapping_periods(sailing, ["ShipID"], "VoyageID", "DepartureDateTime", "ArrivalDateTime", "9999-12-31 00:00:00", closed=False)
