"""Totals kept up to date from change batches instead of from the whole table.

A change is the old form of a row taken back and its new form added. Both are summed per key with a sign,
and the sums are added to the stored totals; so a batch costs what it touches, not what is stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.functions import any_of
from tidewake.schema import SOLD
from tidewake.sources.tables import Tables

ROWS = "_rows"  # rows behind a total; a key without any has none


def signed_changes(stored: DataFrame, batch: DataFrame, key: str, deleted: str = "_deleted") -> DataFrame:
    """Rows of ``stored`` that the batch changes with sign -1, and the batch's rows with +1.

    The batch has the columns of ``stored`` and a flag ``deleted``; one row per key. A deleted row is
    only taken back, a new key only added, an unknown deleted key is nothing.
    """
    touched = batch.select(key).distinct()
    old = stored.join(touched, key, "left_semi").withColumn("_sign", F.lit(-1))
    new = batch.filter(~F.coalesce(deleted, F.lit(False))).select(*stored.columns).withColumn("_sign", F.lit(1))
    return old.unionByName(new)


def totals(rows: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Sums and row counts per key: the totals of a whole table, or of signed rows (``_sign``)."""
    sign = F.col("_sign") if "_sign" in rows.columns else F.lit(1)
    parts = [F.sum(sign * c).alias(name) for name, c in sums.items()]
    return rows.groupBy(*keys).agg(*parts, F.sum(sign).cast("bigint").alias(ROWS))


def merge_totals(stored: DataFrame, delta: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Stored totals with a delta added; keys without rows left are gone. Both sides have one row per key."""
    both = stored.unionByName(delta).groupBy(*keys)
    merged = both.agg(*[F.sum(s).cast(stored.schema[s].dataType).alias(s) for s in sums], F.sum(ROWS).cast("bigint").alias(ROWS))
    return merged.filter(F.col(ROWS) != 0)


def fare_totals(passengers: DataFrame) -> DataFrame:
    """Total per booking, as the booking's total is defined, with the number of passengers."""
    return totals(passengers, ["BookingID"], {"TotalAmount": F.coalesce(F.col("FinalFare"), F.lit(0).cast("decimal(12,2)"))})


def update_fare_totals(stored: DataFrame, passengers: DataFrame, batch: DataFrame) -> DataFrame:
    """``fare_totals`` after a batch of changed, new and deleted passengers of bookings."""
    return merge_totals(stored, fare_totals(signed_changes(passengers, batch, "BookingPassengerID")), ["BookingID"], ["TotalAmount"])


def cabin_sales(bookings: DataFrame, t: Tables) -> DataFrame:
    """Sold bookings per (voyage, cabin): a cabin is sold while at least one holds it.

    Counts instead of flags, because a flag cannot be taken back while another booking holds the cabin.
    """
    sold = bookings.filter(any_of("BookingStatus", SOLD))
    columns = ["BookingID", "VoyageID", *(["_sign"] if "_sign" in bookings.columns else [])]
    held = t["BookingCabin"].select("BookingID", "CabinID").join(sold.select(*columns), "BookingID")
    return totals(held, ["VoyageID", "CabinID"], {})


def update_cabin_sales(stored: DataFrame, t: Tables, batch: DataFrame) -> DataFrame:
    """``cabin_sales`` after a batch of changed, new and deleted bookings."""
    return merge_totals(stored, cabin_sales(signed_changes(t["Booking"], batch, "BookingID"), t), ["VoyageID", "CabinID"], [])


def sold_cabins(stored: DataFrame) -> DataFrame:
    """Cabins sold per voyage."""
    return stored.groupBy("VoyageID").agg(F.count(F.lit(1)).alias("BookedCabins"))
