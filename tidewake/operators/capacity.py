"""Places in sale order: excursion slots, and cabins for the waiting list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.functions import any_of
from tidewake.operators.common import first_violation, violation_list
from tidewake.operators.running import Running, running
from tidewake.schema import EXC_SOLD, HOLDING, SOLD
from tidewake.sources.tables import Tables

# Own wording; the slots are declared, but nothing enforces them.
NO_SLOT = "Excursion has no free slot."
UNKNOWN_OFFER = "Voyage excursion not found."


def _places(df: DataFrame, keys: list[str], order: list, place: str) -> DataFrame:
    """1, 2, 3... per group of any size."""
    return running(df, keys, order, {place: Running(F.lit(1).cast("bigint"))})


def check_excursion_slots(t: Tables) -> DataFrame:
    """Excursion sales with their place in sale order; those past the offer's slots are violations.

    Sales are taken by time, then by key. One that is not active (cancelled) takes no slot and has no
    place. A refused sale still counts as a sale: a later one does not move up.
    """
    sales = t["BookingExcursion"]
    active = any_of("ExcursionStatus", EXC_SOLD)
    offers = t["VoyageExcursion"].select("VoyageExcursionID", "AvailableSlots")
    placed = _places(sales.filter(active), ["VoyageExcursionID"], [F.asc("BookingDateTime"), F.asc("BookingExcursionID")], "SalePlace")
    idle = sales.filter(~F.coalesce(active, F.lit(False))).withColumn("SalePlace", F.lit(None).cast("bigint"))
    rows = placed.unionByName(idle).join(offers, "VoyageExcursionID", "left")
    rows = rows.withColumn(
        "violations",
        violation_list((F.col("AvailableSlots").isNull(), UNKNOWN_OFFER), (F.col("SalePlace") > F.col("AvailableSlots"), NO_SLOT)),
    )
    return rows.select(
        *sales.columns, "SalePlace", "AvailableSlots", "violations", first_violation(F.col("violations")).alias("first_violation")
    )


def promote_waitlisted(t: Tables) -> DataFrame:
    """Waitlisted bookings with their place in the queue and, if one is free for them, a cabin.

    A booking queues once per voyage, for the category of the first cabin it names. Free are the cabins
    that cancelled or rescheduled bookings of the voyage have given up and no other booking holds or has
    used. The k-th booking by date, then key, gets the k-th free cabin by number: both sides are counted
    and meet by equality on the place, so nobody gets two and no group is sorted or multiplied.
    """
    bookings = t["Booking"].select("BookingID", "VoyageID", "BookingStatus", "BookingDate")
    cabins = t["Cabin"].select("CabinID", "CabinCategoryID")
    booked = t["BookingCabin"].select("BookingCabinID", "BookingID", "CabinID")
    spots = ["VoyageID", "CabinCategoryID"]

    waiting = bookings.filter(F.col("BookingStatus") == "Waitlisted")
    asked = booked.join(waiting, "BookingID").groupBy("BookingID", "VoyageID", "BookingDate")
    asked = asked.agg(F.min_by("CabinID", "BookingCabinID").alias("CabinID")).join(cabins, "CabinID").drop("CabinID")
    queue = _places(asked, spots, [F.asc("BookingDate"), F.asc("BookingID")], "Place")

    held = any_of("BookingStatus", tuple(dict.fromkeys((*HOLDING, *SOLD))))
    given_up = any_of("BookingStatus", ("Cancelled", "Rescheduled"))
    state = (
        booked.join(bookings.filter(held | given_up), "BookingID")
        .groupBy("VoyageID", "CabinID")
        .agg(F.max(F.coalesce(held, F.lit(False))).alias("_held"))
    )
    free = state.filter(~F.col("_held")).select("VoyageID", "CabinID").join(cabins, "CabinID")
    free = _places(free, spots, [F.asc("CabinID")], "Place")
    return queue.join(free, [*spots, "Place"], "left").select("BookingID", *spots, "BookingDate", "Place", "CabinID")
