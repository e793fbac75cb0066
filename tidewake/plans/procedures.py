"""Parameterised reports with a guard, and the cancellation job."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions import any_of, hours_until, money
from tidewake.operators.rules import booking_value, mark_cancelled, with_penalty
from tidewake.plans.reports import AMOUNT, Day, fares_per_cabin, in_force, operator_ships, total
from tidewake.plans.views import held_cabins
from tidewake.schema import SOLD
from tidewake.sources.tables import Tables


def _require(rows: DataFrame, message: str) -> None:
    if rows.limit(1).isEmpty():
        raise LookupError(message)


def voyage_revenue_summary(t: Tables, voyage_id: int) -> DataFrame:
    """Sold cabins and revenue per category of one voyage, with route, dates and the ship's total."""
    voyage = t["CruiseVoyage"].filter(F.col("VoyageID") == voyage_id)
    _require(voyage, "Voyage not found.")
    sailing = (
        voyage.select("VoyageID", "ShipID", "RouteID", "DepartureDateTime", "ArrivalDateTime")
        .join(operator_ships(t), "ShipID")
        .join(t["CruiseRoute"], "RouteID")
    )
    booked = (
        t["Booking"]
        .filter((F.col("VoyageID") == voyage_id) & any_of("BookingStatus", SOLD))
        .select("BookingID", "VoyageID")
    )
    cabins = (
        t["BookingCabin"]
        .select("BookingCabinID", "BookingID", "CabinID")
        .join(booked, "BookingID")
        .join(t["Cabin"].select("CabinID", "CabinCategoryID"), "CabinID")
        .select("BookingCabinID", "VoyageID", "CabinCategoryID")
    )
    per_category = (
        fares_per_cabin(t, cabins, few_cabins=True)
        .groupBy("VoyageID", "CabinCategoryID")
        .agg(F.count(F.lit(1)).alias("CabinsSold"), total("CabinFare").alias("CategoryFareRevenue"))
    )
    per_ship = Window.partitionBy("ShipID")
    return (
        per_category.join(sailing, "VoyageID")
        .join(t["CabinCategory"].select("CabinCategoryID", "CategoryName"), "CabinCategoryID")
        .withColumn("TotalShipFareRevenue", F.sum("CategoryFareRevenue").over(per_ship).cast(AMOUNT))
        .select(
            F.col("ShipID").alias("ShipCode"),
            "OperatorName",
            "RouteName",
            "RouteType",
            "DepartureDateTime",
            "ArrivalDateTime",
            F.col("CabinCategoryID").alias("CabinCategoryCode"),
            F.col("CategoryName").alias("CabinCategory"),
            "CabinsSold",
            "CategoryFareRevenue",
            "TotalShipFareRevenue",
        )
        .orderBy("CabinCategoryCode")
    )


def search_available_cabins(
    t: Tables, voyage_id: int, as_of: Day, category: str | None = None
) -> DataFrame:
    """Cabins of the voyage's ship that no pending or confirmed booking holds, with the adult fare.

    One row per cabin; 0 where no adult fare is in force on ``as_of``.
    """
    voyage = t["CruiseVoyage"].filter(F.col("VoyageID") == voyage_id)
    _require(voyage, "Voyage not found.")
    adult = t["AgeCategory"].filter(F.col("CategoryName") == "Adult").select("AgeCategoryID")
    fares = (
        t["FareRule"]
        .filter((F.col("VoyageID") == voyage_id) & in_force(as_of))
        .join(adult, "AgeCategoryID")
        .groupBy("CabinCategoryID")
        .agg(F.max_by("BaseFare", "EffectiveFrom").alias("BaseFare"))
    )
    categories = t["CabinCategory"].select("CabinCategoryID", F.col("CategoryName").alias("CabinCategory"))
    if category is not None:
        categories = categories.filter(F.col("CabinCategory") == category)
    return (
        t["Cabin"]
        .join(voyage.select("ShipID"), "ShipID")
        .join(categories, "CabinCategoryID")
        .join(held_cabins(t, voyage_id).select("CabinID"), "CabinID", "left_anti")
        .join(fares, "CabinCategoryID", "left")
        .select(
            "CabinID",
            "CabinNumber",
            "DeckNumber",
            "CabinCategory",
            "MaxOccupancy",
            "IsWheelchairAccessible",
            money(F.coalesce(F.col("BaseFare"), F.lit(0).cast("decimal(12,2)"))).alias("AdultBaseFare"),
        )
        .orderBy("CabinCategory", "DeckNumber", "CabinNumber")
    )


def passenger_bookings(t: Tables, passenger_id: int) -> DataFrame:
    """All bookings of a passenger, newest departure first."""
    _require(t["Passenger"].filter(F.col("PassengerID") == passenger_id), "Passenger not found.")
    mine = (
        t["BookingPassenger"]
        .filter(F.col("PassengerID") == passenger_id)
        .select("BookingID", "BookingCabinID", "FinalFare")
    )
    sailings = (
        t["CruiseVoyage"]
        .select("VoyageID", "ShipID", "RouteID", "DepartureDateTime", "ArrivalDateTime")
        .join(operator_ships(t), "ShipID")
        .join(t["CruiseRoute"].select("RouteID", "RouteName"), "RouteID")
    )
    cabins = t["Cabin"].select("CabinID", "CabinNumber", "CabinCategoryID").join(
        t["CabinCategory"].select("CabinCategoryID", F.col("CategoryName").alias("CabinCategory")), "CabinCategoryID"
    )
    return (
        mine.join(t["Booking"].select("BookingID", "BookingDate", "BookingStatus", "VoyageID"), "BookingID")
        .join(t["BookingCabin"].select("BookingCabinID", "CabinID"), "BookingCabinID")
        .join(sailings, "VoyageID")
        .join(cabins, "CabinID")
        .select(
            "BookingID",
            "BookingDate",
            "BookingStatus",
            "OperatorName",
            "ShipName",
            "RouteName",
            "DepartureDateTime",
            "ArrivalDateTime",
            "CabinNumber",
            "CabinCategory",
            F.col("FinalFare").alias("FarePaid"),
        )
        .orderBy(F.desc("DepartureDateTime"), "BookingID")
    )


class Cancellations(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame
    booking: DataFrame


# Rejection texts of the cancellation job.
NOT_FOUND = "Booking not found."
NOT_CANCELLABLE = "This booking cannot be cancelled in its current status."
DEPARTED = "Cannot cancel a voyage that has already departed."


def review_cancellations(t: Tables, requests: DataFrame, now: dt.datetime | str) -> DataFrame:
    """Requests (RequestID, BookingID, Reason, ProcessedBy) with the reason to reject them, or NULL.

    The first acceptable request of a booking cancels it, so later ones find it cancelled. The first
    is a minimum per booking, not a sort of its requests.
    """
    moment = F.lit(str(now)).cast("timestamp_ntz")
    first = requests.groupBy("BookingID").agg(F.min("RequestID").alias("_first"))
    hours = hours_until(moment, "DepartureDateTime")
    reason = (
        F.when(F.col("BookingStatus").isNull(), NOT_FOUND)
        .when(any_of("BookingStatus", ("Cancelled", "Completed")), NOT_CANCELLABLE)
        .when(hours < 0, DEPARTED)
        .when(F.col("RequestID") > F.col("_first"), NOT_CANCELLABLE)
    )
    return (
        requests.join(first, "BookingID", "left")
        .join(booking_value(t), "BookingID", "left")
        .withColumn("CancellationDateTime", moment)
        .withColumn("RejectReason", reason)
        .drop("_first")
    )


def process_cancellations(t: Tables, requests: DataFrame, now: dt.datetime | str) -> Cancellations:
    """Cancel a batch of bookings: accepted rows with amounts, rejected rows with reasons, new bookings."""
    reviewed = review_cancellations(t, requests, now)
    accepted = with_penalty(t, reviewed.filter(F.col("RejectReason").isNull()).drop("RejectReason"))
    rejected = reviewed.filter(F.col("RejectReason").isNotNull()).select(*requests.columns, "RejectReason")
    return Cancellations(accepted, rejected, mark_cancelled(t["Booking"], accepted))
