"""The two wide reporting views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.functions import age_on, any_of
from tidewake.schema import HOLDING
from tidewake.sources.tables import Tables


def booking_passenger_details(t: Tables) -> DataFrame:
    """Booked passengers with booking, sailing, cabin, person and age band, one row each."""
    sailings = (
        t["CruiseVoyage"]
        .select("VoyageID", "ShipID", "RouteID", "DepartureDateTime")
        .join(t["CruiseRoute"], "RouteID")
        .join(t["CruiseShip"].select("ShipID", "ShipName"), "ShipID")
    )
    bookings = (
        t["Booking"].select("BookingID", "BookingDate", "BookingStatus", "VoyageID").join(sailings, "VoyageID")
    )
    cabins = (
        t["BookingCabin"]
        .select("BookingCabinID", "CabinID")
        .join(t["Cabin"].select("CabinID", "CabinNumber", "CabinCategoryID"), "CabinID")
        .join(t["CabinCategory"].select("CabinCategoryID", F.col("CategoryName").alias("CabinCategory")), "CabinCategoryID")
    )
    people = t["Passenger"].select("PassengerID", "FullName", "PassportNo", "DateOfBirth")
    bands = t["AgeCategory"].select("AgeCategoryID", F.col("CategoryName").alias("AgeCategory"))
    return (
        t["BookingPassenger"]
        .join(bookings, "BookingID")
        .join(cabins, "BookingCabinID")
        .join(people, "PassengerID")
        .join(bands, "AgeCategoryID")
        .select(
            "BookingID",
            "BookingDate",
            "BookingStatus",
            "VoyageID",
            "RouteName",
            "RouteType",
            "ShipName",
            "CabinNumber",
            "CabinCategory",
            "PassengerID",
            "FullName",
            "PassportNo",
            age_on("DateOfBirth", "DepartureDateTime").alias("AgeAtDeparture"),
            "AgeCategory",
            "InfantBedOption",
            "IsChaperonedYouth",
            "FinalFare",
        )
    )


def held_cabins(t: Tables, voyage_id: int | None = None) -> DataFrame:
    """Distinct (VoyageID, CabinID) held by a pending or confirmed booking, of one voyage or of all."""
    bookings = t["Booking"] if voyage_id is None else t["Booking"].filter(F.col("VoyageID") == voyage_id)
    holding = bookings.filter(any_of("BookingStatus", HOLDING)).select("BookingID", "VoyageID")
    return t["BookingCabin"].select("BookingID", "CabinID").join(holding, "BookingID").select(
        "VoyageID", "CabinID"
    ).distinct()


def voyage_cabin_availability(t: Tables) -> DataFrame:
    """Every cabin of the ship of every voyage, marked Booked or Available."""
    cabins = t["Cabin"].join(
        t["CabinCategory"].select("CabinCategoryID", F.col("CategoryName").alias("CabinCategory")), "CabinCategoryID"
    ).select("CabinID", "ShipID", "CabinNumber", "CabinCategory", "MaxOccupancy")
    sailings = (
        t["CruiseVoyage"]
        .select("VoyageID", "ShipID", "RouteID")
        .join(t["CruiseShip"].select("ShipID", "ShipName"), "ShipID")
        .join(t["CruiseRoute"].select("RouteID", "RouteName"), "RouteID")
    )
    held = held_cabins(t).withColumn("_held", F.lit(True))
    return (
        sailings.join(cabins, "ShipID")
        .join(held, ["VoyageID", "CabinID"], "left")
        .select(
            "VoyageID",
            "ShipName",
            "RouteName",
            "CabinID",
            "CabinNumber",
            "CabinCategory",
            "MaxOccupancy",
            F.when(F.col("_held"), F.lit("Booked")).otherwise(F.lit("Available")).alias("AvailabilityStatus"),
        )
    )


def register_reporting_views(t: Tables) -> None:
    """Expose both views to ``spark.sql``; Catalyst inlines them, so filters reach the scans."""
    booking_passenger_details(t).createOrReplaceTempView("BookingPassengerDetails")
    voyage_cabin_availability(t).createOrReplaceTempView("VoyageCabinAvailability")
