"""The 21 business reports.

Every function takes the table dict and returns a DataFrame. Facts are narrowed and pre-aggregated
before they meet the dimensions; no join is hinted, so Catalyst broadcasts a side only when its size
is under the session threshold and AQE splits skewed partitions of the rest.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions import (
    age_on,
    any_of,
    map_text,
    money,
    on_date,
    on_dates,
    ratio_pct,
    zero_if_null,
)
from tidewake.operators.lookups import route_endpoints
from tidewake.operators.ranking import global_rank
from tidewake.operators.rollup import grouping_sets, labelled_rollup
from tidewake.schema import (
    EXC_SOLD,
    LIVE_VOYAGE,
    OPEN_REQUESTS,
    SOLD,
    STATUS_TEXT,
    STATUS_TEXT_UNKNOWN,
    WHEELCHAIR_TYPES,
)
from tidewake.session import stage
from tidewake.sources.tables import Tables

Day = dt.date | str
AMOUNT = "decimal(38,2)"


def total(c: str) -> Column:
    return F.sum(c).cast(AMOUNT)


def operator_ships(t: Tables, operator: str | None = None) -> DataFrame:
    """Ships with their operator, optionally of one operator only."""
    operators = t["CruiseOperator"].select("OperatorID", "OperatorName")
    if operator is not None:
        operators = operators.filter(F.col("OperatorName") == operator)
    return t["CruiseShip"].select("ShipID", "ShipName", "OperatorID").join(operators, "OperatorID")


def _voyages(t: Tables, *columns: str) -> DataFrame:
    return t["CruiseVoyage"].select("VoyageID", "ShipID", *columns)


def _one_voyage(df: DataFrame, voyage_id: int | None) -> DataFrame:
    return df if voyage_id is None else df.filter(F.col("VoyageID") == voyage_id)


def _bookings(t: Tables, statuses: tuple[str, ...], voyage_id: int | None = None) -> DataFrame:
    rows = _one_voyage(t["Booking"], voyage_id).filter(any_of("BookingStatus", statuses))
    return rows.select("BookingID", "VoyageID")


def fares_per_cabin(t: Tables, cabins: DataFrame, few_cabins: bool) -> DataFrame:
    """``cabins`` (keyed by BookingCabinID) with the sum and number of the fares paid in each.

    For a few cabins the passengers are filtered by the join first. Otherwise they are summed per
    cabin before the join: the sum shuffles on the join key, so the join needs no second shuffle, and
    a cabin with very many rows is one row by then.
    """
    people = t["BookingPassenger"].select("BookingCabinID", "FinalFare")
    sums = [F.sum("FinalFare").alias("CabinFare"), F.count(F.lit(1)).alias("Passengers")]
    if few_cabins:
        return people.join(cabins, "BookingCabinID").groupBy(*cabins.columns).agg(*sums)
    return cabins.join(people.groupBy("BookingCabinID").agg(*sums), "BookingCabinID")


def round_trip_sailings(
    t: Tables, start: Day, end: Day, dep_port: str | None = None, arr_port: str | None = None
) -> DataFrame:
    """Round-trip sailings departing in [start, end] whose first and last stop are the same port."""
    loops = route_endpoints(t["RoutePort"]).filter(F.col("FirstPortID") == F.col("LastPortID"))
    ports = t["Port"].select(F.col("PortID").alias("FirstPortID"), "PortName")
    for wanted in (dep_port, arr_port):
        if wanted is not None:
            ports = ports.filter(F.col("PortName") == wanted)
    routes = t["CruiseRoute"].filter(F.col("RouteType") == "Round-trip").select("RouteID", "RouteName")
    sailings = t["CruiseVoyage"].filter(on_dates("DepartureDateTime", start, end))
    return (
        sailings.join(routes.join(loops, "RouteID").join(ports, "FirstPortID"), "RouteID")
        .select(
            "VoyageID",
            "RouteName",
            F.col("PortName").alias("DeparturePort"),
            F.col("PortName").alias("ArrivalPort"),
            "DepartureDateTime",
            "ArrivalDateTime",
        )
        .orderBy("DepartureDateTime", "VoyageID")
    )


def revenue_by_category(t: Tables, operator: str, voyage_id: int | None = None) -> DataFrame:
    """Sold revenue per ship and cabin category with the ship's total on each row.

    ``voyage_id`` None covers all voyages of the operator.
    """
    ships = operator_ships(t, operator).select("ShipID")
    sailings = _one_voyage(_voyages(t), voyage_id).join(ships, "ShipID")
    cabins = (
        t["BookingCabin"]
        .select("BookingCabinID", "BookingID", "CabinID")
        .join(_bookings(t, SOLD, voyage_id).join(sailings, "VoyageID"), "BookingID")
        .join(t["Cabin"].select("CabinID", "CabinCategoryID"), "CabinID")
        .select("BookingCabinID", "ShipID", "CabinCategoryID")
    )
    revenue = (
        fares_per_cabin(t, cabins, voyage_id is not None)
        .groupBy(F.col("ShipID").alias("ShipCode"), F.col("CabinCategoryID").alias("CabinCategoryCode"))
        .agg(total("CabinFare").alias("CategoryRevenue"))
    )
    per_ship = Window.partitionBy("ShipCode")
    return revenue.withColumn(
        "TotalShipRevenue", F.sum("CategoryRevenue").over(per_ship).cast(AMOUNT)
    ).orderBy("ShipCode", "CabinCategoryCode")


def reservation_status(t: Tables, operator: str) -> DataFrame:
    """Every passenger of an operator's bookings with the status in words."""
    sailings = _voyages(t).join(operator_ships(t, operator), "ShipID").select("VoyageID", "OperatorName")
    bookings = t["Booking"].select("BookingID", "VoyageID", "BookingStatus").join(sailings, "VoyageID")
    return (
        t["BookingPassenger"]
        .select("BookingID", "PassengerID")
        .join(bookings, "BookingID")
        .join(t["Passenger"].select("PassengerID", "FullName"), "PassengerID")
        .select(
            "PassengerID",
            "FullName",
            "BookingID",
            "BookingStatus",
            map_text("BookingStatus", STATUS_TEXT, STATUS_TEXT_UNKNOWN).alias(
                "ReservationStatusDescription"
            ),
            "OperatorName",
        )
        .orderBy("PassengerID", "BookingID")
    )


def top_operator_by_port(t: Tables, port: str, start: Day, end: Day, n: int = 1) -> DataFrame:
    """Operators with most sold bookings made in [start, end] for sailings that start at a port."""
    starts = (
        t["RoutePort"]
        .filter(F.col("StopSequence") == 1)
        .join(t["Port"].filter(F.col("PortName") == port), "PortID")
        .select("RouteID")
    )
    sales = (
        t["Booking"]
        .filter(on_dates("BookingDate", start, end) & any_of("BookingStatus", SOLD))
        .groupBy("VoyageID")
        .agg(F.count("BookingID").alias("_n"))
    )
    return (
        sales.join(_voyages(t, "RouteID"), "VoyageID")
        .join(starts, "RouteID")
        .join(operator_ships(t), "ShipID")
        .groupBy("OperatorID", "OperatorName")
        .agg(F.sum("_n").alias("TotalBookings"))
        .orderBy(F.desc("TotalBookings"), "OperatorName")
        .limit(n)
        .select("OperatorName", "TotalBookings")
    )


def age_band_rollup(t: Tables, operator: str, voyage_id: int | None = None) -> DataFrame:
    """Head counts per age band, spread over one column per band, with a grand total row."""
    ships = operator_ships(t, operator).select("ShipID")
    sailings = _one_voyage(_voyages(t), voyage_id).join(ships, "ShipID").select("VoyageID")
    heads = (
        t["BookingPassenger"]
        .select("BookingID", "AgeCategoryID")
        .join(_bookings(t, SOLD, voyage_id).join(sailings, "VoyageID"), "BookingID")
        .groupBy("AgeCategoryID")
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(t["AgeCategory"].select("AgeCategoryID", "CategoryName"), "AgeCategoryID")
    )

    def band(name: str, column: str) -> Column:
        return F.sum(F.when(F.col("CategoryName") == name, F.col("_n")).otherwise(0)).alias(column)

    bands = [("Infant", "Infants"), ("Child", "Children"), ("Teen", "Teens"), ("Adult", "Adults"), ("Senior", "Seniors")]
    return labelled_rollup(
        heads,
        "CategoryName",
        "AgeCategory",
        "Grand Total",
        [*[band(*b) for b in bands], F.sum("_n").alias("TotalPassengers")],
    )


def top_multi_destination(t: Tables, n: int = 1) -> DataFrame:
    """Operator and end ports with most multi-destination sailings."""
    routes = (
        t["CruiseRoute"]
        .filter(F.col("RouteType") == "Multi-destination")
        .select("RouteID")
        .join(route_endpoints(t["RoutePort"]).filter(F.col("FirstPortID").isNotNull()), "RouteID")
    )
    port = t["Port"].select("PortID", "PortName")
    first = port.select(F.col("PortID").alias("FirstPortID"), F.col("PortName").alias("DeparturePort"))
    last = port.select(F.col("PortID").alias("LastPortID"), F.col("PortName").alias("FinalArrivalPort"))
    return (
        t["CruiseVoyage"]
        .groupBy("ShipID", "RouteID")
        .agg(F.count("VoyageID").alias("_n"))
        .join(routes, "RouteID")
        .join(operator_ships(t), "ShipID")
        .groupBy("OperatorID", "OperatorName", "FirstPortID", "LastPortID")
        .agg(F.sum("_n").alias("MultiDestinationVoyages"))
        .join(first, "FirstPortID")
        .join(last, "LastPortID")
        .orderBy(F.desc("MultiDestinationVoyages"), "OperatorName", "DeparturePort", "FinalArrivalPort")
        .limit(n)
        .select("OperatorName", "DeparturePort", "FinalArrivalPort", "MultiDestinationVoyages")
    )


def passenger_spend(t: Tables, as_written: bool = False) -> DataFrame:
    """Bookings, fare spend, excursion spend and their sum per passenger with a sold booking.

    Excursions are summed per booked passenger first. ``as_written`` keeps the inflated form, in which
    a fare counts once per excursion bought.
    """
    trips = (
        t["BookingPassenger"]
        .select("BookingPassengerID", "PassengerID", "BookingID", "FinalFare")
        .join(_bookings(t, SOLD).select("BookingID"), "BookingID")
    )
    bought = t["BookingExcursion"].filter(any_of("ExcursionStatus", EXC_SOLD))
    bought = bought.select("BookingPassengerID", "AmountPaid")
    if not as_written:
        bought = bought.groupBy("BookingPassengerID").agg(F.sum("AmountPaid").alias("AmountPaid"))
    return (
        trips.join(bought, "BookingPassengerID", "left")
        .groupBy("PassengerID")
        .agg(
            F.count_distinct("BookingID").alias("TotalBookings"),
            zero_if_null(F.sum("FinalFare")).alias("TotalFareSpend"),
            zero_if_null(F.sum("AmountPaid")).alias("TotalExcursionSpend"),
        )
        .withColumn(
            "LifetimeValue", (F.col("TotalFareSpend") + F.col("TotalExcursionSpend")).cast(AMOUNT)
        )
    )


def passenger_lifetime_value(t: Tables, as_written: bool = False) -> DataFrame:
    """Lifetime value per passenger with its rank.

    The spend table is staged because the rank reads it twice; the rank itself never puts the
    passengers into one task (see ``global_rank``).
    """
    spend = stage(passenger_spend(t, as_written), "passenger-spend")
    people = t["Passenger"].select("PassengerID", "FullName", "Nationality")
    return (
        global_rank(spend, "LifetimeValue", "ValueRank")
        .join(people, "PassengerID")
        .select(
            "PassengerID",
            "FullName",
            "Nationality",
            "TotalBookings",
            "TotalFareSpend",
            "TotalExcursionSpend",
            "LifetimeValue",
            "ValueRank",
        )
        .orderBy(F.desc("LifetimeValue"), "PassengerID")
    )


def in_force(as_of: Day) -> Column:
    """A rule row is in force on a fixed day."""
    day = F.lit(str(as_of)).cast("date")
    return (F.col("EffectiveFrom") <= day) & (F.col("EffectiveTo").isNull() | (F.col("EffectiveTo") >= day))


def discounted_fares(
    t: Tables, category: str, as_of: Day, discount: Decimal = Decimal("0.15"), band: str = "Adult"
) -> DataFrame:
    """Regular and discounted fare of a cabin category, per ship and rule in force on a day."""
    keep = F.lit(1 - Decimal(discount))
    return (
        t["FareRule"]
        .filter(in_force(as_of))
        .join(t["CabinCategory"].filter(F.col("CategoryName") == category).select("CabinCategoryID"), "CabinCategoryID")
        .join(t["AgeCategory"].filter(F.col("CategoryName") == band).select("AgeCategoryID"), "AgeCategoryID")
        .join(_voyages(t), "VoyageID")
        .orderBy("ShipID", "VoyageID", "EffectiveFrom")
        .select(
            F.col("ShipID").alias("ShipCode"),
            F.col("BaseFare").alias("RegularFare"),
            money(F.round(F.col("BaseFare") * keep, 2)).alias("DiscountedFare"),
        )
    )


def _routes_calling_at(t: Tables, port: str) -> DataFrame:
    """Routes with any stop at a port, once each, however often they call there."""
    ports = t["Port"].filter(F.col("PortName") == port)
    return t["RoutePort"].select("RouteID", "PortID").join(ports, "PortID").drop("PortID").distinct()


def sailings_to_port(t: Tables, port: str) -> DataFrame:
    """Sailings that call at a port, shortest first."""
    calls = _routes_calling_at(t, port).select(
        "RouteID", F.col("PortName").alias("DestinationPort"), F.col("Country").alias("DestinationCountry")
    )
    return (
        t["CruiseVoyage"]
        .join(calls.join(t["CruiseRoute"], "RouteID"), "RouteID")
        .join(operator_ships(t), "ShipID")
        .select(
            "VoyageID",
            "ShipName",
            "OperatorName",
            "RouteName",
            "RouteType",
            "DestinationPort",
            "DestinationCountry",
            "DepartureDateTime",
            "ArrivalDateTime",
            F.col("VoyageLengthDays").alias("DurationDays"),
            "VoyageStatus",
        )
        .orderBy("DurationDays", "VoyageID")
    )


def specialty_dining(t: Tables, ship: str) -> DataFrame:
    """Specialty dining types offered on a ship."""
    ships = t["CruiseShip"].filter(F.col("ShipName") == ship).select("ShipID", "ShipName")
    return (
        t["ShipSpecialtyDining"]
        .join(ships, "ShipID")
        .join(t["SpecialtyDiningType"], "SpecialtyDiningTypeID")
        .select(
            "ShipName",
            F.col("TypeName").alias("SpecialtyDiningType"),
            F.col("Description").alias("SpecialtyDescription"),
        )
        .orderBy("ShipName", "SpecialtyDiningType")
    )


def dock_countries(t: Tables, operator: str | None = None) -> DataFrame:
    """Countries where live voyages dock, of one operator or of all.

    Voyages collapse to routes and stops to ports before each next join.
    """
    routes = (
        t["CruiseVoyage"]
        .filter(any_of("VoyageStatus", LIVE_VOYAGE))
        .join(operator_ships(t, operator).select("ShipID"), "ShipID")
        .select("RouteID")
        .distinct()
    )
    ports = t["RoutePort"].join(routes, "RouteID").select("PortID").distinct()
    return t["Port"].join(ports, "PortID").select("Country").distinct().orderBy("Country")


def voyages_rollup(t: Tables, dep_date: Day) -> DataFrame:
    """Voyages per operator departing on a day, with the total of all operators."""
    per_operator = (
        t["CruiseVoyage"]
        .filter(on_date("DepartureDateTime", dep_date))
        .groupBy("ShipID")
        .agg(F.count("VoyageID").alias("_n"))
        .join(operator_ships(t), "ShipID")
        .groupBy("OperatorName")
        .agg(F.sum("_n").alias("_n"))
    )
    return labelled_rollup(
        per_operator, "OperatorName", "CruiseOperator", "All Operators", [F.sum("_n").alias("TotalVoyages")]
    )


def itinerary_excursions(t: Tables, ship: str) -> DataFrame:
    """Excursions offered along all sailings of a ship."""
    sailings = t["CruiseVoyage"].join(
        t["CruiseShip"].filter(F.col("ShipName") == ship).select("ShipID", "ShipName"), "ShipID"
    ).select("VoyageID", "ShipName", "DepartureDateTime")
    stops = t["RoutePort"].select("RoutePortID", "PortID", "StopSequence").join(t["Port"], "PortID")
    offers = t["Excursion"].select(
        "ExcursionID", "ExcursionName", F.col("Description").alias("ExcursionDescription"), "DurationHours",
        F.col("Price").alias("ExcursionPrice"),
    )
    return (
        t["VoyageExcursion"]
        .join(sailings, "VoyageID")
        .join(stops, "RoutePortID")
        .join(offers, "ExcursionID")
        .select(
            "ShipName",
            "VoyageID",
            "DepartureDateTime",
            F.col("PortName").alias("ExcursionPort"),
            "Country",
            "StopSequence",
            "ExcursionName",
            "ExcursionDescription",
            "DurationHours",
            "ExcursionPrice",
            "AvailableSlots",
        )
        .orderBy("DepartureDateTime", "StopSequence", "ExcursionName", "VoyageID")
    )


def occupancy(t: Tables) -> DataFrame:
    """Cabins of the ship, cabins sold and their share, per voyage.

    Cabins are counted per ship and sales per voyage; voyages are never multiplied by cabins.
    """
    cabins = t["Cabin"].select("CabinID", "ShipID")
    fleet = cabins.groupBy("ShipID").agg(F.count("CabinID").alias("TotalCabinsOnShip"))
    sold = (
        t["BookingCabin"]
        .select("BookingID", "CabinID")
        .join(_bookings(t, SOLD), "BookingID")
        .select("VoyageID", "CabinID")
        .distinct()
        .join(cabins, "CabinID")
        .groupBy("VoyageID", "ShipID")
        .agg(F.count(F.lit(1)).alias("_sold"))
    )
    booked = F.coalesce(F.col("_sold"), F.lit(0))
    return (
        _voyages(t, "RouteID", "DepartureDateTime")
        .join(operator_ships(t), "ShipID")
        .join(t["CruiseRoute"].select("RouteID", "RouteType"), "RouteID")
        .join(fleet, "ShipID")
        .join(sold, ["VoyageID", "ShipID"], "left")
        .select(
            "VoyageID",
            "ShipName",
            "OperatorName",
            "RouteType",
            "DepartureDateTime",
            "TotalCabinsOnShip",
            booked.alias("BookedCabins"),
            (F.col("TotalCabinsOnShip") - booked).alias("AvailableCabins"),
            ratio_pct(booked.cast("decimal(18,0)"), "TotalCabinsOnShip").alias("OccupancyRatePct"),
        )
        .orderBy("DepartureDateTime", F.desc("OccupancyRatePct"), "VoyageID")
    )


def duration_stats(t: Tables, port: str) -> DataFrame:
    """Shortest, longest and average length of the sailings that call at a port."""
    length = F.col("VoyageLengthDays")
    mean = F.sum(length).cast("decimal(20,0)") / F.nullif(F.count(length), F.lit(0))
    return (
        t["CruiseVoyage"]
        .join(_routes_calling_at(t, port).select("RouteID").distinct(), "RouteID")
        .agg(
            F.min(length).alias("MinimumDuration"),
            F.max(length).alias("MaximumDuration"),
            F.round(mean, 2).cast(AMOUNT).alias("AverageDuration"),
        )
    )


def party_for_passenger(t: Tables, passenger_id: int) -> DataFrame:
    """Departure, size of the whole party on the booking and cabin category, per booking of a passenger."""
    people = t["BookingPassenger"].select("BookingID", "BookingCabinID", "PassengerID")
    mine = people.filter(F.col("PassengerID") == passenger_id).drop("PassengerID")
    party = (
        people.select("BookingID")
        .join(mine.select("BookingID").distinct(), "BookingID", "left_semi")
        .groupBy("BookingID")
        .agg(F.count(F.lit(1)).alias("PassengersInParty"))
    )
    cabins = (
        t["BookingCabin"]
        .select("BookingCabinID", "CabinID")
        .join(t["Cabin"].select("CabinID", "CabinCategoryID"), "CabinID")
        .join(t["CabinCategory"].select("CabinCategoryID", F.col("CategoryName").alias("CabinCategory")), "CabinCategoryID")
    )
    return (
        mine.join(party, "BookingID")
        .join(cabins, "BookingCabinID")
        .join(t["Booking"].select("BookingID", "VoyageID"), "BookingID")
        .join(t["CruiseVoyage"].select("VoyageID", "DepartureDateTime"), "VoyageID")
        .select(F.col("DepartureDateTime").alias("DepartureDate"), "PassengersInParty", "CabinCategory")
        .distinct()
        .orderBy("DepartureDate", "CabinCategory")
    )


def unsold_excursions(t: Tables) -> DataFrame:
    """Excursions without any sale."""
    sold = (
        t["BookingExcursion"]
        .filter(any_of("ExcursionStatus", EXC_SOLD))
        .select("VoyageExcursionID")
        .distinct()
        .join(t["VoyageExcursion"].select("VoyageExcursionID", "ExcursionID"), "VoyageExcursionID")
        .select("ExcursionID")
    )
    return (
        t["Excursion"]
        .join(sold, "ExcursionID", "left_anti")
        .join(t["Port"], "PortID")
        .select("ExcursionID", "ExcursionName", "PortName", "Country", "DurationHours", "Price")
        .orderBy("Country", "ExcursionName", "ExcursionID")
    )


def multi_destination_passengers(t: Tables, operator: str, booking_date: Day) -> DataFrame:
    """Passengers booked on a day with an operator for multi-destination routes."""
    routes = t["CruiseRoute"].filter(F.col("RouteType") == "Multi-destination")
    sailings = (
        _voyages(t, "RouteID", "DepartureDateTime")
        .join(operator_ships(t, operator), "ShipID")
        .join(routes.select("RouteID", F.col("RouteName").alias("Itinerary")), "RouteID")
        .select("VoyageID", "OperatorName", "Itinerary", "DepartureDateTime")
    )
    bookings = (
        t["Booking"]
        .filter(on_date("BookingDate", booking_date))
        .select("BookingID", "BookingDate", "BookingStatus", "VoyageID")
        .join(sailings, "VoyageID")
    )
    people = t["Passenger"].select("PassengerID", "FullName", "PassportNo", "Nationality", "ContactNo")
    return (
        t["BookingPassenger"]
        .select("BookingID", "PassengerID")
        .join(bookings, "BookingID")
        .join(people, "PassengerID")
        .select(
            *people.columns,
            "BookingID",
            "BookingDate",
            "BookingStatus",
            "OperatorName",
            "Itinerary",
            "DepartureDateTime",
        )
        .orderBy("FullName", "PassengerID", "BookingID")
    )


def wheelchair_rollup(t: Tables, dep_date: Day) -> DataFrame:
    """Distinct passengers with an open accessibility or mobility request, per operator and in total."""
    services = t["SpecialService"].filter(any_of("ServiceType", WHEELCHAIR_TYPES)).select("ServiceID")
    asked = (
        t["PassengerSpecialService"]
        .filter(any_of("RequestStatus", OPEN_REQUESTS))
        .join(services, "ServiceID")
        .select("BookingPassengerID")
        .distinct()
    )
    sailings = (
        t["CruiseVoyage"]
        .filter(on_date("DepartureDateTime", dep_date))
        .select("VoyageID", "ShipID")
        .join(operator_ships(t), "ShipID")
        .select("VoyageID", "OperatorName")
    )
    bookings = t["Booking"].select("BookingID", "VoyageID").join(sailings, "VoyageID")
    seats = (
        t["BookingPassenger"]
        .select("BookingPassengerID", "BookingID")
        .join(bookings, "BookingID")
        .join(asked, "BookingPassengerID")
        .select("OperatorName", "BookingPassengerID")
        .distinct()
    )
    return labelled_rollup(
        seats,
        "OperatorName",
        "CruiseOperator",
        "All Operators",
        [F.count_distinct("BookingPassengerID").alias("WheelchairPassengers")],
    )


def chaperoned_youth(t: Tables, voyage_id: int | None, dep_date: Day) -> DataFrame:
    """Chaperoned-youth passengers of the sailing on a day with the supervision fee of the whole trip."""
    sailings = (
        _one_voyage(t["CruiseVoyage"], voyage_id)
        .filter(on_date("DepartureDateTime", dep_date))
        .select("VoyageID", "ShipID", "DepartureDateTime", "VoyageLengthDays")
        .join(operator_ships(t), "ShipID")
    )
    bookings = _one_voyage(t["Booking"], voyage_id).select("BookingID", "BookingDate", "VoyageID")
    people = t["Passenger"].select("PassengerID", "FullName", "DateOfBirth")
    fee = F.round(F.col("DailySupervisionFee") * F.col("VoyageLengthDays"), 2)
    return (
        t["BookingPassenger"]
        .filter(F.col("IsChaperonedYouth"))
        .select("BookingID", "PassengerID", "DailySupervisionFee")
        .join(bookings.join(sailings, "VoyageID"), "BookingID")
        .join(people, "PassengerID")
        .select(
            "PassengerID",
            "FullName",
            "DateOfBirth",
            age_on("DateOfBirth", "DepartureDateTime").alias("AgeAtDeparture"),
            "BookingID",
            "BookingDate",
            "OperatorName",
            "VoyageID",
            "DepartureDateTime",
            "DailySupervisionFee",
            "VoyageLengthDays",
            fee.cast(AMOUNT).alias("TotalSupervisionFee"),
        )
        .orderBy("FullName", "PassengerID", "BookingID")
    )


def cancellation_impact(t: Tables) -> DataFrame:
    """Cancelled value, penalties kept and refunds paid per operator, with both shares in percent."""
    cancelled = t["BookingCancellation"].select("BookingID", "PenaltyAmount", "RefundAmount")
    bookings = t["Booking"].select("BookingID", "VoyageID", "TotalAmount")
    per_operator = (
        cancelled.join(bookings, "BookingID")
        .groupBy("VoyageID")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("TotalAmount").alias("_value"),
            F.sum("PenaltyAmount").alias("_penalty"),
            F.sum("RefundAmount").alias("_refund"),
        )
        .join(_voyages(t), "VoyageID")
        .join(operator_ships(t), "ShipID")
        .groupBy("OperatorID", "OperatorName")
        .agg(
            F.sum("_n").alias("TotalCancellations"),
            total("_value").alias("TotalOriginalValue"),
            total("_penalty").alias("TotalPenaltiesRetained"),
            total("_refund").alias("TotalRefundsIssued"),
        )
    )
    return (
        per_operator.withColumn("PenaltyRetentionPct", ratio_pct("TotalPenaltiesRetained", "TotalOriginalValue"))
        .withColumn("RefundRatePct", ratio_pct("TotalRefundsIssued", "TotalOriginalValue"))
        .orderBy(F.desc("TotalPenaltiesRetained"), "OperatorName")
        .drop("OperatorID")
    )


def revenue_levels(t: Tables) -> DataFrame:
    """Sold revenue, seats and different passengers by operator, ship and cabin category, at five levels at once.

    Levels (see ``grouping_sets``): 0 all three keys, 1 operator and ship, 2 operator and category,
    3 operator, 7 everything.
    """
    sailings = _voyages(t).join(operator_ships(t), "ShipID").select("VoyageID", "ShipID", "OperatorName")
    cabins = (
        t["BookingCabin"]
        .select("BookingCabinID", "BookingID", "CabinID")
        .join(_bookings(t, SOLD), "BookingID")
        .join(t["Cabin"].select("CabinID", "CabinCategoryID"), "CabinID")
        .join(sailings, "VoyageID")
        .select("BookingCabinID", "OperatorName", "ShipID", "CabinCategoryID")
    )
    seats = t["BookingPassenger"].select("BookingCabinID", "PassengerID", "FinalFare").join(cabins, "BookingCabinID")
    operator, ship, category = "OperatorName", "ShipID", "CabinCategoryID"
    sets = [(operator, ship, category), (operator, ship), (operator, category), (operator,), ()]
    levels = grouping_sets(seats, sets, {"Revenue": F.col("FinalFare"), "Seats": F.lit(1)}, "PassengerID", "Passengers")
    return levels.select(operator, ship, category, "Level", F.col("Revenue").cast(AMOUNT).alias("Revenue"), "Seats", "Passengers")
