"""Registered queries: each runs a library function on the derived tables and has a DuckDB oracle."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake import catalogue as K
from tidewake.bindings.star import BUILDERS, VALUES, StarTables
from tidewake.bindings.star_sql import age_sql, with_ctes
from tidewake.functions import (
    age_on,
    any_of,
    as_date,
    hours_until,
    map_text,
    money,
    on_dates,
    voyage_length_days,
    zero_if_null,
)
from tidewake.operators import audits as A
from tidewake.operators import capacity, chains, deltas, intervals, ledger
from tidewake.operators import lookups as H
from tidewake.operators import rules as X
from tidewake.operators.common import union_all
from tidewake.plans import procedures as P
from tidewake.plans import reports as R
from tidewake.plans import views as V
from tidewake.schema import HOLDING, SOLD, STATUS_TEXT, STATUS_TEXT_UNKNOWN, TABLES
from tidewake.session import staging_root
from tidewake.sources import versions

NOW = "2001-06-01 12:00:00"
SAILING_DAY = "2001-06-19"
FARE_DAY = "1998-06-15"


@dataclass(frozen=True)
class Query:
    run: Callable[[StarTables], DataFrame]
    sql: str | None = None
    ctes: dict[str, str] = field(default_factory=dict)

    def bind(self) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: self.run(StarTables(spark, folder))

    def oracle(self) -> str | None:
        return None if self.sql is None else with_ctes(self.sql, self.ctes)


QUERIES: dict[str, Query] = {}


def register(name: str, run: Callable[[StarTables], DataFrame], sql: str | None = None, **ctes: str) -> None:
    QUERIES[name] = Query(run, sql, ctes)


def _with(t: StarTables, **frames: DataFrame) -> StarTables:
    """The tables with some of them replaced."""
    out = StarTables(t.spark, t.folder)
    out.update(frames)
    return out


def _dec(expr: str, p: int = 38) -> str:
    return f"CAST({expr} AS DECIMAL({p},2))"


def _pct(part: str, whole: str) -> str:
    return _dec(f"round(100 * CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0), 2)")


# --- reports -------------------------------------------------------------------------------------

register(
    "q01_round_trip_sailings",
    lambda t: R.round_trip_sailings(t, "2000-01-01", "2000-12-31"),
    "SELECT VoyageID, RouteName, PortName AS DeparturePort, PortName AS ArrivalPort, DepartureDateTime, ArrivalDateTime "
    "FROM sailing JOIN CruiseRoute USING (RouteID) JOIN route_end USING (RouteID) JOIN Port ON PortID = LastPortID "
    "WHERE RouteType = 'Round-trip' AND FirstPortID = LastPortID AND year(DepartureDateTime) = 2000",
)
_SOLD_SEAT = (
    "SELECT BookingCabin.BookingCabinID, sailing.VoyageID, sailing.ShipID, OperatorName, CabinCategoryID, FinalFare AS paid "
    "FROM BookingPassenger JOIN BookingCabin ON BookingCabin.BookingCabinID = BookingPassenger.BookingCabinID "
    "JOIN Booking ON Booking.BookingID = BookingCabin.BookingID AND BookingStatus IN ('Completed', 'Confirmed') "
    "JOIN sailing USING (VoyageID) JOIN Cabin USING (CabinID)"
)
register(
    "q02_revenue_by_category",
    lambda t: R.revenue_by_category(t, "ASIA"),
    f"SELECT ShipCode, CabinCategoryCode, CategoryRevenue, {_dec('sum(CategoryRevenue) OVER (PARTITION BY ShipCode)')} AS TotalShipRevenue "
    f"FROM (SELECT ShipID AS ShipCode, CabinCategoryID AS CabinCategoryCode, {_dec('sum(paid)')} AS CategoryRevenue "
    "FROM sold_seat WHERE OperatorName = 'ASIA' GROUP BY ShipID, CabinCategoryID)",
    sold_seat=_SOLD_SEAT,
)
register(
    "q02_revenue_of_one_voyage",
    lambda t: R.revenue_by_category(t, "EUROPE", 7),
    f"SELECT ShipCode, CabinCategoryCode, CategoryRevenue, {_dec('sum(CategoryRevenue) OVER ()')} AS TotalShipRevenue "
    f"FROM (SELECT ShipID AS ShipCode, CabinCategoryID AS CabinCategoryCode, {_dec('sum(paid)')} AS CategoryRevenue "
    "FROM sold_seat WHERE OperatorName = 'EUROPE' AND VoyageID = 7 GROUP BY ShipID, CabinCategoryID)",
    sold_seat=_SOLD_SEAT,
)
register(
    "q03_reservation_status",
    lambda t: R.reservation_status(t, "EUROPE"),
    "SELECT PassengerID, FullName, Booking.BookingID, BookingStatus, coalesce(wording, 'Status unknown') AS ReservationStatusDescription, OperatorName "
    "FROM BookingPassenger JOIN Booking USING (BookingID) JOIN sailing USING (VoyageID) JOIN Passenger USING (PassengerID) "
    "LEFT JOIN wordings ON wordings.status = BookingStatus WHERE OperatorName = 'EUROPE'",
    wordings="SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in STATUS_TEXT.items()) + ") AS w(status, wording)",
)
register(
    "q04_top_operator_by_port",
    lambda t: R.top_operator_by_port(t, "Port NATION_19", "1996-01-01", "1998-12-31"),
    "SELECT OperatorName, count(*) AS TotalBookings FROM Booking JOIN sailing USING (VoyageID) JOIN route_end USING (RouteID) "
    "JOIN Port ON PortID = FirstPortID WHERE PortName = 'Port NATION_19' AND year(BookingDate) BETWEEN 1996 AND 1998 "
    "AND BookingStatus IN ('Confirmed', 'Completed') GROUP BY OperatorName ORDER BY 2 DESC, 1 LIMIT 1",
)
register(
    "q05_age_band_rollup",
    lambda t: R.age_band_rollup(t, "ASIA"),
    "SELECT CASE grouping(CategoryName) WHEN 1 THEN 'Grand Total' ELSE CategoryName END AS AgeCategory, "
    + ", ".join(
        f"count(*) FILTER (WHERE CategoryName = '{b}') AS {c}"
        for b, c in [("Infant", "Infants"), ("Child", "Children"), ("Teen", "Teens"), ("Adult", "Adults"), ("Senior", "Seniors")]
    )
    + ", count(*) AS TotalPassengers FROM BookingPassenger JOIN Booking USING (BookingID) JOIN sailing USING (VoyageID) "
    "JOIN AgeCategory USING (AgeCategoryID) WHERE OperatorName = 'ASIA' AND BookingStatus IN ('Confirmed', 'Completed') "
    "GROUP BY ROLLUP (CategoryName)",
)
register(
    "q06_top_multi_destination",
    lambda t: R.top_multi_destination(t),
    "SELECT OperatorName, a.PortName AS DeparturePort, z.PortName AS FinalArrivalPort, count(*) AS MultiDestinationVoyages "
    "FROM sailing JOIN CruiseRoute USING (RouteID) JOIN route_end USING (RouteID) JOIN Port a ON a.PortID = FirstPortID "
    "JOIN Port z ON z.PortID = LastPortID WHERE RouteType = 'Multi-destination' GROUP BY ALL ORDER BY 4 DESC, 1, 2, 3 LIMIT 1",
)
_VALUE_SQL = (
    "SELECT PassengerID, FullName, Nationality, TotalBookings, TotalFareSpend, TotalExcursionSpend, LifetimeValue, "
    "rank() OVER (ORDER BY LifetimeValue DESC) AS ValueRank FROM (SELECT PassengerID, TotalBookings, "
    f"{_dec('fare')} AS TotalFareSpend, {_dec('coalesce(extra, 0)')} AS TotalExcursionSpend, {_dec('fare + coalesce(extra, 0)')} AS LifetimeValue "
    "FROM spend) JOIN Passenger USING (PassengerID)"
)
_SOLD_TRIP = (
    "SELECT BookingPassengerID, PassengerID, Booking.BookingID, FinalFare FROM BookingPassenger JOIN Booking USING (BookingID) "
    "WHERE BookingStatus IN ('Confirmed', 'Completed')"
)
_EXTRA = "SELECT BookingPassengerID, AmountPaid FROM BookingExcursion WHERE ExcursionStatus IN ('Booked', 'Completed')"
register(
    "q07_passenger_lifetime_value",
    lambda t: R.passenger_lifetime_value(t),
    _VALUE_SQL,
    sold_trip=_SOLD_TRIP,
    extra_sale=_EXTRA,
    spend="SELECT PassengerID, count(DISTINCT BookingID) AS TotalBookings, sum(FinalFare) AS fare, sum(extra) AS extra FROM sold_trip "
    "LEFT JOIN (SELECT BookingPassengerID, sum(AmountPaid) AS extra FROM extra_sale GROUP BY 1) USING (BookingPassengerID) GROUP BY 1",
)
register(
    "q07_lifetime_value_as_written",
    lambda t: R.passenger_lifetime_value(t, as_written=True),
    _VALUE_SQL,
    sold_trip=_SOLD_TRIP,
    extra_sale=_EXTRA,
    spend="SELECT PassengerID, count(DISTINCT BookingID) AS TotalBookings, sum(FinalFare) AS fare, sum(AmountPaid) AS extra FROM sold_trip "
    "LEFT JOIN extra_sale USING (BookingPassengerID) GROUP BY 1",
)
_IN_FORCE = "EffectiveFrom <= DATE '{d}' AND coalesce(EffectiveTo, DATE '9999-12-31') >= DATE '{d}'"
register(
    "q08_discounted_fares",
    lambda t: R.discounted_fares(t, "Suite", FARE_DAY),
    f"SELECT ShipID AS ShipCode, BaseFare AS RegularFare, {_dec('round(BaseFare * 0.85, 2)', 12)} AS DiscountedFare FROM FareRule "
    "JOIN CruiseVoyage USING (VoyageID) JOIN CabinCategory c USING (CabinCategoryID) JOIN AgeCategory a USING (AgeCategoryID) "
    "WHERE c.CategoryName = 'Suite' AND a.CategoryName = 'Adult' AND " + _IN_FORCE.format(d=FARE_DAY),
)
register(
    "q09_sailings_to_port",
    lambda t: R.sailings_to_port(t, "Port NATION_3"),
    "SELECT VoyageID, ShipName, OperatorName, RouteName, RouteType, PortName AS DestinationPort, Country AS DestinationCountry, "
    "DepartureDateTime, ArrivalDateTime, VoyageLengthDays AS DurationDays, VoyageStatus FROM sailing JOIN CruiseRoute USING (RouteID), Port "
    "WHERE PortName = 'Port NATION_3' AND EXISTS (FROM RoutePort r WHERE r.RouteID = sailing.RouteID AND r.PortID = Port.PortID)",
)
register(
    "q10_specialty_dining",
    lambda t: R.specialty_dining(t, "Supplier#000000003"),
    "SELECT ShipName, TypeName AS SpecialtyDiningType, Description AS SpecialtyDescription FROM ShipSpecialtyDining "
    "JOIN CruiseShip USING (ShipID) JOIN SpecialtyDiningType USING (SpecialtyDiningTypeID) WHERE ShipName = 'Supplier#000000003'",
)
_DOCK = (
    "SELECT DISTINCT Country FROM sailing JOIN RoutePort USING (RouteID) JOIN Port USING (PortID) "
    "WHERE VoyageStatus IN ('Scheduled', 'Boarding', 'Departed')"
)
register("q11_dock_countries", lambda t: R.dock_countries(t, "ASIA"), _DOCK + " AND OperatorName = 'ASIA'")
register("q11_dock_countries_of_all", lambda t: R.dock_countries(t), _DOCK)
register(
    "q12_voyages_rollup",
    lambda t: R.voyages_rollup(t, SAILING_DAY),
    "SELECT CASE grouping(OperatorName) WHEN 1 THEN 'All Operators' ELSE OperatorName END AS CruiseOperator, count(*) AS TotalVoyages "
    f"FROM sailing WHERE CAST(DepartureDateTime AS DATE) = DATE '{SAILING_DAY}' GROUP BY ROLLUP (OperatorName)",
)
register(
    "q13_itinerary_excursions",
    lambda t: R.itinerary_excursions(t, "Supplier#000000003"),
    "SELECT ShipName, VoyageID, DepartureDateTime, PortName AS ExcursionPort, Country, StopSequence, ExcursionName, "
    "Description AS ExcursionDescription, DurationHours, Price AS ExcursionPrice, AvailableSlots FROM VoyageExcursion "
    "JOIN sailing USING (VoyageID) JOIN Excursion USING (ExcursionID) JOIN RoutePort USING (RoutePortID) "
    "JOIN Port ON Port.PortID = RoutePort.PortID WHERE ShipName = 'Supplier#000000003'",
)
register(
    "q14_occupancy",
    lambda t: R.occupancy(t),
    "SELECT VoyageID, ShipName, OperatorName, RouteType, DepartureDateTime, cabins AS TotalCabinsOnShip, taken AS BookedCabins, "
    f"cabins - taken AS AvailableCabins, {_pct('taken', 'cabins')} AS OccupancyRatePct FROM (SELECT VoyageID, count(*) AS cabins, "
    "count(sold.CabinID) AS taken FROM CruiseVoyage JOIN Cabin USING (ShipID) LEFT JOIN (SELECT DISTINCT VoyageID, CabinID FROM BookingCabin "
    "JOIN Booking USING (BookingID) WHERE BookingStatus IN ('Confirmed', 'Completed')) sold USING (VoyageID, CabinID) GROUP BY VoyageID) "
    "JOIN sailing USING (VoyageID) JOIN CruiseRoute USING (RouteID)",
)
register(
    "q15_duration_stats",
    lambda t: R.duration_stats(t, "Port NATION_3"),
    "SELECT min(VoyageLengthDays) AS MinimumDuration, max(VoyageLengthDays) AS MaximumDuration, "
    f"{_dec('round(avg(VoyageLengthDays), 2)')} AS AverageDuration FROM CruiseVoyage WHERE RouteID IN "
    "(SELECT RouteID FROM RoutePort JOIN Port USING (PortID) WHERE PortName = 'Port NATION_3')",
)
register(
    "q16_party_for_passenger",
    lambda t: R.party_for_passenger(t, 1),
    "SELECT DISTINCT DepartureDateTime AS DepartureDate, heads AS PassengersInParty, CategoryName AS CabinCategory FROM BookingPassenger p "
    "JOIN (SELECT BookingID, count(*) AS heads FROM BookingPassenger GROUP BY 1) USING (BookingID) JOIN Booking USING (BookingID) "
    "JOIN CruiseVoyage USING (VoyageID) JOIN BookingCabin k ON k.BookingCabinID = p.BookingCabinID JOIN Cabin USING (CabinID) "
    "JOIN CabinCategory USING (CabinCategoryID) WHERE PassengerID = 1",
)
register(
    "q17_unsold_excursions",
    lambda t: R.unsold_excursions(t),
    "SELECT ExcursionID, ExcursionName, PortName, Country, DurationHours, Price FROM Excursion JOIN Port USING (PortID) "
    "WHERE NOT EXISTS (FROM VoyageExcursion v JOIN extra_sale USING (VoyageExcursionID) WHERE v.ExcursionID = Excursion.ExcursionID)",
    extra_sale="SELECT VoyageExcursionID FROM BookingExcursion WHERE ExcursionStatus IN ('Booked', 'Completed')",
)
register(
    "q18_multi_destination_passengers",
    lambda t: R.multi_destination_passengers(t, "EUROPE", "2000-06-11"),
    "SELECT PassengerID, FullName, PassportNo, Nationality, ContactNo, Booking.BookingID, BookingDate, BookingStatus, OperatorName, "
    "RouteName AS Itinerary, DepartureDateTime FROM Booking JOIN BookingPassenger USING (BookingID) JOIN Passenger USING (PassengerID) "
    "JOIN sailing USING (VoyageID) JOIN CruiseRoute USING (RouteID) WHERE OperatorName = 'EUROPE' AND RouteType = 'Multi-destination' "
    "AND CAST(BookingDate AS DATE) = DATE '2000-06-11'",
)
register(
    "q19_wheelchair_rollup",
    lambda t: R.wheelchair_rollup(t, SAILING_DAY),
    "SELECT CASE grouping(OperatorName) WHEN 1 THEN 'All Operators' ELSE OperatorName END AS CruiseOperator, "
    "count(DISTINCT s.BookingPassengerID) AS WheelchairPassengers FROM PassengerSpecialService s JOIN SpecialService USING (ServiceID) "
    "JOIN BookingPassenger p ON p.BookingPassengerID = s.BookingPassengerID JOIN Booking USING (BookingID) JOIN sailing USING (VoyageID) "
    "WHERE ServiceType IN ('Accessibility', 'Mobility') AND RequestStatus IN ('Requested', 'Approved', 'Completed') "
    f"AND CAST(DepartureDateTime AS DATE) = DATE '{SAILING_DAY}' GROUP BY ROLLUP (OperatorName)",
)
register(
    "q20_chaperoned_youth",
    lambda t: R.chaperoned_youth(t, None, SAILING_DAY),
    f"SELECT PassengerID, FullName, DateOfBirth, {age_sql('DateOfBirth', 'DepartureDateTime')} AS AgeAtDeparture, Booking.BookingID, BookingDate, "
    "OperatorName, VoyageID, DepartureDateTime, DailySupervisionFee, VoyageLengthDays, "
    f"{_dec('DailySupervisionFee * VoyageLengthDays')} AS TotalSupervisionFee FROM BookingPassenger JOIN Booking USING (BookingID) "
    "JOIN sailing USING (VoyageID) JOIN Passenger USING (PassengerID) WHERE IsChaperonedYouth "
    f"AND CAST(DepartureDateTime AS DATE) = DATE '{SAILING_DAY}'",
)

# --- cancellations: rule, report and batch job ---------------------------------------------------

_PENALTY = (
    "SELECT {keys}, TotalAmount, OperatorID, hours AS HoursUntilDeparture, coalesce(kind, 'Percentage') AS PenaltyType, "
    "CAST(coalesce(val, 0) AS DECIMAL(10,2)) AS PenaltyValue, CAST(CASE WHEN kind = 'FullForfeit' AND hours <= 48 THEN TotalAmount "
    "WHEN kind = 'Percentage' THEN round(TotalAmount * (val * 0.01), 2) WHEN kind = 'FixedAmount' THEN least(val, TotalAmount) ELSE 0 END AS DECIMAL(12,2)) AS PenaltyAmount "
    "FROM (SELECT {keys}, TotalAmount, any_value(w.OperatorID) AS OperatorID, hours, arg_min(p.PenaltyType, HoursBeforeDeparture) AS kind, "
    "arg_min(p.PenaltyValue, HoursBeforeDeparture) AS val FROM {src} w LEFT JOIN CancellationPolicy p "
    "ON p.OperatorID = w.OperatorID AND p.HoursBeforeDeparture >= w.hours GROUP BY {keys}, TotalAmount, hours)"
)
_WAITING = (
    "SELECT BookingCancellation.*, TotalAmount, OperatorID, CAST(date_sub('hour', CancellationDateTime, DepartureDateTime) AS INT) AS hours "
    "FROM BookingCancellation JOIN Booking USING (BookingID) JOIN sailing USING (VoyageID)"
)


def _priced(t: StarTables) -> DataFrame:
    return X.cancellation_amounts(t, t["BookingCancellation"])


register(
    "r11_cancellation_penalty",
    lambda t: _priced(t).select(
        "CancellationID", "HoursUntilDeparture", "PenaltyType", "PenaltyValue", "PenaltyAmount", "RefundAmount"
    ),
    "SELECT CancellationID, HoursUntilDeparture, PenaltyType, PenaltyValue, PenaltyAmount, CAST(TotalAmount - PenaltyAmount AS DECIMAL(12,2)) AS RefundAmount FROM penalty",
    waiting=_WAITING,
    penalty=_PENALTY.format(keys="CancellationID", src="waiting"),
)
register(
    "q21_cancellation_impact",
    lambda t: R.cancellation_impact({**_needs(t, "Booking", "CruiseVoyage", "CruiseShip", "CruiseOperator"), "BookingCancellation": _priced(t)}),
    "SELECT OperatorName, count(*) AS TotalCancellations, "
    f"{_dec('sum(TotalAmount)')} AS TotalOriginalValue, {_dec('sum(PenaltyAmount)')} AS TotalPenaltiesRetained, "
    f"{_dec('sum(TotalAmount - PenaltyAmount)')} AS TotalRefundsIssued, {_pct('sum(PenaltyAmount)', 'sum(TotalAmount)')} AS PenaltyRetentionPct, "
    f"{_pct('sum(TotalAmount - PenaltyAmount)', 'sum(TotalAmount)')} AS RefundRatePct FROM penalty JOIN CruiseOperator USING (OperatorID) GROUP BY OperatorName",
    waiting=_WAITING,
    penalty=_PENALTY.format(keys="CancellationID", src="waiting"),
)


def _needs(t: StarTables, *names: str) -> dict[str, DataFrame]:
    return {n: t[n] for n in names}


_REVIEW = {
    "review": "SELECT r.*, b.TotalAmount, s.OperatorID, CAST(date_sub('hour', TIMESTAMP '{now}', s.DepartureDateTime) AS INT) AS hours, "
    "CASE WHEN b.BookingID IS NULL THEN 'Booking not found.' "
    "WHEN b.BookingStatus IN ('Cancelled', 'Completed') THEN 'This booking cannot be cancelled in its current status.' "
    "WHEN date_sub('hour', TIMESTAMP '{now}', s.DepartureDateTime) < 0 THEN 'Cannot cancel a voyage that has already departed.' "
    "WHEN row_number() OVER (PARTITION BY r.BookingID ORDER BY r.RequestID) > 1 THEN 'This booking cannot be cancelled in its current status.' "
    "END AS RejectReason FROM CancellationRequest r LEFT JOIN Booking b ON b.BookingID = r.BookingID LEFT JOIN sailing s ON s.VoyageID = b.VoyageID".format(now=NOW),
    "accepted": "SELECT * FROM review WHERE RejectReason IS NULL",
    "penalty": _PENALTY.format(keys="RequestID, BookingID", src="accepted"),
}


def _process(t: StarTables) -> P.Cancellations:
    return P.process_cancellations(t, t["CancellationRequest"], NOW)


register(
    "p3_cancellations_accepted",
    lambda t: _process(t).accepted.select("RequestID", "BookingID", "PenaltyAmount", "RefundAmount"),
    "SELECT RequestID, BookingID, PenaltyAmount, CAST(TotalAmount - PenaltyAmount AS DECIMAL(12,2)) AS RefundAmount FROM penalty",
    **_REVIEW,
)
register(
    "p3_cancellations_rejected",
    lambda t: _process(t).rejected,
    "SELECT RequestID, BookingID, Reason, ProcessedBy, RejectReason FROM review WHERE RejectReason IS NOT NULL",
    **_REVIEW,
)
register(
    "p3_booking_status_after",
    lambda t: _process(t).booking.select("BookingID", "BookingStatus"),
    "SELECT BookingID, CASE WHEN BookingID IN (SELECT BookingID FROM accepted) THEN 'Cancelled' ELSE BookingStatus END AS BookingStatus FROM Booking",
    **_REVIEW,
)
register(
    "r12_mark_cancelled",
    lambda t: X.mark_cancelled(t["Booking"], t["CancellationRequest"]).select("BookingID", "BookingStatus"),
    "SELECT BookingID, CASE WHEN EXISTS (FROM CancellationRequest r WHERE r.BookingID = Booking.BookingID) THEN 'Cancelled' ELSE BookingStatus END AS BookingStatus FROM Booking",
)

# --- parameterised reports and views -------------------------------------------------------------

register(
    "p1_voyage_revenue_summary",
    lambda t: P.voyage_revenue_summary(t, 7),
    f"SELECT ShipID AS ShipCode, OperatorName, RouteName, RouteType, DepartureDateTime, ArrivalDateTime, CabinCategoryCode, CategoryName AS CabinCategory, "
    f"CabinsSold, CategoryFareRevenue, {_dec('sum(CategoryFareRevenue) OVER ()')} AS TotalShipFareRevenue FROM (SELECT VoyageID, "
    f"CabinCategoryID AS CabinCategoryCode, count(DISTINCT BookingCabinID) AS CabinsSold, {_dec('sum(paid)')} AS CategoryFareRevenue "
    "FROM sold_seat WHERE VoyageID = 7 GROUP BY ALL) JOIN sailing USING (VoyageID) JOIN CruiseRoute USING (RouteID) "
    "JOIN CabinCategory ON CabinCategoryID = CabinCategoryCode",
    sold_seat=_SOLD_SEAT,
)
register(
    "p2_search_available_cabins",
    lambda t: P.search_available_cabins(t, 7, FARE_DAY),
    "SELECT CabinID, CabinNumber, DeckNumber, CategoryName AS CabinCategory, MaxOccupancy, IsWheelchairAccessible, "
    "CAST(coalesce(fare, 0) AS DECIMAL(12,2)) AS AdultBaseFare FROM Cabin JOIN CruiseVoyage USING (ShipID) JOIN CabinCategory USING (CabinCategoryID) "
    "LEFT JOIN (SELECT CabinCategoryID, arg_max(BaseFare, EffectiveFrom) AS fare FROM FareRule WHERE VoyageID = 7 AND AgeCategoryID = 4 AND "
    + _IN_FORCE.format(d=FARE_DAY)
    + " GROUP BY 1) USING (CabinCategoryID) WHERE VoyageID = 7 AND CabinID NOT IN (SELECT CabinID FROM held WHERE held.VoyageID = 7)",
)
register(
    "p4_passenger_bookings",
    lambda t: P.passenger_bookings(t, 1),
    "SELECT b.BookingID, BookingDate, BookingStatus, OperatorName, ShipName, RouteName, DepartureDateTime, ArrivalDateTime, CabinNumber, "
    "CategoryName AS CabinCategory, FinalFare AS FarePaid FROM BookingPassenger p JOIN Booking b ON b.BookingID = p.BookingID "
    "JOIN sailing USING (VoyageID) JOIN CruiseRoute USING (RouteID) JOIN BookingCabin k ON k.BookingCabinID = p.BookingCabinID "
    "JOIN Cabin USING (CabinID) JOIN CabinCategory USING (CabinCategoryID) WHERE PassengerID = 1",
)
register(
    "v1_booking_passenger_details",
    lambda t: V.booking_passenger_details(t),
    "SELECT b.BookingID, BookingDate, BookingStatus, VoyageID, RouteName, RouteType, ShipName, CabinNumber, c.CategoryName AS CabinCategory, "
    f"PassengerID, FullName, PassportNo, {age_sql('DateOfBirth', 'DepartureDateTime')} AS AgeAtDeparture, a.CategoryName AS AgeCategory, InfantBedOption, "
    "IsChaperonedYouth, FinalFare FROM BookingPassenger p JOIN Booking b ON b.BookingID = p.BookingID JOIN sailing USING (VoyageID) "
    "JOIN CruiseRoute USING (RouteID) JOIN BookingCabin k ON k.BookingCabinID = p.BookingCabinID JOIN Cabin USING (CabinID) "
    "JOIN CabinCategory c USING (CabinCategoryID) JOIN Passenger USING (PassengerID) JOIN AgeCategory a USING (AgeCategoryID)",
)
register(
    "v2_voyage_cabin_availability",
    lambda t: V.voyage_cabin_availability(t),
    "SELECT VoyageID, ShipName, RouteName, CabinID, CabinNumber, CategoryName AS CabinCategory, MaxOccupancy, "
    "CASE WHEN EXISTS (FROM held WHERE held.VoyageID = sailing.VoyageID AND held.CabinID = Cabin.CabinID) THEN 'Booked' ELSE 'Available' END AS AvailabilityStatus "
    "FROM sailing JOIN CruiseRoute USING (RouteID) JOIN Cabin USING (ShipID) JOIN CabinCategory USING (CabinCategoryID)",
)

# --- scalar functions ----------------------------------------------------------------------------

register(
    "f1_age",
    lambda t: t["Booking"]
    .join(t["Passenger"], F.col("CustomerPassengerID") == F.col("PassengerID"))
    .select("BookingID", age_on("DateOfBirth", "BookingDate").alias("Age")),
    f"SELECT BookingID, {age_sql('DateOfBirth', 'BookingDate')} AS Age FROM Booking JOIN Passenger ON PassengerID = CustomerPassengerID",
)
register(
    "f2_voyage_length",
    lambda t: t["CruiseVoyage"].select("VoyageID", voyage_length_days("DepartureDateTime", "ArrivalDateTime").alias("Days")),
    "SELECT VoyageID, CAST(date_diff('day', DepartureDateTime, ArrivalDateTime) AS INT) AS Days FROM CruiseVoyage",
)
register(
    "f3_hours_until",
    lambda t: t["Booking"]
    .join(t["CruiseVoyage"], "VoyageID")
    .select("BookingID", hours_until("BookingDate", "DepartureDateTime").alias("Hours")),
    "SELECT BookingID, CAST(date_sub('hour', BookingDate, DepartureDateTime) AS INT) AS Hours FROM Booking JOIN CruiseVoyage USING (VoyageID)",
)
register(
    "f4_date_of_timestamp",
    lambda t: t["BookingExcursion"].groupBy(as_date("BookingDateTime").alias("Day")).agg(F.count(F.lit(1)).alias("Sales")),
    "SELECT CAST(BookingDateTime AS DATE) AS Day, count(*) AS Sales FROM BookingExcursion GROUP BY 1",
)
register(
    "f5_case",
    lambda t: t["Booking"].select(
        "BookingID",
        map_text("BookingStatus", {k: v for k, v in STATUS_TEXT.items() if k != "Waitlisted"}, STATUS_TEXT_UNKNOWN).alias("Wording"),
        F.when(F.col("TotalAmount") > 250000, "large").otherwise("small").alias("SizeClass"),
    ),
    "SELECT BookingID, coalesce(wording, 'Status unknown') AS Wording, if(TotalAmount > 250000, 'large', 'small') AS SizeClass "
    "FROM Booking LEFT JOIN wordings ON status = BookingStatus",
    wordings="SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in STATUS_TEXT.items() if k != "Waitlisted") + ") AS w(status, wording)",
)
register(
    "f6_null_functions",
    lambda t: t["Booking"].select(
        "BookingID",
        F.coalesce("OriginalBookingID", "BookingID").alias("RootBooking"),
        F.nullif(F.col("BookingStatus"), F.lit("Completed")).alias("OpenStatus"),
        F.col("OriginalBookingID").isNull().alias("IsFirst"),
    ),
    "SELECT BookingID, coalesce(OriginalBookingID, BookingID) AS RootBooking, nullif(BookingStatus, 'Completed') AS OpenStatus, "
    "OriginalBookingID IS NULL AS IsFirst FROM Booking",
)
register(
    "f7_decimal_functions",
    lambda t: t["Payment"].select(
        "PaymentID",
        money(F.round(F.col("Amount") * F.expr("0.15BD"), 2)).alias("Share"),
        money(F.least(F.col("Amount"), F.expr("250000.00BD"))).alias("Capped"),
        zero_if_null(F.col("Amount") - F.least(F.col("Amount"), F.expr("250000.00BD"))).alias("Over"),
    ),
    f"SELECT PaymentID, {_dec('round(Amount * 0.15, 2)', 12)} AS Share, {_dec('least(Amount, 250000.00)', 12)} AS Capped, "
    f"{_dec('Amount - least(Amount, 250000.00)')} AS Over FROM Payment",
)
register(
    "f8_predicates",
    lambda t: t["Booking"]
    .filter(on_dates("BookingDate", "1996-03-01", "1997-02-28") & any_of("BookingStatus", SOLD) & (F.col("VoyageID") != 7))
    .join(t["CruiseVoyage"].filter(F.col("VoyageLengthDays").between(3, 9)).select("VoyageID"), "VoyageID", "left_semi")
    .join(t["PassengerSpecialService"].select((F.floor(F.col("BookingPassengerID") / 8)).cast("bigint").alias("BookingID")).distinct(), "BookingID", "left_anti")
    .select("BookingID", "VoyageID"),
    "SELECT BookingID, VoyageID FROM Booking WHERE CAST(BookingDate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1997-02-28' "
    "AND BookingStatus IN ('Confirmed', 'Completed') AND VoyageID <> 7 AND EXISTS (FROM CruiseVoyage v WHERE v.VoyageID = Booking.VoyageID "
    "AND v.VoyageLengthDays BETWEEN 3 AND 9) AND BookingID NOT IN (SELECT BookingPassengerID // 8 FROM PassengerSpecialService)",
)

# --- lookups -------------------------------------------------------------------------------------

register(
    "h1_route_endpoints",
    lambda t: H.route_endpoints(t["RoutePort"]),
    "SELECT RouteID, FirstPortID, LastPortID, Stops FROM route_end",
)


def _adult_seats(t: StarTables) -> DataFrame:
    adult = t["AgeCategory"].filter(F.col("CategoryName") == "Adult").select("AgeCategoryID")
    return (
        t["BookingCabin"]
        .select("BookingCabinID", "BookingID", "CabinID")
        .join(t["Booking"].select("BookingID", "VoyageID", as_date("BookingDate").alias("BookingDay")), "BookingID")
        .join(t["Cabin"].select("CabinID", "CabinCategoryID"), "CabinID")
        .withColumn("AgeCategoryID", adult.scalar())
    )


register(
    "h2_effective_rule",
    lambda t: H.effective_rule(
        _adult_seats(t), t["FareRule"], ["VoyageID", "CabinCategoryID", "AgeCategoryID"], "BookingDay", ["BaseFare", "FareRuleID"]
    ).select("BookingCabinID", "BookingDay", "BaseFare", "FareRuleID"),
    "SELECT BookingCabinID, BookingDay, BaseFare, FareRuleID FROM (SELECT BookingCabinID, CAST(BookingDate AS DATE) AS BookingDay, f.BaseFare, f.FareRuleID, "
    "row_number() OVER (PARTITION BY BookingCabinID ORDER BY f.EffectiveFrom DESC) AS place FROM BookingCabin JOIN Booking USING (BookingID) JOIN Cabin USING (CabinID) "
    "LEFT JOIN FareRule f ON f.VoyageID = Booking.VoyageID AND f.CabinCategoryID = Cabin.CabinCategoryID AND f.AgeCategoryID = 4 "
    "AND f.EffectiveFrom <= CAST(BookingDate AS DATE) AND (f.EffectiveTo IS NULL OR f.EffectiveTo >= CAST(BookingDate AS DATE))) WHERE place = 1",
)


def _ages(t: StarTables) -> DataFrame:
    return t["Passenger"].select("PassengerID", age_on("DateOfBirth", F.lit("2001-01-01")).alias("Age"))


_BAND_SQL = (
    "SELECT PassengerID, Age, CategoryName, MinAge, MaxAge FROM (SELECT PassengerID, "
    f"{age_sql('DateOfBirth', chr(39) + '2001-01-01' + chr(39))} AS Age FROM Passenger) "
    "LEFT JOIN AgeCategory ON Age >= MinAge AND (MaxAge IS NULL OR Age <= MaxAge)"
)
_BAND_COLUMNS = ("PassengerID", "Age", "CategoryName", "MinAge", "MaxAge")
register(
    "h3_band_lookup",
    lambda t: H.band_lookup(_ages(t), t["AgeCategory"], "Age", "MinAge", "MaxAge").select(*_BAND_COLUMNS),
    _BAND_SQL,
)
register(
    "h3_band_lookup_bucketed",
    lambda t: H.band_lookup(
        _ages(t), t["AgeCategory"], "Age", "MinAge", "MaxAge", bucket_width=16, max_broadcast_rows=0
    ).select(*_BAND_COLUMNS),
    _BAND_SQL,
)
register(
    "h3_meal_package",
    lambda t: t["VoyageMealPackage"],
    "SELECT VoyageMealPackageID, VoyageID, MealPackageRuleID FROM VoyageMealPackage",
)
register(
    "h4_threshold_policy",
    lambda t: H.threshold_policy(
        t["Booking"]
        .join(t["CruiseVoyage"].select("VoyageID", "ShipID", "DepartureDateTime"), "VoyageID")
        .join(t["CruiseShip"].select("ShipID", "OperatorID"), "ShipID")
        .select("BookingID", "OperatorID", hours_until("BookingDate", "DepartureDateTime").alias("Hours")),
        t["CancellationPolicy"],
        "Hours",
    ),
    "SELECT BookingID, OperatorID, Hours, coalesce(kind, 'Percentage') AS PenaltyType, CAST(coalesce(val, 0) AS DECIMAL(10,2)) AS PenaltyValue FROM ("
    "SELECT BookingID, w.OperatorID, Hours, p.PenaltyType AS kind, p.PenaltyValue AS val, row_number() OVER (PARTITION BY BookingID ORDER BY HoursBeforeDeparture) AS place "
    "FROM (SELECT BookingID, OperatorID, CAST(date_sub('hour', BookingDate, DepartureDateTime) AS INT) AS Hours FROM Booking JOIN sailing USING (VoyageID)) w "
    "LEFT JOIN CancellationPolicy p ON p.OperatorID = w.OperatorID AND p.HoursBeforeDeparture >= Hours) WHERE place = 1",
)


def _adult_cabins(t: StarTables) -> DataFrame:
    adults = t["BookingPassenger"].join(t["AgeCategory"].filter("MinAge >= 18").select("AgeCategoryID"), "AgeCategoryID")
    held = t["Booking"].filter(any_of("BookingStatus", HOLDING)).select("BookingID", "VoyageID")
    cabins = t["BookingCabin"].select("BookingCabinID", "BookingID", "CabinID").join(held, "BookingID")
    return adults.select("BookingCabinID").distinct().join(cabins, "BookingCabinID").select("VoyageID", "CabinID")


register(
    "h5_guardian_nearby",
    lambda t: H.guardian_nearby(_adult_cabins(t), t["CabinAdjacency"]),
    "SELECT DISTINCT VoyageID, a.CabinID FROM CabinAdjacency a JOIN BookingCabin k ON k.CabinID = a.AdjacentCabinID JOIN Booking USING (BookingID) "
    "WHERE BookingStatus IN ('Pending', 'Confirmed') AND EXISTS (FROM BookingPassenger p WHERE p.BookingCabinID = k.BookingCabinID AND p.AgeCategoryID >= 4)",
)

# --- rules ---------------------------------------------------------------------------------------


def _texts(df: DataFrame) -> DataFrame:
    return df.withColumn("violations", F.concat_ws("; ", "violations"))


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SPOTS = {
    "spot": "SELECT BookingCabinID, BookingCabin.BookingID, BookingCabin.CabinID, VoyageID, BookingStatus, BookingStatus IN ('Pending', 'Confirmed') AS holds, "
    "v.ShipID <> Cabin.ShipID AS misplaced FROM BookingCabin JOIN Booking USING (BookingID) JOIN CruiseVoyage v USING (VoyageID) JOIN Cabin ON Cabin.CabinID = BookingCabin.CabinID",
    "spot_checked": "SELECT s.*, holds AND EXISTS (FROM spot o WHERE o.VoyageID = s.VoyageID AND o.CabinID = s.CabinID AND o.holds AND NOT o.misplaced "
    "AND o.BookingCabinID < s.BookingCabinID) AS twice FROM spot s",
}
register(
    "r01_r02_booking_cabins",
    lambda t: _texts(X.check_booking_cabins(t)),
    f"SELECT BookingCabinID, BookingID, CabinID, VoyageID, BookingStatus, concat_ws('; ', CASE WHEN misplaced THEN {_q(X.WRONG_SHIP)} END, "
    f"CASE WHEN twice THEN {_q(X.DOUBLE_BOOKED)} END) AS violations, CASE WHEN misplaced THEN {_q(X.WRONG_SHIP)} WHEN twice THEN {_q(X.DOUBLE_BOOKED)} END AS first_violation FROM spot_checked",
    **_SPOTS,
)
for _name, _text, _flag in (("r01_cabin_on_ship", X.WRONG_SHIP, "misplaced"), ("r02_double_booking", X.DOUBLE_BOOKED, "twice")):
    register(
        _name,
        lambda t, text=_text: X.check_booking_cabins(t).filter(F.array_contains("violations", text)).select("BookingCabinID", "VoyageID", "CabinID"),
        f"SELECT BookingCabinID, VoyageID, CabinID FROM spot_checked WHERE {_flag}",
        **_SPOTS,
    )

_PERSON = {
    "berth": "SELECT BookingCabinID, BookingCabin.BookingID AS cabin_booking, CabinID, least(MaxOccupancy, 5) AS cap, CabinCategoryID, VoyageID, "
    "CAST(BookingDate AS DATE) AS day, BookingStatus IN ('Pending', 'Confirmed') AS holds, DepartureDateTime, AllowsChaperonedYouth "
    "FROM BookingCabin JOIN Booking USING (BookingID) JOIN Cabin USING (CabinID) JOIN sailing USING (VoyageID)",
    "berth_price": "SELECT BookingCabinID, AgeCategoryID, arg_max(BaseFare, EffectiveFrom) AS fare, arg_max(FareRuleID, EffectiveFrom) AS rule FROM berth "
    "JOIN FareRule USING (VoyageID, CabinCategoryID) WHERE EffectiveFrom <= day AND coalesce(EffectiveTo, day) >= day GROUP BY ALL",
    "traveller": "SELECT p.BookingPassengerID, p.BookingID, p.BookingCabinID, p.PassengerID, p.AgeCategoryID, InfantBedOption AS bed, IsChaperonedYouth AS youth, "
    f"cap, VoyageID, CabinID, holds, CategoryName AS band, MinAge >= 18 AS adult, {age_sql('DateOfBirth', 'DepartureDateTime')} AS age, MinAge, coalesce(MaxAge, 999) AS top, "
    "AllowsChaperonedYouth AS allowed, cabin_booking <> p.BookingID AS astray, own.fare AS own_fare, own.rule AS own_rule, a.fare AS adult_fare, c.fare AS child_fare "
    "FROM BookingPassenger p JOIN berth USING (BookingCabinID) JOIN Passenger USING (PassengerID) JOIN AgeCategory g ON g.AgeCategoryID = p.AgeCategoryID "
    "LEFT JOIN berth_price own ON own.BookingCabinID = p.BookingCabinID AND own.AgeCategoryID = p.AgeCategoryID "
    "LEFT JOIN berth_price a ON a.BookingCabinID = p.BookingCabinID AND a.AgeCategoryID = 4 LEFT JOIN berth_price c ON c.BookingCabinID = p.BookingCabinID AND c.AgeCategoryID = 2",
    "flagged": "SELECT *, age < MinAge OR age > top AS bad_band, band = 'Infant' AND bed = 'NotApplicable' AS no_bed, band <> 'Infant' AND bed <> 'NotApplicable' AS odd_bed, "
    "youth AND NOT (allowed AND band = 'Teen' AND age BETWEEN 15 AND 17) AS refused, age <= 17 AND NOT youth AS minor, "
    "band = 'Infant' AND adult_fare IS NULL AS no_adult, band = 'Infant' AND child_fare IS NULL AS no_child, band <> 'Infant' AND own_fare IS NULL AS no_own FROM traveller",
    "ranked": "SELECT *, NOT (astray OR bad_band OR no_bed OR odd_bed OR refused OR no_adult OR no_child OR no_own) AS sound FROM flagged",
    "placed": "SELECT *, sound AND row_number() OVER (PARTITION BY BookingCabinID, sound ORDER BY BookingPassengerID) <= cap AS stays FROM ranked",
    "adult_spot": "SELECT DISTINCT BookingCabinID, VoyageID, CabinID, holds FROM placed WHERE stays AND adult",
    "judged": "SELECT *, coalesce(sum(CAST(stays AS INT)) OVER (PARTITION BY BookingCabinID ORDER BY BookingPassengerID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= cap AS crowded, "
    "minor AND NOT EXISTS (FROM adult_spot s WHERE s.BookingCabinID = placed.BookingCabinID) AND NOT EXISTS (FROM adult_spot s JOIN CabinAdjacency n ON n.AdjacentCabinID = s.CabinID "
    "WHERE s.holds AND s.VoyageID = placed.VoyageID AND n.CabinID = placed.CabinID) AS alone FROM placed",
}
_PERSON_CHECKS = [
    ("astray", X.WRONG_BOOKING),
    ("NOT astray AND crowded", X.CABIN_FULL),
    ("NOT astray AND bad_band", X.WRONG_AGE_BAND),
    ("NOT astray AND no_bed", X.INFANT_NEEDS_BED),
    ("NOT astray AND odd_bed", X.BED_NOT_ALLOWED),
    ("NOT astray AND refused", X.YOUTH_NOT_ALLOWED),
    ("NOT astray AND alone", X.NO_GUARDIAN),
    ("NOT astray AND no_adult", X.NO_ADULT_FARE),
    ("NOT astray AND no_child", X.NO_CHILD_FARE),
    ("NOT astray AND no_own", X.NO_FARE),
]
_FARE_SQL = (
    "CAST(CASE WHEN astray OR no_adult OR no_child THEN NULL WHEN band = 'Infant' AND bed = 'SharedBed' THEN round(adult_fare * 0.15, 2) "
    "WHEN band = 'Infant' THEN round(child_fare * 0.50, 2) ELSE own_fare END AS DECIMAL(12,2))"
)
_FEE_SQL = "CASE WHEN astray THEN NULL ELSE CAST(CASE WHEN youth THEN (SELECT max(Fee) FROM SpecialService WHERE ServiceType = 'Chaperoned Youth') ELSE 0 END AS DECIMAL(10,2)) END"
_RULE_SQL = "CASE WHEN astray OR band = 'Infant' THEN NULL ELSE own_rule END"
register(
    "r03_r10_booking_passengers",
    lambda t: _texts(X.check_booking_passengers(t)),
    "SELECT BookingPassengerID, BookingID, BookingCabinID, PassengerID, AgeCategoryID, bed AS InfantBedOption, youth AS IsChaperonedYouth, age AS AgeAtDeparture, "
    f"{_RULE_SQL} AS FareRuleID, {_FEE_SQL} AS DailySupervisionFee, {_FARE_SQL} AS FinalFare, concat_ws('; ', "
    + ", ".join(f"CASE WHEN {c} THEN {_q(x)} END" for c, x in _PERSON_CHECKS)
    + ") AS violations, CASE "
    + " ".join(f"WHEN {c} THEN {_q(x)}" for c, x in _PERSON_CHECKS)
    + " END AS first_violation FROM judged",
    **_PERSON,
)


def _unpriced(t: StarTables) -> DataFrame:
    return X.check_passenger_rows(t, fares=False)


def _rejected_for(check: Callable[[StarTables], DataFrame], *texts: str) -> Callable[[StarTables], DataFrame]:
    def run(t: StarTables) -> DataFrame:
        hit = reduce(lambda a, b: a | b, [F.array_contains("violations", x) for x in texts])
        return check(t).filter(hit).select("BookingPassengerID", "BookingCabinID", "AgeAtDeparture")

    return run


for _name, _check, _texts_, _cond in (
    ("r03_cabin_of_booking", X.check_passenger_rows, (X.WRONG_BOOKING,), "astray"),
    ("r04_cabin_capacity", X.check_booking_passengers, (X.CABIN_FULL,), "NOT astray AND crowded"),
    ("r05_age_band", _unpriced, (X.WRONG_AGE_BAND,), "NOT astray AND bad_band"),
    ("r06_infant_bed", _unpriced, (X.INFANT_NEEDS_BED, X.BED_NOT_ALLOWED), "NOT astray AND (no_bed OR odd_bed)"),
    ("r07_chaperoned_youth", _unpriced, (X.YOUTH_NOT_ALLOWED,), "NOT astray AND refused"),
    ("r08_guardian", X.check_booking_passengers, (X.NO_GUARDIAN,), "NOT astray AND alone"),
):
    register(
        _name,
        _rejected_for(_check, *_texts_),
        f"SELECT BookingPassengerID, BookingCabinID, age AS AgeAtDeparture FROM judged WHERE {_cond}",
        **_PERSON,
    )
# Of all seats those under 35,000 are stored and those from 25,000 on are handed in: what lies between is changed.
_BATCH = _PERSON | {
    "mixed_seats": "SELECT r.*, FinalFare < 25000 AS kept FROM ranked r JOIN BookingPassenger USING (BookingPassengerID)",
    "held_seats": "SELECT BookingCabinID, count(*) AS held FROM mixed_seats WHERE kept GROUP BY 1",
    "new_seats": "SELECT m.*, coalesce(h.held, 0) AS held, sound AND row_number() OVER (PARTITION BY m.BookingCabinID, sound ORDER BY BookingPassengerID) <= cap - coalesce(h.held, 0) AS stays "
    "FROM mixed_seats m LEFT JOIN held_seats h USING (BookingCabinID) WHERE NOT kept",
    "adult_seats": "SELECT BookingCabinID, VoyageID, CabinID, holds FROM new_seats WHERE stays AND adult UNION SELECT BookingCabinID, VoyageID, CabinID, holds FROM mixed_seats WHERE kept AND adult",
    "judged_seats": "SELECT *, held + coalesce(sum(CAST(stays AS INT)) OVER (PARTITION BY BookingCabinID ORDER BY BookingPassengerID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= cap AS crowded, "
    "minor AND NOT EXISTS (FROM adult_seats g WHERE g.BookingCabinID = new_seats.BookingCabinID) AND NOT EXISTS (FROM adult_seats g JOIN CabinAdjacency n ON n.AdjacentCabinID = g.CabinID "
    "WHERE g.holds AND g.VoyageID = new_seats.VoyageID AND n.CabinID = new_seats.CabinID) AS alone FROM new_seats",
}


def _check_batch(t: StarTables) -> DataFrame:
    seats = t["BookingPassenger"]
    return X.check_booking_passengers(_with(t, BookingPassenger=seats.filter("FinalFare < 35000")), seats.filter("FinalFare >= 25000"))


for _name, _text, _cond in (("r04_capacity_batch", X.CABIN_FULL, "NOT astray AND crowded"), ("r08_guardian_batch", X.NO_GUARDIAN, "NOT astray AND alone")):
    register(
        _name,
        _rejected_for(_check_batch, _text),
        f"SELECT BookingPassengerID, BookingCabinID, age AS AgeAtDeparture FROM judged_seats WHERE {_cond}",
        **_BATCH,
    )
register(
    "r09_supervision_fee",
    lambda t: t["BookingPassenger"].filter("IsChaperonedYouth").select("BookingPassengerID", X.supervision_fee(t).alias("DailySupervisionFee")),
    "SELECT BookingPassengerID, (SELECT max(Fee) FROM SpecialService WHERE ServiceType = 'Chaperoned Youth') AS DailySupervisionFee "
    "FROM BookingPassenger WHERE IsChaperonedYouth",
)
register(
    "r10_final_fare",
    lambda t: X.check_booking_passengers(t).filter(F.col("first_violation").isNull()).select("BookingPassengerID", "FareRuleID", "FinalFare"),
    f"SELECT BookingPassengerID, {_RULE_SQL} AS FareRuleID, {_FARE_SQL} AS FinalFare FROM judged WHERE stays AND NOT alone",
    **_PERSON,
)
register(
    "r13_booking_total",
    lambda t: X.booking_totals(t).select("BookingID", "TotalAmount"),
    "SELECT BookingID, CAST(coalesce(paid, 0) AS DECIMAL(12,2)) AS TotalAmount FROM Booking LEFT JOIN "
    "(SELECT BookingID, sum(FinalFare) AS paid FROM BookingPassenger GROUP BY 1) USING (BookingID)",
)
register(
    "r14_baggage_limit",
    lambda t: X.check_baggage(t),
    "SELECT BaggageID, BookingPassengerID, WeightKG, WeightKG > BaggageWeightLimitKG AS IsOverLimit, ExcessFee FROM BookingBaggage "
    "JOIN BookingPassenger USING (BookingPassengerID) JOIN Booking USING (BookingID) JOIN CruiseVoyage USING (VoyageID)",
)
register(
    "r15_service_fee_snapshot",
    lambda t: _texts(X.snapshot_service_fees(t)),
    "SELECT PassengerServiceID, BookingPassengerID, ServiceID, RequestStatus, c.Fee, CASE WHEN c.Fee IS NULL THEN "
    f"{_q(X.UNKNOWN_SERVICE)} ELSE '' END AS violations, CASE WHEN c.Fee IS NULL THEN {_q(X.UNKNOWN_SERVICE)} END AS first_violation "
    "FROM PassengerSpecialService LEFT JOIN SpecialService c USING (ServiceID)",
)
_LATE = f"CASE WHEN RequestDateTime >= s.DepartureDateTime THEN {_q(X.ALREADY_DEPARTED)} END"
_FAR = f"CASE WHEN n.DepartureDateTime > BookingDate + INTERVAL 1 YEAR THEN {_q(X.BEYOND_ONE_YEAR)} END"
register(
    "r16_reschedule",
    lambda t: _texts(X.check_reschedules(t)).select(
        "RescheduleID", "OriginalBookingID", "NewVoyageID", "HoursUntilDeparture", "RescheduleFee", "violations", "first_violation"
    ),
    "SELECT RescheduleID, q.OriginalBookingID, NewVoyageID, CAST(date_sub('hour', RequestDateTime, s.DepartureDateTime) AS INT) AS HoursUntilDeparture, "
    f"CAST(CASE WHEN date_sub('hour', RequestDateTime, s.DepartureDateTime) <= 48 THEN TotalAmount ELSE 0 END AS DECIMAL(12,2)) AS RescheduleFee, "
    f"concat_ws('; ', {_LATE}, {_FAR}) AS violations, coalesce({_LATE}, {_FAR}) AS first_violation FROM RescheduleRequest q "
    "JOIN Booking b ON b.BookingID = q.OriginalBookingID JOIN CruiseVoyage s ON s.VoyageID = b.VoyageID JOIN CruiseVoyage n ON n.VoyageID = NewVoyageID",
)
_NO_OLD = f"CASE WHEN s.VoyageID IS NULL THEN {_q(X.UNKNOWN_BOOKING)} END"
_NO_NEW = f"CASE WHEN n.VoyageID IS NULL THEN {_q(X.UNKNOWN_NEW_VOYAGE)} END"
register(
    "r16_reschedule_unknown",
    lambda t: _texts(
        X.check_reschedules(
            _with(
                t,
                RescheduleRequest=t["RescheduleRequest"].withColumns(
                    {"OriginalBookingID": F.col("OriginalBookingID") * 2, "NewVoyageID": F.col("NewVoyageID") * 3}
                ),
            )
        )
    ).select("RescheduleID", "HoursUntilDeparture", "RescheduleFee", "violations", "first_violation"),
    "SELECT RescheduleID, CAST(date_sub('hour', RequestDateTime, s.DepartureDateTime) AS INT) AS HoursUntilDeparture, "
    "CAST(CASE WHEN s.VoyageID IS NULL OR n.VoyageID IS NULL THEN NULL WHEN date_sub('hour', RequestDateTime, s.DepartureDateTime) <= 48 THEN TotalAmount ELSE 0 END AS DECIMAL(12,2)) AS RescheduleFee, "
    f"concat_ws('; ', {_NO_OLD}, {_NO_NEW}, {_LATE}, {_FAR}) AS violations, coalesce({_NO_OLD}, {_NO_NEW}, {_LATE}, {_FAR}) AS first_violation FROM RescheduleRequest q "
    "LEFT JOIN Booking b ON b.BookingID = 2 * q.OriginalBookingID LEFT JOIN CruiseVoyage s ON s.VoyageID = b.VoyageID LEFT JOIN CruiseVoyage n ON n.VoyageID = 3 * q.NewVoyageID",
)
register(
    "r17_birth_date",
    lambda t: _texts(X.check_birth_dates(t, "2001-01-01")).select("PassengerID", "DateOfBirth", "violations"),
    f"SELECT PassengerID, DateOfBirth, CASE WHEN DateOfBirth > DATE '2001-01-01' THEN {_q(X.FUTURE_BIRTH)} ELSE '' END AS violations FROM Passenger",
)

# --- audits --------------------------------------------------------------------------------------


def _audit_sql(name: str, table: str, key: str, detail: str, rest: str) -> str:
    return f"SELECT '{name}' AS \"constraint\", '{table}' AS \"table\", {key} AS \"key\", {detail} AS detail {rest}"


def _unique_sql(constraints: list[K.Unique]) -> str:
    parts = []
    for c in constraints:
        cols = ", ".join(c.columns)
        key = " || '|' || ".join(f"CAST({x} AS VARCHAR)" for x in c.columns)
        known = " AND ".join(f"{x} IS NOT NULL" for x in c.columns)
        parts.append(
            _audit_sql(c.name, c.table, key, "count(*) || ' rows'", f"FROM {c.table} WHERE {known} GROUP BY {cols} HAVING count(*) > 1")
        )
    return "\nUNION ALL ".join(parts)


def _reference_sql(references: list[K.Reference]) -> str:
    return "\nUNION ALL ".join(
        _audit_sql(
            r.name,
            r.table,
            f"CAST(x.{r.column} AS VARCHAR)",
            "count(*) || ' rows'",
            f"FROM {r.table} x WHERE x.{r.column} IS NOT NULL AND NOT EXISTS (FROM {r.parent} y WHERE y.{r.parent_column} = x.{r.column}) GROUP BY x.{r.column}",
        )
        for r in references
    )


def _check_sql(checks: list[K.RowCheck]) -> str:
    return "\nUNION ALL ".join(
        _audit_sql(
            c.name,
            c.table,
            f"CAST({K.key_of(c.table)} AS VARCHAR)",
            _q(c.condition),
            f"FROM {c.table} WHERE NOT ({c.condition.replace('char_length', 'length')})",
        )
        for c in checks
    )


def _required(table: str) -> list[str]:
    return [part.split()[0] for part in TABLES[table].split(", ") if part.endswith("not null")]


register("c1_primary_keys", lambda t: A.audit_unique(t, K.primary_keys()), _unique_sql(K.primary_keys()))
register("c2_references", lambda t: A.audit_references(t, K.REFERENCES), _reference_sql(K.REFERENCES))
register("c3_declared_checks", lambda t: A.audit_rows(t, K.DECLARED_CHECKS), _check_sql(K.DECLARED_CHECKS))
register("c3b_documented_checks", lambda t: A.audit_rows(t, K.DOCUMENTED_CHECKS), _check_sql(K.DOCUMENTED_CHECKS))
register("c3_text_widths", lambda t: A.audit_rows(t, K.width_checks()), _check_sql(K.width_checks()))
register("c4_unique_keys", lambda t: A.audit_unique(t, K.UNIQUES), _unique_sql(K.UNIQUES))
register(
    "c5_not_null",
    lambda t: A.audit_not_null(t, TABLES),
    "\nUNION ALL ".join(
        _audit_sql(f"NN_{table}_{c}", table, f"CAST({K.key_of(table)} AS VARCHAR)", f"'{c}'", f"FROM {table} WHERE {c} IS NULL")
        for table in TABLES
        for c in _required(table)
    ),
)
register(
    "c6_default_fill",
    lambda t: A.fill_defaults(t["PassengerSpecialService"], "PassengerSpecialService", NOW),
    "SELECT PassengerServiceID, BookingPassengerID, ServiceID, coalesce(RequestStatus, 'Requested') AS RequestStatus, "
    "coalesce(Fee, CAST(0 AS DECIMAL(10,2))) AS Fee FROM PassengerSpecialService",
)
register(
    "c7_symmetric_adjacency",
    lambda t: A.audit_symmetric(t["CabinAdjacency"]),
    "SELECT 'SYM_CabinAdjacency' AS \"constraint\", 'CabinAdjacency' AS \"table\", a.CabinID || '|' || a.AdjacentCabinID AS \"key\", count(*) || ' rows' AS detail "
    "FROM CabinAdjacency a WHERE NOT EXISTS (FROM CabinAdjacency b WHERE b.CabinID = a.AdjacentCabinID AND b.AdjacentCabinID = a.CabinID) "
    "GROUP BY a.CabinID, a.AdjacentCabinID",
)

# The derived tables keep these constraints, so they are also checked on columns that break them.
register(
    "c1_repeated_keys",
    lambda t: A.audit_unique(_with(t, Payment=t["Payment"].withColumn("PaymentID", F.expr("PaymentID div 3"))), K.primary_keys(["Payment"])),
    _audit_sql("PK_Payment", "Payment", "CAST(k AS VARCHAR)", "count(*) || ' rows'", "FROM (SELECT PaymentID // 3 AS k FROM Payment) GROUP BY k HAVING count(*) > 1"),
)
register(
    "c3_too_many_berths",
    lambda t: A.audit_rows(
        _with(t, Cabin=t["Cabin"].withColumn("MaxOccupancy", F.expr("MaxOccupancy * 2 - 2"))), [c for c in K.DECLARED_CHECKS if c.table == "Cabin"]
    ),
    _audit_sql("CK_Cabin_MaxOccupancy", "Cabin", "CAST(CabinID AS VARCHAR)", "'MaxOccupancy BETWEEN 1 AND 5'", "FROM Cabin WHERE MaxOccupancy IN (1, 4, 5)"),
)
register(
    "c3_wide_texts",
    lambda t: A.audit_rows(
        _with(t, Cabin=t["Cabin"].withColumn("CabinNumber", F.expr("repeat(CabinNumber, MaxOccupancy)"))), [c for c in K.width_checks() if c.table == "Cabin"]
    ),
    _audit_sql("LEN_Cabin_CabinNumber", "Cabin", "CAST(CabinID AS VARCHAR)", "'char_length(CabinNumber) <= 20'", "FROM Cabin WHERE length(CabinNumber) * MaxOccupancy > 20"),
)

# --- sources -------------------------------------------------------------------------------------

_ALL_TABLES = sorted([*BUILDERS, *VALUES])
register(
    "s1_table_counts",
    lambda t: union_all([t[n].agg(F.lit(n).alias("TableName"), F.count(F.lit(1)).alias("RowCount")) for n in _ALL_TABLES]),
    "\nUNION ALL ".join(f"SELECT '{n}' AS TableName, count(*) AS RowCount FROM {n}" for n in _ALL_TABLES),
)


# --- what the model declares: chains, slots, periods, the waiting list, payments -----------------

# Some bookings are made to replace each other, so that there are circles.
_CIRCLED = (
    "CASE WHEN BookingID % 1000 = 7 THEN BookingID + 1 WHEN BookingID % 1000 = 8 THEN BookingID - 1 ELSE OriginalBookingID END"
)
register(
    "w1_reschedule_chains",
    lambda t: chains.reschedule_chains(_with(t, Booking=t["Booking"].withColumn("OriginalBookingID", F.expr(_CIRCLED)))).drop("violations"),
    "SELECT BookingID, OriginalBookingID, RootBookingID, Depth, CASE WHEN RootBookingID IS NOT NULL THEN first_value(BookingID) OVER "
    "(PARTITION BY RootBookingID ORDER BY Depth DESC, BookingDate DESC, BookingID DESC) END AS LatestBookingID, first_violation FROM "
    "(SELECT c.BookingID, c.OriginalBookingID, c.BookingDate, CASE WHEN hops < 200 THEN last_one END AS RootBookingID, CAST(CASE WHEN hops < 200 THEN hops END AS BIGINT) AS Depth, "
    f"CASE WHEN hops >= 200 THEN '{chains.CIRCULAR}' WHEN hops = 0 AND c.OriginalBookingID IS NOT NULL THEN '{chains.UNKNOWN_ORIGINAL}' END AS first_violation "
    "FROM circled c JOIN chain_ends USING (BookingID))",
    circled=f"SELECT BookingID, BookingDate, {_CIRCLED} AS OriginalBookingID FROM Booking",
    replaced="SELECT a.BookingID AS newer, a.OriginalBookingID AS older FROM circled a JOIN circled b ON b.BookingID = a.OriginalBookingID",
    chain_ends="WITH RECURSIVE walk(BookingID, place, hops) AS (SELECT BookingID, BookingID, 0 FROM circled UNION ALL "
    "SELECT walk.BookingID, older, hops + 1 FROM walk JOIN replaced ON newer = place WHERE hops < 200) "
    "SELECT BookingID, max(hops) AS hops, arg_max(place, hops) AS last_one FROM walk GROUP BY BookingID",
)

_SLOTS_SQL = (
    "SELECT BookingExcursionID, VoyageExcursionID, ExcursionStatus, SalePlace, AvailableSlots, "
    f"CASE WHEN AvailableSlots IS NULL THEN '{capacity.UNKNOWN_OFFER}' WHEN SalePlace > AvailableSlots THEN '{capacity.NO_SLOT}' END AS first_violation "
    "FROM {sales} LEFT JOIN (SELECT BookingExcursionID, row_number() OVER (PARTITION BY VoyageExcursionID ORDER BY BookingDateTime, BookingExcursionID) AS SalePlace "
    "FROM {sales} WHERE ExcursionStatus IN ('Booked', 'Completed')) USING (BookingExcursionID) "
    "LEFT JOIN (SELECT VoyageExcursionID, AvailableSlots FROM VoyageExcursion) USING (VoyageExcursionID)"
)
_SLOT_COLUMNS = ("BookingExcursionID", "VoyageExcursionID", "ExcursionStatus", "SalePlace", "AvailableSlots", "first_violation")
# A third of all sales goes to one offer, some to an offer that does not exist.
_BUSY = "CASE WHEN BookingExcursionID % 3 = 0 THEN 0 WHEN BookingExcursionID % 100 = 1 THEN -1 ELSE VoyageExcursionID END"
register("w2_excursion_slots", lambda t: capacity.check_excursion_slots(t).select(*_SLOT_COLUMNS), _SLOTS_SQL.format(sales="BookingExcursion"))
register(
    "w2_slots_of_a_busy_offer",
    lambda t: capacity.check_excursion_slots(
        _with(t, BookingExcursion=t["BookingExcursion"].withColumn("VoyageExcursionID", F.expr(_BUSY)))
    ).select(*_SLOT_COLUMNS),
    _SLOTS_SQL.format(sales="busy"),
    busy=f"SELECT BookingExcursionID, {_BUSY} AS VoyageExcursionID, ExcursionStatus, BookingDateTime FROM BookingExcursion",
)

_OVERLAP_SQL = (
    "SELECT {keys}, {id}, {start}, {end}, -reach.i AS Overlaps{id} FROM (SELECT *, max(struct_pack(e := coalesce({end}, {never}), i := -{id})) OVER "
    "(PARTITION BY {keys} ORDER BY {start}, {id} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {rows}) WHERE {start} {op} reach.e"
)
_DATED = {"start": "EffectiveFrom", "end": "EffectiveTo", "never": "DATE '9999-12-31'", "op": "<="}
register(
    "w3_overlapping_fares",
    intervals.overlapping_fares,
    _OVERLAP_SQL.format(keys="VoyageID, CabinCategoryID, AgeCategoryID", id="FareRuleID", rows="FareRule", **_DATED),
)
# Many short-lived rules, a third of them of one operator.
_RULES = ("o_orderkey AS BaggageRuleID", "CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 997 END AS OperatorID", "CAST(20 + o_custkey % 9 AS DECIMAL(6,2)) AS MaxWeightKG")
register(
    "w3_overlapping_baggage_rules",
    lambda t: intervals.overlapping_baggage_rules(
        _with(
            t,
            BaggageRule=t.source("orders").selectExpr(
                *_RULES,
                "CAST(o_orderdate AS DATE) AS EffectiveFrom",
                "CASE WHEN o_orderkey % 500 <> 1 THEN date_add(CAST(o_orderdate AS DATE), int(o_custkey % 90)) END AS EffectiveTo",
            ),
        )
    ),
    _OVERLAP_SQL.format(keys="OperatorID", id="BaggageRuleID", rows="short_rules", **_DATED),
    short_rules=f"SELECT {', '.join(_RULES)}, CAST(o_orderdate AS DATE) AS EffectiveFrom, "
    "CASE WHEN o_orderkey % 500 <> 1 THEN CAST(o_orderdate AS DATE) + CAST(o_custkey % 90 AS INT) END AS EffectiveTo FROM orders",
)
# A third of the voyages take two months longer.
register(
    "w3_overlapping_voyages",
    lambda t: intervals.overlapping_voyages(
        _with(
            t,
            CruiseVoyage=t["CruiseVoyage"].withColumn(
                "ArrivalDateTime", F.expr("CASE WHEN VoyageID % 3 = 0 THEN ArrivalDateTime + INTERVAL 60 DAYS ELSE ArrivalDateTime END")
            ),
        )
    ),
    _OVERLAP_SQL.format(
        keys="ShipID", id="VoyageID", start="DepartureDateTime", end="ArrivalDateTime", never="TIMESTAMP '9999-12-31'", op="<", rows="longer"
    ),
    longer="SELECT VoyageID, ShipID, DepartureDateTime, CASE WHEN VoyageID % 3 = 0 THEN ArrivalDateTime + INTERVAL 60 DAYS ELSE ArrivalDateTime END AS ArrivalDateTime "
    "FROM CruiseVoyage WHERE VoyageStatus <> 'Cancelled'",
)

register(
    "w4_waiting_list",
    capacity.promote_waitlisted,
    "SELECT BookingID, VoyageID, CabinCategoryID, BookingDate, Place, CabinID FROM "
    "(SELECT BookingID, VoyageID, CabinCategoryID, BookingDate, row_number() OVER (PARTITION BY VoyageID, CabinCategoryID ORDER BY BookingDate, BookingID) AS Place "
    "FROM (SELECT BookingID, VoyageID, BookingDate, arg_min(CabinID, BookingCabinID) AS CabinID FROM BookingCabin JOIN Booking USING (BookingID) "
    "WHERE BookingStatus = 'Waitlisted' GROUP BY ALL) JOIN (SELECT CabinID, CabinCategoryID FROM Cabin) USING (CabinID)) "
    "LEFT JOIN (SELECT VoyageID, CabinCategoryID, CabinID, row_number() OVER (PARTITION BY VoyageID, CabinCategoryID ORDER BY CabinID) AS Place FROM given_up "
    "JOIN (SELECT CabinID, CabinCategoryID FROM Cabin) USING (CabinID)) USING (VoyageID, CabinCategoryID, Place)",
    given_up="SELECT VoyageID, CabinID FROM BookingCabin JOIN Booking USING (BookingID) GROUP BY ALL "
    "HAVING bool_or(BookingStatus IN ('Cancelled', 'Rescheduled')) AND NOT bool_or(BookingStatus IN ('Pending', 'Confirmed', 'Completed'))",
)

# Payments in parts: a third of them on one booking, some on none.
_PARTS = (
    "event_id AS PaymentID, CASE WHEN event_id % 3 = 0 THEN 1 ELSE event_id * 13 % ({bookings} * 21 {div} 20) END AS BookingID, ts AS PaymentDateTime, "
    "CAST(value AS DECIMAL(12,2)) AS Amount, CASE WHEN event_type IN ('purchase', 'click', 'view') THEN 'Paid' ELSE 'Pending' END AS PaymentStatus"
)


def _in_parts(t: StarTables) -> StarTables:
    expr = _PARTS.format(bookings=t.size("orders"), div="div")
    return _with(t, Payment=t.spark.sql(f"SELECT {expr} FROM {{events}}", events=t.source("events")))


_LEDGER = {
    "waiting": _WAITING,
    "penalty": _PENALTY.format(keys="CancellationID, BookingID, CancellationDateTime", src="waiting"),
    "parts": "SELECT " + _PARTS.format(bookings="(SELECT count(*) FROM orders)", div="//") + " FROM events",
    "entries": "SELECT BookingID, 'charge' AS Kind, 0 AS KindNo, BookingDate AS moment, BookingID AS EntryID, TotalAmount AS Amount FROM Booking "
    "UNION ALL SELECT BookingID, 'payment', 1, PaymentDateTime, PaymentID, -Amount FROM parts WHERE PaymentStatus = 'Paid' "
    "UNION ALL SELECT BookingID, 'void', 2, CancellationDateTime, CancellationID, -TotalAmount FROM penalty "
    "UNION ALL SELECT BookingID, 'penalty', 3, CancellationDateTime, CancellationID, PenaltyAmount FROM penalty "
    "UNION ALL SELECT BookingID, 'refund', 4, CancellationDateTime, CancellationID, TotalAmount - PenaltyAmount FROM penalty",
}
register(
    "w5_account_balances",
    lambda t: ledger.account_balances(_in_parts(t)).drop("violations"),
    "SELECT BookingID, "
    + ", ".join(
        f"{_dec(f'coalesce(sum({sign}Amount) FILTER (WHERE Kind = {kind!r}), 0)')} AS {name}"
        for kind, sign, name in (("charge", "", "Charged"), ("void", "-", "Voided"), ("penalty", "", "Penalty"), ("payment", "-", "Paid"), ("refund", "", "Refunded"))
    )
    + f", {_dec('coalesce(sum(Amount), 0)')} AS Balance, CASE WHEN NOT bool_or(Kind = 'charge') THEN '{ledger.UNKNOWN_ACCOUNT}' "
    f"WHEN sum(Amount) > 0 THEN '{ledger.UNDERPAID}' WHEN sum(Amount) < 0 THEN '{ledger.OVERPAID}' END AS first_violation FROM entries GROUP BY BookingID",
    **_LEDGER,
)
register(
    "w5_account_statement",
    lambda t: ledger.account_statement(_in_parts(t)),
    f"SELECT BookingID, moment AS At, Kind, EntryID, CAST(Amount AS DECIMAL(12,2)) AS Amount, {_dec('sum(Amount) OVER (PARTITION BY BookingID ORDER BY moment, KindNo, EntryID)')} AS Balance FROM entries",
    **_LEDGER,
)


def _merged_bookings(t: StarTables) -> DataFrame:
    """A first version of the bookings, two batches merged into it, the last version read back."""
    folder = f"{staging_root(t.spark)}/bookings-{uuid.uuid4().hex}"
    stored = t["Booking"]
    versions.create_versioned(stored, folder, ["BookingID"])
    cancelled = stored.filter("BookingID % 97 = 0").withColumn("BookingStatus", F.lit("Cancelled")).withColumn("_deleted", F.lit(False))
    dropped = stored.filter("BookingID % 97 = 1").withColumn("_deleted", F.lit(True))
    versions.merge_batch(cancelled.unionByName(dropped), folder)
    versions.merge_batch(stored.filter("BookingID % 101 = 0").withColumn("BookingID", F.expr("-1 - BookingID")), folder)
    return versions.read_version(t.spark, folder)


_BOOKING_COLUMNS = "BookingDate, CustomerPassengerID, VoyageID, {status} AS BookingStatus, TotalAmount, OriginalBookingID FROM Booking WHERE {rows}"
register(
    "w6_merged_bookings",
    _merged_bookings,
    "SELECT BookingID, "
    + _BOOKING_COLUMNS.format(status="CASE WHEN BookingID % 97 = 0 THEN 'Cancelled' ELSE BookingStatus END", rows="BookingID % 97 <> 1")
    + " UNION ALL SELECT -1 - BookingID, "
    + _BOOKING_COLUMNS.format(status="BookingStatus", rows="BookingID % 101 = 0"),
)


def _updated_fares(t: StarTables) -> DataFrame:
    seats = t["BookingPassenger"]
    dearer = seats.filter("BookingPassengerID % 50 = 1").withColumn("FinalFare", F.expr("CAST(FinalFare + 100 AS DECIMAL(12,2))"))
    moved = seats.filter("BookingPassengerID % 50 = 2").withColumn("BookingID", F.expr("BookingID + 1"))
    gone = seats.filter("BookingPassengerID % 50 = 3 OR BookingID % 40 = 0")
    batch = dearer.unionByName(moved).filter("BookingID % 40 > 1").withColumn("_deleted", F.lit(False))
    batch = batch.unionByName(gone.withColumn("_deleted", F.lit(True)))
    return deltas.update_fare_totals(deltas.fare_totals(seats), seats, batch).withColumnRenamed(deltas.ROWS, "Passengers")


register(
    "w7_updated_fare_totals",
    _updated_fares,
    f"SELECT BookingID, {_dec('sum(FinalFare)')} AS TotalAmount, count(*) AS Passengers FROM "
    "(SELECT BookingPassengerID, CASE WHEN BookingPassengerID % 50 = 2 AND (BookingID + 1) % 40 > 1 THEN BookingID + 1 ELSE BookingID END AS BookingID, "
    "CASE WHEN BookingPassengerID % 50 = 1 AND BookingID % 40 > 1 THEN FinalFare + 100 ELSE FinalFare END AS FinalFare "
    "FROM BookingPassenger WHERE NOT (BookingPassengerID % 50 = 3 OR BookingID % 40 = 0)) GROUP BY BookingID",
)


def _updated_occupancy(t: StarTables) -> DataFrame:
    bookings = t["Booking"]
    changed = bookings.filter("BookingID % 10 = 1").withColumn(
        "BookingStatus", F.expr("CASE WHEN BookingStatus = 'Confirmed' THEN 'Cancelled' ELSE 'Confirmed' END")
    )
    batch = changed.withColumn("_deleted", F.lit(False)).unionByName(bookings.filter("BookingID % 10 = 2").withColumn("_deleted", F.lit(True)))
    return deltas.sold_cabins(deltas.update_cabin_sales(deltas.cabin_sales(bookings, t), t, batch))


register(
    "w7_updated_occupancy",
    _updated_occupancy,
    "SELECT VoyageID, count(DISTINCT CabinID) AS BookedCabins FROM BookingCabin JOIN (SELECT BookingID, VoyageID, "
    "CASE WHEN BookingID % 10 = 1 THEN CASE WHEN BookingStatus = 'Confirmed' THEN 'Cancelled' ELSE 'Confirmed' END ELSE BookingStatus END AS state "
    "FROM Booking WHERE BookingID % 10 <> 2) USING (BookingID) WHERE state IN ('Confirmed', 'Completed') GROUP BY VoyageID",
)
register(
    "w8_revenue_levels",
    R.revenue_levels,
    "SELECT OperatorName, ShipID, CabinCategoryID, grouping(OperatorName, ShipID, CabinCategoryID) AS Level, "
    f"{_dec('sum(paid)')} AS Revenue, count(*) AS Seats, count(DISTINCT PassengerID) AS Passengers FROM sold_place "
    "GROUP BY GROUPING SETS ((OperatorName, ShipID, CabinCategoryID), (OperatorName, ShipID), (OperatorName, CabinCategoryID), (OperatorName), ())",
    sold_place=_SOLD_SEAT.replace("SELECT ", "SELECT BookingPassenger.PassengerID, ", 1),
)
register(
    "w9_service_ages",
    lambda t: X.check_service_ages(t).select("PassengerServiceID", "ServiceID", "AgeAtDeparture", "first_violation"),
    "SELECT PassengerServiceID, ServiceID, age AS AgeAtDeparture, CASE WHEN age < AgeRestrictionMin OR age > AgeRestrictionMax "
    "THEN 'Special service is not offered for the passenger''s age at departure.' END AS first_violation "
    "FROM PassengerSpecialService LEFT JOIN (SELECT ServiceID, AgeRestrictionMin, AgeRestrictionMax FROM SpecialService) USING (ServiceID) LEFT JOIN "
    f"(SELECT BookingPassengerID, {age_sql('DateOfBirth', 'DepartureDateTime')} AS age FROM BookingPassenger JOIN Booking USING (BookingID) "
    "JOIN CruiseVoyage USING (VoyageID) JOIN Passenger USING (PassengerID)) USING (BookingPassengerID)",
)
# Every other voyage has no limit of its own; the operators' rules change by the year.
register(
    "w9_baggage_rules",
    lambda t: X.check_baggage_by_operator(
        _with(
            t,
            CruiseVoyage=t["CruiseVoyage"].withColumn("BaggageWeightLimitKG", F.expr("CASE WHEN VoyageID % 2 = 0 THEN BaggageWeightLimitKG END")),
            BaggageRule=t.source("nation").selectExpr(
                "n_nationkey AS BaggageRuleID", "n_nationkey % 4 AS OperatorID", "CAST(20 + n_nationkey AS DECIMAL(6,2)) AS MaxWeightKG",
                "make_date(int(1998 + n_nationkey div 4), 1, 1) AS EffectiveFrom", "CASE WHEN n_nationkey % 3 = 0 THEN make_date(int(1998 + n_nationkey div 4), 6, 30) END AS EffectiveTo",
            ),
        )
    ).select("BaggageID", "WeightKG", "LimitKG", "IsOverLimit"),
    "SELECT BaggageID, WeightKG, LimitKG, WeightKG > LimitKG AS IsOverLimit FROM BookingBaggage LEFT JOIN (SELECT BookingPassengerID, "
    "CASE WHEN VoyageID % 2 = 0 THEN BaggageWeightLimitKG ELSE (SELECT arg_max(weight, since) FROM yearly WHERE yearly.who = sailing.OperatorID "
    "AND since <= CAST(DepartureDateTime AS DATE) AND (until IS NULL OR until >= CAST(DepartureDateTime AS DATE))) END AS LimitKG "
    "FROM BookingPassenger JOIN Booking USING (BookingID) JOIN sailing USING (VoyageID)) USING (BookingPassengerID)",
    yearly="SELECT n_nationkey % 4 AS who, CAST(20 + n_nationkey AS DECIMAL(6,2)) AS weight, make_date(1998 + n_nationkey // 4, 1, 1) AS since, "
    "CASE WHEN n_nationkey % 3 = 0 THEN make_date(1998 + n_nationkey // 4, 6, 30) END AS until FROM nation",
)

# The lookup of the ends of a route on routes that grow with the data: an order's lines as its stops.
register(
    "h1_endpoints_of_orders",
    lambda t: H.route_endpoints(t.source("lineitem").selectExpr("l_orderkey AS RouteID", "l_linenumber AS StopSequence", "l_orderkey * 10 + l_linenumber AS PortID")),
    "SELECT l_orderkey AS RouteID, max(CASE WHEN l_linenumber = 1 THEN l_orderkey * 10 + l_linenumber END) AS FirstPortID, "
    "max(l_orderkey * 10 + l_linenumber) AS LastPortID, count(*) AS Stops FROM lineitem GROUP BY l_orderkey",
)

# Declared defaults, "now" included, on columns with gaps.
_GAPS = {
    "Booking": ("BookingID", ("BookingDate", "BookingStatus", "TotalAmount")),
    "BookingExcursion": ("BookingExcursionID", ("BookingDateTime", "ExcursionStatus", "AmountPaid")),
    "BookingCancellation": ("CancellationID", ("CancellationDateTime", "PenaltyAmount")),
    "RescheduleRequest": ("RescheduleID", ("RequestDateTime", "RescheduleFee", "RequestStatus")),
    "Payment": ("PaymentID", ("PaymentDateTime", "PaymentStatus")),
    "CruiseVoyage": ("VoyageID", ("VoyageStatus",)),
    "Cabin": ("CabinID", ("IsWheelchairAccessible",)),
    "CabinAdjacency": ("CabinAdjacencyID", ("AdjacencyType",)),
    "BookingPassenger": ("BookingPassengerID", ("InfantBedOption", "IsChaperonedYouth", "FinalFare")),
    "Excursion": ("ExcursionID", ("Price",)),
    "VoyageExcursion": ("VoyageExcursionID", ("AvailableSlots",)),
}


def _gap_filled(table: str) -> Callable[[StarTables], DataFrame]:
    key, columns = _GAPS[table]
    gaps = [f"CASE WHEN {key} % 7 <> {i} THEN {c} END AS {c}" for i, c in enumerate(columns)]
    return lambda t: A.fill_defaults(t[table].selectExpr(key, *gaps), table, NOW)


def _gap_sql(table: str) -> str:
    key, columns = _GAPS[table]

    def filled(i: int, c: str) -> str:
        value = K.DEFAULTS[table][c]
        literal = f"TIMESTAMP '{NOW}'" if value == "now" else f"'{value}'"
        return f"CASE WHEN {key} % 7 <> {i} AND {c} IS NOT NULL THEN {c} ELSE {literal} END AS {c}"

    return f"SELECT {key}, {', '.join(filled(i, c) for i, c in enumerate(columns))} FROM {table}"


for _table in _GAPS:
    register(f"c6_defaults_{_table.lower()}", _gap_filled(_table), _gap_sql(_table))
