"""Known answers of every report on the seed data."""

from decimal import Decimal

import pytest

from seed import TOTALS
from tidewake.operators import lookups, rules
from tidewake.plans import procedures, reports, views


def rows(df, *columns):
    return [tuple(r) if len(r) > 1 else r[0] for r in df.select(*columns).collect()]


def num(*values):
    return tuple(Decimal(str(v)) for v in values)


def test_round_trips(t):
    assert rows(reports.round_trip_sailings(t, "2026-01-01", "2026-12-31"), "VoyageID", "DeparturePort", "ArrivalPort") == [(3, "Port 3", "Port 3")]
    assert rows(reports.round_trip_sailings(t, "2026-03-10", "2026-03-10", dep_port="Port 3"), "VoyageID") == [3]
    assert rows(reports.round_trip_sailings(t, "2026-03-11", "2026-12-31"), "VoyageID") == []
    assert rows(reports.round_trip_sailings(t, "2026-01-01", "2026-12-31", arr_port="Port 1"), "VoyageID") == []


def test_revenue_by_category(t):
    got = rows(reports.revenue_by_category(t, "Operator 1", 1), "ShipCode", "CabinCategoryCode", "CategoryRevenue", "TotalShipRevenue")
    assert got == [(1, c, Decimal(r), Decimal(10370)) for c, r in ((1, 2000), (2, 2350), (4, 6020))]
    assert len(rows(reports.revenue_by_category(t, "Operator 1"), "ShipCode")) == 4
    assert rows(reports.revenue_by_category(t, "Operator 2", 1), "ShipCode") == []


def test_voyage_revenue_summary(t):
    got = rows(procedures.voyage_revenue_summary(t, 1), "CabinCategory", "CabinsSold", "CategoryFareRevenue", "TotalShipFareRevenue")
    assert got == [
        ("Interior", 1, *num(2000, 10370)),
        ("Ocean View", 2, *num(2350, 10370)),
        ("Suite", 1, *num(6020, 10370)),
    ]
    with pytest.raises(LookupError, match="Voyage not found."):
        procedures.voyage_revenue_summary(t, 99)


def test_reservation_status(t):
    got = rows(reports.reservation_status(t, "Operator 1"), "PassengerID", "BookingStatus", "ReservationStatusDescription")
    assert [g[0] for g in got] == list(range(1, 21))
    assert [g[0] for g in got if g[1] == "Pending"] == [3, 4]
    assert [g[0] for g in got if g[2] == "Reservation has been cancelled"] == [10, 11, 12]


def test_top_operator(t):
    top = reports.top_operator_by_port(t, "Port 1", "2026-01-01", "2026-12-31", n=3)
    assert rows(top, "OperatorName", "TotalBookings") == [("Operator 1", 6), ("Operator 5", 3), ("Operator 4", 2)]
    assert rows(reports.top_operator_by_port(t, "Port 1", "2026-01-01", "2026-12-31"), "TotalBookings") == [6]


def test_age_bands(t):
    got = {r.AgeCategory: r for r in reports.age_band_rollup(t, "Operator 1", 1).collect()}
    assert {k: r.TotalPassengers for k, r in got.items()} == {"Adult": 5, "Infant": 1, "Teen": 1, "Grand Total": 7}
    grand = got["Grand Total"]
    assert (grand.Infants, grand.Children, grand.Teens, grand.Adults, grand.Seniors) == (1, 0, 1, 5, 0)


def test_top_multi_destination(t):
    assert [tuple(r) for r in reports.top_multi_destination(t).collect()] == [("Operator 1", "Port 1", "Port 1", 2)]


def test_lifetime_value(t):
    got = rows(reports.passenger_lifetime_value(t), "PassengerID", "LifetimeValue", "ValueRank")
    assert len(got) == 30
    assert got[:4] == [(20, Decimal(5385), 1), (34, Decimal(4800), 2), (35, Decimal(4800), 2), (19, Decimal(3800), 4)]
    written = rows(reports.passenger_lifetime_value(t, as_written=True), "PassengerID", "LifetimeValue")
    assert written[0] == (20, Decimal(10585))


def test_discounted_fares(t):
    got = rows(reports.discounted_fares(t, "Suite", "2026-08-01"), "ShipCode", "RegularFare", "DiscountedFare")
    want = [(1, 2800, 2380), (1, 5200, 4420), (2, 5200, 4420), (4, 2500, 2125), (5, 3000, 2550), (6, 4800, 4080)]
    assert got == [(s, *num(a, b)) for s, a, b in want]
    assert rows(reports.discounted_fares(t, "Suite", "2025-12-31"), "ShipCode") == []


def test_port_reports(t):
    assert rows(reports.sailings_to_port(t, "Port 2"), "VoyageID", "DurationDays") == [(1, 2), (4, 2)]
    assert [tuple(r) for r in reports.duration_stats(t, "Port 2").collect()] == [(2, 2, Decimal("2.00"))]
    # the home port of a loop is two stops of one sailing
    assert rows(reports.sailings_to_port(t, "Port 1"), "VoyageID") == [1, 4, 5, 2, 6]
    assert [tuple(r) for r in reports.duration_stats(t, "Port 1").collect()] == [(2, 8, Decimal("5.20"))]


def test_ship_reports(t):
    assert rows(reports.specialty_dining(t, "Ship 1"), "SpecialtyDiningType") == ["Gluten-Free", "Halal", "Seafood Grill", "Vegan"]
    assert rows(reports.itinerary_excursions(t, "Ship 1"), "VoyageID", "StopSequence") == [(2, s) for s in (2, 2, 3, 3, 4, 4)]


def test_operator_reports(t):
    assert rows(reports.dock_countries(t, "Operator 1"), "Country") == ["Malaysia", "Singapore", "Thailand"]
    assert rows(reports.dock_countries(t, "Operator 3"), "Country") == []
    assert {tuple(r) for r in reports.voyages_rollup(t, "2026-09-10").collect()} == {("Operator 1", 1), ("All Operators", 1)}
    assert {tuple(r) for r in reports.wheelchair_rollup(t, "2026-08-01").collect()} == {("Operator 1", 2), ("All Operators", 2)}


def test_occupancy(t):
    got = rows(reports.occupancy(t), "VoyageID", "TotalCabinsOnShip", "BookedCabins", "AvailableCabins", "OccupancyRatePct")
    want = {1: (5, 4, 1, 80), 2: (5, 3, 2, 60), 3: (4, 3, 1, 75), 4: (4, 2, 2, 50), 5: (4, 3, 1, 75), 6: (4, 0, 4, 0)}
    assert {g[0]: g[1:] for g in got} == {v: (*w[:3], Decimal(w[3])) for v, w in want.items()}


def test_passenger_reports(t):
    assert rows(reports.party_for_passenger(t, 1), "PassengersInParty", "CabinCategory") == [(2, "Interior")]
    assert rows(procedures.passenger_bookings(t, 1), "BookingID", "CabinNumber", "FarePaid") == [(1, "I-1", Decimal(1000))]
    assert rows(reports.multi_destination_passengers(t, "Operator 1", "2026-07-01"), "PassengerID") == [14, 13, 15, 16]
    assert rows(reports.multi_destination_passengers(t, "Operator 1", "2026-07-06"), "PassengerID") == [17, 18]
    assert rows(reports.multi_destination_passengers(t, "Operator 1", "2026-06-10"), "PassengerID") == []
    with pytest.raises(LookupError, match="Passenger not found."):
        procedures.passenger_bookings(t, 99)


def test_unsold_excursions(t):
    assert sorted(rows(reports.unsold_excursions(t), "ExcursionID")) == [1, 2, 8]


def test_chaperoned_youth(t):
    got = rows(reports.chaperoned_youth(t, 2, "2026-09-10"), "PassengerID", "AgeAtDeparture", "DailySupervisionFee", "VoyageLengthDays", "TotalSupervisionFee")
    assert got == [(19, 15, Decimal(50), 8, Decimal(400))]
    assert rows(reports.chaperoned_youth(t, 1, "2026-08-01"), "PassengerID") == []


def test_cancellation_impact(t):
    assert [tuple(r) for r in reports.cancellation_impact(t).collect()] == [("Operator 1", 1, *num(7000, 7000, 0, 100, 0))]


def test_available_cabins(t):
    got = rows(procedures.search_available_cabins(t, 2, "2026-08-01"), "CabinID", "CabinCategory", "AdultBaseFare")
    assert got == [(4, "Balcony", Decimal(3200)), (2, "Ocean View", Decimal(2700)), (3, "Ocean View", Decimal(2700))]
    assert rows(procedures.search_available_cabins(t, 1, "2026-08-01", "Suite"), "CabinID") == []
    assert rows(procedures.search_available_cabins(t, 2, "2025-01-01", "Balcony"), "AdultBaseFare") == [Decimal(0)]
    with pytest.raises(LookupError):
        procedures.search_available_cabins(t, 99, "2026-08-01")


def test_views(t):
    assert views.booking_passenger_details(t).count() == 35
    cabins = rows(views.voyage_cabin_availability(t), "VoyageID", "AvailabilityStatus")
    booked = [v for v, s in cabins if s == "Booked"]
    assert len(cabins) == 26 and sorted(booked) == [1] * 5 + [2] * 2 + [5] * 3
    views.register_reporting_views(t)
    spark = t["Booking"].sparkSession
    assert spark.sql("SELECT count(*) FROM BookingPassengerDetails WHERE AgeCategory = 'Infant'").first()[0] == 2


def test_totals_and_invariants(t):
    assert rows(t["Booking"].orderBy("BookingID"), "TotalAmount") == [Decimal(x) for x in TOTALS]
    cancelled = t["BookingCancellation"].join(t["Booking"], "BookingID").first()
    assert cancelled.PenaltyAmount + cancelled.RefundAmount == cancelled.TotalAmount
    assert cancelled.BookingStatus == "Cancelled"
    assert rules.booking_totals(t).exceptAll(t["Booking"]).count() == 0


def test_meal_packages(t):
    lengths = t["Booking"].sparkSession.createDataFrame([(1,), (2,), (8,)], "days int")
    found = lookups.band_lookup(lengths, t["VoyageMealPackageRule"], "days", "MinVoyageLengthDays", "MaxVoyageLengthDays")
    assert sorted(rows(found, "days", "MealPackageRuleID")) == [(1, 1), (2, 2), (8, 2)]
