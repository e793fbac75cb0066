"""A small complete data set: six sailings of five operators, with the rules' results filled in.

Names, birth dates, booking times, weights and excursion prices are invented. The other values are fixed:
the known answers of reports and rules follow from them.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from tidewake.operators.rules import booking_totals, cancellation_amounts, check_baggage, check_booking_passengers, mark_cancelled
from tidewake.schema import TABLES, struct_of
from tidewake.sources.tables import with_derived

# The rows that known answers need.
CATEGORIES = ["Interior", "Ocean View", "Balcony", "Suite"]
# ship, cabin category
CABINS = [
    (1, 1), (1, 2), (1, 2), (1, 3), (1, 4), (2, 1), (2, 2), (2, 3), (2, 4),
    (3, 1), (3, 2), (3, 3), (3, 4), (4, 1), (4, 2), (4, 3), (4, 4), (5, 1),
    (5, 2), (5, 3), (5, 4), (6, 3), (6, 1), (6, 4), (6, 2),
]
SHIP_OPERATOR = {1: 1, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5}
# kind, ports in order
ROUTES = {
    1: ("One-way", (1, 2)),
    2: ("Round-trip", (3, 4, 3)),
    3: ("Multi-destination", (1, 4, 5, 6, 1)),
}
COUNTRIES = ("Malaysia", "Singapore", "Malaysia", "Malaysia", "Thailand", "Thailand")
# ship, route, departure, arrival, status
VOYAGES = [
    (1, 1, "2026-08-01 18:00", "2026-08-03 08:00", "Scheduled"),
    (1, 3, "2026-09-10 17:00", "2026-09-18 09:00", "Scheduled"),
    (4, 2, "2026-03-10 09:00", "2026-03-13 17:00", "Completed"),
    (5, 1, "2026-04-15 18:00", "2026-04-17 08:00", "Completed"),
    (6, 3, "2026-11-05 17:00", "2026-11-11 09:00", "Scheduled"),
    (2, 3, "2026-12-01 17:00", "2026-12-09 09:00", "Scheduled"),
]
# per voyage and cabin category: child, teen, adult, senior
FARES = {
    1: ((600, 750, 1000, 850), (850, 1000, 1350, 1150), (1100, 1300, 1750, 1500), (1800, 2100, 2800, 2500)),
    2: ((1200, 1500, 2000, 1750), (1600, 2000, 2700, 2400), (1800, 2300, 3200, 2800), (3000, 3800, 5200, 4600)),
    3: ((450, 550, 750, 650), (600, 750, 950, 850), (800, 1000, 1300, 1100), (1500, 1900, 2500, 2200)),
    4: ((500, 650, 900, 800), (700, 900, 1200, 1050), (950, 1200, 1600, 1400), (1800, 2200, 3000, 2600)),
    5: ((1000, 1300, 1800, 1500), (1400, 1700, 2200, 1900), (1600, 2000, 2700, 2400), (2800, 3500, 4800, 4200)),
}
FARES[6] = FARES[2]
# customer, voyage, status
BOOKINGS = [
    (1, 1, "Confirmed"), (3, 1, "Pending"), (5, 1, "Confirmed"), (8, 1, "Confirmed"), (13, 2, "Confirmed"),
    (17, 2, "Completed"), (20, 2, "Confirmed"), (10, 2, "Confirmed"), (21, 3, "Completed"), (23, 3, "Completed"),
    (25, 3, "Completed"), (27, 4, "Completed"), (29, 4, "Completed"), (30, 5, "Confirmed"), (32, 5, "Confirmed"),
    (34, 5, "Confirmed"),
]
TOTALS = [2000, 3000, 6020, 2350, 5800, 5600, 9000, 7000, 1500, 1800, 2600, 1800, 1050, 5400, 2800, 9600]
# booking, cabin
BOOKED_CABINS = [
    (1, 1), (2, 4), (3, 5), (4, 3), (4, 2), (5, 1), (6, 4), (7, 5), (8, 2), (9, 14),
    (10, 15), (11, 16), (12, 18), (13, 19), (14, 22), (15, 23), (16, 24),
]
# booking, booked cabin, passenger, age band
SEATS = [
    (1, 1, 1, 4), (1, 1, 2, 4), (2, 2, 3, 5), (2, 2, 4, 5), (3, 3, 5, 4), (3, 3, 6, 4), (3, 3, 7, 1),
    (4, 4, 8, 4), (4, 5, 9, 3), (5, 6, 13, 4), (5, 6, 14, 4), (5, 6, 15, 2), (5, 6, 16, 1), (6, 7, 17, 5),
    (6, 7, 18, 5), (7, 8, 20, 4), (7, 8, 19, 3), (8, 9, 10, 4), (8, 9, 11, 4), (8, 9, 12, 2), (9, 10, 21, 4),
    (9, 10, 22, 4), (10, 11, 23, 4), (10, 11, 24, 5), (11, 12, 25, 4), (11, 12, 26, 4), (12, 13, 27, 4), (12, 13, 28, 4),
    (13, 14, 29, 5), (14, 15, 30, 4), (14, 15, 31, 4), (15, 16, 32, 4), (15, 16, 33, 2), (16, 17, 34, 4), (16, 17, 35, 4),
]
BEDS = {7: "SharedBed", 13: "Cot"}  # seat: bed of an infant
CHAPERONED_SEAT = 17
# type, least age, greatest age, fee
SERVICES = [
    ("Childcare", 2, 12, 35),
    ("Teen Club", 13, 17, 0),
    ("Accessibility", None, None, 0),
    ("Mobility", None, None, 0),
    ("Chaperoned Youth", 15, 17, 50),
]
# seat, service, status
SERVICE_REQUESTS = [
    (3, 3, "Approved"), (4, 4, "Approved"), (9, 2, "Approved"), (12, 1, "Approved"),
    (17, 5, "Approved"), (17, 2, "Approved"), (20, 1, "Cancelled"),
]
EXCURSION_PORTS = (2, 2, 4, 4, 5, 5, 6, 6)
# route stop, excursion; all on voyage 2
OFFERED = [(7, 3), (7, 4), (8, 5), (8, 6), (9, 7), (9, 8)]
# seat, offer, paid
EXCURSION_SALES = [(10, 1, 60), (10, 3, 60), (11, 2, 60), (14, 4, 60), (14, 5, 60), (15, 5, 60), (16, 1, 75), (16, 3, 110)]
SPECIALTIES = ("Vegan", "Gluten-Free", "Halal", "Kosher", "Low-Sodium", "Seafood Grill")
# ship, specialty
SHIP_SPECIALTIES = [
    (1, 1), (1, 2), (1, 3), (1, 6), (2, 1), (2, 3), (3, 2), (3, 5),
    (3, 6), (4, 1), (4, 3), (5, 2), (5, 6), (6, 1), (6, 3), (6, 5),
]
OVERWEIGHT = (2, 8, 11, 19, 25, 29, 32)

# Invented values.
BORN = {1: "2025-10-01", 2: "2016-05-05", 3: "2010-06-15", 4: "1980-05-05", 5: "1958-05-05"}  # age band: birth date
BORN_OTHERWISE = {7: "2025-02-01", 19: "2011-02-10"}  # passenger: birth date
BAGGAGE_LIMIT, LIGHT, HEAVY = Decimal(25), Decimal(18), Decimal("31.5")
EXCURSION_PRICE = Decimal(70)


def _time(text: str) -> datetime:
    return datetime.fromisoformat(text)


def _numbered(rows) -> list[tuple]:
    return [(i, *row) for i, row in enumerate(rows, 1)]


def _booked_at(booking: int, voyage: int) -> datetime:
    """Months before the departure; bookings of later voyages every 126 hours, the fifth on the first of July."""
    if VOYAGES[voyage - 1][4] == "Completed":
        return _time("2026-01-10 10:00")
    return _time("2026-06-10 10:00") + timedelta(hours=126 * (booking - 1))


def raw_rows() -> dict[str, list[tuple]]:
    stops = [(r, p, i, p == ports[0]) for r, (_, ports) in ROUTES.items() for i, p in enumerate(ports, 1)]
    fares = [
        (v, c, band, Decimal(fare), date(2026, 1, 1), None)
        for v in sorted(FARES)
        for c, of_bands in enumerate(FARES[v], 1)
        for band, fare in zip((2, 3, 4, 5), of_bands)
    ]
    seats = [
        (b, c, p, band, None, BEDS.get(i, "NotApplicable"), i == CHAPERONED_SEAT, Decimal(0), Decimal(0))
        for i, (b, c, p, band) in enumerate(SEATS, 1)
    ]
    births = {p: BORN_OTHERWISE.get(p, BORN[band]) for _, _, p, band in SEATS}
    booked = [(_booked_at(i, voyage), customer, voyage, status) for i, (customer, voyage, status) in enumerate(BOOKINGS, 1)]
    day = date(2026, 1, 1)
    return {
        "CruiseOperator": [(i, f"Operator {i}", "X", None, i in (1, 4)) for i in range(1, 6)],
        "CruiseShip": [(s, o, f"Ship {s}", 10, 2000) for s, o in SHIP_OPERATOR.items()],
        "CabinCategory": _numbered((c, None) for c in CATEGORIES),
        "Cabin": [(i, s, c, f"{CATEGORIES[c - 1][0]}-{i}", c + 4, 4 if c < 3 else 5, c > 2) for i, (s, c) in enumerate(CABINS, 1)],
        "CabinAdjacency": [(1, 2, 3, "Adjacent"), (2, 3, 2, "Adjacent")],
        "CruiseRoute": [(r, f"Route {r}", kind) for r, (kind, _) in ROUTES.items()],
        "Port": _numbered((f"Port {i}", c) for i, c in enumerate(COUNTRIES, 1)),
        "RoutePort": _numbered(stops),
        "CruiseVoyage": _numbered((s, r, _time(d), _time(a), BAGGAGE_LIMIT, st) for s, r, d, a, st in VOYAGES),
        # passenger 14 sorts before 13, as in the known answer of one report
        "Passenger": [(i, f"{'A' if i == 14 else 'B'} guest {i:02d}", date.fromisoformat(b), f"P{i:03d}", "X", None, None, None) for i, b in sorted(births.items())],
        "AgeCategory": [(1, "Infant", 0, 1), (2, "Child", 2, 12), (3, "Teen", 13, 17), (4, "Adult", 18, 59), (5, "Senior", 60, None)],
        "Booking": _numbered((*b, Decimal(0), None) for b in booked),
        "BookingCabin": _numbered((b, c, Decimal(0)) for b, c in BOOKED_CABINS),
        "FareRule": _numbered(fares),
        "BookingPassenger": _numbered(seats),
        "DiningOption": [(1, "fixed"), (2, "flexible"), (3, "specialty")],
        "ShipDiningOption": [(s, s, 1) for s in SHIP_OPERATOR],
        "SpecialtyDiningType": _numbered((s, None) for s in SPECIALTIES),
        "ShipSpecialtyDining": _numbered(SHIP_SPECIALTIES),
        "VoyageMealPackageType": [(1, "boarding meal"), (2, "all meals")],
        "VoyageMealPackageRule": [(1, 1, 1, 1), (2, 2, 2, None)],
        "VoyageMealPackage": [(v, v, 2) for v in range(1, 7)],
        "SpecialService": _numbered((f"{k} service", k, lo, hi, Decimal(fee)) for k, lo, hi, fee in SERVICES),
        "PassengerSpecialService": _numbered((*r, Decimal(0)) for r in SERVICE_REQUESTS),
        "BaggageRule": _numbered((o, Decimal(25), day, None) for o in range(1, 6)),
        "BookingBaggage": _numbered((s, HEAVY if s in OVERWEIGHT else LIGHT, False, Decimal(0)) for s in range(1, len(SEATS) + 1) if s not in BEDS),
        "Excursion": _numbered((p, f"Excursion {i}", None, Decimal(3), EXCURSION_PRICE) for i, p in enumerate(EXCURSION_PORTS, 1)),
        "VoyageExcursion": _numbered((2, s, e, 40) for s, e in OFFERED),
        "BookingExcursion": _numbered((s, o, _time("2026-07-01 08:30") + timedelta(minutes=i), "Booked", Decimal(p)) for i, (s, o, p) in enumerate(EXCURSION_SALES)),
        "CancellationPolicy": _numbered((o, 48, "FullForfeit", Decimal(100)) for o in range(1, 6)),
        "BookingCancellation": [(1, 8, _time("2026-09-09 10:00"), None, Decimal(0), Decimal(0), None)],
        "RescheduleRequest": [(1, 1, None, _time("2026-07-01 10:00"), 2, Decimal(0), "Requested", None)],
        "Payment": _numbered((i, b[0], Decimal(total), "card", "Paid", f"TXN-{i:03d}") for i, (b, total) in enumerate(zip(booked, TOTALS), 1)),
    }


def frame(spark, table: str, rows: list[tuple]):
    return with_derived(table, spark.createDataFrame(rows, struct_of(table)))


def seed_tables(spark) -> dict:
    """Raw rows, then the rule jobs: fares, totals, over-limit flags, the cancellation of booking 8."""
    rows = raw_rows()
    t = {name: frame(spark, name, rows[name]) for name in TABLES}
    checked = check_booking_passengers(t)
    t["BookingPassenger"] = checked.select(*t["BookingPassenger"].columns).cache()
    t["Booking"] = booking_totals(t).cache()
    t["BookingBaggage"] = check_baggage(t).cache()
    t["BookingCancellation"] = cancellation_amounts(t, t["BookingCancellation"]).select(*t["BookingCancellation"].columns).cache()
    t["Booking"] = mark_cancelled(t["Booking"], t["BookingCancellation"]).cache()
    return t
