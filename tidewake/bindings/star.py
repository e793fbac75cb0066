"""Reservation tables derived by Spark from a star schema (orders, lineitem, part, ...).

The same library functions that serve real reservation data run on these, so every registered query
reads whole star-schema tables and grows with them: bookings are orders, booked passengers are
lineitems, voyages and excursions are parts, ships are suppliers, passengers and cabins are customers,
ports are nations, operators are regions, purchases and requests are events. Derived keys are
arithmetic on source keys and table sizes; nearly all tables are plain projections of one source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.operators.lookups import band_lookup
from tidewake.sources.tables import with_derived

_SIZES: dict[str, int] = {}
# Source rows of one partition where each becomes 32.
PARTS_DEALT = 16_384
# Source lines of one partition that are grouped.
LINES_DEALT = 262_144

# Declared schemas of the sources, so that no read infers one.
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Small lookup tables of the model.
VALUES = {
    "CabinCategory": (
        "CabinCategoryID, CategoryName, CategoryDescription",
        "(1, 'Interior', 'inside'), (2, 'Ocean View', 'window'), (3, 'Balcony', 'balcony'), (4, 'Suite', 'suite')",
    ),
    "AgeCategory": (
        "AgeCategoryID, CategoryName, MinAge, MaxAge",
        "(1, 'Infant', 0, 1), (2, 'Child', 2, 12), (3, 'Teen', 13, 17), (4, 'Adult', 18, 59), (5, 'Senior', 60, NULL)",
    ),
    "DiningOption": (
        "DiningOptionID, DiningName",
        "(1, 'Fixed-time dining'), (2, 'Flexible dining'), (3, 'Specialty restaurant')",
    ),
    "SpecialtyDiningType": (
        "SpecialtyDiningTypeID, TypeName, Description",
        "(1, 'Vegan', 'a'), (2, 'Gluten-Free', 'b'), (3, 'Halal', 'c'), (4, 'Kosher', 'd'), (5, 'Low-Sodium', 'e'), (6, 'Seafood Grill', NULL)",
    ),
    "VoyageMealPackageType": (
        "MealPackageTypeID, PackageName",
        "(1, 'Standard boarding meal'), (2, 'Multi-day all-inclusive dining package')",
    ),
    "VoyageMealPackageRule": (
        "MealPackageRuleID, MealPackageTypeID, MinVoyageLengthDays, MaxVoyageLengthDays",
        "(1, 1, 1, 1), (2, 2, 2, NULL)",
    ),
    "SpecialService": (
        "ServiceID, ServiceName, ServiceType, AgeRestrictionMin, AgeRestrictionMax, Fee",
        "(1, 'Childcare', 'Childcare', 2, 12, 35.00), (2, 'Teen club', 'Teen Club', 13, 17, 0.00), "
        "(3, 'Wheelchair', 'Accessibility', NULL, NULL, 0.00), (4, 'Mobility', 'Mobility', NULL, NULL, 0.00), "
        "(5, 'Youth supervision', 'Chaperoned Youth', 15, 17, 50.00)",
    ),
    "CancellationPolicy": (
        "PolicyID, OperatorID, HoursBeforeDeparture, PenaltyType, PenaltyValue",
        "(1, 0, 48, 'FullForfeit', 100.00), (2, 1, 24, 'FullForfeit', 100.00), (3, 1, 72, 'Percentage', 25.00), "
        "(4, 2, 72, 'FixedAmount', 50.00), (5, 3, 96, 'Percentage', 10.00)",
    ),
}
_MONEY_COLUMNS = {"Fee": "decimal(10,2)", "PenaltyValue": "decimal(10,2)"}


class StarTables(dict):
    """Table dict that derives a table when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark = spark
        self.folder = folder.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCES[name]).parquet(f"{self.folder}/{name}.parquet")

    def size(self, name: str) -> int:
        """Row count of a source, from Parquet footers."""
        key = f"{self.folder}/{name}"
        if key not in _SIZES:
            _SIZES[key] = self.source(name).count()
        return _SIZES[key]

    def __missing__(self, table: str) -> DataFrame:
        if table in VALUES:
            names, rows = VALUES[table]
            df = self.spark.sql(f"SELECT * FROM VALUES {rows} AS v({names})")
            df = df.withColumns({c: F.col(c).cast(d) for c, d in _MONEY_COLUMNS.items() if c in df.columns})
        else:
            df = with_derived(table, BUILDERS[table](self))
        self[table] = df
        return df


BUILDERS: dict[str, Callable[[StarTables], DataFrame]] = {}


def derived(table: str) -> Callable:
    def add(build: Callable[[StarTables], DataFrame]) -> Callable:
        BUILDERS[table] = build
        return build

    return add


# Departures fall on 73 days, 30 days apart, from 1999 to 2004.
DEPARTURE_DAY = "int({v} * 37 % 73 * 30)"


def departure(voyage: str) -> str:
    return f"timestamp_ntz'1999-01-01' + make_dt_interval({DEPARTURE_DAY.format(v=voyage)}, int({voyage} % 24))"


@derived("CruiseOperator")
def _operators(t: StarTables) -> DataFrame:
    return t.source("region").selectExpr(
        "r_regionkey AS OperatorID",
        "r_name AS OperatorName",
        "r_name AS HeadquartersCountry",
        "CAST(NULL AS STRING) AS ContactEmail",
        "r_name IN ('AMERICA', 'ASIA', 'EUROPE') AS AllowsChaperonedYouth",
    )


@derived("CruiseShip")
def _ships(t: StarTables) -> DataFrame:
    nations = t.source("nation").selectExpr("n_nationkey AS s_nationkey", "n_regionkey AS OperatorID")
    return t.source("supplier").join(nations, "s_nationkey").selectExpr(
        "s_suppkey AS ShipID", "OperatorID", "s_name AS ShipName", "12 AS TotalDecks",
        "CAST(s_acctbal AS INT) AS PassengerCapacity",
    )


@derived("Cabin")
def _cabins(t: StarTables) -> DataFrame:
    ships = t.size("supplier")
    return t.source("customer").selectExpr(
        "c_custkey AS CabinID",
        f"c_custkey % {ships} AS ShipID",
        f"1 + c_custkey div {ships} % 4 AS CabinCategoryID",
        "concat('C-', c_custkey) AS CabinNumber",
        f"c_custkey div {ships} AS DeckNumber",
        "1 + c_nationkey % 5 AS MaxOccupancy",
        "c_mktsegment = 'HOUSEHOLD' AS IsWheelchairAccessible",
    )


@derived("CabinAdjacency")
def _adjacency(t: StarTables) -> DataFrame:
    """Each cabin and the next one of its ship; doors of MACHINERY cabins are logged one way only."""
    ships, cabins = t.size("supplier"), t.size("customer")
    directions = "CASE WHEN c_mktsegment = 'MACHINERY' THEN array(0) ELSE array(0, 1) END"
    return (
        t.source("customer")
        .filter(f"c_custkey + {ships} < {cabins}")
        .selectExpr("c_custkey AS a", f"c_custkey + {ships} AS b", "c_mktsegment", f"explode({directions}) AS d")
        .selectExpr(
            "a * 2 + d AS CabinAdjacencyID",
            "CASE WHEN d = 0 THEN a ELSE b END AS CabinID",
            "CASE WHEN d = 0 THEN b ELSE a END AS AdjacentCabinID",
            "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Connecting' ELSE 'Adjacent' END AS AdjacencyType",
        )
    )


@derived("CruiseRoute")
def _routes(t: StarTables) -> DataFrame:
    return (
        t.source("nation")
        .selectExpr("n_nationkey", "n_name", "posexplode(array('One-way', 'Round-trip', 'Multi-destination')) AS (k, kind)")
        .selectExpr("n_nationkey * 3 + k AS RouteID", "concat(n_name, ' ', kind) AS RouteName", "kind AS RouteType")
    )


@derived("Port")
def _ports(t: StarTables) -> DataFrame:
    return t.source("nation").selectExpr(
        "n_nationkey AS PortID", "concat('Port ', n_name) AS PortName", "n_name AS Country"
    )


@derived("RoutePort")
def _stops(t: StarTables) -> DataFrame:
    n = t.size("nation")
    steps = (
        "array(array(0, 5), array(0, 1, 0), "
        "CASE WHEN n_regionkey = 2 THEN array(0, 1, 2, 3, 4) ELSE array(0, 1, 2, 3, 0) END)"
    )
    return (
        t.source("nation")
        .selectExpr("n_nationkey AS home", f"posexplode({steps}) AS (k, way)")
        .selectExpr("home", "k", "posexplode(way) AS (i, step)")
        .selectExpr(
            "(home * 3 + k) * 8 + i + 1 AS RoutePortID",
            "home * 3 + k AS RouteID",
            f"(home + step) % {n} AS PortID",
            "i + 1 AS StopSequence",
            "step = 0 AS IsHomePort",
        )
    )


@derived("CruiseVoyage")
def _voyages(t: StarTables) -> DataFrame:
    return t.source("part").selectExpr(
        "p_partkey AS VoyageID",
        f"p_partkey % {t.size('supplier')} AS ShipID",
        f"p_partkey * 7 % {3 * t.size('nation')} AS RouteID",
        f"{departure('p_partkey')} AS DepartureDateTime",
        f"timestamp_ntz'1999-01-01' + make_dt_interval({DEPARTURE_DAY.format(v='p_partkey')} + 1 + p_size % 14, 10) AS ArrivalDateTime",
        "CAST(20 + p_size % 15 AS DECIMAL(6,2)) AS BaggageWeightLimitKG",
        "CASE p_type WHEN 'ECONOMY' THEN 'Cancelled' WHEN 'PROMO' THEN 'Completed' WHEN 'SMALL' THEN 'Departed' "
        "WHEN 'MEDIUM' THEN 'Boarding' ELSE 'Scheduled' END AS VoyageStatus",
    )


@derived("Passenger")
def _passengers(t: StarTables) -> DataFrame:
    return t.source("customer").selectExpr(
        "c_custkey AS PassengerID",
        "c_name AS FullName",
        "date_sub(date'2002-06-30', int(c_custkey * 7919 % 29000)) AS DateOfBirth",
        "concat('P', c_custkey) AS PassportNo",
        "concat('NATION_', c_nationkey) AS Nationality",
        "CAST(NULL AS STRING) AS Gender",
        "c_mktsegment AS ContactNo",
        "CAST(NULL AS STRING) AS Email",
    )


@derived("Booking")
def _bookings(t: StarTables) -> DataFrame:
    return t.source("orders").selectExpr(
        "o_orderkey AS BookingID",
        "o_orderdate AS BookingDate",
        "o_custkey AS CustomerPassengerID",
        f"o_orderkey * 17 % {t.size('part')} AS VoyageID",
        f"{BOOKING_STATUS} AS BookingStatus",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS TotalAmount",
        "CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderkey + 100 END AS OriginalBookingID",
    )


BOOKING_STATUS = (
    "CASE o_orderstatus WHEN 'F' THEN 'Completed' "
    "WHEN 'O' THEN CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'Waitlisted' WHEN '5-LOW' THEN 'Cancelled' ELSE 'Confirmed' END "
    "ELSE CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'Cancelled' WHEN '5-LOW' THEN 'Rescheduled' ELSE 'Pending' END END"
)


@derived("BookingCabin")
def _booking_cabins(t: StarTables) -> DataFrame:
    """One or two cabins of the voyage's ship per booking; urgent pending ones name another ship."""
    ships, cabins, voyages = t.size("supplier"), t.size("customer"), t.size("part")
    ship = (
        f"(o_orderkey * 17 % {voyages} + CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 1 ELSE 0 END) % {ships}"
    )
    return (
        t.source("orders")
        .selectExpr("o_orderkey", "o_custkey", f"{ship} AS ship", "explode(sequence(0, int(o_orderkey % 2))) AS j")
        .selectExpr(
            "o_orderkey * 2 + j AS BookingCabinID",
            "o_orderkey AS BookingID",
            f"ship + {ships} * ((o_custkey + 3 * j) % {cabins // ships}) AS CabinID",
            "CAST(0 AS DECIMAL(12,2)) AS CabinPrice",
        )
    )


@derived("FareRule")
def _fare_rules(t: StarTables) -> DataFrame:
    """Per voyage four categories, four bands and two periods: an open one and a dearer season.

    The parts are dealt out first: their file is small and would be read, and multiplied, in few tasks.
    A cross join makes the 32 rows, since Spark's size estimate sees those, and not the ones of ``explode``.
    """
    return (
        t.source("part")
        .select("p_partkey")
        .repartition(1 + t.size("part") // PARTS_DEALT, "p_partkey")
        .crossJoin(t.spark.range(32).selectExpr("int(id) AS j"))
        .selectExpr("p_partkey", "j", "1 + j div 8 AS category", "2 + j % 8 div 2 AS band", "j % 2 AS season")
        .selectExpr(
            "p_partkey * 32 + j AS FareRuleID",
            "p_partkey AS VoyageID",
            "int(category) AS CabinCategoryID",
            "int(band) AS AgeCategoryID",
            "CAST((4 + 2 * season + p_partkey % 50) * category * element_at(array(50, 65, 100, 85), int(band - 1)) AS DECIMAL(12,2)) AS BaseFare",
            "CASE WHEN season = 0 THEN date'1995-07-01' ELSE date'1998-01-01' END AS EffectiveFrom",
            "CASE WHEN season = 1 THEN date'1999-12-31' END AS EffectiveTo",
        )
    )


def _line_groups(t: StarTables) -> DataFrame:
    """Line numbers repeat within an order; one seat per (order, line number). Fixed-width buffers only.

    The lines are dealt by number, so that no task groups more of them as the table grows.
    """
    lines = t.source("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        "l_quantity",
        F.expr("CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END").alias("a"),
        F.expr("CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END").alias("r"),
    )
    dealt = lines.repartition(1 + t.size("lineitem") // LINES_DEALT, "l_orderkey", "l_linenumber")
    return dealt.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").alias("part"),
        F.max("l_extendedprice").alias("price"),
        F.max("l_quantity").alias("quantity"),
        F.max("a").alias("flag_a"),
        F.max("r").alias("flag_r"),
    )


@derived("BookingPassenger")
def _booking_passengers(t: StarTables) -> DataFrame:
    people, bookings = t.size("customer"), t.size("orders")
    return (
        _line_groups(t)
        .withColumn("person", F.expr(f"(part * 31 + l_linenumber * 7 + l_orderkey) % {people}"))
        .withColumn("years", F.expr("person * 7919 % 29000 div 365"))
        .withColumn("youth", F.expr("(years BETWEEN 13 AND 17 AND flag_a = 1) OR quantity = 48"))
        .selectExpr(
            "l_orderkey * 8 + l_linenumber AS BookingPassengerID",
            "l_orderkey AS BookingID",
            f"CASE WHEN quantity = 50 THEN (l_orderkey + 1) % {bookings} * 2 "
            "ELSE l_orderkey * 2 + l_linenumber % (1 + l_orderkey % 2) END AS BookingCabinID",
            "person AS PassengerID",
            "CASE WHEN years <= 1 THEN 1 WHEN years <= 12 THEN 2 WHEN years <= 17 THEN 3 WHEN years <= 59 THEN 4 ELSE 5 END AS AgeCategoryID",
            "CAST(NULL AS BIGINT) AS FareRuleID",
            "CASE WHEN years <= 1 THEN CASE WHEN flag_a = 1 THEN 'SharedBed' WHEN flag_r = 1 THEN 'NotApplicable' ELSE 'Cot' END "
            "WHEN quantity = 49 THEN 'Cot' ELSE 'NotApplicable' END AS InfantBedOption",
            "youth AS IsChaperonedYouth",
            "CAST(CASE WHEN youth THEN 50 ELSE 0 END AS DECIMAL(10,2)) AS DailySupervisionFee",
            "CAST(price AS DECIMAL(12,2)) AS FinalFare",
        )
    )


@derived("ShipDiningOption")
def _ship_dining(t: StarTables) -> DataFrame:
    return (
        t.source("supplier")
        .selectExpr("s_suppkey", "explode(array(1, 2, 3)) AS k")
        .selectExpr("s_suppkey * 3 + k AS ShipDiningOptionID", "s_suppkey AS ShipID", "k AS DiningOptionID")
    )


@derived("ShipSpecialtyDining")
def _ship_specialty(t: StarTables) -> DataFrame:
    return (
        t.source("supplier")
        .selectExpr("s_suppkey", "explode(array(0, 2, 3)) AS k")
        .selectExpr(
            "s_suppkey * 4 + k AS ShipSpecialtyDiningID", "s_suppkey AS ShipID",
            "int(1 + (s_suppkey + k) % 6) AS SpecialtyDiningTypeID",
        )
    )


@derived("VoyageMealPackage")
def _meal_packages(t: StarTables) -> DataFrame:
    rules = t["VoyageMealPackageRule"]
    found = band_lookup(
        t["CruiseVoyage"].select("VoyageID", "VoyageLengthDays"),
        rules, "VoyageLengthDays", "MinVoyageLengthDays", "MaxVoyageLengthDays",
    )
    return found.selectExpr("VoyageID AS VoyageMealPackageID", "VoyageID", "MealPackageRuleID")


@derived("PassengerSpecialService")
def _services(t: StarTables) -> DataFrame:
    return t.source("events").selectExpr(
        "event_id AS PassengerServiceID",
        f"event_id * 7 % {t.size('orders')} * 8 + 1 + event_id % 7 AS BookingPassengerID",
        "int(1 + user_id % 6) AS ServiceID",
        "CASE event_type WHEN 'signup' THEN 'Requested' WHEN 'view' THEN 'Approved' WHEN 'click' THEN 'Completed' "
        "WHEN 'purchase' THEN 'Cancelled' END AS RequestStatus",
        "CASE WHEN event_type <> 'signup' THEN CAST(0 AS DECIMAL(10,2)) END AS Fee",
    )


@derived("BaggageRule")
def _baggage_rules(t: StarTables) -> DataFrame:
    return t.source("region").selectExpr(
        "r_regionkey AS BaggageRuleID", "r_regionkey AS OperatorID", "CAST(20 + r_regionkey AS DECIMAL(6,2)) AS MaxWeightKG",
        "date'1995-01-01' AS EffectiveFrom", "CAST(NULL AS DATE) AS EffectiveTo",
    )


@derived("BookingBaggage")
def _baggage(t: StarTables) -> DataFrame:
    return _line_groups(t).selectExpr(
        "l_orderkey * 8 + l_linenumber AS BaggageID",
        "l_orderkey * 8 + l_linenumber AS BookingPassengerID",
        "CAST(quantity AS DECIMAL(6,2)) AS WeightKG",
        "false AS IsOverLimit",
        "CAST(0 AS DECIMAL(10,2)) AS ExcessFee",
    )


@derived("Excursion")
def _excursions(t: StarTables) -> DataFrame:
    return t.source("part").selectExpr(
        "p_partkey AS ExcursionID",
        f"p_partkey % {t.size('nation')} AS PortID",
        "concat(p_name, ' ', p_partkey) AS ExcursionName",
        "p_brand AS Description",
        "CAST(1 + p_size % 8 AS DECIMAL(5,2)) AS DurationHours",
        "CAST(p_retailprice AS DECIMAL(10,2)) AS Price",
    )


@derived("VoyageExcursion")
def _voyage_excursions(t: StarTables) -> DataFrame:
    voyages, routes = t.size("part"), 3 * t.size("nation")
    return (
        t.source("part")
        .selectExpr("p_partkey", "p_size", "explode(array(0, 1)) AS k")
        .selectExpr(
            "p_partkey * 2 + k AS VoyageExcursionID",
            "p_partkey AS VoyageID",
            f"p_partkey * 7 % {routes} * 8 + 1 + k AS RoutePortID",
            f"(p_partkey * 13 + k * 29) % {voyages} AS ExcursionID",
            "p_size AS AvailableSlots",
        )
    )


@derived("BookingExcursion")
def _booking_excursions(t: StarTables) -> DataFrame:
    return t.source("events").selectExpr(
        "event_id AS BookingExcursionID",
        f"event_id * 11 % {t.size('orders')} * 8 + 1 + event_id % 7 AS BookingPassengerID",
        f"event_id * 5 % {2 * t.size('part')} AS VoyageExcursionID",
        "ts AS BookingDateTime",
        "CASE event_type WHEN 'purchase' THEN 'Booked' WHEN 'click' THEN 'Completed' ELSE 'Cancelled' END AS ExcursionStatus",
        "CAST(value AS DECIMAL(10,2)) AS AmountPaid",
    )


@derived("BookingCancellation")
def _cancellations(t: StarTables) -> DataFrame:
    """One per cancelled booking, from 10 hours after departure to 109 hours before it."""
    voyage = f"(o_orderkey * 17 % {t.size('part')})"
    return (
        t.source("orders")
        .filter(f"{BOOKING_STATUS} = 'Cancelled'")
        .selectExpr(
            "o_orderkey AS CancellationID",
            "o_orderkey AS BookingID",
            f"{departure(voyage)} - make_dt_interval(0, int(o_orderkey % 120) - 10) AS CancellationDateTime",
            "o_orderpriority AS Reason",
            "CAST(0 AS DECIMAL(12,2)) AS PenaltyAmount",
            "CAST(0 AS DECIMAL(12,2)) AS RefundAmount",
            "CAST(NULL AS STRING) AS ProcessedBy",
        )
    )


@derived("RescheduleRequest")
def _reschedules(t: StarTables) -> DataFrame:
    voyages = t.size("part")
    voyage = f"(o_orderkey * 17 % {voyages})"
    return (
        t.source("orders")
        .filter(f"{BOOKING_STATUS} = 'Rescheduled'")
        .selectExpr(
            "o_orderkey AS RescheduleID",
            "o_orderkey AS OriginalBookingID",
            "CAST(NULL AS BIGINT) AS NewBookingID",
            f"{departure(voyage)} - make_dt_interval(0, int(o_orderkey % 100) - 5, 30) AS RequestDateTime",
            f"({voyage} + 7) % {voyages} AS NewVoyageID",
            "CAST(0 AS DECIMAL(12,2)) AS RescheduleFee",
            "'Requested' AS RequestStatus",
            "CAST(NULL AS STRING) AS Reason",
        )
    )


@derived("Payment")
def _payments(t: StarTables) -> DataFrame:
    return t.source("orders").selectExpr(
        "o_orderkey AS PaymentID",
        "o_orderkey AS BookingID",
        "o_orderdate AS PaymentDateTime",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS Amount",
        "o_orderpriority AS PaymentMethod",
        "CASE o_orderstatus WHEN 'F' THEN 'Paid' WHEN 'O' THEN 'Pending' ELSE 'Declined' END AS PaymentStatus",
        "CASE WHEN o_orderstatus <> 'P' THEN concat('TXN-', o_custkey, '-', date_format(o_orderdate, 'yyyyMMdd')) END AS TransactionReference",
    )


@derived("CancellationRequest")
def _cancellation_requests(t: StarTables) -> DataFrame:
    """Requests to cancel; some name no booking, many name one twice."""
    bookings = t.size("orders")
    return t.source("events").selectExpr(
        "event_id AS RequestID",
        f"event_id * 3 % {bookings * 21 // 20} AS BookingID",
        "event_type AS Reason",
        "concat('Agent', user_id) AS ProcessedBy",
    )
