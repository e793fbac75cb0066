"""Business rules as set-based jobs over whole tables.

A job takes candidate rows and reference tables and returns the rows with computed columns, an array
``violations`` holding the texts of the failed checks in checking order, and ``first_violation``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions import age_on, any_of, as_date, hours_until, money
from tidewake.operators.common import first_violation, violation_list
from tidewake.operators.lookups import effective_prices, effective_rule, guardian_nearby, threshold_policy
from tidewake.schema import HOLDING
from tidewake.session import stage, unstage
from tidewake.sources.tables import Tables

MAX_IN_CABIN = 5
FORFEIT_HOURS = 48
# Booked passengers that meet their cabins at a time, and parts they are cut in at most.
ROWS_IN_SLICE = 4_000_000
MOST_SLICES = 4

# Violation texts of the rules.
WRONG_SHIP = "Cabin must belong to the ship assigned to the booked voyage."
DOUBLE_BOOKED = "This cabin is already booked for the same voyage."
WRONG_BOOKING = "BookingPassenger.BookingID must match BookingCabin.BookingID."
CABIN_FULL = "A cabin can contain a maximum of 5 passengers only."
WRONG_AGE_BAND = "Passenger age category must match the passenger age at voyage departure."
INFANT_NEEDS_BED = "Infant passengers must have either SharedBed or Cot as InfantBedOption."
BED_NOT_ALLOWED = "InfantBedOption must be NotApplicable for non-infant passengers."
YOUTH_NOT_ALLOWED = "Chaperoned Youth is only allowed for age 15 to 17 when the operator supports the program."
NO_GUARDIAN = "Passengers aged 17 or below require an adult in the same or adjacent cabin unless approved for Chaperoned Youth."
NO_ADULT_FARE = "Adult fare rule is required to calculate SharedBed infant fare."
NO_CHILD_FARE = "Child fare rule is required to calculate Cot infant fare."
NO_FARE = "Fare rule is required for this voyage, cabin category, and age category."
NO_VOYAGE = "Invalid Booking or Voyage"
UNKNOWN_SERVICE = "Referenced SpecialService not found."
# Own wording; the rules behind these exist as prose only.
ALREADY_DEPARTED = "Cannot reschedule after the original voyage has departed."
BEYOND_ONE_YEAR = "New voyage must depart within one year of the original booking date."
UNKNOWN_BOOKING = "Original booking not found."
UNKNOWN_NEW_VOYAGE = "New voyage not found."
FUTURE_BIRTH = "Date of birth cannot be in the future."
WRONG_SERVICE_AGE = "Special service is not offered for the passenger's age at departure."


def _with_violations(df: DataFrame, *checks: tuple[Column, str]) -> DataFrame:
    return df.withColumn("violations", violation_list(*checks)).withColumn(
        "first_violation", first_violation(F.col("violations"))
    )


# --- cabins of a booking -------------------------------------------------------------------------


def _cabin_context(t: Tables, booking_cabins: DataFrame) -> DataFrame:
    bookings = (
        t["Booking"]
        .select("BookingID", "VoyageID", "BookingStatus")
        .join(t["CruiseVoyage"].select("VoyageID", F.col("ShipID").alias("_voyage_ship")), "VoyageID")
    )
    return (
        booking_cabins.select("BookingCabinID", "BookingID", "CabinID")
        .join(bookings, "BookingID", "left")
        .join(t["Cabin"].select("CabinID", F.col("ShipID").alias("_cabin_ship")), "CabinID", "left")
        .withColumn("_wrong_ship", F.coalesce(F.col("_voyage_ship") != F.col("_cabin_ship"), F.lit(False)))
    )


def check_booking_cabins(t: Tables, batch: DataFrame | None = None) -> DataFrame:
    """Cabin is on the voyage's ship, and no two pending or confirmed bookings hold it on a voyage.

    Without ``batch`` the whole table is checked. With it, the stored rows hold their cabins already.
    The first holder in key order wins: a minimum per (voyage, cabin), so a cabin claimed by very
    many bookings is aggregated on the map side and never sorted in one task. A row on the wrong
    ship is not stored and so holds nothing.
    """
    spot = ["VoyageID", "CabinID"]
    rows = _cabin_context(t, t["BookingCabin"] if batch is None else batch)
    holding = any_of("BookingStatus", HOLDING)
    # a condition inside the minimum instead of a filter keeps both uses of ``rows`` alike, so that
    # their shuffles are shared
    holder = F.when(holding & ~F.col("_wrong_ship"), F.col("BookingCabinID"))
    first = rows.groupBy(*spot).agg(F.min(holder).alias("_first"))
    rows = rows.join(first, spot, "left")
    taken = holding & (F.col("BookingCabinID") > F.col("_first"))
    if batch is not None:
        # A stored row that the batch changes holds nothing in its old form.
        others = t["BookingCabin"].join(batch.select("BookingCabinID").distinct(), "BookingCabinID", "left_anti")
        stored = (
            _cabin_context(t, others)
            .filter(holding & ~F.col("_wrong_ship"))
            .select(*spot)
            .distinct()
            .withColumn("_stored", F.lit(True))
        )
        rows = rows.join(stored, spot, "left")
        taken = holding & (F.coalesce("_stored", F.lit(False)) | (F.col("BookingCabinID") > F.col("_first")))
    checked = _with_violations(rows, (F.col("_wrong_ship"), WRONG_SHIP), (taken, DOUBLE_BOOKED))
    return checked.select(
        "BookingCabinID", "BookingID", "CabinID", "VoyageID", "BookingStatus", "violations", "first_violation"
    )


# --- booked passengers ---------------------------------------------------------------------------


def supervision_fee(t: Tables) -> Column:
    """Highest fee of the 'Chaperoned Youth' services, 0 without one, as a scalar subquery."""
    fees = t["SpecialService"].filter(F.col("ServiceType") == "Chaperoned Youth")
    fee = fees.agg(F.coalesce(F.max("Fee"), F.lit(0)).cast("decimal(10,2)").alias("fee"))
    return fee.scalar()


class _Fares(NamedTuple):
    """Fares per (VoyageID, CabinCategoryID, BookingDay), and how to read the one of a band."""

    rows: DataFrame
    of_band: Callable[[str], Column]
    of_own_band: Column
    own_rule: Column


def _fares_by_band(t: Tables, cabins: DataFrame) -> _Fares:
    """Fares in force per voyage, cabin category and booking day: all by band id, and those of adults and children.

    Of several bands with one name the lowest id counts.
    """
    keys = ["VoyageID", "CabinCategoryID", "BookingDay"]
    prices = effective_prices(
        cabins, t["FareRule"], keys[:2], "BookingDay", ["BaseFare", "FareRuleID"], extra_keys=["AgeCategoryID"]
    )
    named = prices.join(t["AgeCategory"].select("AgeCategoryID", "CategoryName"), "AgeCategoryID")

    def of_name(name: str) -> Column:
        mine = F.col("CategoryName") == name
        return F.min_by(F.when(mine, F.col("BaseFare")), F.when(mine, F.col("AgeCategoryID"))).alias(f"_fare_{name}")

    # The map has one entry per band.
    entry = F.struct("AgeCategoryID", F.struct("BaseFare", "FareRuleID"))
    fares = F.map_from_entries(F.collect_list(entry)).alias("_fares")
    rows = named.groupBy(*keys).agg(fares, of_name("Adult"), of_name("Child"))
    own = F.try_element_at("_fares", F.col("AgeCategoryID"))
    return _Fares(rows, lambda band: F.col(f"_fare_{band}"), own["BaseFare"], own["FareRuleID"])


def _no_fares() -> _Fares:
    """For jobs that ask for no fare: nothing is joined."""
    none = F.lit(None).cast("decimal(12,2)")
    return _Fares(None, lambda band: none, none, F.lit(None).cast("bigint"))


def _lazily(df: DataFrame, label: str, *done: DataFrame, sliced_by: str | None = None) -> DataFrame:
    """For jobs of one pass: nothing is staged."""
    return df


def _in_steps(df: DataFrame, label: str, *done: DataFrame, sliced_by: str | None = None) -> DataFrame:
    """Staged; the steps before it that nothing else reads are deleted.

    With ``sliced_by``, the key of its join, a large one is joined slice by slice; the first of ``done`` has
    as many rows. The hash is not the one that deals rows to partitions.
    """
    n = min(MOST_SLICES, 1 + done[0].count() // ROWS_IN_SLICE) if sliced_by else 1
    slices = [F.pmod(F.xxhash64(sliced_by), F.lit(n)) == i for i in range(n)] if n > 1 else []
    staged = stage(df, label, lean=True, slices=slices)
    unstage(*done)
    return staged


def _booked_cabins(t: Tables, priced: bool, keep: Callable[..., DataFrame]) -> tuple[DataFrame, _Fares]:
    """Booked cabins with voyage, operator flag, limits and, if asked for, fares; the context of their passengers.

    Sailings meet the bookings, which are fewer and narrower than cabins with fares.
    """
    sailings = (
        t["CruiseVoyage"]
        .select("VoyageID", "ShipID", "DepartureDateTime")
        .join(t["CruiseShip"].select("ShipID", "OperatorID"), "ShipID")
        .join(t["CruiseOperator"].select("OperatorID", "AllowsChaperonedYouth"), "OperatorID")
        .select("VoyageID", "DepartureDateTime", "AllowsChaperonedYouth")
    )
    bookings = (
        t["Booking"]
        .select(
            F.col("BookingID").alias("_cabin_booking"),
            "VoyageID",
            any_of("BookingStatus", HOLDING).alias("_holding"),
            as_date("BookingDate").alias("BookingDay"),
        )
        .join(sailings, "VoyageID", "left")
    )
    cabins = (
        t["BookingCabin"]
        .select("BookingCabinID", F.col("BookingID").alias("_cabin_booking"), "CabinID")
        .join(t["Cabin"].select("CabinID", "MaxOccupancy", "CabinCategoryID"), "CabinID", "left")
        .join(bookings, "_cabin_booking", "left")
    )
    if not priced:
        return cabins, _no_fares()
    cabins = keep(cabins, "booked-cabins")
    fares = _fares_by_band(t, cabins)
    keys = ["VoyageID", "CabinCategoryID", "BookingDay"]
    return keep(cabins.join(fares.rows, keys, "left").drop(*keys[1:]), "priced-cabins", cabins), fares


_SEAT = ("BookingPassengerID", "BookingID", "BookingCabinID", "PassengerID", "AgeCategoryID", "InfantBedOption", "IsChaperonedYouth")
_LOCAL_FLAGS = (
    "_wrong_booking",
    "_wrong_band",
    "_no_bed",
    "_odd_bed",
    "_youth_refused",
    "_no_adult_fare",
    "_no_child_fare",
    "_no_fare",
)
# Bits of the column ``_flags``.
_FLAGS = (*_LOCAL_FLAGS, "_needs_guardian")


def _flag(*names: str) -> Column:
    """Whether one of the flags is set; an unknown one is not."""
    return F.col("_flags").bitwiseAND(sum(1 << _FLAGS.index(name) for name in names)) != 0


def _passenger_context(
    t: Tables, rows: DataFrame, priced: bool = True, keep: Callable[..., DataFrame] = _lazily, done: Sequence[DataFrame] = ()
) -> DataFrame:
    """Rows with everything the row-local checks need, already reduced to flags and amounts.

    Rows meet passengers while they are narrow, and cabins last, so that rows of a cabin leave together.
    ``done`` are staged frames that nothing reads once the passengers are met.
    """
    people = t["Passenger"].select("PassengerID", "DateOfBirth")
    bands = t["AgeCategory"].select("AgeCategoryID", "CategoryName", "MinAge", "MaxAge")
    booked, fares = _booked_cabins(t, priced, keep)
    seats = keep(rows.select(*_SEAT, "_stored").join(people, "PassengerID", "left"), "passengers", *done)
    df = (
        seats.join(booked, "BookingCabinID", "left")
        .join(bands, "AgeCategoryID", "left")
        .withColumn("_age", age_on("DateOfBirth", "DepartureDateTime"))
    )
    infant = F.col("CategoryName") == "Infant"
    bed = F.col("InfantBedOption")
    chaperoned = F.col("IsChaperonedYouth")

    adult, child, own = fares.of_band("Adult"), fares.of_band("Child"), fares.of_own_band
    infant_fare = F.when(bed == "SharedBed", adult * F.expr("0.15BD")).otherwise(child * F.expr("0.50BD"))
    asked = F.lit(priced)
    no_adult = asked & infant & adult.isNull()
    no_child = asked & infant & child.isNull()
    no_own = asked & ~infant & own.isNull()
    has_fare = ~(no_adult | no_child | no_own)
    flags = {
        "_wrong_booking": F.col("_cabin_booking") != F.col("BookingID"),
        "_wrong_band": (F.col("_age") < F.col("MinAge")) | F.coalesce(F.col("_age") > F.col("MaxAge"), F.lit(False)),
        "_no_bed": infant & ~bed.isin("SharedBed", "Cot"),
        "_odd_bed": ~infant & (bed != "NotApplicable"),
        "_youth_refused": chaperoned
        & (~F.col("AllowsChaperonedYouth") | (F.col("CategoryName") != "Teen") | ~F.col("_age").between(15, 17)),
        "_no_adult_fare": no_adult,
        "_no_child_fare": no_child,
        "_no_fare": no_own,
        "_needs_guardian": (F.col("_age") <= 17) & ~chaperoned,
    }
    bits = [F.when(flags[name], F.lit(1 << i)).otherwise(F.lit(0)) for i, name in enumerate(_FLAGS)]
    context = df.select(
        *_SEAT,
        "VoyageID",
        "CabinID",
        "_stored",
        F.col("_age").alias("AgeAtDeparture"),
        "_holding",
        F.least("MaxOccupancy", F.lit(MAX_IN_CABIN)).alias("_cap"),
        (F.col("MinAge") >= 18).alias("_adult"),
        reduce(Column.bitwiseOR, bits).alias("_flags"),
        F.when(~infant, fares.own_rule).alias("FareRuleID"),
        F.when(has_fare, money(F.when(infant, infant_fare).otherwise(own))).alias("FinalFare"),
    )
    return keep(context, "booked-passengers", seats, booked, sliced_by="BookingCabinID")


_COMPUTED = ("FareRuleID", "DailySupervisionFee", "FinalFare")
# Texts in checking order; a flag of None comes from the passes over other passengers.
_CHECKS = (
    (CABIN_FULL, None),
    (WRONG_AGE_BAND, "_wrong_band"),
    (INFANT_NEEDS_BED, "_no_bed"),
    (BED_NOT_ALLOWED, "_odd_bed"),
    (YOUTH_NOT_ALLOWED, "_youth_refused"),
    (NO_GUARDIAN, None),
    (NO_ADULT_FARE, "_no_adult_fare"),
    (NO_CHILD_FARE, "_no_child_fare"),
    (NO_FARE, "_no_fare"),
)


def _passenger_result(t: Tables, df: DataFrame, group_flags: dict[str, Column]) -> DataFrame:
    right = ~_flag("_wrong_booking")
    flags = [(text, _flag(flag) if flag else group_flags.get(text)) for text, flag in _CHECKS]
    checked = _with_violations(
        df,
        (_flag("_wrong_booking"), WRONG_BOOKING),
        *[(right & flag, text) for text, flag in flags if flag is not None],
    )
    fee = F.when(F.col("IsChaperonedYouth"), supervision_fee(t)).otherwise(F.lit(0).cast("decimal(10,2)"))
    computed = {"FareRuleID": F.col("FareRuleID"), "DailySupervisionFee": fee, "FinalFare": F.col("FinalFare")}
    return checked.select(
        *_SEAT,
        "AgeAtDeparture",
        *[F.when(right, computed[c]).alias(c) for c in _COMPUTED],
        "violations",
        "first_violation",
    )


def _cabin_state(t: Tables, context: DataFrame) -> DataFrame:
    """Per booked cabin: how many rows are stored, the last of them, and whether an adult is near.

    Rows that are stored already are only counted, however many there are. Of the new rows the survivors
    of the row-local checks take the places left, in key order. Their rank is cut at the hard limit
    before the shuffle, so at most five rows per cabin leave a map task.
    """
    cabins = context.groupBy("BookingCabinID").agg(
        F.max("VoyageID").alias("VoyageID"),
        F.max("CabinID").alias("CabinID"),
        F.max("_holding").alias("_holding"),
        F.count_if("_stored").alias("_held"),
        F.max(F.col("_stored") & F.col("_adult")).alias("_adult_held"),
    )
    order = Window.partitionBy("BookingCabinID").orderBy("BookingPassengerID")
    first = (
        context.filter(~F.col("_stored") & ~_flag(*_LOCAL_FLAGS))
        .select("BookingCabinID", "BookingPassengerID", "_cap", "_adult")
        .withColumn("_place", F.row_number().over(order))
        .filter(F.col("_place") <= MAX_IN_CABIN)
    )
    stays = F.col("_place") <= F.col("_cap") - F.col("_held")
    # One row per cabin before the join, so all of it is grouped where it meets.
    seated = (
        cabins.join(first, "BookingCabinID", "left")
        .groupBy("BookingCabinID")
        .agg(
            F.max("VoyageID").alias("VoyageID"),
            F.max("CabinID").alias("CabinID"),
            F.max("_holding").alias("_holding"),
            (F.max("_held") + F.count_if(stays)).alias("_seated"),
            F.max(F.when(stays, F.col("BookingPassengerID"))).alias("_last"),
            (F.coalesce(F.max("_adult_held"), F.lit(False)) | F.coalesce(F.max(stays & F.col("_adult")), F.lit(False))).alias("_has_adult"),
        )
    )
    state = _in_steps(seated, "cabin-state")
    near = guardian_nearby(
        state.filter(F.col("_has_adult") & F.col("_holding")), t["CabinAdjacency"]
    ).withColumn("_near", F.lit(True))
    # Only cabins without an adult ask for a neighbour's.
    alone = state.filter(~F.col("_has_adult")).select("BookingCabinID", "VoyageID", "CabinID")
    helped = alone.join(near, ["VoyageID", "CabinID"]).select("BookingCabinID", "_near")
    return state.join(helped, "BookingCabinID", "left").select(
        "BookingCabinID",
        "_seated",
        "_last",
        (F.coalesce("_has_adult", F.lit(False)) | F.coalesce("_near", F.lit(False))).alias("_guarded"),
    )


def check_booking_passengers(t: Tables, batch: DataFrame | None = None) -> DataFrame:
    """All checks and computed amounts of booked passengers.

    Checks, in order: booking of the cabin, cabin capacity, age band, infant bed, chaperoned youth,
    adult guardian, fare. A row whose cabin belongs to another booking is rejected for that alone,
    since the other checks presuppose the right booking. Rows are taken in key order; a rejected row
    occupies nothing and guards nobody, except that a minor rejected for want of a guardian keeps its
    place. With ``batch`` the table's rows are stored already: they occupy and guard, and only the
    batch is returned.

    The context is built in staged steps, of which each holds the shuffle files of its own joins only, and
    is staged itself; so is the state per cabin. The later passes read narrow columns.
    """
    done = []
    if batch is None:
        rows = t["BookingPassenger"].withColumn("_stored", F.lit(False))
    else:
        # A stored row that the batch changes counts in its new form only.
        new = _in_steps(batch.select(*_SEAT), "batch")
        others = t["BookingPassenger"].select(*_SEAT).join(new.select("BookingPassengerID").distinct(), "BookingPassengerID", "left_anti")
        rows = new.withColumn("_stored", F.lit(False)).unionByName(others.withColumn("_stored", F.lit(True)))
        rows = _in_steps(rows, "seats", new)
        done = [rows]
    context = _passenger_context(t, rows, keep=_in_steps, done=done)
    df = context.filter(~F.col("_stored")).join(_cabin_state(t, context), "BookingCabinID", "left")
    full = (F.col("_cap") < 1) | (
        (F.coalesce("_seated", F.lit(0)) >= F.col("_cap"))
        & (F.col("_last").isNull() | (F.col("BookingPassengerID") > F.col("_last")))
    )
    lone = _flag("_needs_guardian") & ~F.coalesce("_guarded", F.lit(False))
    return _passenger_result(t, df, {CABIN_FULL: full, NO_GUARDIAN: lone})


def check_passenger_rows(t: Tables, rows: DataFrame | None = None, fares: bool = True) -> DataFrame:
    """The checks of booked passengers that need no other passenger, with the computed amounts.

    Capacity and guardian are left out, so nothing is staged: one pass over the rows. Without ``fares``
    no fare rule is read: fares are NULL and their absence is no violation.
    """
    rows = (t["BookingPassenger"] if rows is None else rows).withColumn("_stored", F.lit(False))
    return _passenger_result(t, _passenger_context(t, rows, fares), {})


# --- cancellations -------------------------------------------------------------------------------


def booking_value(t: Tables) -> DataFrame:
    """Bookings with what a penalty depends on: status, total, operator and departure."""
    sailings = (
        t["CruiseVoyage"]
        .select("VoyageID", "ShipID", "DepartureDateTime")
        .join(t["CruiseShip"].select("ShipID", "OperatorID"), "ShipID")
    )
    return (
        t["Booking"]
        .select("BookingID", "VoyageID", "BookingStatus", "TotalAmount")
        .join(sailings, "VoyageID")
        .select("BookingID", "BookingStatus", "TotalAmount", "OperatorID", "DepartureDateTime")
    )


def with_penalty(t: Tables, rows: DataFrame) -> DataFrame:
    """Penalty and refund for rows that carry ``booking_value`` and a CancellationDateTime.

    The operator's policy is the one with the smallest threshold at or above the hours left. A full
    forfeit applies within 48 hours only; later thresholds of that type cost nothing.
    """
    timed = rows.withColumn("HoursUntilDeparture", hours_until("CancellationDateTime", "DepartureDateTime"))
    priced = threshold_policy(timed, t["CancellationPolicy"], "HoursUntilDeparture")
    kind, value, whole = F.col("PenaltyType"), F.col("PenaltyValue"), F.col("TotalAmount")
    penalty = (
        F.when((F.col("HoursUntilDeparture") <= FORFEIT_HOURS) & (kind == "FullForfeit"), whole)
        .when(kind == "Percentage", money(whole * (value / 100)))
        .when(kind == "FixedAmount", money(F.least(value, whole)))
        .otherwise(F.lit(0).cast("decimal(12,2)"))
    )
    priced = priced.withColumn("PenaltyAmount", F.when(whole.isNotNull(), money(penalty))).withColumn(
        "RefundAmount", money(whole - F.col("PenaltyAmount"))
    )
    return _with_violations(priced, (F.col("DepartureDateTime").isNull(), NO_VOYAGE)).drop(
        "DepartureDateTime", "BookingStatus"
    )


def cancellation_amounts(t: Tables, cancellations: DataFrame) -> DataFrame:
    """Cancellations (BookingID, CancellationDateTime) with penalty and refund filled in."""
    rows = cancellations.drop("PenaltyAmount", "RefundAmount")
    return with_penalty(t, rows.join(booking_value(t), "BookingID", "left"))


def mark_cancelled(bookings: DataFrame, cancellations: DataFrame) -> DataFrame:
    """A new version of the bookings in which every cancelled one has status 'Cancelled'."""
    gone = cancellations.select("BookingID").distinct().withColumn("_gone", F.lit(True))
    status = F.when(F.col("_gone"), F.lit("Cancelled")).otherwise(F.col("BookingStatus"))
    return (
        bookings.join(gone, "BookingID", "left")
        .withColumn("BookingStatus", status)
        .select(*bookings.columns)
    )


# --- totals, baggage, services, rescheduling, birth dates ----------------------------------------


def booking_totals(t: Tables) -> DataFrame:
    """A new version of the bookings whose total is the sum of the passengers' fares, 0 without any."""
    sums = t["BookingPassenger"].groupBy("BookingID").agg(F.sum("FinalFare").alias("_sum"))
    whole = money(F.coalesce(F.col("_sum").cast("decimal(12,2)"), F.lit(0).cast("decimal(12,2)")))
    return (
        t["Booking"]
        .join(sums, "BookingID", "left")
        .withColumn("TotalAmount", whole)
        .select(*t["Booking"].columns)
    )


def check_baggage(t: Tables) -> DataFrame:
    """Baggage with ``IsOverLimit`` set against the voyage's limit; the fee is left alone."""
    limits = (
        t["BookingPassenger"]
        .select("BookingPassengerID", "BookingID")
        .join(t["Booking"].select("BookingID", "VoyageID"), "BookingID")
        .join(t["CruiseVoyage"].select("VoyageID", "BaggageWeightLimitKG"), "VoyageID")
        .select("BookingPassengerID", "BaggageWeightLimitKG")
    )
    return (
        t["BookingBaggage"]
        .join(limits, "BookingPassengerID", "left")
        .withColumn("IsOverLimit", F.col("WeightKG") > F.col("BaggageWeightLimitKG"))
        .select(*t["BookingBaggage"].columns)
    )


def check_baggage_by_operator(t: Tables) -> DataFrame:
    """Baggage with ``IsOverLimit`` against the voyage's limit, or where it has none the operator's rule.

    The rule is the one in force on the day of departure; without limit and rule the flag is NULL. Days
    are looked up once per operator and departure day, not per bag.
    """
    sailings = t["CruiseVoyage"].select(
        "VoyageID", "ShipID", "BaggageWeightLimitKG", as_date("DepartureDateTime").alias("_day")
    ).join(t["CruiseShip"].select("ShipID", "OperatorID"), "ShipID")
    ruled = effective_rule(sailings, t["BaggageRule"], ["OperatorID"], "_day", ["MaxWeightKG"])
    limits = ruled.select("VoyageID", F.coalesce("BaggageWeightLimitKG", "MaxWeightKG").alias("LimitKG"))
    seats = (
        t["BookingPassenger"]
        .select("BookingPassengerID", "BookingID")
        .join(t["Booking"].select("BookingID", "VoyageID"), "BookingID")
        .join(limits, "VoyageID")
        .select("BookingPassengerID", "LimitKG")
    )
    bags = t["BookingBaggage"]
    judged = bags.join(seats, "BookingPassengerID", "left").withColumn("IsOverLimit", F.col("WeightKG") > F.col("LimitKG"))
    return judged.select(*bags.columns, "LimitKG")


def check_service_ages(t: Tables) -> DataFrame:
    """Service requests of passengers too young or too old for the service at departure.

    An open limit (NULL) refuses nobody; a request whose service, passenger or voyage is unknown is left
    to the reference audits.
    """
    limits = t["SpecialService"].select("ServiceID", "AgeRestrictionMin", "AgeRestrictionMax")
    ages = (
        t["BookingPassenger"]
        .select("BookingPassengerID", "BookingID", "PassengerID")
        .join(t["Booking"].select("BookingID", "VoyageID"), "BookingID")
        .join(t["CruiseVoyage"].select("VoyageID", "DepartureDateTime"), "VoyageID")
        .join(t["Passenger"].select("PassengerID", "DateOfBirth"), "PassengerID")
        .select("BookingPassengerID", age_on("DateOfBirth", "DepartureDateTime").alias("AgeAtDeparture"))
    )
    rows = t["PassengerSpecialService"]
    judged = rows.join(limits, "ServiceID", "left").join(ages, "BookingPassengerID", "left")
    age = F.col("AgeAtDeparture")
    refused = (age < F.col("AgeRestrictionMin")) | (age > F.col("AgeRestrictionMax"))
    checked = _with_violations(judged, (F.coalesce(refused, F.lit(False)), WRONG_SERVICE_AGE))
    return checked.select(*rows.columns, "AgeAtDeparture", "violations", "first_violation")


def snapshot_service_fees(t: Tables, requests: DataFrame | None = None) -> DataFrame:
    """Service requests with the catalogue fee of now copied in; an unknown service is a violation."""
    rows = t["PassengerSpecialService"] if requests is None else requests
    catalogue = t["SpecialService"].select("ServiceID", F.col("Fee").alias("_fee"))
    priced = rows.join(catalogue, "ServiceID", "left").withColumn("Fee", F.col("_fee"))
    checked = _with_violations(priced, (F.col("_fee").isNull(), UNKNOWN_SERVICE))
    return checked.select(*rows.columns, "violations", "first_violation")


def check_reschedules(t: Tables) -> DataFrame:
    """Reschedule requests with the fee: nothing, or the whole total within 48 hours of departure.

    A request whose original booking or new voyage is unknown is a violation without a fee.
    """
    sailings = t["CruiseVoyage"].select("VoyageID", "DepartureDateTime")
    original = (
        t["Booking"]
        .select(F.col("BookingID").alias("OriginalBookingID"), "BookingDate", "VoyageID", "TotalAmount")
        .join(sailings.withColumnRenamed("DepartureDateTime", "_old"), "VoyageID")
        .drop("VoyageID")
    )
    planned = sailings.select(F.col("VoyageID").alias("NewVoyageID"), F.col("DepartureDateTime").alias("_new"))
    rows = t["RescheduleRequest"]
    hours = hours_until("RequestDateTime", "_old")
    fee = F.when(hours <= FORFEIT_HOURS, F.col("TotalAmount")).otherwise(F.lit(0).cast("decimal(12,2)"))
    joined = (
        rows.join(original, "OriginalBookingID", "left")
        .join(planned, "NewVoyageID", "left")
        .withColumn("HoursUntilDeparture", hours)
        .withColumn("RescheduleFee", money(fee))
    )
    unknown_old, unknown_new = F.col("_old").isNull(), F.col("_new").isNull()
    joined = joined.withColumn("RescheduleFee", F.when(~unknown_old & ~unknown_new, F.col("RescheduleFee")))
    checked = _with_violations(
        joined,
        (unknown_old, UNKNOWN_BOOKING),
        (unknown_new, UNKNOWN_NEW_VOYAGE),
        (F.col("RequestDateTime") >= F.col("_old"), ALREADY_DEPARTED),
        (F.col("_new") > F.col("BookingDate") + F.expr("interval 1 year"), BEYOND_ONE_YEAR),
    )
    return checked.select(*rows.columns, "HoursUntilDeparture", "violations", "first_violation")


def check_birth_dates(t: Tables, as_of: dt.date | str) -> DataFrame:
    """Passengers whose birth date lies after ``as_of`` get a violation."""
    day = F.lit(str(as_of)).cast("date")
    return _with_violations(t["Passenger"], (F.col("DateOfBirth") > day, FUTURE_BIRTH))
