"""One accepted and at least one rejected case per rule."""

import os
import time
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from pyspark.sql import functions as F
from seed import frame, raw_rows
from tidewake import session
from tidewake.operators import rules
from tidewake.operators.common import split_valid
from tidewake.plans.procedures import process_cancellations


def first_of(df, key):
    return {r[key]: r.first_violation for r in df.collect()}


def violations_of(df, key):
    return {r[key]: r.violations for r in df.collect()}


def variant(t, **changes):
    """The raw tables with some replaced by rows."""
    spark = t["Booking"].sparkSession
    return {**t, **{name: frame(spark, name, rows) for name, rows in changes.items()}}


def test_seed_is_clean(t):
    assert set(first_of(rules.check_booking_cabins(t), "BookingCabinID").values()) == {None}
    checked = rules.check_booking_passengers(t)
    valid, rejected = split_valid(checked)
    assert (valid.count(), rejected.count()) == (35, 0)
    fares = {r.BookingPassengerID: (r.FinalFare, r.FareRuleID, r.DailySupervisionFee) for r in checked.collect()}
    assert fares[7] == (Decimal("420.00"), None, Decimal("0.00"))
    assert fares[13] == (Decimal("600.00"), None, Decimal("0.00"))
    assert fares[17] == (Decimal("3800.00"), 30, Decimal("50.00"))
    assert fares[9] == (Decimal("1000.00"), 6, Decimal("0.00"))


def test_cabin_of_other_ship_and_double_booking(t):
    rows = raw_rows()["BookingCabin"]
    more = [
        (18, 1, 6, Decimal(0)),  # cabin 6 is on ship 2, voyage 1 on ship 1
        (19, 2, 1, Decimal(0)),  # cabin 1 is held by booking 1 on voyage 1
        (20, 8, 1, Decimal(0)),  # held by booking 5, but booking 8 is cancelled and holds nothing
        (21, 16, 25, Decimal(0)),
        (22, 15, 25, Decimal(0)),  # the second of two new rows
    ]
    got = first_of(rules.check_booking_cabins(variant(t, BookingCabin=rows + more)), "BookingCabinID")
    assert {k: v for k, v in got.items() if v} == {18: rules.WRONG_SHIP, 19: rules.DOUBLE_BOOKED, 22: rules.DOUBLE_BOOKED}
    batch = first_of(rules.check_booking_cabins(t, frame(t["Booking"].sparkSession, "BookingCabin", more)), "BookingCabinID")
    assert batch == {k: got[k] for k in range(18, 23)}


def test_misplaced_cabin_holds_nothing(t):
    rows = raw_rows()["BookingCabin"] + [(18, 1, 25, Decimal(0)), (19, 16, 25, Decimal(0))]
    got = first_of(rules.check_booking_cabins(variant(t, BookingCabin=rows)), "BookingCabinID")
    assert got[18] == rules.WRONG_SHIP and got[19] is None


def seat(key, booking, cabin, person, band, bed="NotApplicable", youth=False):
    return (key, booking, cabin, person, band, None, bed, youth, Decimal(0), Decimal(0))


def people(*births):
    return [(100 + i, f"Guest {i}", date.fromisoformat(b), f"Q{i}", "X", None, None, None) for i, b in enumerate(births)]


def check(t, seats, births, batch=True, **changes):
    base = variant(t, Passenger=raw_rows()["Passenger"] + people(*births), **changes)
    spark = t["Booking"].sparkSession
    new = frame(spark, "BookingPassenger", seats)
    if not batch:
        base["BookingPassenger"] = new
        new = None
    return violations_of(rules.check_booking_passengers(base, new), "BookingPassengerID")


def test_booking_must_match_cabin(t):
    assert check(t, [seat(50, 1, 2, 100, 1, "Cot")], ["1980-01-01"]) == {50: [rules.WRONG_BOOKING]}


def test_sixth_occupant(t):
    # cabin of booking 3 holds three of five
    seats = [seat(50 + i, 3, 3, 100 + i, 4) for i in range(4)]
    assert check(t, seats, ["1980-01-01"] * 4) == {50: [], 51: [], 52: [rules.CABIN_FULL], 53: [rules.CABIN_FULL]}


def test_limit_of_the_cabin_and_rejected_rows_take_no_place(t):
    # an interior cabin takes four; the second row is in the wrong band and takes no place
    seats = [seat(50 + i, 9, 10, 100 + i, 2 if i == 1 else 4) for i in range(6)]
    got = check(t, seats, ["1980-01-01"] * 6, batch=False)
    assert got == {50: [], 51: [rules.WRONG_AGE_BAND], 52: [], 53: [], 54: [], 55: [rules.CABIN_FULL]}


@pytest.mark.parametrize(
    "birth, band, bed, youth, want",
    [
        ("2008-08-01", 4, "NotApplicable", False, []),  # eighteen on the day of departure
        ("2008-08-02", 4, "NotApplicable", False, [rules.WRONG_AGE_BAND]),
        ("1966-08-02", 5, "NotApplicable", False, [rules.WRONG_AGE_BAND]),
        ("1966-08-01", 5, "NotApplicable", False, []),
        ("2025-08-02", 1, "NotApplicable", False, [rules.INFANT_NEEDS_BED]),
        ("1980-01-01", 4, "Cot", False, [rules.BED_NOT_ALLOWED]),
        ("2011-01-01", 3, "NotApplicable", True, []),
        ("2012-01-01", 3, "NotApplicable", True, [rules.YOUTH_NOT_ALLOWED]),  # fourteen
        ("1980-01-01", 4, "NotApplicable", True, [rules.YOUTH_NOT_ALLOWED]),
    ],
)
def test_row_rules(t, birth, band, bed, youth, want):
    # cabin of booking 1 has two adults; the minors among these cases are guarded
    assert check(t, [seat(50, 1, 1, 100, band, bed, youth)], [birth])[50] == want


def test_youth_needs_operator(t):
    assert check(t, [seat(50, 9, 10, 100, 3, youth=True)], ["2010-01-01"])[50] == [rules.YOUTH_NOT_ALLOWED]


def test_guardian(t):
    lone = [seat(50, 4, 5, 100, 2)]
    # the guardian of cabin 2 sits in cabin 3
    assert check(t, lone, ["2016-01-01"], batch=False)[50] == [rules.NO_GUARDIAN]
    both = [seat(49, 4, 4, 101, 4), *lone]
    assert check(t, both, ["2016-01-01", "1980-01-01"], batch=False) == {49: [], 50: []}
    # the set sees the whole batch, whatever the order
    later = [seat(50, 4, 5, 100, 2), seat(51, 4, 4, 101, 4)]
    assert check(t, later, ["2016-01-01", "1980-01-01"], batch=False) == {50: [], 51: []}
    assert check(t, both, ["2016-01-01", "1980-01-01"], batch=False, CabinAdjacency=[])[50] == [rules.NO_GUARDIAN]
    # stored rows guard a batch
    assert check(t, lone, ["2016-01-01"])[50] == []
    # a rejected adult guards nobody
    wrong = [seat(49, 4, 5, 101, 5), *lone]
    assert check(t, wrong, ["2016-01-01", "1980-01-01"], batch=False)[50] == [rules.NO_GUARDIAN]


def test_guardian_next_door_needs_a_holding_booking(t):
    bookings = [(*b[:4], "Completed" if b[0] == 4 else b[4], *b[5:]) for b in raw_rows()["Booking"]]
    both = [seat(49, 4, 4, 101, 4), seat(50, 4, 5, 100, 2)]
    assert check(t, both, ["2016-01-01", "1980-01-01"], batch=False, Booking=bookings)[50] == [rules.NO_GUARDIAN]
    same = [seat(49, 4, 5, 101, 4), seat(50, 4, 5, 100, 2)]
    assert check(t, same, ["2016-01-01", "1980-01-01"], batch=False, Booking=bookings)[50] == []


def test_unguarded_minor_keeps_the_place(t):
    # four places: a lone minor counts although it is rejected
    seats = [seat(50 + i, 9, 10, 100 + i, 2) for i in range(5)]
    got = check(t, seats, ["2016-01-01"] * 5, batch=False)
    assert got[53] == [rules.NO_GUARDIAN] and got[54] == [rules.CABIN_FULL, rules.NO_GUARDIAN]


def test_missing_fares(t):
    fares = [f for f in raw_rows()["FareRule"] if not (f[1] == 1 and f[2] == 1 and f[3] in (2, 4))]
    seats = [seat(50, 1, 1, 100, 4), seat(51, 1, 1, 101, 5), seat(52, 1, 1, 102, 1, "Cot")]
    got = check(t, seats, ["1980-01-01", "1960-01-01", "2026-01-01"], batch=False, FareRule=fares)
    assert got == {50: [rules.NO_FARE], 51: [], 52: [rules.NO_ADULT_FARE, rules.NO_CHILD_FARE]}


def test_latest_rule_in_force(t):
    extra = [(200, 1, 1, 4, Decimal(1100), date(2026, 5, 1), None), (201, 1, 1, 4, Decimal(900), date(2026, 6, 1), date(2026, 6, 9)), (202, 1, 1, 4, Decimal(1), date(2026, 6, 11), None)]
    base = variant(t, FareRule=raw_rows()["FareRule"] + extra)
    row = rules.check_booking_passengers(base).filter("BookingPassengerID = 1").first()
    assert (row.FinalFare, row.FareRuleID) == (Decimal(1100), 200)


def test_bands_of_one_name(t):
    check = lambda tables: {tuple(r) for r in rules.check_booking_passengers(tables).select("BookingPassengerID", "FinalFare", "FareRuleID").collect()}
    bands = raw_rows()["AgeCategory"]
    adult = next(b for b in bands if b[1] == "Adult")
    # No fare is in force for the second one; nor do many bands change a fare.
    more = [(900, *adult[1:])] + [(i, f"Band {i}", *adult[2:]) for i in range(901, 950)]
    assert check(variant(t, AgeCategory=[*bands, *more])) == check(t)


def policies(*rows):
    return [(i, 1, hours, kind, Decimal(value)) for i, (hours, kind, value) in enumerate(rows, 1)]


@pytest.mark.parametrize(
    "hours, rows, penalty",
    [
        (31, [(48, "FullForfeit", 100)], 7000),
        (49, [(72, "FullForfeit", 100)], 0),  # forfeits only within 48 hours
        (48, [(72, "FullForfeit", 100)], 7000),
        (60, [(48, "FullForfeit", 100), (72, "Percentage", 25)], 1750),
        (60, [(72, "FixedAmount", 50)], 50),
        (60, [(72, "FixedAmount", 9000)], 7000),
        (73, [(72, "Percentage", 25)], 0),  # no policy reaches that far
        (60, [], 0),
        (-5, [(48, "FullForfeit", 100)], 7000),
        (60, [(100, "Percentage", 50), (72, "Percentage", "12.345")], "864.50"),
    ],
)
def test_penalty(t, hours, rows, penalty):
    when = datetime(2026, 9, 10, 17) - timedelta(hours=hours)
    base = variant(t, CancellationPolicy=policies(*rows), BookingCancellation=[(1, 8, when, None, Decimal(0), Decimal(0), None)])
    row = rules.cancellation_amounts(base, base["BookingCancellation"]).first()
    assert (row.PenaltyAmount, row.RefundAmount) == (Decimal(penalty), Decimal(7000) - Decimal(penalty))
    assert row.HoursUntilDeparture == hours and row.violations == []


def test_penalty_without_booking(t):
    base = variant(t, BookingCancellation=[(1, 99, datetime(2026, 1, 1), None, Decimal(0), Decimal(0), None)])
    row = rules.cancellation_amounts(base, base["BookingCancellation"]).first()
    assert row.first_violation == rules.NO_VOYAGE and row.PenaltyAmount is None


def test_process_cancellations(t):
    spark = t["Booking"].sparkSession
    requests = spark.createDataFrame(
        [(1, 1, "r", "a"), (2, 99, "r", "a"), (3, 8, "r", "a"), (4, 9, "r", "a"), (5, 1, "r", "a"), (6, 2, "r", "a")],
        "RequestID int, BookingID int, Reason string, ProcessedBy string",
    )
    done = process_cancellations(t, requests, "2026-07-31 10:00:00")
    accepted = {r.RequestID: (r.PenaltyAmount, r.RefundAmount) for r in done.accepted.collect()}
    assert accepted == {1: (Decimal(2000), Decimal(0)), 6: (Decimal(3000), Decimal(0))}
    rejected = {r.RequestID: r.RejectReason for r in done.rejected.collect()}
    assert rejected == {
        2: "Booking not found.",
        3: "This booking cannot be cancelled in its current status.",
        4: "This booking cannot be cancelled in its current status.",
        5: "This booking cannot be cancelled in its current status.",
    }
    after = {r.BookingID: r.BookingStatus for r in done.booking.collect()}
    assert after[1] == after[2] == after[8] == "Cancelled" and after[3] == "Confirmed" and len(after) == 16
    # whole hours are truncated: half an hour after departure still passes, an hour does not
    one = requests.filter("RequestID = 1")
    assert process_cancellations(t, one, "2026-08-01 18:30:00").accepted.count() == 1
    late = process_cancellations(t, one, "2026-08-01 19:00:00").rejected.first()
    assert late.RejectReason == "Cannot cancel a voyage that has already departed."


def test_baggage(t):
    over = [r.BookingPassengerID for r in t["BookingBaggage"].filter("IsOverLimit").collect()]
    assert sorted(over) == [2, 8, 11, 19, 25, 29, 32]


def test_service_fee_snapshot(t):
    got = rules.snapshot_service_fees(t)
    assert {r.ServiceID: r.Fee for r in got.collect()}[1] == Decimal(35)
    assert {r.ServiceID: r.Fee for r in got.collect()}[5] == Decimal(50)
    rows = [(1, 3, 1, "Requested", Decimal(0)), (2, 3, 9, "Requested", Decimal(0))]
    got = rules.snapshot_service_fees(t, frame(t["Booking"].sparkSession, "PassengerSpecialService", rows))
    assert first_of(got, "PassengerServiceID") == {1: None, 2: rules.UNKNOWN_SERVICE}


def test_reschedule(t):
    def run(when, voyage=2, booked=None):
        bookings = [(b[0], booked or b[1], *b[2:5], Decimal(2000), b[6]) for b in raw_rows()["Booking"]]
        base = variant(t, Booking=bookings, RescheduleRequest=[(1, 1, None, when, voyage, Decimal(0), "Requested", None)])
        row = rules.check_reschedules(base).first()
        return row.violations, row.HoursUntilDeparture, row.RescheduleFee

    assert run(datetime(2026, 7, 1, 10)) == ([], 752, Decimal(0))
    assert run(datetime(2026, 7, 30, 18)) == ([], 48, Decimal(2000))
    assert run(datetime(2026, 7, 30, 17)) == ([], 49, Decimal(0))
    assert run(datetime(2026, 8, 1, 18))[0] == [rules.ALREADY_DEPARTED]
    assert run(datetime(2026, 7, 1, 10), booked=datetime(2025, 9, 10, 16))[0] == [rules.BEYOND_ONE_YEAR]
    assert run(datetime(2026, 7, 1, 10), booked=datetime(2025, 9, 10, 17))[0] == []
    assert run(datetime(2026, 7, 1, 10), voyage=999) == ([rules.UNKNOWN_NEW_VOYAGE], 752, None)


def test_stored_row_handed_in_again_keeps_its_cabin(t):
    again = t["BookingCabin"].filter("BookingCabinID = 1")
    assert rules.check_booking_cabins(t, again).first().violations == []


def test_birth_dates(t):
    got = first_of(rules.check_birth_dates(t, "2025-05-20"), "PassengerID")
    assert [k for k, v in got.items() if v] == [16] and got[16] == rules.FUTURE_BIRTH


def test_booking_without_passengers_costs_nothing(t):
    base = {**t, "BookingPassenger": t["BookingPassenger"].filter("BookingID <> 1")}
    assert rules.booking_totals(base).filter("BookingID = 1").first().TotalAmount == Decimal(0)
    assert rules.booking_totals(base).agg(F.sum("TotalAmount")).first()[0] == t["BookingPassenger"].filter("BookingID <> 1").agg(F.sum("FinalFare")).first()[0]


def test_row_checks_agree_with_the_full_job(t):
    want = {r.BookingPassengerID: r.FinalFare for r in rules.check_booking_passengers(t).collect()}
    got = rules.check_passenger_rows(t)
    assert {r.BookingPassengerID: r.FinalFare for r in got.collect()} == want
    assert split_valid(got)[1].count() == 0


def test_staged_folders_can_be_dropped(spark):
    from pyspark.errors import PySparkException

    kept = list(session._STAGED)
    session._STAGED.clear()
    df = session.stage(spark.range(5), "probe")
    assert df.count() == 5 and len(session._STAGED) == 1
    path = session._STAGED[0]
    session.drop_staged(spark)
    with pytest.raises(PySparkException):
        spark.read.parquet(path).count()
    session._STAGED.extend(kept)


def shuffle_files(spark):
    """Shuffle files in the session's folders."""
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    return {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def test_lean_staging_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    df = session.stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "probe", lean=True)
    left = shuffle_files(spark) - before
    for _ in range(50):
        if not left:
            break
        time.sleep(0.1)
        left = shuffle_files(spark) - before
    assert df.count() == 7 and not left
    session.unstage(df)


def test_steps_of_the_full_job_are_deleted(t, monkeypatch):
    """Of all that the job stages only the rows in context and the state per cabin outlast it."""
    monkeypatch.setattr(session, "_STAGED", [])
    spark = t["Booking"].sparkSession
    seats = [seat(50, 1, 1, 100, 4), seat(51, 1, 1, 101, 5)]
    labels = lambda: sorted(p.rsplit("/", 1)[1][:-33] for p in session._STAGED)
    assert len(check(t, seats, ["1980-01-01", "1960-01-01"])) == 2
    assert labels() == ["booked-passengers", "cabin-state"]
    session.drop_staged(spark)
    rules.check_passenger_rows(t).count()
    assert labels() == []


def test_slices_hold_all_rows(t, monkeypatch):
    """Joined slice by slice the job returns what it returns at once, rows without a cabin included."""
    spark = t["Booking"].sparkSession
    lost = spark.range(900, 903).selectExpr(
        "id AS BookingPassengerID", "1 AS BookingID", "nullif(id, 902) * 0 + nullif(id, 901) AS BookingCabinID", "1 AS PassengerID", "4 AS AgeCategoryID",
        "CAST(NULL AS BIGINT) AS FareRuleID", "'NotApplicable' AS InfantBedOption", "false AS IsChaperonedYouth",
        "CAST(0 AS DECIMAL(10,2)) AS DailySupervisionFee", "CAST(0 AS DECIMAL(12,2)) AS FinalFare",
    )
    base = {**t, "BookingPassenger": t["BookingPassenger"].unionByName(lost)}
    rows = lambda: sorted(map(repr, rules.check_booking_passengers(base).collect()))
    want = rows()
    monkeypatch.setattr(rules, "ROWS_IN_SLICE", 10)
    written = []
    monkeypatch.setattr(rules, "stage", lambda df, label, **more: written.append((label, len(more["slices"]))) or session.stage(df, label, **more))
    assert rows() == want and len(want) == 38
    assert dict(written)["booked-passengers"] == 4 and dict(written)["passengers"] == 0


def test_hot_cabin(t):
    """Thousands of claims on one cabin and one spot: the first ones win, nothing is dropped."""
    spark = t["Booking"].sparkSession
    claims = spark.range(100, 3100).selectExpr(
        "id AS BookingPassengerID", "3 AS BookingID", "3 AS BookingCabinID", "1 AS PassengerID", "4 AS AgeCategoryID",
        "'NotApplicable' AS InfantBedOption", "false AS IsChaperonedYouth",
    )
    seats = claims.selectExpr("*", "CAST(NULL AS INT) AS FareRuleID", "CAST(0 AS DECIMAL(10,2)) AS DailySupervisionFee", "CAST(0 AS DECIMAL(12,2)) AS FinalFare")
    got = rules.check_booking_passengers({**t, "BookingPassenger": seats})
    valid, rejected = split_valid(got)
    assert sorted(r.BookingPassengerID for r in valid.collect()) == [100, 101, 102, 103, 104]
    assert rejected.count() == 2995 and rejected.select("first_violation").distinct().count() == 1
    spots = spark.range(100, 3100).selectExpr("id AS BookingCabinID", "16 AS BookingID", "25 AS CabinID", "CAST(0 AS DECIMAL(12,2)) AS CabinPrice")
    checked = rules.check_booking_cabins({**t, "BookingCabin": spots})
    assert [r.BookingCabinID for r in checked.filter("first_violation IS NULL").collect()] == [100]
