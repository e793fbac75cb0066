"""Running totals, chains, slots, periods, the waiting list, accounts, versions, deltas and levels."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from seed import frame, raw_rows
from tidewake.operators import capacity, chains, deltas, intervals, ledger, rules
from tidewake.operators.ranking import global_rank
from tidewake.operators.rollup import grouping_sets
from tidewake.operators.running import Running, running
from tidewake.session import staging_root
from tidewake.sources import versions


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small tables would be one range; keep every partition so that groups cross ranges."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def table(spark, name, rows):
    return frame(spark, name, rows)


# --- running totals --------------------------------------------------------------------------------


def brute_running(rows):
    """(sum with the row, greatest before the row) per group, by place."""
    out = {}
    for group in {g for g, _, _ in rows}:
        total, most = None, None
        for _, place, v in sorted((r for r in rows if r[0] == group), key=lambda r: r[1]):
            total_before = total
            if v is not None:
                total = (total or 0) + v
            out[group, place] = (total if v is not None or total_before is not None else None, most)
            if v is not None:
                most = v if most is None else max(most, v)
    return out


def test_running_across_ranges(spark):
    rng = random.Random(1)
    # a third of the rows are one group, which covers several ranges; NULL is a group of its own
    rows = [(rng.choice([7, 7, rng.randrange(60), None]), i, rng.choice([None, 1, 2, 5, -3])) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, place int, v int").repartition(5)
    got = running(df, ["g"], [F.asc("place")], {"s": Running(F.col("v")), "m": Running(F.col("v"), "max", with_row=False)})
    assert got.columns == ["g", "place", "v", "s", "m"]
    assert {(r.g, r.place): (r.s, r.m) for r in got.collect()} == brute_running(rows)
    whole = running(df, [], [F.desc("place")], {"n": Running(F.lit(1))})
    assert {(r.place, r.n) for r in whole.collect()} == {(i, 3000 - i) for i in range(3000)}
    assert running(df.limit(0), ["g"], [F.asc("place")], {"s": Running(F.col("v"))}).count() == 0


def test_global_rank(spark):
    rng = random.Random(2)
    values = [rng.choice([None, Decimal(rng.randrange(90)), Decimal("5.50")]) for _ in range(800)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v decimal(12,2)")
    key = lambda v: Decimal(-1) if v is None else v
    want = {i: 1 + sum(key(o) > key(v) for o in values) for i, v in enumerate(values)}
    assert {r.id: r.place for r in global_rank(df, "v", "place").collect()} == want


# --- chains ----------------------------------------------------------------------------------------


def bookings(spark, links):
    """(id, original) pairs; the booking date follows the id."""
    day = datetime(2026, 1, 1)
    return {"Booking": table(spark, "Booking", [(i, day + timedelta(minutes=i), 1, 1, "Confirmed", Decimal(0), o) for i, o in links])}


def chained(t):
    return {r.BookingID: (r.RootBookingID, r.Depth, r.LatestBookingID, r.first_violation) for r in chains.reschedule_chains(t).collect()}


def test_chain_of_ten_thousand(spark):
    n = 10_000
    got = chained(bookings(spark, [(i, i - 1 if i else None) for i in range(n)]))
    assert got == {i: (0, i, n - 1, None) for i in range(n)}


def test_chain_cases(spark):
    links = [(1, None), (2, 1), (3, 1), (4, 3), (5, None), (6, 99), (7, 6), (8, 8), (9, 10), (10, 11), (11, 9), (12, 11), (13, 12)]
    got = chained(bookings(spark, links))
    assert {i: got[i] for i in (1, 2, 3, 4)} == {1: (1, 0, 4, None), 2: (1, 1, 4, None), 3: (1, 1, 4, None), 4: (1, 2, 4, None)}
    assert got[5] == (5, 0, 5, None)
    assert got[6] == (6, 0, 7, chains.UNKNOWN_ORIGINAL) and got[7] == (6, 1, 7, None)
    # circles of one and of three, and two bookings that lead into the latter
    assert all(got[i] == (None, None, None, chains.CIRCULAR) for i in (8, 9, 10, 11, 12, 13))
    assert chained(bookings(spark, [])) == {}


def test_many_replacements_of_one_booking(spark):
    got = chained(bookings(spark, [(0, None), *[(i, 0) for i in range(1, 400)], (400, 17)]))
    assert got[400] == (0, 2, 400, None) and got[0] == (0, 0, 400, None)
    assert all(got[i] == (0, 1, 400, None) for i in range(1, 400))


# --- slots and the waiting list --------------------------------------------------------------------


def test_slots_of_a_hot_offer(spark):
    """A third of all sales are of one offer, sold in no order; cancelled ones take no slot."""
    rng = random.Random(3)
    day = datetime(2026, 7, 1)
    sales = []
    for i in range(1500):
        offer = 1 if i % 3 == 0 else rng.randrange(2, 200)
        sales.append((i, 1, offer, day + timedelta(minutes=rng.randrange(300)), rng.choice(["Booked", "Completed", "Cancelled"]), Decimal(1)))
    t = {
        "BookingExcursion": table(spark, "BookingExcursion", sales).repartition(6),
        "VoyageExcursion": table(spark, "VoyageExcursion", [(o, 1, 1, 1, 120 if o == 1 else o % 4) for o in range(1, 190)]),
    }
    want = {}
    for offer in {s[2] for s in sales}:
        slots = None if offer >= 190 else 120 if offer == 1 else offer % 4
        place = 0
        for s in sorted((s for s in sales if s[2] == offer), key=lambda s: (s[3], s[0])):
            place += s[4] != "Cancelled"
            mine = place if s[4] != "Cancelled" else None
            text = capacity.UNKNOWN_OFFER if slots is None else capacity.NO_SLOT if mine and mine > slots else None
            want[s[0]] = (mine, slots, text)
    got = {r.BookingExcursionID: (r.SalePlace, r.AvailableSlots, r.first_violation) for r in capacity.check_excursion_slots(t).collect()}
    assert got == want
    assert sum(v[2] == capacity.NO_SLOT for k, v in want.items() if k % 3 == 0) > 100


def test_waiting_list(spark):
    rows = raw_rows()
    day = datetime(2026, 5, 1)
    status = ["Confirmed", "Cancelled", "Rescheduled", "Waitlisted", "Waitlisted", "Waitlisted", "Waitlisted", "Completed"]
    book = [(i, day + timedelta(days=-i if i == 6 else i), 1, 1, s, Decimal(0), None) for i, s in enumerate(status, 1)]
    # cabins 1 (category 1), 2 and 3 (category 2), 4 (category 3); booking 2 gave up 2 and 4, booking 3 gave up 3 and 1, which 1 holds
    cabins = [(1, 1, 1), (2, 2, 2), (3, 2, 4), (4, 3, 3), (5, 3, 1), (6, 4, 2), (7, 4, 4), (8, 5, 3), (9, 6, 2), (10, 7, 1), (11, 8, 4)]
    t = {
        "Booking": table(spark, "Booking", book),
        "BookingCabin": table(spark, "BookingCabin", [(*c, Decimal(0)) for c in cabins]),
        "Cabin": table(spark, "Cabin", rows["Cabin"]),
    }
    got = {r.BookingID: (r.CabinCategoryID, r.Place, r.CabinID) for r in capacity.promote_waitlisted(t).collect()}
    # category 2: booking 6 was made first, then 4 and 5; cabins 2 and 3 are free; cabin 1 is held, cabin 4 was used by booking 8
    assert got == {6: (2, 1, 2), 4: (2, 2, 3), 5: (2, 3, None), 7: (1, 1, None)}


# --- periods ---------------------------------------------------------------------------------------


def test_overlaps_against_all_pairs(spark):
    rng = random.Random(4)
    day = date(2026, 1, 1)
    rules_ = []
    for i in range(900):
        start = day + timedelta(days=rng.randrange(2500))
        end = None if i % 200 == 3 else start + timedelta(days=rng.randrange(4))
        rules_.append((i, 0 if i % 3 == 0 else rng.randrange(1, 40), Decimal(20), start, end))
    t = {"BaggageRule": table(spark, "BaggageRule", rules_)}
    far = date(9999, 12, 31)
    want = {}
    for i, op, _, start, end in rules_:
        earlier = [r for r in rules_ if r[1] == op and (r[3], r[0]) < (start, i) and (r[4] or far) >= start]
        if earlier:
            reach = max((r[4] or far) for r in earlier)
            want[i] = min(r[0] for r in rules_ if r[1] == op and (r[3], r[0]) < (start, i) and (r[4] or far) == reach)
    got = {r.BaggageRuleID: r.OverlapsBaggageRuleID for r in intervals.overlapping_baggage_rules(t).collect()}
    assert got == want and 20 < len(got) < 900


def test_voyages_meet_only_inside(spark):
    at = lambda d, h=0: datetime(2026, 1, d, h)
    rows = [(1, 1, 1, at(1), at(5), Decimal(1), "Scheduled"), (2, 1, 1, at(5), at(9), Decimal(1), "Scheduled"), (3, 1, 1, at(8, 23), at(10), Decimal(1), "Scheduled")]
    rows += [(4, 2, 1, at(1), at(20), Decimal(1), "Scheduled"), (5, 2, 1, at(2), at(3), Decimal(1), "Cancelled"), (6, 2, 1, at(19), at(21), Decimal(1), "Boarding")]
    got = intervals.overlapping_voyages({"CruiseVoyage": table(spark, "CruiseVoyage", rows)}).collect()
    assert {(r.ShipID, r.VoyageID, r.OverlapsVoyageID) for r in got} == {(1, 3, 2), (2, 6, 4)}


# --- accounts --------------------------------------------------------------------------------------


def test_accounts(spark, t):
    paid = [(i, b, datetime(2026, 8, 30) + timedelta(days=i), Decimal(a), "card", s, None) for i, (b, a, s) in enumerate(
        [(1, 2000, "Paid"), (3, 6000, "Paid"), (3, 50, "Paid"), (5, 5800, "Declined"), (8, 7000, "Paid"), (99, 10, "Paid"), (99, 5, "Pending")])]
    t = dict(t) | {"Payment": table(spark, "Payment", paid)}
    total = {r.BookingID: r.TotalAmount for r in t["Booking"].collect()}
    got = {r.BookingID: r for r in ledger.account_balances(t).collect()}
    assert (got[1].Charged, got[1].Paid, got[1].Balance, got[1].first_violation) == (total[1], 2000, total[1] - 2000, None if total[1] == 2000 else ledger.UNDERPAID)
    assert got[3].Balance == total[3] - 6050 and got[3].Paid == 6050
    assert (got[5].Paid, got[5].first_violation) == (0, ledger.UNDERPAID)
    # booking 8 is cancelled with full forfeit: charged, voided, the penalty is what was paid
    assert (got[8].Charged, got[8].Voided, got[8].Penalty, got[8].Paid, got[8].Refunded, got[8].Balance) == (total[8], total[8], total[8], 7000, 0, total[8] - 7000)
    assert (got[99].Charged, got[99].Paid, got[99].Balance, got[99].first_violation) == (0, 10, -10, ledger.UNKNOWN_ACCOUNT)
    lines = ledger.account_statement(t).filter("BookingID IN (3, 8, 99)").collect()
    lines.sort(key=lambda r: (r.At, ledger.KINDS.index(r.Kind)))
    three = [(r.Kind, r.Balance) for r in lines if r.BookingID == 3]
    assert three == [("charge", total[3]), ("payment", total[3] - 6000), ("payment", total[3] - 6050)]
    eight = [(r.Kind, r.Balance) for r in lines if r.BookingID == 8]
    assert eight[-1][1] == got[8].Balance and {k for k, _ in eight} == set(ledger.KINDS)
    assert [(r.Kind, r.Balance) for r in lines if r.BookingID == 99] == [("payment", -10)]


def test_statement_of_a_hot_account(spark):
    """Most entries belong to one account, so its statement covers several ranges."""
    rng = random.Random(5)
    at = datetime(2026, 1, 1)
    pay = [(i, 1 if i % 2 else rng.randrange(2, 30), at + timedelta(minutes=rng.randrange(500)), Decimal(rng.randrange(1, 99)), "card", "Paid", None) for i in range(800)]
    book = [(b, at - timedelta(days=1), 1, 1, "Confirmed", Decimal(5000), None) for b in range(1, 30)]
    names = ("CruiseVoyage", "CruiseShip", "CancellationPolicy", "BookingCancellation")
    t = {n: table(spark, n, [] if n == "BookingCancellation" else raw_rows()[n]) for n in names}
    t |= {"Booking": table(spark, "Booking", book), "Payment": table(spark, "Payment", pay)}
    got = {(r.BookingID, r.Kind, r.EntryID): r.Balance for r in ledger.account_statement(t).collect()}
    for b in range(1, 30):
        balance = Decimal(5000)
        assert got[b, "charge", b] == balance
        for i, _, _, amount, *_ in sorted((p for p in pay if p[1] == b), key=lambda p: (p[2], p[0])):
            balance -= amount
            assert got[b, "payment", i] == balance


# --- versions --------------------------------------------------------------------------------------


def test_versions(spark):
    folder = f"{staging_root(spark)}/versioned-test-{random.randrange(10**12)}"
    base = spark.createDataFrame([(i, f"v{i}", None) for i in range(200)], "id long, name string, note string")
    assert versions.create_versioned(base, folder, ["id"], buckets=16) == 1
    batch = spark.createDataFrame([(3, "new", "n", False), (4, None, None, True), (1000, "more", None, None), (1001, None, None, True)], "id long, name string, note string, _deleted boolean")
    assert versions.merge_batch(batch, folder) == 2
    want = {i: f"v{i}" for i in range(200)} | {3: "new", 1000: "more"}
    del want[4]
    assert {r.id: r.name for r in versions.read_version(spark, folder).collect()} == want
    assert {r.id for r in versions.read_version(spark, folder, 1).collect()} == set(range(200))
    # only buckets with a key of the batch moved to new files
    files = versions._Files(spark, folder)
    one, two = (versions._manifest(files, folder, v)["places"] for v in (1, 2))
    hit = {r[0] for r in batch.select(versions._bucket(["id"], 16)).collect()}
    assert {int(b) for b in two if two[b] != one.get(b)} <= hit and {int(b) for b in one if one[b] != two.get(b)} <= hit
    assert len(hit) < len(one)
    # a batch made on version 1 comes too late, and changes nothing
    with pytest.raises(versions.VersionConflict):
        versions.merge_batch(batch.withColumn("name", F.lit("late")), folder, base=1)
    assert {r.id: r.name for r in versions.read_version(spark, folder).collect()} == want
    assert versions.merge_batch(batch.limit(0), folder) == 2
    assert versions.merge_batch(spark.createDataFrame([(i, True) for i in [*want]], "id long, _deleted boolean").withColumn("name", F.lit("")).withColumn("note", F.lit("")), folder) == 3
    assert versions.read_version(spark, folder).count() == 0
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, folder + "-none")


# --- deltas ----------------------------------------------------------------------------------------


def seats(spark, rows):
    columns = "BookingPassengerID long, BookingID long, FinalFare decimal(12,2)"
    return spark.createDataFrame(rows, columns)


@pytest.mark.parametrize("seed", range(3))
def test_totals_follow_batches(spark, seed):
    """After several random batches the merged totals are those of the whole new table."""
    rng = random.Random(seed)
    fare = lambda: rng.choice([None, Decimal(rng.randrange(1000)) / 4])
    now = {i: (rng.randrange(12), fare()) for i in range(60)}
    table_ = seats(spark, [(i, *v) for i, v in now.items()])
    stored = deltas.fare_totals(table_)
    for _ in range(2):
        batch, after = [], dict(now)
        for i in rng.sample(range(80), 25):
            if rng.random() < 0.3:
                batch.append((i, 0, None, True))
                after.pop(i, None)
            else:
                after[i] = (rng.randrange(14), fare())
                batch.append((i, *after[i], rng.choice([False, None])))
        frame_ = spark.createDataFrame(batch, "BookingPassengerID long, BookingID long, FinalFare decimal(12,2), _deleted boolean")
        stored = deltas.update_fare_totals(stored, table_, frame_)
        now = after
        table_ = seats(spark, [(i, *v) for i, v in now.items()])
    key = lambda df: {r.BookingID: (r.TotalAmount, r[deltas.ROWS]) for r in df.collect()}
    assert key(stored) == key(deltas.fare_totals(table_))


def test_occupancy_follows_cancellations(spark, t):
    stored = deltas.cabin_sales(t["Booking"], t)
    batch = t["Booking"].filter("BookingID IN (1, 5)").withColumn("BookingStatus", F.lit("Cancelled")).withColumn("_deleted", F.lit(False))
    got = {r.VoyageID: r.BookedCabins for r in deltas.sold_cabins(deltas.update_cabin_sales(stored, t, batch)).collect()}
    new = rules.mark_cancelled(t["Booking"], batch)
    want = {r.VoyageID: r.BookedCabins for r in deltas.sold_cabins(deltas.cabin_sales(new, t)).collect()}
    assert got == want and got[1] == 3


# --- levels ----------------------------------------------------------------------------------------


def test_grouping_sets(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["x", None]), rng.randrange(3), rng.choice([None, 1, 2, 3, 4]), rng.randrange(9)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a string, b int, who int, v int")
    got = grouping_sets(df, [("a", "b"), ("a",), ()], {"s": F.col("v"), "n": F.lit(1)}, "who", "people")
    assert got.columns == ["a", "b", "Level", "s", "n", "people"]
    want = {}
    for level, pick in ((0, lambda r: (r[0], r[1])), (1, lambda r: (r[0], None)), (3, lambda r: (None, None))):
        for r in rows:
            at = want.setdefault((*pick(r), level), [0, 0, set()])
            at[0] += r[3]
            at[1] += 1
            at[2] |= {r[2]} - {None}
    assert {(r.a, r.b, r.Level): (r.s, r.n, r.people) for r in got.collect()} == {k: (s, n, len(p)) for k, (s, n, p) in want.items()}
    plain = grouping_sets(df, [("a",), ()], {"s": F.col("v")})
    assert {(r.a, r.Level): r.s for r in plain.collect()} == {(k[0], k[2] // 3): v[0] for k, v in want.items() if k[2]}


# --- service ages ----------------------------------------------------------------------------------


def test_service_ages(spark, t):
    """Childcare is for ages 2 to 12: seat 1 holds an adult, seat 7 an infant, seat 12 a child of ten or so."""
    asked = [(1, 1, 1), (2, 7, 1), (3, 12, 1), (4, 1, 3), (5, 999, 1), (6, 1, 99)]
    requests = table(spark, "PassengerSpecialService", [(*a, "Requested", Decimal(0)) for a in asked])
    got = {r.PassengerServiceID: r for r in rules.check_service_ages(dict(t) | {"PassengerSpecialService": requests}).collect()}
    assert {i for i, r in got.items() if r.first_violation == rules.WRONG_SERVICE_AGE} == {1, 2}
    assert 2 <= got[3].AgeAtDeparture <= 12 and got[5].AgeAtDeparture is None


def test_grouping_sets_keep_one_set_in_a_task(spark, capsys):
    """Wide to narrow, one set from another: no row is multiplied by the number of sets."""
    df = spark.range(40).selectExpr("id % 2 AS a", "id % 3 AS b", "id % 5 AS who", "CAST(id AS DECIMAL(12,2)) AS v")
    got = grouping_sets(df, [("a", "b"), ("b",), ("a",), ()], {"s": F.col("v")}, "who", "people")
    rows = {(r.a, r.b, r.Level): (int(r.s), r.people) for r in got.collect()}
    want = {}
    for i in range(40):
        for a, b, level in ((i % 2, i % 3, 0), (None, i % 3, 2), (i % 2, None, 1), (None, None, 3)):
            s, who = want.get((a, b, level), (0, set()))
            want[a, b, level] = (s + i, who | {i % 5})
    assert rows == {k: (s, len(who)) for k, (s, who) in want.items()}
    got.explain()
    assert "Expand" not in capsys.readouterr().out
