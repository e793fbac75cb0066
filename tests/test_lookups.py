"""Scalars and lookups against brute force."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from pyspark.sql import functions as F
from tidewake.functions import age_on, hours_until, on_date, voyage_length_days
from tidewake.bindings.star import PARTS_DEALT, StarTables
from tidewake.operators import lookups
from tidewake.operators.ranking import global_rank
from tidewake.operators.rollup import labelled_rollup


@pytest.mark.parametrize(
    "dob, ref, want",
    [("2009-03-12", "2026-08-01", 17), ("2008-02-29", "2026-02-28", 17), ("2008-02-29", "2026-03-01", 18), ("2000-06-01", "2000-01-01", 0), ("2000-06-01", "1999-05-31", -1)],
)
def test_age(spark, dob, ref, want):
    df = spark.createDataFrame([(date.fromisoformat(dob), date.fromisoformat(ref))], "a date, b date")
    assert df.select(age_on("a", "b")).first()[0] == want


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_hours_do_not_depend_on_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        gaps = [(datetime(2026, 3, 28, 12), datetime(2026, 3, 29, 12), 24), (datetime(2026, 1, 1, 10, 59), datetime(2026, 1, 1, 12, 1), 1), (datetime(2026, 1, 1, 10, 59), datetime(2026, 1, 1, 10, 0), 0), (datetime(2026, 1, 2), datetime(2026, 1, 1, 22, 30), -1)]
        df = spark.createDataFrame(gaps, "a timestamp_ntz, b timestamp_ntz, want int")
        assert df.filter(hours_until("a", "b") != F.col("want")).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dates(spark):
    df = spark.createDataFrame([(datetime(2026, 8, 1, 23, 59), datetime(2026, 8, 3, 0, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(voyage_length_days("a", "b")).first()[0] == 2
    assert df.filter(on_date("a", "2026-08-01")).count() == 1 and df.filter(on_date("b", "2026-08-02")).count() == 0


def test_date_filter_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2026, 8, 1))], "k int, ts timestamp_ntz")
    df.write.parquet(str(tmp_path / "x"))
    plan = spark.read.parquet(str(tmp_path / "x")).filter(on_date("ts", "2026-08-01"))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,2026-08-01T00:00)" in plan


def test_route_endpoints(spark):
    stops = spark.createDataFrame([(1, 7, 1), (1, 8, 2), (2, 5, 2), (2, 6, 3)], "RouteID int, PortID int, StopSequence int")
    got = {tuple(r) for r in lookups.route_endpoints(stops).collect()}
    assert got == {(1, 7, 8, 2), (2, None, 6, 2)}


def test_effective_rule_brute_force(spark):
    rnd = random.Random(7)
    day = date(2026, 1, 1)
    starts = {(k, rnd.randrange(60)) for k in range(4) for _ in range(12)}
    rules = [(i, k, day + timedelta(s), day + timedelta(s + rnd.randrange(40)) if rnd.random() < 0.7 else None) for i, (k, s) in enumerate(sorted(starts))]
    facts = [(i, rnd.choice([0, 1, 2, 3, 4, None]), day + timedelta(rnd.randrange(-5, 90))) for i in range(300)]
    want = {}
    for i, k, d in facts:
        fits = [r for r in rules if r[1] == k and r[2] <= d and (r[3] is None or r[3] >= d)]
        want[i] = max(fits, key=lambda r: r[2])[0] if fits else None
    got = lookups.effective_rule(
        spark.createDataFrame(facts, "id int, k int, d date"),
        spark.createDataFrame(rules, "rule int, k int, EffectiveFrom date, EffectiveTo date"),
        ["k"], "d", ["rule"],
    )
    assert {r.id: r.rule for r in got.collect()} == want


@pytest.mark.parametrize("limit", [100, 0])
def test_band_lookup_brute_force(spark, limit):
    bands = [(1, 0, 9), (2, 10, 10), (3, 11, 70), (4, 75, None)]
    values = [(v,) for v in [*range(-3, 100), None, 5000]]
    want = {v: next((b for b, lo, hi in bands if v is not None and lo <= v and (hi is None or v <= hi)), None) for (v,) in values}
    got = lookups.band_lookup(
        spark.createDataFrame(values, "v int"), spark.createDataFrame(bands, "band int, lo int, hi int"), "v", "lo", "hi", bucket_width=8, max_broadcast_rows=limit
    )
    assert {r.v: r.band for r in got.collect()} == want and got.count() == len(values)


@pytest.mark.parametrize("limit", [100, 0])
@pytest.mark.parametrize("kind,of", [("date", lambda n: date(2026, 1, 1) + timedelta(n)), ("decimal(12,2)", Decimal), ("bigint", lambda n: n * 10**9)])
def test_band_lookup_types(spark, limit, kind, of):
    bands = [(1, of(-50), of(-1)), (2, of(0), of(9)), (3, of(20), None), (4, None, of(15))]
    values = [*map(of, (-60, -50, -7, 0, 9, 10, 19, 20, 900)), None]
    want = {v: next((b for b, lo, hi in bands if v is not None and lo is not None and lo <= v and (hi is None or v <= hi)), None) for v in values}
    facts = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, v {kind}")
    table = spark.createDataFrame(bands, f"id int, lo {kind}, hi {kind}")
    got = lookups.band_lookup(facts, table, "v", "lo", "hi", bucket_width=8, max_broadcast_rows=limit)
    assert got.columns == ["id", "v", "id", "lo", "hi"]
    assert {r[1]: r[2] for r in got.collect()} == want
    assert lookups.band_lookup(facts.limit(0), table, "v", "lo", "hi", max_broadcast_rows=limit).count() == 0


def test_threshold_policy(spark):
    rows = [(2, 1, 48, "A", 1), (1, 1, 48, "B", 2), (3, 1, 72, "C", 3)]
    policies = spark.createDataFrame(rows, "PolicyID int, OperatorID int, HoursBeforeDeparture int, PenaltyType string, PenaltyValue int")
    facts = spark.createDataFrame([(1, 10), (1, 48), (1, 49), (1, 73), (2, 10)], "OperatorID int, h int")
    got = {(r.OperatorID, r.h): r.PenaltyType for r in lookups.threshold_policy(facts, policies, "h").collect()}
    assert got == {(1, 10): "B", (1, 48): "B", (1, 49): "C", (1, 73): "Percentage", (2, 10): "Percentage"}


def test_global_rank_brute_force(spark):
    rnd = random.Random(3)
    values = [rnd.choice([0, 0, 0, 5, 10**4 * rnd.randrange(9), rnd.randrange(-(10**7), 10**7)]) for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int").selectExpr("id", "CAST(v / 100 AS DECIMAL(18,2)) AS v")
    rows = df.collect()
    want = {r.id: 1 + sum(o.v > r.v for o in rows) for r in rows}
    assert {r.id: r.place for r in global_rank(df, "v", "place").collect()} == want


def test_rollup_keeps_a_null_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    got = {tuple(r) for r in labelled_rollup(df, "k", "Key", "Total", [F.sum("n").alias("n")]).collect()}
    assert got == {("a", 1), (None, 2), ("Total", 3)}


def test_fare_rules_are_dealt_out_and_their_size_is_seen(spark, tmp_path, capsys):
    """32 rules a part: a narrow file of parts is neither multiplied in one task nor broadcast."""
    parts = 200_000
    spark.range(parts).selectExpr("id AS p_partkey").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    rules = StarTables(spark, str(tmp_path))["FareRule"]
    tasks = [r["count"] for r in rules.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 32 * parts and max(tasks) <= 2 * 32 * PARTS_DEALT
    assert rules.filter("VoyageID = 7").agg(F.count_distinct("FareRuleID")).first()[0] == 32
    probes = spark.range(10**7).selectExpr("id AS VoyageID", "1 AS CabinCategoryID", "4 AS AgeCategoryID", "date'1998-06-15' AS day")
    lookups.effective_rule(probes, rules, ["VoyageID", "CabinCategoryID", "AgeCategoryID"], "day", ["BaseFare"]).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
