"""Every audit finds nothing in the seed data and the planted fault elsewhere."""

import re
from datetime import datetime
from decimal import Decimal

import pytest

from seed import frame, raw_rows
from tidewake import catalogue as K
from tidewake.bindings import star
from tidewake.bindings.star import StarTables
from tidewake.catalogue import Unique
from tidewake.operators import audits
from tidewake.schema import TABLES
from tidewake.sources import tables as sources


def found(df):
    return {(r.constraint, r.key) for r in df.collect()}


def changed(t, table, *rows):
    return {**t, table: frame(t["Booking"].sparkSession, table, list(rows))}


def test_catalogue_size():
    assert (len(K.primary_keys()), len(K.UNIQUES), len(K.REFERENCES), len(K.DECLARED_CHECKS)) == (33, 26, 45, 7)


def test_seed_passes(t):
    assert found(audits.audit_unique(t, [*K.primary_keys(), *K.UNIQUES])) == set()
    assert found(audits.audit_references(t, K.REFERENCES)) == set()
    assert found(audits.audit_rows(t, [*K.DECLARED_CHECKS, *K.DOCUMENTED_CHECKS, *K.width_checks()])) == set()
    assert found(audits.audit_not_null(t, TABLES)) == set()
    assert found(audits.audit_symmetric(t["CabinAdjacency"])) == set()


def test_duplicate_keys(t):
    bad = changed(t, "Port", (1, "A", "X"), (1, "A", "X"), (2, "A", "Y"))
    assert found(audits.audit_unique(bad, K.primary_keys(["Port"]))) == {("PK_Port", "1")}
    assert found(audits.audit_unique(bad, [u for u in K.UNIQUES if u.table == "Port"])) == {("UQ_Port_PortName_Country", "A|X")}


def test_null_is_not_a_duplicate(t):
    pay = [(i, 1, datetime(2026, 1, 1), Decimal(1), "c", "Paid", None) for i in (1, 2)]
    assert found(audits.audit_unique(changed(t, "Payment", *pay), [u for u in K.UNIQUES if u.table == "Payment"])) == set()


def test_orphans(t):
    bad = changed(t, "Booking", *[(*b[:2], 77 if b[0] == 1 else b[2], *b[3:6], 99 if b[0] == 2 else None) for b in raw_rows()["Booking"]])
    refs = [r for r in K.REFERENCES if r.table == "Booking"]
    assert found(audits.audit_references(bad, refs)) == {("FK_Booking_CustomerPassengerID", "77"), ("FK_Booking_OriginalBookingID", "99")}


def test_row_checks(t):
    bad = changed(t, "Cabin", (1, 1, 1, "x" * 21, 0, 6, True), (2, 1, 1, "ok", 1, 5, True))
    got = found(audits.audit_rows(bad, [c for c in [*K.DECLARED_CHECKS, *K.DOCUMENTED_CHECKS, *K.width_checks()] if c.table == "Cabin"]))
    assert got == {("CK_Cabin_MaxOccupancy", "1"), ("CK_Cabin_DeckNumber", "1"), ("LEN_Cabin_CabinNumber", "1")}


def _service(low, high):
    return (1, "s", "Mobility", low, high, Decimal(0))


@pytest.mark.parametrize("low, high, fine", [(None, None, True), (1, 5, True), (5, 1, False), (None, 5, False), (1, None, False)])
def test_paired_age_limits(t, low, high, fine):
    bad = changed(t, "SpecialService", _service(low, high))
    checks = [c for c in K.DOCUMENTED_CHECKS if c.name == "CK_SpecialService_AgeRestriction"]
    assert (found(audits.audit_rows(bad, checks)) == set()) is fine


def test_unknown_condition_passes(t):
    bad = changed(t, "FareRule", (1, 1, 1, 1, Decimal(1), datetime(2026, 1, 2).date(), None), (2, 1, 1, 2, Decimal(1), datetime(2026, 1, 2).date(), datetime(2026, 1, 1).date()))
    checks = [c for c in K.DOCUMENTED_CHECKS if c.table == "FareRule"]
    assert found(audits.audit_rows(bad, checks)) == {("CK_FareRule_EffectiveDate", "2")}


def test_nulls_and_defaults(spark, t):
    loose = spark.createDataFrame([(1, 1, None, None, None)], "BookingCabinID int, BookingID int, CabinID int, CabinPrice decimal(12,2), x string")
    assert found(audits.audit_not_null({"BookingCabin": loose}, ["BookingCabin"])) == {("NN_BookingCabin_CabinID", "1"), ("NN_BookingCabin_CabinPrice", "1")}
    filled = audits.fill_defaults(loose, "BookingCabin", "2026-01-01")
    assert filled.first().CabinPrice == Decimal(0)
    booking = spark.createDataFrame([(1, None, None)], "BookingID int, BookingDate timestamp_ntz, BookingStatus string")
    row = audits.fill_defaults(booking, "Booking", "2026-01-01 10:00:00").first()
    assert (row.BookingDate, row.BookingStatus) == (datetime(2026, 1, 1, 10), "Confirmed")


def test_one_way_edge(t):
    assert found(audits.audit_symmetric(t["CabinAdjacency"].filter("CabinID = 2"))) == {("SYM_CabinAdjacency", "2|3")}


def test_write_and_load(spark, t, tmp_path):
    folder = str(tmp_path / "tables")
    sources.write_tables({n: t[n] for n in ("CruiseVoyage", "Booking")}, folder)
    back = sources.load_tables(spark, folder, ["CruiseVoyage", "Booking"])
    assert back["CruiseVoyage"].exceptAll(t["CruiseVoyage"]).count() == 0
    assert back["CruiseVoyage"].agg({"VoyageLengthDays": "max"}).first()[0] == 8
    assert back["Booking"].count() == 16
    sources.register_views(back)
    assert spark.table("Booking").count() == 16


def test_write_split(spark, t, tmp_path):
    from tidewake.operators.rules import check_birth_dates

    path = str(tmp_path / "people")
    sources.write_split(check_birth_dates(t, "2025-05-20"), path)
    back = spark.read.parquet(path).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in back} == {"valid": 34, "rejected": 1}


def test_fare_keys_are_counted_where_they_are_dealt(spark, tmp_path, capsys):
    """The rules of a part lie in one partition, so counting their keys moves nothing and no task holds a whole file."""
    spark.range(1000).selectExpr("id AS p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    key = [c for c in K.UNIQUES if c.table == "FareRule"]
    counted = audits.audit_unique(StarTables(spark, str(tmp_path)), key)
    counted.explain()
    assert "ENSURE_REQUIREMENTS" not in capsys.readouterr().out
    assert counted.count() == 0


def _plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_references_are_settled_by_one_join(t, capsys):
    """An anti join would be moved into the union of the child tables, each of which would read all parents."""
    plan = _plan(audits.audit_references(t, K.REFERENCES), capsys)
    assert len(re.findall(r"Join \[parent#\d+, value#\d+L\]", plan)) == 1


def test_repeated_parents_and_nulls_settle_references(spark):
    child = spark.createDataFrame([(1, 1), (2, 1), (3, 9), (4, None), (5, 9), (6, 8)], "BookingID int, VoyageID int")
    parent = spark.createDataFrame([(1,), (1,), (1,), (None,)], "VoyageID int")
    refs = [r for r in K.REFERENCES if r.name == "FK_Booking_VoyageID"]
    rows = audits.audit_references({"Booking": child, "CruiseVoyage": parent}, refs).collect()
    assert sorted(tuple(r) for r in rows) == [("FK_Booking_VoyageID", "Booking", "8", "1 rows"), ("FK_Booking_VoyageID", "Booking", "9", "2 rows")]


def test_keys_are_counted_in_partitions_of_bounded_size(spark, monkeypatch, capsys):
    """No grouping is left to partitions that AQE joins; a value in many rows and NULLs count as before."""
    monkeypatch.setattr(audits, "KEYS_DEALT", 100)
    rows = spark.range(0, 1000, 1, 6).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id < 4 THEN NULL ELSE id END AS k", "id AS v")
    key = [Unique("PK", "A", ("k",), True), Unique("UQ", "A", ("k",), False)]
    got = audits.audit_unique({"A": rows}, key)
    assert "ENSURE_REQUIREMENTS" not in _plan(got, capsys)
    hot = f"{334 + 1} rows"
    assert sorted(tuple(r) for r in got.collect()) == [("PK", "A", "7", hot), ("PK", "A", "NULL", "2 rows"), ("UQ", "A", "7", hot)]


def test_lines_are_grouped_in_partitions_of_bounded_size(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(star, "LINES_DEALT", 100)
    lines = spark.range(1000).selectExpr(
        "id div 4 AS l_orderkey", "id AS l_partkey", "0L AS l_suppkey", "int(id % 3) AS l_linenumber", "double(id) AS l_quantity",
        "double(id) AS l_extendedprice", "0D AS l_discount", "0D AS l_tax", "IF(id % 2 = 0, 'A', 'R') AS l_returnflag", "'O' AS l_linestatus", "timestamp_ntz'2000-01-01' AS l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    seats = star._line_groups(StarTables(spark, str(tmp_path)))
    assert seats.rdd.getNumPartitions() == 11
    assert "ENSURE_REQUIREMENTS" not in _plan(seats, capsys)
    assert seats.filter("l_orderkey = 3").orderBy("l_linenumber").collect() == [(3, 0, 12, 15.0, 15.0, 1, 1), (3, 1, 13, 13.0, 13.0, 0, 1), (3, 2, 14, 14.0, 14.0, 1, 0)]
