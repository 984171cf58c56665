"""Trips, cash and burn on small hand-made ledgers."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import context, reports, tables
from tallyfold.plans.runs import sync_sidecars
from tallyfold.schemas import CASH_LOG, TRIPS
from tallyfold.sources.sidecars import read_cash_log, read_trips


def day(text):
    return datetime.date.fromisoformat(text)


LEDGER = """transaction_id string, transaction_date date, raw_description string, category string,
            sub_category string, amount decimal(18,2)"""


@pytest.fixture
def ledger(spark):
    rows = [
        ("a1", "2025-05-02", "Landlord", "Transfer", "Rent Payment", "-1200.00"),
        ("a2", "2025-05-06", "Films", "Subscriptions", "Video Streaming", "-12.50"),
        ("a3", "2025-05-11", "Inn", "Travel", "Lodging", "-310.00"),
        ("a4", "2025-05-12", "Card", "Transfer", "Credit Card Payment", "-700.00"),
        ("a5", "2025-05-12", "Songs", "Subscriptions", "Audio Streaming", "-9.50"),
        ("a6", "2025-05-12", "Friend", "Cash", "Person to Person Payment", "-40.00"),
        ("a7", "2025-05-12", "Lunch", "Meals", "Fast Food", "-21.00"),
        ("a8", "2025-05-12", "Market", "Groceries", "Grocery Store", "-55.00"),
        ("a9", "2025-05-10", "First day", "Meals", "Fast Food", "-1.00"),
        ("b1", "2025-05-14", "Last day", "Meals", "Fast Food", "-2.00"),
        ("b2", "2025-05-09", "Day before", "Meals", "Fast Food", "-3.00"),
        ("b3", "2025-05-15", "Day after", "Meals", "Fast Food", "-4.00"),
        ("b4", "2025-05-12", "No sub-category", "Meals", None, "-5.00"),
        ("b5", "2025-05-12", "No category", None, "Fast Food", "-6.00"),
        ("b6", None, "No date", "Meals", "Fast Food", "-7.00"),
    ]
    typed = [(i, day(d) if d else None, t, c, s, Decimal(a)) for i, d, t, c, s, a in rows]
    return spark.createDataFrame(typed, LEDGER)


def trip(key, start, end, kind="Business", place="Lima"):
    return (key, day(start), day(end), kind, place, None)


@pytest.mark.parametrize("mode", ["auto", "broadcast", "days"])
def test_trip_context(spark, ledger, mode):
    trips = spark.createDataFrame([trip("T1", "2025-05-10", "2025-05-14")], TRIPS)
    found = {r.transaction_id: r for r in context.ledger_with_trips(ledger, trips, mode).collect()}
    assert len(found) == ledger.count()
    assert {k for k, r in found.items() if r.is_travel_expense} == {"a3", "a7", "a9", "b1"}
    assert (found["a3"].travel_context, found["a3"].trip_location) == ("Business", "Lima")
    assert (found["a5"].travel_context, found["a5"].trip_location) == ("Personal/Local", None)


def test_burn(spark, ledger):
    trips = spark.createDataFrame([trip("T1", "2025-05-10", "2025-05-14")], TRIPS)
    burn = reports.monthly_burn(context.ledger_with_trips(ledger.limit(8), trips)).collect()
    assert len(burn) == 1
    assert burn[0].fixed_overhead == Decimal("1222.00")
    assert burn[0].variable_lifestyle == Decimal("386.00")
    assert burn[0].total_operational_spend == Decimal("1648.00")


@pytest.mark.parametrize("mode", ["broadcast", "days"])
def test_overlapping_trips_repeat_rows(spark, ledger, mode):
    trips = spark.createDataFrame(
        [trip("T1", "2025-05-10", "2025-05-14"), trip("T2", "2025-05-12", "2025-05-20", "Personal", "Rome")], TRIPS
    )
    every = context.ledger_with_trips(ledger, trips, mode)
    assert every.where("transaction_id = 'a7'").count() == 2
    first = context.ledger_with_trips(ledger, trips, mode, on_overlap="first")
    assert [r.trip_id for r in first.where("transaction_id = 'a7'").collect()] == ["T1"]
    assert first.count() == ledger.count()


@pytest.mark.parametrize("small", [True, False])
def test_cash(spark, ledger, small):
    entries = [
        (day("2025-05-12"), Decimal("-700.00"), "Loan", True, "one"),
        (day("2025-05-12"), Decimal("-700.00"), None, False, "two"),
        (day("2025-05-12"), Decimal("-20.99"), "Cent off", True, "none"),
    ]
    cash = spark.createDataFrame(entries, CASH_LOG)
    matched = context.match_cash(ledger, cash, small).where("transaction_id = 'a4'").collect()
    assert sorted(r.cash_notes for r in matched) == ["one", "two"]
    loans = context.loan_tracking(ledger, cash).collect()
    assert [(r.final_category, r.notes) for r in loans] == [("Loan", "one")]


def test_sidecars_twice(spark, tmp_path):
    rows = [
        ("x1", day("2026-03-15"), "Room", "Travel", "Lodging", Decimal("-250.00")),
        ("x2", day("2026-03-16"), "Withdrawal", "Transfer", "Cash", Decimal("-80.00")),
    ]
    ledger = spark.createDataFrame(rows, LEDGER)
    trips_csv, cash_csv = tmp_path / "trips.csv", tmp_path / "cash.csv"
    head = "trip_id,start_date,end_date,trip_type,destination,notes\n"
    trips_csv.write_text(head + "T1,3/14/26,03/18/2026,Business,Oslo\n")
    cash_csv.write_text("tx_date,amount,override_category,is_loan,notes\n3/16/2026,-80.00,Cash,TRUE,lent\n")
    once = sync_sidecars(spark, ledger, str(trips_csv), str(cash_csv))
    assert once.trips.count() == 1 and once.master_ledger.count() == 2
    assert once.trips.first().notes is None
    stored = spark.createDataFrame(once.trips.collect(), TRIPS)
    trips_csv.write_text(
        head + "T1,2026-03-14,2026/03/19,Business,Oslo N,longer\nT2,4/1/2026,4/5/2026,Personal,Bern,fun\n"
    )
    twice = sync_sidecars(spark, ledger, str(trips_csv), str(cash_csv), stored)
    assert {r.trip_id: r.destination for r in twice.trips.collect()} == {"T1": "Oslo N", "T2": "Bern"}
    master = {r.tx_date: r for r in twice.master_ledger.collect()}
    assert len(master) == 2
    assert master[day("2026-03-15")].travel_context == "Business"
    lent = master[day("2026-03-16")]
    assert lent.is_account_receivable and lent.final_category == "Cash"


def test_bad_trip_date_is_an_error(spark, tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text("trip_id,start_date,end_date,trip_type,destination,notes\nT1,soon,3/1/2026,Business,Oslo,\n")
    with pytest.raises(Exception, match="unrecognized date"):
        read_trips(spark, str(path)).collect()
    assert read_trips(spark, str(path), strict=False).first().start_date is None


def test_mixed_cash_dates(spark, tmp_path):
    path = tmp_path / "cash.csv"
    path.write_text(
        'tx_date,amount,override_category,is_loan,notes\n2026-03-06,-73.98,A,TRUE,x\n3/7/26,5,B,false,\n"Mar 8, 2026",1.5,,,\n'
    )
    found = read_cash_log(spark, str(path)).orderBy("tx_date").collect()
    assert [r.tx_date.day for r in found] == [6, 7, 8]
    assert [r.is_loan for r in found] == [True, False, None]


def test_delete_keeps_unknown(spark, ledger):
    left = tables.delete_where(ledger, F.col("category") == "Meals")
    assert left.where("category IS NULL").count() == 1
    assert left.where("category = 'Meals'").count() == 0
