"""Stored ledgers, watched folders, and keys that hold a large share of all rows."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import context, labels, reports, skew, tables
from tallyfold.operators.entities import invalid_rules, match_entities
from tallyfold.plans.runs import sync_sidecars
from tallyfold.schemas import CASH_LOG, ENTITIES, LEDGER, MAPPING, MERCHANT_MAP, RAW_TRANSACTIONS, TRIPS
from tallyfold.sources.sidecars import read_cash_log
from tallyfold.streaming.incremental import watch_statements


def test_watched_folder(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    head = "Date,Description,Amount\n"
    (inbox / "a.csv").write_text(head + "2026-01-05,NETFLIX.COM,-9.00\n2026-02-05,SHELL 1,-30.00\n")
    rows = [(name, "acct", "checking") for name in ("a.csv", "b.csv")]
    accounts = spark.createDataFrame(rows, "file_name string, account_name string, account_type string")
    path, checkpoint = str(tmp_path / "ledger"), str(tmp_path / "checkpoint")

    def load():
        watch_statements(spark, str(inbox), accounts, path, checkpoint, once=True).awaitTermination()
        return {r.raw_description: r.category for r in tables.read_monthly(spark, path).collect()}

    assert load() == {"NETFLIX.COM": "Subscriptions", "SHELL 1": "Transport"}
    (inbox / "b.csv").write_text("junk\n" + head + "2026-02-05,SHELL 1,-30.00\n2026-02-06,MARRIOTT,-200.00\n")
    assert load() == {"NETFLIX.COM": "Subscriptions", "SHELL 1": "Transport", "MARRIOTT": "Travel"}
    assert tables.read_monthly(spark, path).count() == 3


def hot_ledger(spark, n=6000):
    """A third of the rows on one account, day, text and amount."""
    hot = F.col("id") % 3 == 0
    day = F.when(hot, F.lit(datetime.date(2026, 3, 3))).otherwise(F.date_add(F.lit("2026-01-01"), (F.col("id") % 90).cast("int")))
    return spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("transaction_id"),
        day.cast("date").alias("transaction_date"),
        F.when(hot, "one").otherwise(F.concat(F.lit("a"), F.col("id") % 50)).alias("account_name"),
        F.when(hot, "HOT").otherwise(F.concat(F.lit("T"), F.col("id") % 500)).alias("raw_description"),
        F.lit("UNKNOWN").alias("merchant_name"),
        F.when(F.col("id") % 2 == 0, "Meals").otherwise("Fees").alias("category"),
        F.lit("x").alias("sub_category"),
        F.when(hot, F.lit(-5)).otherwise(-(F.col("id") % 40)).cast("decimal(18,2)").alias("amount"),
        F.lit("Expense").alias("direction"),
        F.lit("pos").alias("channel"),
    ).select(*LEDGER.names)


def same(one, other):
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_hot_keys_give_the_same_rows(spark):
    ledger = hot_ledger(spark).cache()
    day = datetime.date(2026, 3, 3)
    trips = spark.createDataFrame(
        [("T1", day, day, "Business", "Rome", None), ("T2", datetime.date(2026, 2, 1), day, "Personal", "Bonn", None)],
        TRIPS,
    )
    cash = spark.createDataFrame(
        [(day, Decimal("-5.00"), "Loan", True, "a"), (day, Decimal("-5.00"), None, False, "b")], CASH_LOG
    )
    mapping = spark.createDataFrame(
        [("HOT", "Hot", "Fees", None, "ach", 1), ("HOT", "Hotter", "Fees", None, "ach", 2), ("T7", "T", "Fees", "s", "p", 3)],
        MAPPING,
    )
    assert same(context.ledger_with_trips(ledger, trips, "broadcast"), context.ledger_with_trips(ledger, trips, "days"))
    assert same(context.match_cash(ledger, cash, True), context.match_cash(ledger, cash, False))
    mapped = labels.apply_mapping(ledger, mapping, small=False)
    assert same(mapped, labels.apply_mapping(ledger, mapping, small=True))
    assert mapped.where("merchant_name = 'Hotter'").count() == 2000
    ledger.unpersist()


def test_salt_spreads_a_hot_key(spark):
    ledger = hot_ledger(spark)
    dim = spark.createDataFrame([("HOT", 1)], "raw_description string, v int")
    joined = skew.dimension_join(
        ledger, dim, lambda a, b: a("raw_description") == b("raw_description"), "transaction_id", "inner", small=False
    )
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(sizes) == 2000 and max(sizes) < 1000


def test_broadcast_bound(spark):
    assert skew.fits_broadcast(spark.range(10))
    assert not skew.fits_broadcast(spark.range(11), max_rows=10)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 100).alias("t"))
    assert not skew.fits_broadcast(wide, max_bytes=1000)


@pytest.mark.parametrize("id_prefix", [0, 1, 3])
def test_running_balance_of_hot_account(spark, id_prefix):
    ledger = hot_ledger(spark, 3000)
    rows = reports.running_balance(ledger, id_prefix=id_prefix).collect()
    totals = {}
    for row in sorted(rows, key=lambda r: (r.account_name, r.transaction_date, r.transaction_id)):
        totals[row.account_name] = totals.get(row.account_name, 0) + row.amount
        assert row.running_balance == totals[row.account_name]
    assert len(rows) == 3000


def test_first_arrival_and_idempotence(spark):
    batch = spark.createDataFrame(
        [("k1", "first", 1), ("k1", "second", 2), ("k2", "only", 3)], "transaction_id string, v string, pos int"
    )
    empty = batch.limit(0)
    once = tables.insert_if_absent(empty, batch, order=["pos"])
    assert {r.transaction_id: r.v for r in once.collect()} == {"k1": "first", "k2": "only"}
    assert same(once, tables.insert_if_absent(once, batch, order=["pos"]))


def test_upsert_twice_is_once(spark):
    ledger = hot_ledger(spark, 300)
    batch = ledger.withColumn("category", F.lit("New")).withColumn("amount", F.col("amount") - 1)
    once = tables.upsert_labels(ledger, batch)
    assert same(once, tables.upsert_labels(once, batch))
    assert once.agg(F.sum("amount")).first() == ledger.agg(F.sum("amount")).first()


def test_report_totals_agree(spark):
    ledger = hot_ledger(spark, 3000)
    total = ledger.agg(F.sum("amount")).first()[0]
    for freq in ("month_end", "week_sunday"):
        assert reports.resample(ledger, freq).agg(F.sum("total")).first()[0] == total
    compared = reports.compare_months(ledger, ["2026-03", "2026-02"])
    by_month = ledger.where("transaction_date >= '2026-03-01'").agg(F.sum(F.abs("amount"))).first()[0]
    assert compared.agg(F.sum("`2026-03`")).first()[0] == by_month
    assert reports.compare_months(ledger.where("transaction_date < '2026-02-01'")) is None


def raw_rows(spark):
    rows = [(f"k{n}", f"a{n % 3}", "checking", datetime.date(2026, 1 + n % 4, 5), f"T{n}", Decimal(n), "Income") for n in range(24)]
    return spark.createDataFrame(rows, RAW_TRANSACTIONS)


def test_raw_table_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.create_monthly(spark, path, RAW_TRANSACTIONS)
    tables.append_absent(spark, path, raw_rows(spark), ["transaction_id"])
    tables.delete_rows(spark, path, F.col("account_name") == "a1")
    tables.append_absent(spark, path, raw_rows(spark), ["transaction_id"])
    tables.delete_rows(spark, path, F.col("account_name") == "a2", "2026-01-01", "2026-02-28")
    left = tables.read_monthly(spark, path)
    assert left.columns == RAW_TRANSACTIONS.names
    assert left.where("account_type = 'checking'").count() == left.count() == 24 - 4
    tables.delete_rows(spark, path, F.col("transaction_date") < "2026-02-01")
    assert tables.stored_months(spark, path) == ["2026-04", "2026-03", "2026-02"]


def test_other_columns_are_refused(spark, tmp_path):
    path = str(tmp_path / "ledger")
    tables.create_monthly(spark, path)
    with pytest.raises(ValueError, match="columns"):
        tables.append_monthly(spark, path, raw_rows(spark))
    assert tables.read_monthly(spark, path).count() == 0


def test_window_prunes_months(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.create_monthly(spark, path, RAW_TRANSACTIONS)
    tables.append_monthly(spark, path, raw_rows(spark))
    window = tables.read_monthly(spark, path, None, "2026-02-01", "2026-03-31")
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and window.count() == 12


def test_copies_inside_an_upsert(spark):
    ledger = hot_ledger(spark, 30)
    one = ledger.limit(1)
    batch = one.withColumn("category", F.lit("A")).unionByName(one.withColumn("category", F.lit("B")))
    after = tables.upsert_labels(ledger, batch)
    assert after.count() == 30 and after.where("category = 'B'").count() == 1


def test_watched_folder_with_odd_names_and_rejects(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "my card+1.csv").write_text("Date,Description,Amount\n2026-01-05,HULU WITH ADS,-9.00\n2026-01-06,BAD,x\n")
    (inbox / "odd.csv").write_text("no header\n")
    accounts = spark.createDataFrame([("my card+1.csv", "a", "checking")], "file_name string, account_name string, account_type string")
    path, rejects = str(tmp_path / "ledger"), str(tmp_path / "rejects")
    watch_statements(spark, str(inbox), accounts, path, str(tmp_path / "c"), once=True, rejects_path=rejects).awaitTermination()
    assert [r.raw_description for r in tables.read_monthly(spark, path).collect()] == ["HULU WITH ADS"]
    assert [r.reason for r in spark.read.parquet(f"{rejects}/rows").collect()] == ["amount is not a number"]
    assert spark.read.parquet(f"{rejects}/files").count() == 1


def test_repeated_trip_gives_one_row(spark, tmp_path):
    day = datetime.date(2026, 3, 3)
    ledger = hot_ledger(spark, 9).where("account_name = 'one'").limit(1).withColumns({"category": F.lit("Meals")})
    trips, cash = tmp_path / "trips.csv", tmp_path / "cash.csv"
    trips.write_text("trip_id,start_date,end_date,trip_type,destination\nT1,2026-03-04,2026-03-09,Business,Oslo\nT1,2026-03-01,2026-03-05,Personal,Bern\n")
    cash.write_text("tx_date,amount,override_category,is_loan,notes\n")
    views = sync_sidecars(spark, ledger, str(trips), str(cash))
    assert [(r.tx_date, r.trip_location) for r in views.master_ledger.collect()] == [(day, "Bern")]
    stored = spark.createDataFrame([("T1", day, day, "Business", "Rome", None)], TRIPS)
    again = sync_sidecars(spark, ledger, str(trips), str(cash), stored)
    assert [r.destination for r in again.trips.collect()] == ["Bern"]


def test_bad_cash_rows(spark, tmp_path):
    cash = tmp_path / "cash.csv"
    cash.write_text("tx_date,amount,override_category,is_loan,notes\n2026-01-02,5.00,,FALSE,x\nsoon,5.00,,FALSE,y\n2026-01-03,lots,,TRUE,z\n")
    assert [r.notes for r in read_cash_log(spark, str(cash), strict=False).collect()] == ["x"]
    with pytest.raises(Exception, match="unrecognized date|amount is not"):
        read_cash_log(spark, str(cash)).collect()


@pytest.mark.parametrize("inline", [300, 1])
def test_rules_without_priority_or_with_bad_patterns(spark, inline):
    rules = spark.createDataFrame(
        [("SHOP", "keyword", 1, None), ("SHOP 7", "keyword", 2, 5), ("[", "regex", 3, 1), (None, "keyword", 3, 1), ("^S.*9$", "regex", 2, None)],
        MERCHANT_MAP,
    )
    entities = spark.createDataFrame([(k, f"e{k}", "c") for k in (1, 2, 3)], ENTITIES)
    texts = spark.createDataFrame([("SHOP 7",), ("SHOP 8",), ("SHOP 9",)], "raw_description string")
    found = match_entities(texts, rules, entities, inline_rules=inline).collect()
    assert {r.raw_description: r.entity_id for r in found} == {"SHOP 7": 2, "SHOP 8": 1, "SHOP 9": 2}
    assert [r.pattern for r in invalid_rules(spark, rules).collect()] == ["["]


def test_months_in_any_order(spark):
    ledger = hot_ledger(spark, 300)
    one, two = (reports.compare_months(ledger, m) for m in (["2026-02", "2026-03"], ["2026-03", "2026-02"]))
    assert same(one, two) and one.count() > 0
