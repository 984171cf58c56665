"""Stored tables whose writers die at any step, or come second; filters of their keys."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import tables, versions
from tallyfold.schemas import LEDGER


class Killed(Exception):
    pass


def ledger(spark, ids, category="Fees"):
    rows = [
        (f"k{n}", datetime.date(2026, 1 + n % 3, 5 + n % 20), f"a{n % 4}", f"T{n}", "M", category, "s", Decimal(n), "Expense", "pos")
        for n in ids
    ]
    names = ["transaction_id", "transaction_date", "account_name", "raw_description", "merchant_name", "category", "sub_category", "amount", "direction", "channel"]
    return spark.createDataFrame(rows, names).select(*[F.col(f.name).cast(f.dataType) for f in LEDGER.fields])


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def stored(spark, path):
    tables.create_monthly(spark, path)
    tables.append_monthly(spark, path, ledger(spark, range(30)))
    return path


CHANGES = {
    "append": lambda spark, path: tables.append_absent(spark, path, ledger(spark, range(20, 50)), ["transaction_id"]),
    "labels": lambda spark, path: tables.rewrite_labels(spark, path, ledger(spark, range(25, 35), "New")),
    "account": lambda spark, path: tables.delete_rows(spark, path, F.col("account_name") == "a1"),
    "accounts": lambda spark, path: tables.delete_rows(spark, path, F.col("account_name").isin("a1", "a3")),
    "window": lambda spark, path: tables.delete_rows(spark, path, F.col("account_name") == "a2", "2026-01-10", "2026-02-20"),
    "month": lambda spark, path: tables.delete_rows(spark, path, F.col("transaction_date") < "2026-02-01"),
}
STEPS = ["write_run", "_write_filter", "publish", "rename_new", "clean", "remove"]


@pytest.fixture
def few_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("name", CHANGES)
def test_a_killed_change_is_whole_or_not_there(spark, tmp_path, monkeypatch, few_tasks, name):
    """Every step dies once before and once after its work; then the change is run again."""
    steps = STEPS if name == "labels" else ["rename_new"]
    wanted_path = stored(spark, str(tmp_path / "wanted"))
    before = bag(tables.read_monthly(spark, wanted_path))
    CHANGES[name](spark, wanted_path)
    after = bag(tables.read_monthly(spark, wanted_path))
    assert before != after
    seen = set()
    for step in steps:
        for late in (False, True):
            path = stored(spark, str(tmp_path / f"{step}{late}"))
            whole, died = getattr(versions, step), []

            def dying(*args, whole=whole, late=late, died=died, **kw):
                if died:
                    return whole(*args, **kw)
                died.append(True)
                if late:
                    whole(*args, **kw)
                raise Killed

            with monkeypatch.context() as patch:
                patch.setattr(versions, step, dying)
                try:
                    CHANGES[name](spark, path)
                except Killed:
                    pass
            found = bag(tables.read_monthly(spark, path))
            assert found in (before, after), (step, late)
            seen.add(found == after)
            CHANGES[name](spark, path)
            assert bag(tables.read_monthly(spark, path)) == after, (step, late)
            versions.vacuum(spark, path, older_than_hours=0)
            named = {run for n in versions._numbers(spark, path) for run in versions._read(spark, path, n).runs()}
            assert {n.removeprefix("run=") for n in versions.names_in(spark, path) if n.startswith("run=")} == named
    assert seen == {True, False}


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = stored(spark, str(tmp_path / "t"))
    held = tables.read_monthly(spark, path)
    for n in range(versions.KEPT):
        tables.delete_rows(spark, path, F.col("amount") >= 25 - n)
    assert held.count() == 30
    for n in range(3):
        tables.append_monthly(spark, path, ledger(spark, [200 + n]))
    assert len(versions._numbers(spark, path)) == versions.KEPT + 1


def test_the_second_writer_starts_anew(spark, tmp_path, monkeypatch):
    """Both add the same new keys; the one that commits second sees those of the first."""
    path = stored(spark, str(tmp_path / "t"))
    whole, raced = versions.write_run, []

    def racing(*args, **kw):
        made = whole(*args, **kw)
        if not raced:
            raced.append(True)
            tables.append_absent(spark, path, ledger(spark, range(28, 34)), ["transaction_id"])
        return made

    monkeypatch.setattr(versions, "write_run", racing)
    tables.append_absent(spark, path, ledger(spark, range(30, 40)), ["transaction_id"])
    assert bag(tables.read_monthly(spark, path)) == bag(ledger(spark, range(40)))


def test_a_place_that_is_taken_is_a_conflict(spark, tmp_path):
    path = stored(spark, str(tmp_path / "t"))
    base = versions.current(spark, path)
    versions.publish(spark, path, base, base.months)
    with pytest.raises(versions.Conflict):
        versions.publish(spark, path, base, {})
    assert tables.read_monthly(spark, path).count() == 30


def test_disjoint_keys_read_no_keys(spark, tmp_path, monkeypatch):
    path = stored(spark, str(tmp_path / "t"))
    for k in range(1, 4):
        tables.append_monthly(spark, path, ledger(spark, range(1000 * k, 1000 * k + 300)))
    whole, read = versions.read_runs, []
    monkeypatch.setattr(versions, "read_runs", lambda *a: read.append(a[3]) or whole(*a))
    tables.append_absent(spark, path, ledger(spark, range(50_000, 50_100)), ["transaction_id"])
    assert read == [[]]
    # Keys of one run: only that run is read.
    tables.append_absent(spark, path, ledger(spark, range(2000, 2300)), ["transaction_id"])
    assert len({folder.split("/")[0] for folder in read[1]}) == 1
    assert tables.read_monthly(spark, path).count() == 30 + 900 + 100


def test_filters_find_every_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "KEYS_PER_BITMAP", 50)
    path = str(tmp_path / "t")
    tables.create_monthly(spark, path)
    tables.append_monthly(spark, path, ledger(spark, range(3000)))
    version = versions.current(spark, path)
    assert min(n for runs in version.months.values() for n in runs.values()) >= 20
    keys = ledger(spark, range(2000, 6000)).select("transaction_id", F.date_format("transaction_date", "yyyy-MM").alias("month"))
    found = {r.transaction_id for r in versions.may_hold(spark, path, version, keys, "transaction_id").collect()}
    assert found >= {f"k{n}" for n in range(2000, 3000)} and len(found) < 1030


def test_runs_without_filters_are_read(spark, tmp_path):
    path = stored(spark, str(tmp_path / "t"))
    run = versions.write_run(spark, path, tables._stamped(ledger(spark, range(60, 70)), "transaction_date"))
    versions.change(spark, path, lambda base: (run, set()))
    tables.append_absent(spark, path, ledger(spark, range(55, 75)), ["transaction_id"])
    assert bag(tables.read_monthly(spark, path)) == bag(ledger(spark, [*range(30), *range(55, 75)]))


def test_a_batch_is_worked_out_once(spark, tmp_path, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    made = {"transaction_id": "md5(CAST(id AS STRING))", "transaction_date": "DATE_ADD(DATE'2020-01-01', CAST(id % 90 AS INT))"}
    columns = [f"CAST({made.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in LEDGER.fields]
    rows = spark.range(4000).selectExpr(*columns)
    batch = rows.mapInArrow(counted, rows.schema)
    path = str(tmp_path / "ledger")
    tables.create_monthly(spark, path)
    tables.append_monthly(spark, path, batch)
    # The rows were worked out a second time before, for a sample of their range.
    assert seen.value == 4000
    # A batch that lies on disk is not written again.
    place = str(tmp_path / "batch")
    rows.write.parquet(place)
    monkeypatch.setattr(tables, "Scratch", None)
    tables.append_absent(spark, path, spark.read.parquet(place).withColumn("pos", F.lit(0)), ["pos"], stored=True)
    tables.rewrite_labels(spark, path, spark.read.parquet(place).withColumn("channel", F.lit("x")), stored=True)
    found = tables.read_monthly(spark, path)
    assert found.count() == 4000 and found.where("channel = 'x'").count() == 4000


def test_a_busy_month_is_written_by_several_tasks(spark, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    path = str(tmp_path / "raw")
    rows = spark.range(200_000, numPartitions=8).selectExpr(
        "md5(CAST(id AS STRING)) AS transaction_id", "IF(id % 100 = 0, DATE'2020-02-02', DATE'2020-01-01') AS transaction_date"
    )
    tables.create_monthly(spark, path, rows.schema)
    spark.conf.set(name, "500000")
    try:
        tables.append_monthly(spark, path, rows)
    finally:
        spark.conf.unset(name)
    files = tables.read_monthly(spark, path).inputFiles()
    assert len([f for f in files if "month=2020-01" in f]) > 2
    assert len([f for f in files if "month=2020-02" in f]) == 1
    assert tables.read_monthly(spark, path).count() == 200_000
