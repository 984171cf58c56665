"""Statement files on disk, with every defect they may have."""

import pytest

from tallyfold.operators import labels, reports, tables
from tallyfold.operators.classify import classify, unknown_descriptions, unknown_rows
from tallyfold.operators.entities import match_entities
from tallyfold.operators.ingest import TOO_LARGE, ingest_files, ingest_lines, load_files
from tallyfold.plans.runs import statements_to_ledger
from tallyfold.sources import statements
from tallyfold.sources.seeds import seed_dims

FILES = {
    "card.csv": "Transaction Date,Post Date,Description,Category,Type,Amount,Memo\n"
    '11/28/2021,11/30/2021,"LYFT   ""POOL"", PORTO",Taxi,Buy,41.07,\n'
    "12/03/2021,12/04/2021,AUTOMATIC PAYMENT PLAN B,,Credit,-260.90,\n"
    "12/09/2021,12/09/2021, COSTCO  TYRES ,Car,Buy,318.66,\n",
    "bent.csv": "date,memo,amt\n2022/05/09,TWICE,-8.20\n2022/05/09,TWICE,-8.20\n2022-05-11,WIDE,4.40,MORE\n"
    "2022-05-12,NOT YET,UNKNOWN\n2022-05-13,TOO SHORT\n,UNDATED,17.10\n2022-05-15,TENT HIRE,(62.35)\n"
    "2022-05-16,CHOIR FUND,940.00\n2022-05-17,PAINT SHOP,-33.80\n2022-05-18,HUGE,12345678901234567890.00\n",
    "apple_sheet.csv": "\ufeffTransaction Date,Clearing Date,Description,Merchant,Amount (USD)\r\n"
    "08/21/2022,08/22/2022,Payment,,-71.00\r\n9/4/22,09/05/2022,HULU WITH ADS,Hulu,6.75\r\n",
    "bank.csv": "Description:,ACCOUNT 5\nPrinted:,11/30/2021\n,,,\nDate,Description,Amount,Running Bal.\n"
    "10-19-2021,GARDEN LEASE,-402.18,77.00\n",
    "split.csv": '"Date","Description","Deposits","Withdrawals"\n2022-02-02,"CHOIR FUND",,81.00\n',
    "late.csv": "note\n" * 25 + "Date,Description,Amount\n2022-07-07,LATE,2.00\n",
    "just.csv": "note\n" * 24 + "Date,Description,Amount\n2022-07-07,IN TIME,2.00\n",
    "empty.csv": "",
    "nobody.csv": "Date,Description,Amount\n2022-07-08,OWNERLESS,3.00\n",
}
TYPES = {"bent.csv": "checking", "bank.csv": "checking", "split.csv": "checking", "late.csv": "checking"}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("apple_folder")
    for name, text in FILES.items():
        (root / name).write_bytes(text.encode("utf-8"))
    return str(root)


@pytest.fixture(scope="module")
def accounts(spark):
    rows = [(name, name.removesuffix(".csv"), TYPES.get(name, "credit_card")) for name in FILES if name != "nobody.csv"]
    return spark.createDataFrame(rows, "file_name string, account_name string, account_type string")


def test_ingest(spark, folder, accounts):
    found = {r.raw_description: r for r in ingest_files(spark, folder, accounts).collect()}
    amounts = {text: float(row.amount) for text, row in found.items()}
    assert amounts == {
        'LYFT   "POOL", PORTO': -41.07,
        "AUTOMATIC PAYMENT PLAN B": 260.9,
        " COSTCO  TYRES ": -318.66,
        "TWICE": -8.2,
        "TENT HIRE": 62.35,
        "CHOIR FUND": 940.0,
        "PAINT SHOP": -33.8,
        "Payment": 71.0,
        "HULU WITH ADS": -6.75,
        "GARDEN LEASE": -402.18,
        "IN TIME": -2.0,
    }
    assert str(found["HULU WITH ADS"].transaction_date) == "2022-09-04"
    assert str(found["GARDEN LEASE"].transaction_date) == "2021-10-19"
    assert found["CHOIR FUND"].direction == "Income"


def test_rejects(spark, folder):
    lines = statements.read_statement_lines(spark, folder)
    columns = statements.map_columns(statements.discover_headers(lines))
    reasons = {r.file.rsplit("/", 1)[1]: r.reason for r in statements.rejected_files(columns).collect()}
    assert reasons == {"split.csv": statements.NO_AMOUNT, "late.csv": statements.NO_HEADER}
    assert [r.line for r in statements.wide_rows(lines, columns).collect()] == ["2022-05-11,WIDE,4.40,MORE"]
    with pytest.raises(ValueError, match="late.csv|split.csv"):
        statements.raise_on_rejects(columns)


def _collected(df):
    return df.collect(), df.schema


def test_every_row_is_accounted_for(spark, folder, accounts):
    """Body rows of usable files = transactions, their copies, and rejected rows; no file is lost."""
    found = load_files(spark, folder, accounts)
    files = {r.file.rsplit("/", 1)[1]: r.reason for r in found.rejected_files.collect()}
    assert files == {
        "split.csv": statements.NO_AMOUNT,
        "late.csv": statements.NO_HEADER,
        "nobody.csv": statements.NO_ACCOUNT,
        "empty.csv": statements.EMPTY,
    }
    reasons = sorted(r.reason for r in found.rejected_rows.collect())
    assert reasons == sorted(["no date", "no amount", "amount is not a number", TOO_LARGE, statements.TOO_WIDE])
    body = sum(text.count("\n") for name, text in FILES.items() if name not in files) - 5 - 3 - 24
    assert found.transactions.count() + len(reasons) == body - 1  # one row stands there twice


def test_places_hold_when_the_layout_changes(spark, tmp_path):
    for n in range(30):
        rows = "".join(f"2026-02-0{1 + k % 9},FILE {n} ROW {k},-{k}.50\n" for k in range(60))
        (tmp_path / f"f{n}.csv").write_text("note\n" * (n % 5) + "Date,Description,Amount\n" + rows)
    accounts = spark.createDataFrame(
        [(f"f{n}.csv", "a", "checking") for n in range(30)], "file_name string, account_name string, account_type string"
    )
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(name) for name in names]
    try:
        for name in names:
            spark.conf.set(name, "2048")
        lines = statements.read_statement_lines(spark, str(tmp_path))
        columns = spark.createDataFrame(*_collected(statements.map_columns(statements.discover_headers(lines))))
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)
        assert statements.statement_rows(lines, columns).count() == 1800
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)
    assert load_files(spark, str(tmp_path), accounts).transactions.count() == 1800


def test_account_by_full_path(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "same.csv").write_text(f"Date,Description,Amount\n2026-02-01,OF {name},-1.00\n")
    path = [r.file for r in statements.list_files(spark, str(tmp_path)).collect() if "/two/" in r.file][0]
    accounts = spark.createDataFrame(
        [("same.csv", "by name", "checking"), (path, "by path", "checking")], "file_name string, account_name string, account_type string"
    )
    found = load_files(spark, str(tmp_path), accounts).transactions.collect()
    assert {r.raw_description: r.account_name for r in found} == {"OF one": "by name", "OF two": "by path"}


def test_options(spark, folder, accounts):
    negative = ingest_files(spark, folder, accounts, paren_negative=True)
    assert float(negative.where("raw_description = 'TENT HIRE'").first().amount) == -62.35
    with pytest.raises(ValueError):
        ingest_files(spark, folder, accounts, strict=True)
    scoped = ingest_files(spark, folder, accounts, key_scope="account")
    assert scoped.count() == 11


def test_one_large_file_in_many_splits(spark, tmp_path):
    path = tmp_path / "big.csv"
    rows = [f"2026-01-{1 + i % 28:02d},SHOP {i},-{i}.25" for i in range(4000)]
    path.write_text("junk\nDate,Description,Amount\n" + "\n".join(rows) + "\n")
    accounts = spark.createDataFrame(
        [("big.csv", "big", "checking")], "file_name string, account_name string, account_type string"
    )
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        lines = statements.read_statement_lines(spark, str(path))
        assert lines.rdd.getNumPartitions() > 4
        for small in (True, False):
            found = ingest_lines(lines, accounts, small=small)
            assert (found.count(), found.agg({"amount": "sum"}).first()[0]) == (
                4000,
                -sum(range(4000)) - 1000,
            )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    "line, cells",
    [
        ("a,b", ["a", "b"]),
        (",x,", [None, "x", None]),
        ('"a, b",""', ["a, b", None]),
        ('"say ""hi""",1', ['say "hi"', "1"]),
        ('"abc"z, 1 ', ["abcz", " 1 "]),
        ('no "quote" start,2', ['no "quote" start', "2"]),
        ('"open,2', ['"open', "2"]),
        (",".join(str(i) for i in range(60)), [str(i) for i in range(60)]),
    ],
)
def test_cells(spark, line, cells):
    lines = spark.createDataFrame([("f", 0, 0, line)], "file string, block bigint, pos bigint, line string")
    assert statements.statement_cells(lines).first().cells == cells


def test_records_over_several_lines(spark, tmp_path):
    path = tmp_path / "my card + more.csv"
    wide = "2026-01-04,WIDE,-4.00" + ",x" * 80
    path.write_text(
        'note\nDate,Description,Amount,"Extended\nDetails"\n2026-01-02,"SHELL\nPUMP ""4""",-1.50,"a\nb"\n'
        f"2026-01-03,,-2.00,\n{wide}\n"
    )
    accounts = spark.createDataFrame(
        [(path.name, "card", "checking")], "file_name string, account_name string, account_type string"
    )
    found = ingest_files(spark, str(path), accounts, multiline=True).collect()
    assert {(r.raw_description, float(r.amount)) for r in found} == {('SHELL\nPUMP "4"', -1.5), (None, -2.0)}
    lines = statements.read_statement_lines(spark, str(path), multiline=True)
    columns = statements.map_columns(statements.discover_headers(lines))
    assert [r.line for r in statements.wide_rows(lines, columns).collect()] == [wide]


def test_second_load_adds_nothing(spark, folder, accounts):
    once = ingest_files(spark, folder, accounts)
    assert tables.insert_if_absent(once, once, order=["transaction_id"]).count() == once.count()


def test_ledger_and_tax_file(spark, folder, accounts, tmp_path):
    ledger = statements_to_ledger(spark, folder, accounts)
    out = str(tmp_path / "tax")
    reports.export_tax(ledger, out)
    back = statements.preview(spark, out, 100)
    assert back.columns == [
        "Date",
        "Account/Card",
        "Clean Merchant",
        "Tax Category",
        "Amount",
        "Direction",
        "Raw Statement Line",
    ]
    assert back.count() == ledger.count()
    assert statements.preview(spark, f"{folder}/card.csv").count() == 3


def test_audit_log(spark, folder, accounts, tmp_path):
    ledger = classify(ingest_files(spark, folder, accounts))
    unknown = unknown_rows(ledger)
    audit = labels.audit_batch(labels.row_payload(unknown), "b1", "tx_id", chunk_rows=2)
    labels.write_audit(audit, str(tmp_path / "log"))
    lines = spark.read.json(str(tmp_path / "log"))
    assert lines.agg({"record_count": "sum"}).first()[0] == unknown.count()
    texts = labels.audit_batch(labels.text_payload(unknown_descriptions(ledger)), "b2", "desc")
    assert texts.count() == 1


@pytest.mark.parametrize("inline", [300, 2, 0])
def test_seeded_rules(spark, inline):
    entities, rules, samples = seed_dims(spark)
    found = match_entities(samples, rules, entities, inline_rules=max(inline, 1))
    assert {r.raw_description: r.clean_name for r in found.collect()} == {
        "UBER *EATS PENDING SAN JOSE": "Uber Eats",
        "UBER *TRIP HELP.UBER.COM": "Uber Ride",
        "SAFEWAY STORE 0402": "Safeway",
        "CHASE CREDIT CARD PPD PMT": "Credit Card Payment",
    }


def test_truncate_in_order(spark, tmp_path):
    spark.range(3).write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable("tally_kept")
    try:
        assert tables.truncate_all(spark, ["tally_absent", "tally_kept"]) == ["tally_kept"]
        assert spark.table("tally_kept").count() == 0
    finally:
        spark.sql("DROP TABLE tally_kept")
