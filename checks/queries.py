"""One query per operator, over the given tables."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as fx
from tallyfold.functions import columns as cols
from tallyfold.operators import classify as cl
from tallyfold.operators import context as ctx
from tallyfold.operators import entities as ent
from tallyfold.operators import ingest as ing
from tallyfold.operators import labels as lab
from tallyfold.operators import reports as rep
from tallyfold.operators import tables as tab
from tallyfold.operators.skew import fits_broadcast
from tallyfold.schemas import P2P, RAW_TRANSACTIONS
from tallyfold.session import kept, scratch_path, tune
from tallyfold.sources import sidecars, statements

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, last of all, so results compare across engines."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def register(name: str, source: Query, then: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    QUERIES[name] = lambda spark, folder: plain(then(source(tune(spark), folder)))


def query(function: Query) -> Query:
    register(function.__name__, function)
    return function


def on_ledger(name: str, report: Callable[[DataFrame], DataFrame]) -> None:
    register(name, fx.ledger, report)


def on_labelled(name: str, report: Callable[[DataFrame], DataFrame]) -> None:
    register(name, fx.labelled, report)


def trips(spark, folder):
    return sidecars.parse_trips(fx.trip_texts(spark, folder))


def cash(spark, folder):
    return sidecars.parse_cash(fx.cash_texts(spark, folder))


# Statement files


@query
def statement_cells(spark, folder):
    cells = statements.statement_cells(fx.statement_lines(spark, folder))
    return cells.select(
        "file",
        "pos",
        F.size("cells").cast("bigint").alias("n_cells"),
        F.get("cells", F.lit(0)).alias("c0"),
        F.get("cells", F.lit(1)).alias("c1"),
        F.get("cells", F.lit(2)).alias("c2"),
        F.get("cells", F.lit(3)).alias("c3"),
    )


@query
def header_discovery(spark, folder):
    heads = statements.discover_headers(fx.statement_lines(spark, folder))
    return heads.select("file", "header_line", F.array_join("header", "|").alias("header"))


@query
def column_mapping(spark, folder):
    heads = statements.discover_headers(fx.statement_lines(spark, folder))
    return statements.map_columns(heads).select("file", "date_ix", "desc_ix", "amt_ix", "reject_reason")


@query
def rejected_files(spark, folder):
    heads = statements.discover_headers(fx.statement_lines(spark, folder))
    return statements.rejected_files(statements.map_columns(heads))


@query
def wide_rows(spark, folder):
    lines = fx.statement_lines(spark, folder)
    columns = statements.map_columns(statements.discover_headers(lines))
    return statements.wide_rows(lines, columns).select("file", "pos", "reason")


@query
def statement_rows(spark, folder):
    lines = fx.statement_lines(spark, folder)
    columns = statements.map_columns(statements.discover_headers(lines))
    return statements.statement_rows(lines, columns).drop("block")


@query
def ingest_statements(spark, folder):
    accounts = fx.accounts(spark, folder)
    one_file_each = fits_broadcast(accounts)
    return ing.ingest_lines(fx.statement_lines(spark, folder), accounts, small=one_file_each)


@query
def ingest_statements_shuffled(spark, folder):
    return ing.ingest_lines(fx.statement_lines(spark, folder), fx.accounts(spark, folder), small=False)


@query
def ingest_from_files(spark, folder):
    """The statement lines written out as files, one per customer, and ingested from there."""
    path = fx.statement_files(spark, folder)
    files = statements.list_files(spark, path).select("file", ing.base_name("file").alias("file_name"))
    accounts = files.join(fx.accounts(spark, folder), "file_name").drop("file_name")
    return ing.ingest_files(spark, path, accounts.withColumnRenamed("file", "file_name"))


@query
def rejected_input(spark, folder):
    """Rejected files and rows by reason; every fourth file has no account."""
    accounts = fx.accounts(spark, folder).where("CAST(regexp_extract(file_name, '[0-9]+', 0) AS BIGINT) % 4 <> 3")
    found = ing.load_lines(fx.statement_lines(spark, folder), accounts)
    files = found.rejected_files.withColumn("kind", F.lit("file"))
    rows = found.rejected_rows.select("file", "reason").withColumn("kind", F.lit("row"))
    return files.unionByName(rows).groupBy("file", "kind", "reason").agg(F.count("*").alias("n"))


@query
def file_preview(spark, folder):
    path = scratch_path(spark, "preview")
    customers = fx.table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    customers.orderBy("c_custkey").write.option("header", True).csv(path)
    return statements.preview(spark, path, 5)


@query
def cash_rejects(spark, folder):
    return sidecars.cash_rejects(fx.spoiled_cash(spark, folder)).select("notes", "reason")


@query
def trips_sidecar(spark, folder):
    return sidecars.parse_trips(fx.trip_texts(spark, folder, "customer"))


@query
def cash_sidecar(spark, folder):
    return cash(spark, folder)


# Row-level parsing


@query
def parsed_amounts(spark, folder):
    rows = fx.rows(spark, folder)
    return rows.select(
        "pos",
        cols.parse_amount("amount_text").alias("amount"),
        cols.parse_amount("amount_text", paren_negative=True).alias("amount_paren_negative"),
    )


@query
def parsed_dates(spark, folder):
    return fx.rows(spark, folder).select("pos", cols.parse_date("date_text").alias("day"))


@query
def signed_amounts(spark, folder):
    rows = fx.rows(spark, folder).withColumn("parsed", cols.parse_amount("amount_text"))
    amount = cols.normalize_sign("parsed", "description", "sign_rule")
    return rows.select("pos", amount.alias("amount")).withColumn("direction", cols.direction("amount"))


@query
def content_keys(spark, folder):
    return fx.rows(spark, folder).select(
        "pos",
        cols.content_key("date_text", "description", "amount_text").alias("transaction_id"),
        cols.content_key("account_name", "date_text", "description", "amount_text").alias("account_scoped_id"),
    )


@query
def valid_rows(spark, folder):
    return ing.valid_rows(fx.rows(spark, folder)).select("pos", "date_text", "amount_text")


@query
def attached_accounts(spark, folder):
    rows = fx.rows(spark, folder).select("file", "pos")
    named = fx.accounts(spark, folder).drop("sign_rule")
    return ing.with_account(rows, named, spread="pos")


@query
def raw_transactions(spark, folder):
    return fx.raw(spark, folder).drop("file", "block", "pos")


# Labels


@query
def classified_ledger(spark, folder):
    return fx.ledger(spark, folder)


def _axis(name: str) -> None:
    def axis(spark, folder):
        return fx.ledger(spark, folder).select("transaction_id", "raw_description", name)

    register(f"{name}_axis", axis)


for _name in ("merchant_name", "category", "sub_category", "channel"):
    _axis(_name)


@query
def prefix_strip(spark, folder):
    rows = fx.rows(spark, folder)
    return rows.select("pos", "description", cl.strip_prefix("description").alias("merchant"))


on_ledger("unknown_rows", cl.unknown_rows)
on_ledger("unknown_descriptions", cl.unknown_descriptions)


@query
def mapped_labels(spark, folder):
    return fx.labelled(spark, folder)


@query
def mapped_labels_shuffled(spark, folder):
    return lab.apply_mapping(fx.ledger(spark, folder), fx.mapping(spark, folder), small=False)


@query
def latest_mapping(spark, folder):
    return lab.latest_mapping(fx.mapping(spark, folder))


@query
def mapping_usable(spark, folder):
    return lab.validate_mapping(fx.mapping(spark, folder))[0]


@query
def mapping_rejects(spark, folder):
    return lab.validate_mapping(fx.mapping(spark, folder))[1].select("raw_description", "seq", "reject_reason")


@query
def entity_match(spark, folder):
    texts = cl.unknown_descriptions(fx.ledger(spark, folder))
    return ent.match_entities(texts, fx.merchant_map(spark, folder), fx.entities(spark, folder))


@query
def entity_match_by_join(spark, folder):
    texts = cl.unknown_descriptions(fx.ledger(spark, folder))
    rules, entities = fx.merchant_map(spark, folder), fx.entities(spark, folder)
    return ent.match_entities(texts, rules, entities, inline_rules=3)


@query
def orphan_rules(spark, folder):
    return ent.orphan_rules(fx.merchant_map(spark, folder), fx.entities(spark, folder))


@query
def audit_of_rows(spark, folder):
    payload = lab.row_payload(cl.unknown_rows(fx.ledger(spark, folder)))
    return lab.audit_batch(payload, "batch-1", "tx_id", chunk_rows=100)


@query
def audit_of_texts(spark, folder):
    payload = lab.text_payload(cl.unknown_descriptions(fx.ledger(spark, folder)))
    return lab.audit_batch(payload, "batch-2", "desc", chunk_rows=100)


# Trip and cash context


def _travelled(mode: str = "auto", on_overlap: str = "all") -> Query:
    return lambda spark, folder: ctx.ledger_with_trips(
        fx.labelled(spark, folder), trips(spark, folder), mode, on_overlap
    )


def _master(mode: str = "auto") -> Query:
    return lambda spark, folder: ctx.master_ledger(
        fx.labelled(spark, folder), trips(spark, folder), cash(spark, folder), mode
    )


register("ledger_with_trips", _travelled())
register("ledger_with_trips_shuffled", _travelled("days"))
register("ledger_with_first_trip", _travelled(on_overlap="first"))
register("master_ledger", _master())
register("master_ledger_shuffled", _master("days"))
register("travel_rows", _travelled(), ctx.travel_rows)
register("business_expenses", _master(), ctx.business_expenses)
register("monthly_burn", _travelled(), rep.monthly_burn)
register("latest_burn_months", _travelled(), lambda df: rep.monthly_burn(df, last=6))


@query
def cash_match(spark, folder):
    matched = ctx.match_cash(fx.labelled(spark, folder), cash(spark, folder))
    return matched.select(
        "transaction_id", "transaction_date", "amount", "override_category", "is_loan", "cash_notes"
    )


@query
def loan_tracking(spark, folder):
    return ctx.loan_tracking(fx.labelled(spark, folder), cash(spark, folder))


# Reports


def _lent(ledger):
    """Person-to-person payments labelled as cash: too few to fill every month."""
    return ledger.where((F.col("category") == "Cash") & (F.col("sub_category") == P2P))


on_ledger("ledger_status", rep.ledger_status)
on_labelled("tax_summary", rep.tax_summary)
on_labelled("tax_export", rep.tax_export)
on_labelled("merchant_history", lambda df: rep.merchant_history(df, "Shop"))
on_ledger("merchant_history_wildcard", lambda df: rep.merchant_history(df, "amzn%us"))
on_labelled("category_direction", rep.category_direction)
on_labelled("monthly_pivot", lambda df: rep.monthly_pivot(df, "1996-02-01", "1996-08-01"))
on_labelled("high_spenders", rep.high_spenders)
on_labelled("account_category", rep.account_category)
on_labelled("account_groceries", lambda df: rep.account_category(df).where(F.col("category") == "Groceries"))
on_labelled("monthly_resample", lambda df: rep.resample(df, "month_end"))
on_labelled("weekly_resample", lambda df: rep.resample(df, "week_sunday"))
on_labelled("sparse_resample", lambda df: rep.resample(_lent(df), "month_end"))
on_labelled("category_channel", rep.category_channel)
on_ledger("platform_analysis", rep.platform_analysis)
on_ledger("row_count", tab.row_count)
on_ledger("running_balance", rep.running_balance)
on_labelled("running_balance_of_account", lambda df: rep.running_balance(df, "acct_1"))
on_labelled("last_transactions", lambda df: rep.last_n(df, ["transaction_date", "transaction_id"], 6))
on_ledger("description_search", lambda df: cl.search_description(df, "%prime%member%"))
on_ledger("rows_for_merchant", lambda df: cl.rows_for_merchant(df, "Amazon"))
on_labelled("net_of_transfers", rep.net_of_transfers)


@query
def latest_months(spark, folder):
    ledger = fx.ledger(spark, folder)
    newest = rep.latest_months(ledger)
    shown = ledger.select(cols.month_of("transaction_date").alias("month")).distinct()
    return shown.where(F.col("month").isin(newest))


@query
def compare_months(spark, folder):
    ledger = fx.labelled(spark, folder)
    current, last = rep.latest_months(ledger)
    compared = rep.compare_months(ledger, [current, last])
    return compared.select(
        "category",
        F.col(f"`{last}`").alias("last_total"),
        F.col(f"`{current}`").alias("current_total"),
        F.lit(last).alias("last_month"),
        F.lit(current).alias("current_month"),
    )


# Keeping tables


def _raw_of(spark, folder, *statuses):
    rows = fx.rows(spark, folder).where(F.col("o_orderstatus").isin(*statuses))
    return ing.to_transactions(ing.valid_rows(rows))


@query
def insert_if_absent(spark, folder):
    """Stored open orders win over the batch, which holds every row twice."""
    stored = _raw_of(spark, folder, "O").withColumn("account_type", F.lit("stored"))
    batch = _raw_of(spark, folder, "O", "F", "P")
    again = batch.withColumn("pos", F.col("pos") + fx.LATER).withColumn("account_type", F.lit("later"))
    return tab.insert_if_absent(stored, batch.unionByName(again), order=ing.ARRIVAL).drop(*ing.ARRIVAL)


@query
def upsert_labels(spark, folder):
    """Stored rows keep date, amount and direction; labels come from the new sweep."""
    stored = cl.classify(_raw_of(spark, folder, "O", "P")).withColumns(
        {"amount": F.col("amount").cast("decimal(16,2)") * 2, "category": F.lit("old"), "channel": F.lit("old")}
    )
    return tab.upsert_labels(stored, cl.classify(_raw_of(spark, folder, "P", "F")))


@query
def upsert_by_key(spark, folder):
    """Two updates for one segment's accounts, where the later one wins; others are kept."""
    customers = fx.table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    stored = customers.where(F.col("c_mktsegment") != "BUILDING").withColumn("seq", F.lit(0))
    changed = customers.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    first = changed.withColumn("seq", F.lit(1))
    second = changed.withColumns({"c_name": F.upper("c_name"), "seq": F.lit(2)})
    return tab.upsert_by_key(stored, first.unionByName(second), "c_custkey", ["seq"])


@query
def replaced_table(spark, folder):
    """The cash log written over an older one and read back."""
    path = scratch_path(spark, "cash_log")
    entries = cash(spark, folder)
    tab.replace_table(entries.where(F.col("is_loan")), path)
    tab.replace_table(entries, path)
    return spark.read.parquet(path)


@query
def upsert_trips(spark, folder):
    """A second trips file in which ids repeat; the last row of a file counts, whatever its dates."""
    stored = trips(spark, folder)
    texts = fx.repeated_trips(spark, folder)
    return tab.upsert_by_key(stored, sidecars.parse_trips(texts), "trip_id", [sidecars.PLACE]).drop(sidecars.PLACE)


@query
def stored_ledger(spark, folder):
    """Insert-if-absent, relabelling and deletion on a stored, month-partitioned ledger."""
    path = scratch_path(spark, "ledger")
    arrived = _raw_of(spark, folder, "F", "O")
    # Four changes take the batch, so it is classified once and kept.
    filled = kept(spark, cl.classify(arrived.drop(*ing.ARRIVAL)), "filled")
    placed = filled.withColumn("pos", F.lit(0))
    tab.create_monthly(spark, path)
    tab.append_monthly(spark, path, filled.where(F.col("direction") == "Expense"))
    tab.append_absent(spark, path, placed, ["pos"], stored=True)
    tab.append_absent(spark, path, placed, ["pos"], stored=True)
    tab.rewrite_labels(spark, path, filled.withColumn("channel", F.upper("channel")), stored=True)
    tab.delete_rows(spark, path, F.col("account_name") == "acct_3")
    return tab.read_monthly(spark, path)


@query
def stored_raw_transactions(spark, folder):
    """The landing table: two appends of one batch, an account deleted, then a window of another."""
    path = scratch_path(spark, "raw_transactions")
    batch = _raw_of(spark, folder, "F", "O", "P")
    tab.create_monthly(spark, path, RAW_TRANSACTIONS)
    tab.append_absent(spark, path, batch, ing.ARRIVAL)
    tab.append_absent(spark, path, batch, ing.ARRIVAL)
    tab.delete_rows(spark, path, F.col("account_name") == "acct_1")
    tab.delete_rows(spark, path, F.col("account_name") == "acct_3", "1996-01-15", "1998-01-20")
    return tab.read_monthly(spark, path)


@query
def stored_window(spark, folder):
    """A date window of a stored ledger; only its months are read."""
    path = scratch_path(spark, "ledger")
    tab.create_monthly(spark, path)
    tab.append_monthly(spark, path, fx.ledger(spark, folder))
    return tab.read_monthly(spark, path, None, "1997-03-10", "1997-11-05")


@query
def truncated_tables(spark, folder):
    """Two catalog tables filled from given ones and emptied in order; an absent one is skipped."""
    names = [f"{name}_{uuid.uuid4().hex}" for name in ("first", "second")]
    counts = []
    try:
        for name, source in zip(names, ("customer", "orders"), strict=True):
            path = scratch_path(spark, name)
            fx.table(spark, folder, source).write.option("path", path).saveAsTable(name)
        before = [spark.table(name).agg(F.count("*").alias("n_before")) for name in names]
        counts = [frame.first()["n_before"] for frame in before]
        emptied = tab.truncate_all(spark, [names[1], "tally_absent", names[0]])
        after = [spark.table(name).count() for name in names]
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = [(label, counts[k], after[k], emptied.index(names[k]) + 1) for k, label in enumerate(("customer", "orders"))]
    return spark.createDataFrame(rows, "source string, n_before bigint, n_after bigint, turn bigint")


on_ledger("delete_account", lambda df: tab.delete_where(df, F.col("account_name") == "acct_1"))
on_ledger("delete_accounts", lambda df: tab.delete_where(df, F.col("account_name").isin("acct_1", "acct_4")))
on_ledger(
    "delete_account_window",
    lambda df: tab.delete_where(
        df,
        (F.col("account_name") == "acct_3") & F.col("transaction_date").between("1996-01-15", "1998-01-20"),
    ),
)
