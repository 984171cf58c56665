"""Ledger inputs that Spark derives from the given tables.

Every frame here reads whole tables, so each query's work grows with them:

- orders become transactions (one per order) and statement lines (one file per customer),
- customers become the label mapping,
- pending orders become the cash log,
- nations become trips, suppliers entities, customers and regions the rules for them.

The same derivations are written as SQL in `checks.sql`.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.columns import FLIP, FORCE, KEEP
from tallyfold.operators.classify import classify
from tallyfold.operators.ingest import to_transactions, valid_rows
from tallyfold.plans.runs import label
from tallyfold.session import scratch_path
from tallyfold.sources.sidecars import PLACE

# Description texts; every rule fires for at least one, some come close only.
TEXTS = (
    "DOORDASH*STARBUCKS PIER 9",
    "DD *LOTUS KITCHEN 31",
    "dd *noodle house",
    "INSTACART*GREEN BASKET",
    "GRUBHUB*THAI GARDEN",
    "UBER  EATS ORDER 51 LISBON",
    "Uber night trip 5am",
    "LYFT SCOOTER 77",
    "CVS DRIVE-UP 12",
    "AUTOMATIC PAYMENT, MANY THANKS TO YOU",
    "INTERNET TRANSFER PAYMENT 6",
    "ONLINE CARD PAYMENT 3",
    "payment",
    "AUTOMATIC PAYMENT PLAN B",
    "ONLINE CC PAYMENT APRIL",
    "LOBBY ATM WITHDRAWAL 2",
    "YEARLY MAINTENANCE FEE",
    "LATE FINANCE CHARGE",
    "  netflix family plan ",
    "SPOTIFY DUO",
    "APPLE.COM/BILL MUSIC",
    "HULU WITH ADS",
    "SHELL RING ROAD",
    "CHEVRON EXIT 4",
    "EXXON HARBOUR",
    "MARRIOTT LAKESIDE",
    "METROCARD TOP-UP",
    "SFW_9 BAKERY",
    "SAFEWAY HILL STREET",
    "COSTCO TYRES",
    "TARGET STORE NORTH 55",
    "AMZN DIGITAL BOOK",
    "AMAZON FRESH BOX",
    "Amazon prime*membership year",
    "MCDONALDS STATION",
    "CHIPOTLE AIRPORT",
    "STARBUCKS PIER 3",
    "SWEETGREEN ELM AVE",
    "COACH TOURS",
    "SFW",
    "PRIME VIDEO MEMBERSHIP",
    "VENMO TO SAM",
    "PAYPAL BOOK FAIR",
    "ACH CREDIT SALARY",
    "it's 100% \"local\" co.",
    "CORNER SHOP",
    "HILLTOP FLATS RENTAL",
    "WIRE TO FRIEND",
)
# Texts that are followed by the customer number, so that distinct texts grow with the data.
LATER = 1_000_000_000_000
NUMBERED = ("CORNER SHOP", "HILLTOP FLATS RENTAL", "WIRE TO FRIEND", "COACH TOURS")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _dealt(df: DataFrame) -> DataFrame:
    """Deal rows to all cores when the input is one small split. A large input has more splits
    than cores already and stays where it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _listed(values) -> str:
    return ", ".join('"' + value.replace('"', '\\"') + '"' for value in values)


# Texts of an order, with faults of every kind spread over all orders; no order is left out.
_BASE = f"element_at(array({_listed(TEXTS)}), CAST(o_orderkey % {len(TEXTS)} AS INT) + 1)"
_DESCRIPTION = f"""
CASE WHEN o_orderkey % 101 = 0 THEN NULL
     WHEN base IN ({_listed(NUMBERED)}) THEN concat(base, " ", o_custkey) ELSE base END"""
_DATE_TEXT = """
CASE WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderkey % 107 = 0 THEN "not a date"
     ELSE date_format(o_orderdate, CASE o_orderkey % 5 WHEN 0 THEN "yyyy-MM-dd" WHEN 1 THEN "yyyy/MM/dd"
       WHEN 2 THEN "MM/dd/yyyy" WHEN 3 THEN "M/d/yyyy" ELSE "MM-dd-yyyy" END) END"""
_AMOUNT_TEXT = """
CASE WHEN o_orderkey % 109 = 0 THEN NULL WHEN o_orderkey % 113 = 0 THEN "PENDING"
     WHEN o_orderkey % 127 = 0 THEN concat("$", price) WHEN o_orderkey % 7 < 4 THEN concat("-", price)
     WHEN o_orderkey % 7 = 4 THEN concat("(", price, ")") WHEN o_orderkey % 7 = 5 THEN concat(" ", price, " ")
     ELSE price END"""


def account_columns(customer: str) -> list[str]:
    return [
        f"concat('acct_', {customer} % 5) AS account_name",
        f"CASE WHEN {customer} % 5 < 2 THEN 'checking' ELSE 'credit_card' END AS account_type",
        f"CASE WHEN {customer} % 5 < 2 THEN '{KEEP}' WHEN {customer} % 5 = 2 THEN '{FLIP}' ELSE '{FORCE}' END AS sign_rule",
    ]


def rows(spark: SparkSession, folder: str) -> DataFrame:
    """Statement rows as texts, one per order, with the account attached.

    The texts come out of a generator, as if read from a file: filters on what is parsed from
    them are not rewritten into filters on how they are made up here.
    """
    texts = f"'date_text', {_DATE_TEXT}, 'description', {_DESCRIPTION}, 'amount_text', {_AMOUNT_TEXT}"
    return (
        _dealt(table(spark, folder, "orders"))
        .selectExpr("*", f"{_BASE} AS base", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS price")
        .selectExpr(
            "concat('cust_', o_custkey, '.csv') AS file",
            "0L AS block",
            "o_orderkey + 100 AS pos",
            f"inline(array(named_struct({texts})))",
            "o_custkey",
            "o_orderstatus",
            *account_columns("o_custkey"),
        )
    )


def raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw transactions."""
    return to_transactions(valid_rows(rows(spark, folder)))


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    return classify(raw(spark, folder))


_HEAD = r"""
CASE style WHEN 0 THEN 'Date,Description,Amount,Running Bal.'
  WHEN 1 THEN 'Transaction Date,Post Date,Description,Category,Amount (USD),Memo'
  WHEN 2 THEN concat('Description:,', c_name, '\nPrinted:,11/30/2021\n,,,\ndate,"memo",amt')
  WHEN 3 THEN '\uFEFFTrans. Date,Payee,Charge,Updated'
  WHEN 4 THEN 'Date,Description,Deposits,Withdrawals' ELSE 'When,What,How much' END"""
_PLACES = f"IF(o_orderstatus = 'F', array(pos, pos + {LATER}), array(pos))"
_DATE_CELL, _AMOUNT_CELL = "coalesce(date_text, '')", "coalesce(amount_text, '')"
_TEXT_CELL = """concat('"', replace(coalesce(description, ''), '"', '""'), '"')"""
_CELLS = f"{_DATE_CELL}, {_TEXT_CELL}, {_AMOUNT_CELL}"
_BODY = f"""
CASE o_custkey % 6
  WHEN 1 THEN concat_ws(',', {_DATE_CELL}, {_DATE_CELL}, {_TEXT_CELL}, 'x', {_AMOUNT_CELL}, '')
  WHEN 2 THEN concat_ws(',', {_CELLS}) WHEN 3 THEN concat_ws(',', {_CELLS}, 'z', '')
  WHEN 4 THEN concat_ws(',', {_CELLS}, '') ELSE concat_ws(',', {_CELLS}, '1.00') END"""


def statement_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Statement files as lines, one file per customer, in six header styles.

    Style 4 has split amounts and style 5 no header; both are to be rejected. Style 2 opens
    with a preamble and style 3 with a byte order mark.
    """
    heads = (
        table(spark, folder, "customer")
        .selectExpr("concat('cust_', c_custkey, '.csv') AS file", "c_custkey % 6 AS style", "c_name")
        .selectExpr("file", f"posexplode(split({_HEAD}, '\n')) AS (pos, line)")
    )
    # Filled orders are exported a second time, further down the same file.
    bodies = rows(spark, folder).selectExpr(
        "file", f"explode({_PLACES}) AS pos", f"concat({_BODY}, IF(pos % 89 = 0, ',7,8,9', '')) AS line"
    )
    every = heads.selectExpr("file", "CAST(pos AS BIGINT) AS pos", "line").unionByName(bodies)
    return every.selectExpr("file", "0L AS block", "pos", "line")


def statement_files(spark: SparkSession, folder: str) -> str:
    """The statement lines as files on disk, one per customer, named like it.

    A folder holds the files whose names begin alike, so paths sort as the names do. Spark's own
    writer makes a folder per file, and spends most of its time on setting their permissions.
    """
    path = scratch_path(spark, "statements")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = statement_lines(spark, folder).withColumn("file", F.coalesce("file", F.lit("unnamed.csv")))
    lines = F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines")
    whole = named.repartition(parts, "file").groupBy("file").agg(lines)

    def write(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(path)
        made = set()
        for batch in batches:
            for name, text in zip(batch["file"].to_pylist(), batch["value"].to_pylist(), strict=True):
                at = f"{root}/{name[:8]}"
                if at not in made:
                    system.create_dir(at)
                    made.add(at)
                # Under its name only when it is whole: a task may be run again. Listings pass over the other one.
                part = f"{at}/.{name}-{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(f"{text}\n".encode())
                system.move(part, f"{at}/{name}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    texts = whole.select("file", F.array_join("lines.line", "\n").alias("value"))
    texts.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return path


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Account of each statement file."""
    customers = table(spark, folder, "customer")
    return customers.selectExpr("concat('cust_', c_custkey, '.csv') AS file_name", *account_columns("c_custkey"))


def trip_texts(spark: SparkSession, folder: str, per: str = "nation") -> DataFrame:
    """A trip per nation (or customer), as texts in the layouts the sidecar accepts; many overlap."""
    key, name = F.col(f"{per[0]}_{'nation' if per == 'nation' else 'cust'}key"), F.col(f"{per[0]}_name")
    start = F.date_add(F.lit("1995-02-01").cast("date"), (key * 61 % 2400).cast("int"))
    end = F.date_add(start, (F.lit(10) + key * 5 % 120).cast("int"))

    def text(day: Column) -> Column:
        return (
            F.when(key % 3 == 0, F.date_format(day, "M/d/yyyy"))
            .when(key % 3 == 1, F.date_format(day, "yyyy-MM-dd"))
            .otherwise(F.date_format(day, "yyyy/MM/dd"))
        )

    return table(spark, folder, per).select(
        F.concat(F.lit("TRIP-"), key.cast("string")).alias("trip_id"),
        text(start).alias("start_date"),
        text(end).alias("end_date"),
        F.when(key % 2 == 0, "Business").otherwise("Personal").alias("trip_type"),
        name.alias("destination"),
        F.when(key % 4 != 0, F.concat(F.lit("note "), name)).alias("notes"),
    )


def cash_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Cash log entries as texts: each pending order's amount on its date, urgent ones twice."""
    pending = table(spark, folder, "orders").where(F.col("o_orderstatus") == "P")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    key = F.col("o_orderkey")
    twice = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return pending.select(
        F.when(key % 2 == 0, F.date_format("o_orderdate", "M/d/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("tx_date"),
        F.concat(F.lit("-"), price).alias("amount"),
        F.when(key % 3 != 0, "Shared flat loan").alias("override_category"),
        F.when(key % 4 == 0, "FALSE").otherwise("TRUE").alias("is_loan"),
        F.explode(twice).alias("copy"),
        key.alias("entry"),
    ).select(
        "tx_date",
        "amount",
        "override_category",
        "is_loan",
        F.concat(F.lit("entry "), F.col("entry").cast("string"), F.lit("/"), F.col("copy").cast("string")).alias(
            "notes"
        ),
    )


def spoiled_cash(spark: SparkSession, folder: str) -> DataFrame:
    """A cash log entry per pending order; some dates, amounts and loan flags cannot be read."""
    key = F.col("o_orderkey")
    pending = table(spark, folder, "orders").where(F.col("o_orderstatus") == "P")
    return pending.select(
        F.when(key % 5 == 0, "next week").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("tx_date"),
        F.when(key % 7 == 0, "much").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("amount"),
        F.lit(None).cast("string").alias("override_category"),
        F.when(key % 11 == 0, "maybe").when(key % 13 != 0, "FALSE").alias("is_loan"),
        F.concat(F.lit("entry "), key.cast("string")).alias("notes"),
    )


def repeated_trips(spark: SparkSession, folder: str) -> DataFrame:
    """A second trips file: two of three trips again, each twice; the first of the two has later dates."""
    texts = trip_texts(spark, folder).where("CAST(substr(trip_id, 6) AS BIGINT) % 3 <> 0")
    wrong = texts.withColumns({"start_date": F.lit("2031-01-01"), "end_date": F.lit("2031-01-05")})
    right = texts.withColumn("destination", F.upper("destination"))
    return wrong.withColumn(PLACE, F.lit(1)).unionByName(right.withColumn(PLACE, F.lit(2)))


def _label(text: str, merchant: str, category: str, sub_category: str, channel: str, at: int) -> str:
    return f"""named_struct('raw_description', {text}, 'merchant', {merchant}, 'category', {category},
      'sub_category', {sub_category}, 'channel', {channel}, 'seq', c_custkey * 10 + {at})"""


_SHOP = "concat('CORNER SHOP ', c_custkey)"
_LABELS = f"""filter(array(
  {_label(_SHOP, "concat('Corner Shop ', c_custkey)", "IF(c_mktsegment = 'MACHINERY', 'Gadgets', 'Groceries')",
          "IF(c_mktsegment = 'HOUSEHOLD', NULL, 'Convenience')", "IF(c_mktsegment = 'FURNITURE', NULL, 'pos')", 0)},
  {_label("concat('HILLTOP FLATS RENTAL ', c_custkey)", "IF(c_mktsegment = 'HOUSEHOLD', NULL, 'Hilltop Flats')",
          "'Transfer'", "'Rent Payment'", "'ach'", 1)},
  {_label("concat('WIRE TO FRIEND ', c_custkey)", "'Zelle'", "IF(c_mktsegment = 'BUILDING', 'Cash', 'Transfer')",
          "'Person to Person Payment'", "'p2p'", 2)},
  {_label("'SWEETGREEN ELM AVE'", "'Never used'", "'Meals'", "'Salad'", "'pos'", 3)},
  IF(c_mktsegment = 'AUTOMOBILE',
     {_label(_SHOP, "concat('Corner Shop No. ', c_custkey)", "'Shopping'", "'Corner'", "'online'", 4)}, NULL)
), entry -> entry IS NOT NULL)"""


def mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Labels for the numbered texts of each customer; one segment is labelled twice.

    It also holds a text that rules already label, absent fields and a category that is not allowed.
    """
    return table(spark, folder, "customer").selectExpr(f"inline({_LABELS})")


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger with rules and mapping applied."""
    return label(raw(spark, folder), mapping(spark, folder))


def entities(spark: SparkSession, folder: str) -> DataFrame:
    """An entity per supplier."""
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("int").alias("entity_id"),
        F.col("s_name").alias("clean_name"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("primary_category"),
    )


def merchant_map(spark: SparkSession, folder: str) -> DataFrame:
    """Rules that point at suppliers: a keyword per customer, and per region three more.

    Those are a regular expression, a keyword without an entity, and one that is too general.
    Keywords hold each other, so priority and length decide.
    """
    key = F.col("c_custkey")
    customers = table(spark, folder, "customer").select(
        F.concat(F.lit("SHOP "), key.cast("string")).alias("pattern"),
        F.lit("keyword").alias("match_type"),
        F.col("c_nationkey").cast("int").alias("entity_id"),
        (F.lit(1) + key % 2).cast("int").alias("priority"),
    )
    region = F.col("r_regionkey")
    regions = table(spark, folder, "region").select(
        F.inline(
            F.array(
                F.struct(
                    F.concat(F.lit("^CORNER SHOP [0-9]*"), region.cast("string"), F.lit("$")).alias("pattern"),
                    F.lit("regex").alias("match_type"),
                    (region + 1).cast("int").alias("entity_id"),
                    F.lit(2).alias("priority"),
                ),
                F.struct(
                    F.concat(F.lit("FLATS RENTAL "), region.cast("string")).alias("pattern"),
                    F.lit("keyword").alias("match_type"),
                    (region + 100000000).cast("int").alias("entity_id"),
                    F.lit(1).alias("priority"),
                ),
                F.struct(
                    F.substring("r_name", 1, 2).alias("pattern"),
                    F.lit("keyword").alias("match_type"),
                    (region + 2).cast("int").alias("entity_id"),
                    F.lit(3).alias("priority"),
                ),
            )
        )
    )
    return customers.unionByName(regions)
