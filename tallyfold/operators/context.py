"""Trip and cash context laid over the ledger by joins, and reports on it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.skew import dimension_join, first_by
from tallyfold.schemas import NO_CATEGORY, NO_TRIP, NOT_SPENDING, P2P, TRIP_CATEGORIES


def trip_days(trips: DataFrame, on_overlap: str = "all") -> DataFrame:
    """One row per trip and day, both end days included.

    This turns the date-range join into an equality join on the day, so each ledger row
    looks its trips up by hash instead of being compared with every trip.
    With `on_overlap='first'` a day keeps only the trip that starts first.
    """
    valid = trips.where(F.col("start_date") <= F.col("end_date"))
    days = valid.select(
        "trip_id",
        "trip_type",
        "destination",
        "start_date",
        F.explode(F.sequence("start_date", "end_date")).alias("trip_day"),
    )
    if on_overlap == "first":
        days = first_by(days, ["trip_day"], ["start_date", "trip_id"])
    elif on_overlap != "all":
        raise ValueError("on_overlap must be 'all' or 'first'")
    return days.drop("start_date")


def trip_eligible(category: Column, sub_category: Column) -> Column:
    """Only travel-related categories take a trip's context, and person-to-person payments never."""
    return category.isin(*TRIP_CATEGORIES) & (sub_category != P2P)


def _with_trips(ledger: DataFrame, trips: DataFrame, mode: str, on_overlap: str) -> DataFrame:
    if mode not in ("auto", "broadcast", "days"):
        raise ValueError("mode must be 'auto', 'broadcast' or 'days'")
    small = {"auto": None, "broadcast": True, "days": False}[mode]

    def condition(fact, trip):
        eligible = trip_eligible(fact("category"), fact("sub_category"))
        return (fact("transaction_date") == trip("trip_day")) & eligible

    days = trip_days(trips, on_overlap)
    return dimension_join(ledger, days, condition, "transaction_id", "left", small, {"transaction_date": "trip_day"})


def ledger_with_trips(
    ledger: DataFrame, trips: DataFrame, mode: str = "auto", on_overlap: str = "all"
) -> DataFrame:
    """Ledger rows with the context of the trip they fall into.

    Overlapping trips repeat a row, once per trip. `mode` forces the broadcast or the
    shuffled plan; by default the size of the trip-day table decides.
    """
    joined = _with_trips(ledger, trips, mode, on_overlap)
    return joined.select(
        *[F.col(f"facts.{name}") for name in ledger.columns],
        "trip_id",
        F.coalesce("trip_type", F.lit(NO_TRIP)).alias("travel_context"),
        F.col("destination").alias("trip_location"),
        F.col("trip_id").isNotNull().alias("is_travel_expense"),
    )


def _cash_condition(fact, cash):
    return (fact("transaction_date") == cash("cash_day")) & (fact("amount") == cash("cash_amount"))


def match_cash(ledger: DataFrame, cash: DataFrame, small: bool | None = None) -> DataFrame:
    """Ledger rows with the cash-log entry of the same date and amount, NULL if there is none.

    Two entries of one date and amount repeat the row.
    """
    entries = cash.select(
        F.col("tx_date").alias("cash_day"),
        F.col("amount").alias("cash_amount"),
        "override_category",
        "is_loan",
        F.col("notes").alias("cash_notes"),
    )
    keys = {"transaction_date": "cash_day", "amount": "cash_amount"}
    joined = dimension_join(ledger, entries, _cash_condition, "transaction_id", "left", small, keys)
    return joined.select(
        *[F.col(f"facts.{name}") for name in ledger.columns], "override_category", "is_loan", "cash_notes"
    )


def _overlaid(ledger: DataFrame, trips: DataFrame, cash: DataFrame, mode: str) -> DataFrame:
    travelled = ledger_with_trips(ledger, trips, mode)
    small = {"auto": None, "broadcast": True, "days": False}[mode]
    return match_cash(travelled, cash, small).select(
        F.col("transaction_date").alias("tx_date"),
        F.col("raw_description").alias("merchant_string"),
        "amount",
        F.coalesce("override_category", "category", F.lit(NO_CATEGORY)).alias("final_category"),
        "travel_context",
        "trip_location",
        F.coalesce("is_loan", F.lit(False)).alias("is_account_receivable"),
        F.col("cash_notes").alias("notes"),
        "trip_id",
    )


def master_ledger(ledger: DataFrame, trips: DataFrame, cash: DataFrame, mode: str = "auto") -> DataFrame:
    """Ledger with trip context and cash overrides, in seven columns."""
    return _overlaid(ledger, trips, cash, mode).drop("notes", "trip_id")


def travel_rows(travelled: DataFrame) -> DataFrame:
    """Rows that belong to a trip, by date. The trip_id test lets the outer join become inner."""
    on_trip = F.col("trip_id").isNotNull() & (F.col("travel_context") != NO_TRIP)
    return (
        travelled.where(on_trip)
        .select("transaction_date", "raw_description", "amount", "travel_context", "trip_location")
        .orderBy(F.asc_nulls_last("transaction_date"))
    )


def business_expenses(master: DataFrame) -> DataFrame:
    """Spending on business trips, by date."""
    wanted = (F.col("travel_context") == "Business") & ~F.col("final_category").isin(*NOT_SPENDING)
    return (
        master.where(wanted)
        .select("tx_date", "merchant_string", "amount", "final_category", "travel_context", "trip_location")
        .orderBy(F.asc_nulls_last("tx_date"))
    )


def loan_tracking(ledger: DataFrame, cash: DataFrame) -> DataFrame:
    """Ledger rows matched to a loan in the cash log, with its notes. Only loans enter the join."""
    loans = cash.where(F.col("is_loan"))
    return (
        match_cash(ledger, loans)
        .where(F.col("is_loan"))
        .select(
            F.col("transaction_date").alias("tx_date"),
            F.col("raw_description").alias("merchant_string"),
            "amount",
            F.coalesce("override_category", "category", F.lit(NO_CATEGORY)).alias("final_category"),
            F.col("is_loan").alias("is_account_receivable"),
            F.col("cash_notes").alias("notes"),
        )
        .orderBy(F.asc_nulls_last("tx_date"))
    )
