"""Reports over the ledger.

Every grouping here is on a small set of keys, so tasks pre-aggregate and only partial sums
are shuffled. Sums run on decimals; orderings name their NULL order.
"""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfold.functions.columns import money, month_of
from tallyfold.schemas import (
    EXPENSE,
    FIXED_CATEGORIES,
    MONEY,
    NOT_SPENDING,
    RENT,
    TRANSFER,
    VARIABLE_CATEGORIES,
)
from tallyfold.session import kept


def _count() -> Column:
    return F.count(F.lit(1))


def _sum(value: Column | str = "amount") -> Column:
    return money(F.sum(value))


def _sum_if(condition: Column, value: Column) -> Column:
    return money(F.sum(F.when(condition, value).otherwise(F.lit(0).cast(MONEY))))


def _expenses(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("direction") == EXPENSE)


def ledger_status(ledger: DataFrame) -> DataFrame:
    """Rows and total per category."""
    return ledger.groupBy("category").agg(_count().alias("n"), F.sum("amount").alias("total"))


def tax_summary(ledger: DataFrame) -> DataFrame:
    """Rows and net amount per category, expenses counted below zero."""
    size = F.abs("amount")
    net = F.when(F.col("direction") == EXPENSE, -size).otherwise(size)
    summary = ledger.groupBy("category").agg(_count().alias("total_count"), _sum(net).alias("net_amount"))
    return summary.orderBy(F.asc_nulls_last("net_amount"))


def tax_export(ledger: DataFrame) -> DataFrame:
    """All transactions for the tax file, newest first."""
    return ledger.orderBy(F.desc_nulls_last("transaction_date")).select(
        F.col("transaction_date").alias("Date"),
        F.col("account_name").alias("Account/Card"),
        F.col("merchant_name").alias("Clean Merchant"),
        F.col("category").alias("Tax Category"),
        F.col("amount").alias("Amount"),
        F.col("direction").alias("Direction"),
        F.col("raw_description").alias("Raw Statement Line"),
    )


def export_tax(ledger: DataFrame, path: str) -> None:
    """Write the tax file as CSV parts whose names follow the date order; nothing is collected."""
    tax_export(ledger).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").option(
        "escape", '"'
    ).csv(path)


def _month() -> Column:
    """First day of the month. Grouping on a date is cheap; only result rows are formatted."""
    return F.trunc("transaction_date", "MM")


def _newest_months_first(grouped: DataFrame, name: str) -> DataFrame:
    labelled = grouped.withColumn("_month", month_of("_month")).withColumnRenamed("_month", name)
    return labelled.orderBy(F.desc_nulls_last(name))


def monthly_burn(travelled: DataFrame, last: int | None = None) -> DataFrame:
    """Fixed, variable and total spending per month, newest first.

    `last` keeps that many of the newest months.
    """
    size = F.abs("amount")
    category, sub_category = F.col("category"), F.col("sub_category")
    rent = sub_category == RENT
    burn = travelled.groupBy(_month().alias("_month")).agg(
        _sum_if(category.isin(*FIXED_CATEGORIES) | ((category == TRANSFER) & rent), size).alias("fixed_overhead"),
        _sum_if(category.isin(*VARIABLE_CATEGORIES), size).alias("variable_lifestyle"),
        _sum_if(~category.isin(*NOT_SPENDING) | rent, size).alias("total_operational_spend"),
    )
    newest = _newest_months_first(burn, "monthly_period")
    return newest if last is None else newest.limit(last)


def merchant_history(ledger: DataFrame, term: str) -> DataFrame:
    """Monthly rows and spending where the merchant or the raw text holds the term.

    LIKE wildcards inside the term keep their meaning.
    """
    pattern = f"%{term}%".replace("\\", "\\\\")
    hits = ledger.where(F.col("merchant_name").ilike(pattern) | F.col("raw_description").ilike(pattern))
    months = hits.groupBy(_month().alias("_month")).agg(
        _count().alias("transactions"), _sum(F.abs("amount")).alias("total_spent")
    )
    return _newest_months_first(months, "month")


def latest_months(ledger: DataFrame, n: int = 2) -> list[str]:
    """The newest n months that occur, newest first."""
    months = ledger.where(F.col("transaction_date").isNotNull()).select(_month().alias("month")).distinct()
    return [f"{row.month:%Y-%m}" for row in months.orderBy(F.desc("month")).limit(n).collect()]


def _first_day(month: str) -> Column:
    return F.lit(datetime.date.fromisoformat(f"{month}-01"))


def _within(first: Column, end: Column) -> Column:
    """A plain date range, which reaches the scan as a filter."""
    return (F.col("transaction_date") >= first) & (F.col("transaction_date") < end)


def _month_columns(months: list[str], value: Column, absent: Column) -> list[Column]:
    """A column per month: conditional sums, so a known list of months needs one grouping only."""
    return [
        money(F.sum(F.when(_month() == _first_day(month), value).otherwise(absent))).alias(month) for month in months
    ]


def compare_months(ledger: DataFrame, months: list[str] | None = None) -> DataFrame | None:
    """Expenses per category in the two newest months, one column per month.

    `months` names the two in any order; by default the newest two. None if there are fewer than two.
    """
    months = latest_months(ledger) if months is None else months
    if len(months) < 2:
        return None
    last, current = sorted(months[:2])
    either = _month().isin(_first_day(last), _first_day(current))
    chosen = _expenses(ledger).where(_within(_first_day(last), F.add_months(_first_day(current), 1)) & either)
    return chosen.groupBy("category").agg(*_month_columns([last, current], F.abs("amount"), F.lit(0).cast(MONEY)))


def category_direction(ledger: DataFrame) -> DataFrame:
    return (
        ledger.groupBy("category", "direction")
        .agg(_count().alias("n"), _sum().alias("net"))
        .orderBy(F.asc_nulls_last("net"))
    )


def monthly_pivot(ledger: DataFrame, start: str, end: str) -> DataFrame:
    """Net amount per category, one column per month that occurs in [start, end)."""
    chosen = ledger.where(_within(F.lit(start).cast("date"), F.lit(end).cast("date")))
    found = chosen.select(_month().alias("month")).distinct().orderBy("month").collect()
    columns = _month_columns([f"{row.month:%Y-%m}" for row in found], F.col("amount"), F.lit(None).cast(MONEY))
    return chosen.groupBy("category").agg(*columns) if columns else chosen.select("category").distinct()


def high_spenders(ledger: DataFrame, threshold: float = -500, k: int = 10) -> DataFrame:
    """The k merchants with the largest spending beyond the threshold."""
    totals = _expenses(ledger).groupBy("merchant_name").agg(_count().alias("txn_count"), _sum().alias("total_spent"))
    return (
        totals.where(F.col("total_spent") < threshold)
        .orderBy(F.asc_nulls_last("total_spent"), F.asc_nulls_last("merchant_name"))
        .limit(k)
    )


def account_category(ledger: DataFrame) -> DataFrame:
    """Total per account and category. A `where` on either column is pushed below the grouping."""
    return ledger.groupBy("account_name", "category").agg(F.sum("amount").alias("amount"))


def category_channel(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("category", "channel").agg(
        F.sum("amount").alias("total_spent"), _count().alias("txn_count")
    )


# Channels shown by the platform report and the columns they fill.
PLATFORMS = {
    "pos": "spent_direct",
    "instacart": "spent_via_instacart",
    "doordash": "spent_via_doordash",
    "uber_eats": "spent_via_uber_eats",
}


def platform_analysis(ledger: DataFrame, channels: dict[str, str] = PLATFORMS) -> DataFrame:
    """Expenses per category, split by the platform they went through."""
    amount = F.col("amount")
    split = [_sum_if(F.col("channel") == channel, amount).alias(name) for channel, name in channels.items()]
    return (
        _expenses(ledger)
        .groupBy("category")
        .agg(*split, _sum().alias("total_category_burn"))
        .orderBy(F.asc_nulls_last("total_category_burn"))
    )


def resample(ledger: DataFrame, freq: str = "month_end") -> DataFrame:
    """Expense total per calendar period, labelled by its last day; empty periods give 0.

    Each period found is followed by the empty ones up to the next period found. That step
    sees one row per period only, so the calendar bounds it and not the ledger.
    """
    day = F.col("transaction_date")
    labels = {"month_end": F.last_day(day), "week_sunday": F.next_day(F.date_sub(day, 1), "SUN")}
    found = (
        _expenses(ledger)
        .where(F.col("transaction_date").isNotNull())
        .groupBy(labels[freq].alias("period"))
        .agg(F.sum("amount").alias("total"))
    )
    following = F.lead("period").over(W.partitionBy(F.lit(0)).orderBy("period"))
    gaps = found.withColumn("following", following)
    if freq == "month_end":
        steps = F.coalesce(F.months_between("following", "period").cast("int"), F.lit(1))
        nth = F.last_day(F.add_months(F.col("period"), F.col("step")))
    else:
        steps = F.coalesce((F.datediff("following", "period") / 7).cast("int"), F.lit(1))
        nth = F.date_add(F.col("period"), F.col("step") * 7)
    filled = gaps.withColumn("step", F.explode(F.sequence(F.lit(0), steps - 1)))
    zero = F.lit(0).cast(MONEY)
    return filled.select(
        nth.alias("period"), F.when(F.col("step") == 0, F.col("total")).otherwise(zero).alias("total")
    )


def running_balance(ledger: DataFrame, account: str | None = None, id_prefix: int = 2) -> DataFrame:
    """Running sum of amounts per account, by date and then by transaction id.

    One account may hold most of the rows, even on one day, so no task sorts a whole account.
    Rows are cut into slots by account, day and leading letters of the id, in that order. The
    slot totals give each slot's opening balance, and only rows of one slot meet in a task.
    The ledger is read once: the columns needed are kept below the shared folder, from where
    both the totals and the rows are taken.
    """
    rows = ledger if account is None else ledger.where(F.col("account_name") == account)
    rows = rows.select(
        "account_name",
        "transaction_date",
        "transaction_id",
        "merchant_name",
        "amount",
        F.coalesce("account_name", F.lit("")).alias("_account"),
        F.coalesce("transaction_date", F.lit("9999-12-31").cast("date")).alias("_day"),
        F.coalesce(F.substring("transaction_id", 1, id_prefix), F.lit("")).alias("_slot"),
    )
    rows = kept(ledger.sparkSession, rows, "balances")
    in_slot = W.partitionBy(*_SLOT).orderBy("transaction_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    balance = F.col("_before") + F.sum("amount").over(in_slot)
    return rows.join(_opening_balances(rows), _SLOT).select(
        "account_name",
        "transaction_date",
        "transaction_id",
        "merchant_name",
        "amount",
        balance.alias("running_balance"),
    )


# Never NULL, so that the join and the window share one partitioning of the rows.
_SLOT = ["_account", "_day", "_slot"]


def _opening_balances(rows: DataFrame) -> DataFrame:
    """Balance before each slot: all earlier days, plus earlier slots of the same day."""

    def before(window) -> Column:
        earlier = F.sum("_sum").over(window.rowsBetween(W.unboundedPreceding, -1))
        return F.coalesce(earlier, F.lit(0).cast("decimal(38,2)"))

    slots = rows.groupBy(*_SLOT).agg(F.sum("amount").alias("_sum"))
    in_day = slots.withColumn("_earlier", before(W.partitionBy("_account", "_day").orderBy("_slot")))
    days = slots.groupBy("_account", "_day").agg(F.sum("_sum").alias("_sum"))
    by_day = days.select("_account", "_day", before(W.partitionBy("_account").orderBy("_day")).alias("_days_before"))
    both = in_day.join(by_day, ["_account", "_day"])
    return both.select(*_SLOT, (F.col("_earlier") + F.col("_days_before")).alias("_before"))


def last_n(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The last n rows in the order of the keys: a top-k, without a full sort."""
    return df.orderBy(*[F.desc_nulls_last(key) for key in keys]).limit(n)


def net_of_transfers(ledger: DataFrame) -> DataFrame:
    """Ledger without money that only moves between accounts."""
    return ledger.where(~F.col("category").isin(TRANSFER))
