"""From statement rows to raw transactions."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.columns import (
    as_column,
    computed_once,
    content_key,
    direction,
    normalize_sign,
    parse_amount,
    parse_date,
    sign_rule,
)
from tallyfold.operators.skew import dimension_join, first_by, fits_broadcast
from tallyfold.schemas import RAW_TRANSACTIONS
from tallyfold.sources.statements import (
    EMPTY,
    NO_ACCOUNT,
    discover_headers,
    map_columns,
    read_files_and_lines,
    rejected_files,
    statement_rows,
    wide_rows,
)

ARRIVAL = ["file", "block", "pos"]


NO_DATE_TEXT = "no date"
NO_AMOUNT_TEXT = "no amount"
NOT_A_NUMBER = "amount is not a number"
TOO_LARGE = "amount has more than 16 digits before the point"


def checked_rows(rows: DataFrame, paren_negative: bool = False) -> DataFrame:
    """All rows with `parsed`, the amount, and the `reason` why a row cannot be used, else NULL."""
    parsed = computed_once(rows, "parsed", parse_amount("amount_text", paren_negative))
    number = F.translate("amount_text", "() ", "").try_cast("double")
    reason = (
        F.when(F.col("date_text").isNull(), NO_DATE_TEXT)
        .when(F.col("amount_text").isNull(), NO_AMOUNT_TEXT)
        .when(F.col("parsed").isNull() & (F.abs(number) >= 1e16), TOO_LARGE)
        .when(F.col("parsed").isNull(), NOT_A_NUMBER)
    )
    return parsed.withColumn("reason", reason)


def valid_rows(rows: DataFrame, paren_negative: bool = False) -> DataFrame:
    """Rows with a date text and an amount that is a number, with `parsed` holding it."""
    given = rows.where(F.col("date_text").isNotNull() & F.col("amount_text").isNotNull())
    parsed = computed_once(given, "parsed", parse_amount("amount_text", paren_negative))
    return parsed.where(F.col("parsed").isNotNull())


def base_name(file: Column | str) -> Column:
    return F.element_at(F.split(as_column(file), "/"), -1)


def with_account(
    rows: DataFrame, accounts: DataFrame, small: bool | None = None, spread: str = "file", how: str = "inner"
) -> DataFrame:
    """Attach account_name, account_type and sign_rule by the file's base name.

    Works on a frame of files as well as of rows; `spread` tells rows of one file apart.
    `accounts` has (file_name, account_name, account_type) and may give its own sign_rule. With
    `how="left"`, files without an account stay, with NULLs.
    """
    rule = sign_rule("account_type", "account_name", "file_name")
    given = F.coalesce("sign_rule", rule) if "sign_rule" in accounts.columns else rule
    dim = accounts.select("file_name", "account_name", "account_type", given.alias("sign_rule"))
    joined = dimension_join(
        rows.withColumn("_base", base_name(F.col("file"))),
        dim,
        lambda row, account: row("_base") == account("file_name"),
        spread,
        how,
        small,
    )
    return joined.select(
        *[F.col(f"facts.{name}") for name in rows.columns],
        "dim.account_name",
        "dim.account_type",
        "dim.sign_rule",
    )


def to_transactions(rows: DataFrame, key_scope: str = "content") -> DataFrame:
    """Typed transactions of valid rows with an account; arrival columns are kept.

    The key covers the three texts only, so equal rows of two accounts collapse later;
    `key_scope='account'` adds the account to the key.
    """
    texts = ["date_text", "description", "amount_text"]
    if key_scope == "account":
        texts = ["account_name", *texts]
    elif key_scope != "content":
        raise ValueError("key_scope must be 'content' or 'account'")
    amount = normalize_sign("parsed", "description", "sign_rule")
    typed = rows.select(
        *ARRIVAL,
        content_key(*texts).alias("transaction_id"),
        "account_name",
        "account_type",
        parse_date("date_text").alias("transaction_date"),
        F.col("description").alias("raw_description"),
        amount.alias("amount"),
    )
    return typed.withColumn("direction", direction("amount"))


@dataclass(frozen=True)
class Load:
    """What came out of statement lines: every row is in `transactions`, a copy of one, or in a reject."""

    transactions: DataFrame
    rejected_files: DataFrame  # file, reason
    rejected_rows: DataFrame  # file, block, pos, reason


def _accounted(columns: DataFrame, accounts: DataFrame, small: bool | None) -> DataFrame:
    """Files with their accounts. An account given by a full path comes before one by base name."""
    rule = sign_rule("account_type", "account_name", "file_name")
    given = F.coalesce("sign_rule", rule) if "sign_rule" in accounts.columns else rule
    full = accounts.where(F.col("file_name").contains("/")).select(
        F.col("file_name").alias("_path"),
        F.struct("account_name", "account_type", given.alias("sign_rule")).alias("_account"),
    )
    names = accounts.where(~F.col("file_name").contains("/"))
    both = with_account(columns, names, small, how="left").join(full, F.col("file") == F.col("_path"), "left")
    own = [F.coalesce(F.col("_account").getField(c), F.col(c)).alias(c) for c in ("account_name", "account_type", "sign_rule")]
    return both.select(*columns.columns, *own)


def load_lines(
    lines: DataFrame,
    accounts: DataFrame,
    paren_negative: bool = False,
    key_scope: str = "content",
    small: bool | None = None,
    files: DataFrame | None = None,
) -> Load:
    """Statement lines to raw transactions, each content key once (first arrival wins), and rejects.

    Accounts are attached to files, so the lines are joined once. `small` says whether one row
    per file can be broadcast, for callers who know how many files there are; else they are
    counted. `files` lists all files, for those without any line to be among the rejects.
    """
    mapped = map_columns(discover_headers(lines))
    owned = _accounted(mapped, accounts, small)
    nobody = F.when(F.col("reject_reason").isNull() & F.col("account_type").isNull(), NO_ACCOUNT)
    columns = owned.withColumn("reject_reason", F.coalesce("reject_reason", nobody))
    rejected = rejected_files(columns)
    if files is not None:
        without = files.select("file").join(mapped.select("file"), "file", "left_anti")
        rejected = rejected.unionByName(without.select("file", F.lit(EMPTY).alias("reason")))
    judged = checked_rows(statement_rows(lines, columns, small), paren_negative)
    typed = to_transactions(judged.where(F.col("reason").isNull()), key_scope)
    once = first_by(typed, ["transaction_id"], ARRIVAL).select(*RAW_TRANSACTIONS.names)
    unusable = judged.where(F.col("reason").isNotNull()).select(*ARRIVAL, "reason")
    wide = wide_rows(lines, columns, small).select(*ARRIVAL, "reason")
    return Load(once, rejected, unusable.unionByName(wide))


def ingest_lines(lines: DataFrame, accounts: DataFrame, strict: bool = False, **options) -> DataFrame:
    """The transactions of `load_lines`. With `strict`, a file that is rejected is an error."""
    return _transactions(load_lines(lines, accounts, **options), strict)


def _transactions(found: Load, strict: bool) -> DataFrame:
    bad = found.rejected_files.orderBy("file").limit(1).collect() if strict else []
    if bad:
        raise ValueError(f"{bad[0].file}: {bad[0].reason}")
    return found.transactions


def load_files(
    spark: SparkSession, paths: str | list[str], accounts: DataFrame, multiline: bool = False, **options
) -> Load:
    """Statement files of any number of accounts, in one pass over all files.

    The lines are read once and kept below the shared folder.
    """
    files, lines = read_files_and_lines(spark, paths, multiline)
    small = fits_broadcast(files.select("file")) and fits_broadcast(accounts)
    return load_lines(lines, accounts, small=small, files=files, **options)


def ingest_files(
    spark: SparkSession, paths: str | list[str], accounts: DataFrame, strict: bool = False, **options
) -> DataFrame:
    """The transactions of `load_files`. With `strict`, a file that is rejected is an error."""
    return _transactions(load_files(spark, paths, accounts, **options), strict)
