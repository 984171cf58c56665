"""Trip and cash sidecar files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.columns import CASH_DATES, SIDECAR_DATES, parse_date
from tallyfold.schemas import CASH_LOG, MONEY, TRIPS


PLACE = "_place"  # order of the rows in a sidecar file
NO_DATE = "unrecognized date"
NOT_A_NUMBER = "amount is not a number"
NOT_A_FLAG = "loan flag is not true or false"


def _read_texts(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """CSV columns by header name, all as text; a column the file lacks is NULL."""
    table = spark.read.option("header", True).option("escape", '"').csv(path)
    absent = F.lit(None).cast("string")
    texts = table.select(*[F.col(n) if n in table.columns else absent.alias(n) for n in names])
    return texts.withColumn(PLACE, F.monotonically_increasing_id())


def _required(value: Column, text: str, reason: str = NO_DATE, bad: Column | None = None) -> Column:
    message = F.concat(F.lit(f"{reason}: "), F.coalesce(F.col(text), F.lit("(none)")))
    return F.when(value.isNull() if bad is None else bad, F.raise_error(message)).otherwise(value)


def _placed(texts: DataFrame) -> list[str]:
    return [PLACE] if PLACE in texts.columns else []


def parse_trips(texts: DataFrame, strict: bool = True) -> DataFrame:
    """Typed trips. An unknown date layout is an error, or NULL with `strict=False`."""

    def date(name: str) -> Column:
        value = parse_date(name, SIDECAR_DATES, generic=False)
        return (_required(value, name) if strict else value).alias(name)

    return texts.select(
        "trip_id", date("start_date"), date("end_date"), "trip_type", "destination", "notes", *_placed(texts)
    )


def read_trips(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_trips(_read_texts(spark, path, TRIPS.names), strict)


def _cash_date() -> Column:
    return parse_date("tx_date", CASH_DATES)


def _cash_amount() -> Column:
    return F.col("amount").try_cast(MONEY)


def _cash_flag() -> Column:
    return F.trim("is_loan").try_cast("boolean")


def _bad_flag() -> Column:
    """A flag that is given, but neither true nor false; none given is no loan."""
    return F.coalesce((F.trim("is_loan") != "") & _cash_flag().isNull(), F.lit(False))


def parse_cash(texts: DataFrame, strict: bool = True) -> DataFrame:
    """Typed cash log; dates may be written in mixed layouts, month first.

    A date, an amount or a loan flag that cannot be read is an error. With `strict=False` such
    rows are left out; `cash_rejects` gives them with the reason.
    """
    day, amount, flag = _cash_date(), _cash_amount(), _cash_flag()
    if not strict:
        texts = texts.where(day.isNotNull() & amount.isNotNull() & ~_bad_flag())
    return texts.select(
        (_required(day, "tx_date") if strict else day).alias("tx_date"),
        (_required(amount, "amount", NOT_A_NUMBER) if strict else amount).alias("amount"),
        "override_category",
        (_required(flag, "is_loan", NOT_A_FLAG, _bad_flag()) if strict else flag).alias("is_loan"),
        "notes",
    )


def cash_rejects(texts: DataFrame) -> DataFrame:
    """Cash rows that cannot be read, as they are, with a `reason`."""
    reason = (
        F.when(_cash_date().isNull(), NO_DATE).when(_cash_amount().isNull(), NOT_A_NUMBER).when(_bad_flag(), NOT_A_FLAG)
    )
    return texts.withColumn("reason", reason).where(F.col("reason").isNotNull())


def read_cash_log(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_cash(_read_texts(spark, path, CASH_LOG.names), strict)
