"""Row-level column expressions used while statements become transactions.

All of them stay in the JVM; source text is only ever cast with `try_` functions,
because ANSI mode would turn one bad cell into a failed job.
"""

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.schemas import CREDIT_CARD, EXPENSE, INCOME, MONEY

# Accepted date layouts, in the order they are tried.
STATEMENT_DATES = ("yyyy-M-d", "yyyy/M/d", "M/d/yyyy", "M/d/yy", "M-d-yyyy")
SIDECAR_DATES = ("M/d/yyyy", "M/d/yy", "yyyy-M-d", "yyyy/M/d")
CASH_DATES = (*STATEMENT_DATES, "MMM d, yyyy", "d MMM yyyy", "MMMM d, yyyy")

FLIP, FORCE, KEEP = "flip", "force", "keep"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is evaluated once per row, however often it is used.

    Exploding an array of one keeps the optimizer from copying the expression into every
    filter and projection that refers to it. Filters on other columns still pass.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


_ISO_START = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_SHAPES = {
    "yyyy": "[0-9]{4}",
    "yy": "[0-9]{2}",
    "MMMM": "[A-Za-z]+",
    "MMM": "[A-Za-z]{3}",
    "M": "[0-9]{1,2}",
    "d": "[0-9]{1,2}",
}


def _shape(layout: str) -> str:
    """Regular expression of the texts a date layout can fit."""
    return "^" + re.sub("y+|M+|d+", lambda part: _SHAPES[part.group()], layout) + "$"


def parse_date(col: Column | str, formats: Iterable[str] = STATEMENT_DATES, generic: bool = True) -> Column:
    """First layout that fits wins; then the generic date cast; else NULL.

    A layout is tried only on texts of its shape: a failed parse costs an exception, which
    would be most of the time spent on a column of mixed layouts.
    """
    text = as_column(col)
    tries = [F.when(text.rlike(_shape(layout)), F.try_to_date(text, layout)) for layout in formats]
    if generic:
        tries.append(F.when(text.rlike(_ISO_START), text.try_cast("date")))
    return F.coalesce(*tries)


def parse_amount(col: Column | str, paren_negative: bool = False) -> Column:
    """Drop parentheses and blanks, then read a decimal; NULL if it is none.

    Parentheses do not negate unless `paren_negative` is set.
    """
    text = as_column(col)
    value = F.translate(text, "() ", "").try_cast(MONEY)
    if paren_negative:
        return F.when(F.trim(text).rlike(r"^\(.*\)$"), -F.abs(value)).otherwise(value)
    return value


def sign_rule(account_type: Column | str, account_name: Column | str, file: Column | str) -> Column:
    """Default sign rule of an account: which brand flips signs, which cards force them.

    Only the file's base name counts, so a folder name cannot change the sign.
    """
    base = F.element_at(F.split(as_column(file), "/"), -1)
    flips = F.lower(F.concat_ws(" ", as_column(account_name), base)).contains("apple")
    is_card = as_column(account_type) == CREDIT_CARD
    return F.when(is_card & flips, FLIP).when(is_card, FORCE).otherwise(KEEP)


def normalize_sign(amount: Column | str, description: Column | str, rule: Column | str) -> Column:
    """Signed amount: expenses below zero, payments and deposits above."""
    value, text, kind = as_column(amount), F.upper(as_column(description)), as_column(rule)
    pays_card = text.contains("PAYMENT") | text.contains("THANK YOU")
    return (
        F.when(kind == FLIP, -value)
        .when((kind == FORCE) & pays_card, F.abs(value))
        .when(kind == FORCE, -F.abs(value))
        .otherwise(value)
    ).cast(MONEY)


def direction(amount: Column | str) -> Column:
    return F.when(as_column(amount) < 0, EXPENSE).otherwise(INCOME)


def content_key(*parts: Column | str) -> Column:
    """md5 over the raw texts joined by `_`; NULL parts are skipped."""
    return F.md5(F.concat_ws("_", *[as_column(part) for part in parts]))


def month_of(col: Column | str) -> Column:
    return F.date_format(as_column(col), "yyyy-MM")


def money(col: Column) -> Column:
    """Report amounts: exact decimal sum, rounded to cents."""
    return F.round(col, 2)
