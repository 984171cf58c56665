"""Labelling transactions on four axes, and the work-list of what stays unknown."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.columns import as_column, computed_once
from tallyfold.functions.rules import DEFAULT_RULES, RuleSet
from tallyfold.schemas import DEFAULT_CHANNEL, LEDGER, UNCLASSIFIED, UNKNOWN

_DEFAULTS = {
    "merchant_name": UNKNOWN,
    "category": UNCLASSIFIED,
    "sub_category": UNCLASSIFIED,
    "channel": DEFAULT_CHANNEL,
}


def _quoted(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def match_text(pattern: str, text: str) -> str:
    """SQL test: a lower-cased text fits a LIKE pattern, whatever the pattern's case.

    Catalyst turns one-sided patterns into contains / startsWith. A pattern with inner
    wildcards stays a regular expression, so plain contains tests on its pieces go first.
    """
    lowered = pattern.lower()
    tests = [f"{text} LIKE {_quoted(lowered.replace(chr(92), chr(92) * 2))}"]
    if not re.fullmatch("%?[^%_]*%?", lowered):
        pieces = [piece for piece in re.split("[%_]+", lowered) if piece]
        tests = [f"contains({text}, {_quoted(piece)})" for piece in pieces] + tests
    return "(" + " AND ".join(tests) + ")"


def compile_axis(rules: tuple[tuple[str, ...], ...], default: str, text: str) -> Column:
    """One CASE expression over a lower-cased text column: the first rule with a matching
    pattern gives the label."""
    branches = [
        f"WHEN {' OR '.join(match_text(pattern, text) for pattern in patterns)} THEN {_quoted(value)}"
        for value, *patterns in rules
    ]
    return F.expr(f"CASE {' '.join(branches)} ELSE {_quoted(default)} END") if branches else F.lit(default)


def strip_prefix(
    description: Column | str,
    lowered: Column | str | None = None,
    prefixes: tuple[str, ...] = DEFAULT_RULES.prefixes,
) -> Column:
    """The text behind a marketplace prefix, verbatim; NULL when no prefix is there."""
    text = as_column(description)
    low = F.lower(text) if lowered is None else as_column(lowered)
    branches = F
    for prefix in prefixes:
        branches = branches.when(low.startswith(prefix.lower()), F.substr(text, F.lit(len(prefix) + 1)))
    return branches.otherwise(None) if prefixes else F.lit(None).cast("string")


def label_columns(description: str, lowered: str, rules: RuleSet = DEFAULT_RULES) -> dict[str, Column]:
    labels = {axis: compile_axis(getattr(rules, axis), default, lowered) for axis, default in _DEFAULTS.items()}
    stripped = strip_prefix(description, lowered, rules.prefixes)
    labels["merchant_name"] = F.coalesce(stripped, labels["merchant_name"])
    return labels


def classify(raw: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Classification sweep: raw transactions to ledger rows. Narrow, no shuffle.

    The lower-cased text is made once per row and never NULL, which keeps null checks out of
    the generated code; an absent text matches no rule anyway.
    """
    texts = computed_once(raw, "_text", F.coalesce(F.lower("raw_description"), F.lit("")))
    return texts.withColumns(label_columns("raw_description", "_text", rules)).select(*LEDGER.names)


def unknown_rows(ledger: DataFrame) -> DataFrame:
    """Rows no merchant rule fired for."""
    return ledger.where(F.col("merchant_name") == UNKNOWN).select("transaction_id", "raw_description", "amount")


def unknown_descriptions(ledger: DataFrame) -> DataFrame:
    """Each text still without a merchant, once; the work-list for the label mapping."""
    return ledger.where(F.col("merchant_name") == UNKNOWN).select("raw_description").distinct()


def search_description(raw: DataFrame, pattern: str) -> DataFrame:
    """Rows whose raw description fits a case-insensitive LIKE pattern."""
    return raw.where(F.col("raw_description").ilike(pattern))


def rows_for_merchant(ledger: DataFrame, name: str) -> DataFrame:
    return ledger.where(F.col("merchant_name") == name)
