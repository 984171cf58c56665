"""Dimension seeds: entities, priority rules and sample transactions."""

import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tallyfold.schemas import ENTITIES, MERCHANT_MAP, RAW_TRANSACTIONS

# Entities, rules and sample rows a fresh installation starts with.
ENTITY_ROWS = [
    (101, "Uber Ride", "Transportation"),
    (102, "Uber Eats", "Dining / Delivery"),
    (103, "Safeway", "Groceries"),
    (104, "Credit Card Payment", "Transfer"),
]
RULE_ROWS = [
    ("^UBER \\*EATS", "regex", 102, 1),
    ("UBER", "keyword", 101, 2),
    ("SAFEWAY", "keyword", 103, 2),
    ("INSTACART\\*SAFEWAY", "regex", 103, 1),
    ("CHASE CREDIT CARD PPD", "keyword", 104, 1),
]
SAMPLE_ROWS = [
    ("tx_001", "Chase Checking", "Checking", "2026-06-01", "UBER *EATS PENDING SAN JOSE", "-34.50", "Expense"),
    ("tx_002", "Chase Checking", "Checking", "2026-06-02", "UBER *TRIP HELP.UBER.COM", "-15.00", "Expense"),
    ("tx_003", "Amex Card", "Credit Card", "2026-06-03", "SAFEWAY STORE 0402", "-112.10", "Expense"),
    ("tx_004", "Chase Checking", "Checking", "2026-06-05", "CHASE CREDIT CARD PPD PMT", "-500.00", "Transfer"),
]


def seed_dims(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities, priority rules and sample transactions."""
    samples = [
        (key, name, kind, datetime.date.fromisoformat(day), text, Decimal(amount), way)
        for key, name, kind, day, text, amount, way in SAMPLE_ROWS
    ]
    return (
        spark.createDataFrame(ENTITY_ROWS, ENTITIES),
        spark.createDataFrame(RULE_ROWS, MERCHANT_MAP),
        spark.createDataFrame(samples, RAW_TRANSACTIONS),
    )
