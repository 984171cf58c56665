"""Table schemas, sentinels and category sets shared by all operators."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _D, _I, _B = T.StringType(), T.DateType(), T.IntegerType(), T.BooleanType()

LINES = _struct(("file", _S), ("block", T.LongType()), ("pos", T.LongType()), ("line", _S))

RAW_TRANSACTIONS = _struct(
    ("transaction_id", _S),
    ("account_name", _S),
    ("account_type", _S),
    ("transaction_date", _D),
    ("raw_description", _S),
    ("amount", MONEY),
    ("direction", _S),
)

LEDGER = _struct(
    ("transaction_id", _S),
    ("transaction_date", _D),
    ("account_name", _S),
    ("raw_description", _S),
    ("merchant_name", _S),
    ("category", _S),
    ("sub_category", _S),
    ("amount", MONEY),
    ("direction", _S),
    ("channel", _S),
)

TRIPS = _struct(
    ("trip_id", _S),
    ("start_date", _D),
    ("end_date", _D),
    ("trip_type", _S),
    ("destination", _S),
    ("notes", _S),
)

CASH_LOG = _struct(
    ("tx_date", _D),
    ("amount", MONEY),
    ("override_category", _S),
    ("is_loan", _B),
    ("notes", _S),
)

ENTITIES = _struct(("entity_id", _I), ("clean_name", _S), ("primary_category", _S))

MERCHANT_MAP = _struct(("pattern", _S), ("match_type", _S), ("entity_id", _I), ("priority", _I))

MAPPING = _struct(
    ("raw_description", _S),
    ("merchant", _S),
    ("category", _S),
    ("sub_category", _S),
    ("channel", _S),
    ("seq", T.LongType()),
)

LABELS = ("merchant_name", "category", "sub_category", "channel")

# Sentinels and category sets that reports and joins depend on.
UNKNOWN = "UNKNOWN"
UNCLASSIFIED = "UNCLASSIFIED"
DEFAULT_CHANNEL = "pos"
NO_TRIP = "Personal/Local"
NO_CATEGORY = "Unclassified"
EXPENSE = "Expense"
INCOME = "Income"
CHECKING = "checking"
CREDIT_CARD = "credit_card"
P2P = "Person to Person Payment"
RENT = "Rent Payment"
TRANSFER = "Transfer"
TRIP_CATEGORIES = ("Travel", "Transport", "Meals", "Cash")
FIXED_CATEGORIES = ("Subscriptions", "Fees")
VARIABLE_CATEGORIES = ("Meals", "Groceries", "Shopping", "Transport", "Travel", "Medical")
NOT_SPENDING = ("Transfer", "Income")
MAPPING_CATEGORIES = (
    "Shopping",
    "Groceries",
    "Meals",
    "Transport",
    "Utilities",
    "Entertainment",
    "Income",
    "Transfer",
    "Medical",
    "Fees",
)
