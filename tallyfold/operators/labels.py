"""The label mapping that patches unknown merchants, its checks, and the outbound audit."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.skew import dimension_join, first_by, fits_broadcast
from tallyfold.schemas import DEFAULT_CHANNEL, MAPPING, MAPPING_CATEGORIES, UNCLASSIFIED, UNKNOWN

# Ledger column, mapping column, value used when the mapping leaves the field out.
_PATCHED = (
    ("merchant_name", "merchant", UNKNOWN),
    ("category", "category", UNCLASSIFIED),
    ("sub_category", "sub_category", UNCLASSIFIED),
    ("channel", "channel", DEFAULT_CHANNEL),
)


def latest_mapping(mapping: DataFrame) -> DataFrame:
    """One mapping row per raw description: the last one in `seq` wins."""
    return first_by(mapping.select(*MAPPING.names), ["raw_description"], ["seq"], last=True)


def apply_mapping(ledger: DataFrame, mapping: DataFrame, small: bool | None = None) -> DataFrame:
    """Patch the four labels of rows whose merchant is still unknown and whose text is mapped.

    The mapping is measured before its duplicates are dropped, which can only make it smaller.
    """
    small = fits_broadcast(mapping) if small is None else small

    def condition(fact, entry):
        return (fact("raw_description") == entry("raw_description")) & (fact("merchant_name") == UNKNOWN)

    keys = {"raw_description": "raw_description"}
    joined = dimension_join(ledger, latest_mapping(mapping), condition, "transaction_id", "left", small, keys)
    mapped = F.col("dim.raw_description").isNotNull()
    patched = {
        name: F.when(mapped, F.coalesce(F.col(f"dim.{source}"), F.lit(default))).otherwise(F.col(f"facts.{name}"))
        for name, source, default in _PATCHED
    }
    return joined.select(
        *[patched[name].alias(name) if name in patched else F.col(f"facts.{name}") for name in ledger.columns]
    )


def check_mapping(mapping: DataFrame, allowed: tuple[str, ...] = MAPPING_CATEGORIES) -> DataFrame:
    """The mapping with a `reject_reason`; NULL marks a usable row."""
    required = ("raw_description", "merchant", "category", "sub_category", "channel")
    reason = F
    for name in required:
        reason = reason.when(F.col(name).isNull(), f"missing {name}")
    reason = reason.when(~F.col("category").isin(*allowed), "category not allowed")
    return mapping.withColumn("reject_reason", reason.otherwise(None))


def validate_mapping(
    mapping: DataFrame, allowed: tuple[str, ...] = MAPPING_CATEGORIES
) -> tuple[DataFrame, DataFrame]:
    """Usable mapping rows, and the rejected ones with their reason."""
    checked = check_mapping(mapping, allowed)
    usable = checked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return usable, checked.where(F.col("reject_reason").isNotNull())


def audit_batch(payload: DataFrame, batch_id: str, key: str, chunk_rows: int = 1000) -> DataFrame:
    """One JSON line per chunk of the outbound payload, holding every payload row once.

    Rows are told apart by `key`, whose md5 prefix names the chunk. The prefix is as long as
    the payload needs for chunks of about `chunk_rows`, so no chunk grows with the data.
    """
    total = payload.count()
    digits = 0
    while total > chunk_rows * 16**digits:
        digits += 1
    row = F.struct(*[F.col(name) for name in payload.columns])
    chunk = F.substring(F.md5(F.coalesce(F.col(key), F.lit(""))), 1, digits)
    chunks = payload.groupBy(chunk.alias("chunk")).agg(
        F.sort_array(F.collect_list(row)).alias("transmitted_data"), F.count(F.lit(1)).alias("record_count")
    )
    record = F.struct(F.lit(batch_id).alias("batch_id"), "record_count", "transmitted_data")
    return chunks.select("chunk", F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def row_payload(unknown: DataFrame) -> DataFrame:
    """Payload of the row audit: id, text and amount of each unknown row."""
    return unknown.select(
        F.col("transaction_id").alias("tx_id"),
        F.col("raw_description").alias("desc"),
        F.col("amount").cast("double").alias("amt"),
    )


def text_payload(descriptions: DataFrame) -> DataFrame:
    """Payload of the label request: each distinct unknown text."""
    return descriptions.select(F.col("raw_description").alias("desc"))


def write_audit(audit: DataFrame, path: str) -> None:
    """Add the audit lines to a text log."""
    audit.select("value").write.mode("append").text(path)
