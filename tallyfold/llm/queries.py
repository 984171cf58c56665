"""One query per operator, over its whole table and with production settings."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import (
    alignment,
    licenses,
    line_dedup,
    mixing,
    near_copies,
    ngram_join,
    packing,
    quality,
    secret_scan,
    sharding,
    spelling,
    topk,
    toxicity,
)
from tallyfold.llm.common import staged, table
from tallyfold.llm.sql import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _joined(spans):
    text = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(text, ",")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    versions = docs.select(F.col("doc_id").alias("path"), F.lit(1).alias("version"), "text")
    found = secret_scan.scan(versions)
    kinds = [r.kind for r in secret_scan.BASE]
    base = F.filter("found", lambda x: x["kind"].isin(kinds))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("path").alias("doc_id"),
        *map(count, kinds),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
    )


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.per_document(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "position")


def op3_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    found = packing.packed(table(spark, folder, "documents"), tokenizer_path())
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.deduplicated(table(spark, folder, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_removed")


def op7_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies.near_copies(table(spark, folder, "documents"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    found = sharding.sharded(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    signals = staged(quality.with_signals(docs).drop("text"), "signals")
    found = quality.judged(signals, quality.fences(signals))
    return found.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op11_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.linked_components(table(spark, folder, "documents"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.grouped(spelling.vocabulary(table(spark, folder, "documents")))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = alignment.aligned(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    scored = alignment.scored(found.select("doc_id", "n_a", "n_b", "n_groups", digest, "links"))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_mixing": op2_mixing,
    "op3_top_k": op3_top_k,
    "op4_packing": op4_packing,
    "op5_licenses": op5_licenses,
    "op6_line_dedup": op6_line_dedup,
    "op7_near_copies": op7_near_copies,
    "op8_sharding": op8_sharding,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_ngram_join": op11_ngram_join,
    "op12_spelling": op12_spelling,
    "op13_alignment": op13_alignment,
}
