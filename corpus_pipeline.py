"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result
is written as Parquet below the shared folder and read back as the next one's docs.

Defined cases are those of the operators; a stage on an empty table gives an empty table.
Ids may be missing or repeated: only the stages' own rules drop rows, and of rows equal in
doc_id and text, which are copies, one goes on from the third stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import line_dedup, mixing, near_copies, packing, quality
from tallyfold.llm.common import ship, staged, table
from tallyfold.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the rules reject go."""
    ship(spark)
    # Measured once: the counts serve the fences and the verdicts.
    counted = staged(quality.with_signals(docs), "counted")
    return quality.judged(counted, quality.fences(counted)).where("kept").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later occurrences go; documents that nothing is left of go with them."""
    found = line_dedup.deduplicated(docs)
    left = found.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays."""
    # Rows whose id is missing or repeated go by a hash of their content instead.
    often = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    often = staged(often.select(F.col("doc_id").alias("_often"), F.lit(True).alias("_unclear")), "often")
    # They travel to the texts as long as they are few; else both are shuffled.
    often = F.broadcast(often) if often.count() <= near_copies.FEW else often
    named = docs.select(F.struct(*docs.columns).alias("row")).join(often, F.col("row.doc_id").eqNullSafe(F.col("_often")), "left")
    content = F.xxhash64("row.doc_id", "row.text")
    named = staged(
        named.select("row", F.coalesce("_unclear", F.lit(False)).alias("unclear"), F.when(F.col("_unclear"), content).otherwise(F.col("row.doc_id")).alias("id")),
        "named",
    )
    kept = near_copies.near_copies(named.select(F.col("id").alias("doc_id"), "row.text")).where("kept")
    left = named.join(kept.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi")
    once = left.where("unclear").dropDuplicates(["id"])
    return left.where("NOT unclear").unionByName(once).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents as often as the mix takes them; the last one of a source may be cut."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of token ids with their places in sequences."""
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack),
]

# Tokenizing, quantile sketches and minwise trees are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
