"""Line de-duplication over overlapping windows of three lines.

Three consecutive lines make a window. Windows are hashed and counted over all documents; of a
window that occurs again, every occurrence but the first (by doc_id, then place) is removed,
and the lines covered by removed windows are merged into spans. A passage of three or more
lines that stands in many documents thus stays in the first one only, while single lines that
recur by chance stay everywhere. Lines are compared without white space around them; windows
without any word are not compared.

Everything is DataFrame operations. Only hashes and places are shuffled by window; texts move
once, to meet their spans.

Defined cases: a null text stays null and has no lines; a text of fewer than three lines has
no window and stays; a null doc_id comes before all others; rows that repeat both doc_id and
text are one document and share its result; an empty table gives an empty result. Input
columns named like a result column are replaced by it, others are carried.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _lines(text):
    return F.split(text, "\n", -1)


def _windows(docs: DataFrame) -> DataFrame:
    """One row per window: where it stands and a key of 128 bits."""
    trimmed = F.transform(_lines(F.col("text")), lambda x: F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""))
    lines = docs.where(F.col("text").contains("\n")).select("doc_id", F.xxhash64("text").alias("copy"), trimmed.alias("lines"))
    each = lines.where(F.size("lines") >= WINDOW).select(
        "doc_id", "copy",
        F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(x, F.lit(1)).alias("b"), (x != "").alias("c"))).alias("h"),
    )
    following = lambda k: F.expr(f"slice(h, {k + 1}, size(h) - {WINDOW - 1})")
    joined = each.select("doc_id", "copy", F.posexplode(F.arrays_zip(*[following(k).alias(f"l{k}") for k in range(WINDOW)])))
    part = lambda name: [F.col(f"col.l{k}.{name}") for k in range(WINDOW)]
    some = F.expr(" OR ".join(f"col.l{k}.c" for k in range(WINDOW)))
    return joined.where(some).select(
        "doc_id", "copy", F.col("pos").alias("place"), F.xxhash64(*part("a")).alias("a"), F.xxhash64(*part("b")).alias("b")
    )


def repeated_windows(docs: DataFrame) -> DataFrame:
    """Places (doc_id, copy, place) of windows that occurred before."""
    windows = _windows(docs)
    here = F.struct("doc_id", "copy", "place")
    firsts = windows.groupBy("a", "b").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return windows.join(firsts, ["a", "b"]).where(~here.eqNullSafe(F.col("first"))).select("doc_id", "copy", "place")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents with `text` cleaned, `n_lines` before and `n_removed`."""
    spans = (
        repeated_windows(docs)
        .groupBy(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"))
        .agg(F.array_sort(F.collect_set("place")).alias("_places"))
    )
    carried = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = F.struct(*[c for c in carried if c != "text"]).alias("_row")
    split = docs.select(rows, F.xxhash64("text").alias("_own"), _lines(F.col("text")).alias("_lines"))
    on = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_copy"))
    n_lines = F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines"))
    # What stands between two removed windows is kept; a window covers its own three lines.
    between = F.zip_with(
        F.concat(F.array(F.lit(-WINDOW)), "_places"),
        F.concat("_places", F.array(F.size("_lines"))),
        lambda a, b: F.struct((a + WINDOW + 1).alias("start"), (b - a - WINDOW).alias("length")),
    )
    joined = split.join(spans, on, "left").select(
        "_row", "_lines", n_lines.alias("_n"), F.filter(between, lambda x: x["length"] > 0).alias("_kept")
    )
    pieces = F.transform("_kept", lambda x: F.array_join(F.slice("_lines", x["start"], x["length"]), "\n"))
    text = F.array_join(F.coalesce(pieces, F.col("_lines")), "\n")
    left = F.aggregate("_kept", F.lit(0), lambda total, x: total + x["length"])
    removed = F.coalesce(F.col("_n") - left, F.lit(0))
    return joined.select(
        *[text.alias("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in carried],
        F.col("_n").cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"),
    )
