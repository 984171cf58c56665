"""Quality rules with adaptive fences instead of fixed cut-offs.

Signals of every text are summed up in quantile sketches per language and source: counts in
logarithmic buckets, which merge by addition. Documents that fail the base rules do not count,
and equal texts of a group count once. A group's fence follows from its sketch alone: it stands
below the first wide empty stretch that at most a tenth of the documents lie beyond; without
one, some inter-quartile ranges above the upper quartile; and where most documents are alike,
as far above the 99th percentile. Groups of few documents use their language's merged sketch,
and languages of few documents that of all. A group whose middle lies within its language's
fence is bounded by it, so that junk cannot raise its own fence; a group of another kind
(tables, code) keeps to its own. Documents are then joined with their group's fences.

Defined cases: a null or empty text has no words and fails the base rules; null languages and
sources are groups of their own; repeated rows are judged each; an empty table gives an empty
result. Input columns named like a result column are replaced by it, others are carried; a
group whose documents all fail the base rules has no fence, and needs none.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The symbols counted, the window of the repeat rule, the base rules.
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
# Signal: a count by another one, and its step, the resolution: values less than a step apart are alike.
SIGNALS = {
    "symbol_ratio": ("n_symbols", "n_words", 0.05),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 0.05),
    "repeat_ratio": ("n_repeat_words", "n_words", 0.05),
    "mean_word": ("word_chars", "n_words", 0.5),
}
ACCURACY = 1.01  # ratio of neighbouring bucket bounds, of values counted in steps from 1 on
SPREADS = 3  # how many inter-quartile ranges above the upper quartile the fence stands
MARGIN = 20  # buckets it stands above it at least, where documents are all alike
STRETCH = 139  # buckets of an empty stretch that counts as wide: a ratio of four
BELOW = 0.9  # share of the documents below such a stretch
LEAST_DOCUMENTS = 100  # groups below use a merged sketch

_BLANKS = " \t\n\x0b\x0c\r"
_MIX = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(REPEAT_WINDOW)]


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight that occur twice or more in the text."""
    windows = len(words) - REPEAT_WINDOW + 1
    if windows < 2:
        return 0
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(windows, np.uint64)
    for k, factor in enumerate(_MIX):
        rolled += each[k : k + windows] * factor
    ordered = np.sort(rolled)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(np.isin(rolled, twice))
    edges[starts] += 1
    np.subtract.at(edges, starts + REPEAT_WINDOW, 1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def duplicate_lines(lines: list[str]) -> int:
    """Lines with a word that equal an earlier line."""
    if len(set(lines)) == len(lines):
        return 0
    seen: set[str] = set()
    count = 0
    for line in lines:
        if line.strip(_BLANKS):
            count += line in seen
            seen.add(line)
    return count


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of COUNTS."""
    text = text or ""
    words = text.encode().split()
    lines = text.split("\n")
    return (
        len(words),
        len(text) - sum(map(text.count, _BLANKS)),
        sum(map(text.count, SYMBOLS)),
        duplicate_lines(lines),
        repeated_words(words),
        len(lines),
    )


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in COUNTS]))
def _counts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=COUNTS, dtype="int64")


def with_signals(docs: DataFrame) -> DataFrame:
    """The documents with the counts of each text, a hash of it, and the verdict of the base rules."""
    carried = [c for c in docs.columns if c not in (*COUNTS, "text_hash", "base_failed")]
    counted = docs.select(F.struct(*carried).alias("row"), _counts("text").alias("counts"), F.xxhash64("text").alias("text_hash"))
    return counted.select("row.*", "counts.*", "text_hash").withColumn("base_failed", F.expr(BASE_FAILED))


def _bucket(name: str, row: str = ""):
    part, whole, step = SIGNALS[name]
    ratio = F.try_divide(F.col(f"{row}{part}").cast("double"), F.col(f"{row}{whole}").cast("double"))
    return F.floor(F.log(1 + ratio / F.lit(step)) / F.lit(math.log(ACCURACY))).cast("long")


def _key(name: str):
    """Null is a group of its own."""
    return F.when(F.col(name).isNull(), "").otherwise(F.concat(F.lit("="), F.col(name).cast("string")))


def sketches(signals: DataFrame) -> DataFrame:
    """Bucket counts per language, source and signal, of documents that pass the base rules.

    Equal texts of a group count once, where `text_hash` tells them.
    """
    rows = signals.where("NOT base_failed").select(
        _key("lang").alias("lang"), _key("source").alias("source"), *[_bucket(name).alias(name) for name in SIGNALS],
        *[c for c in ("text_hash",) if c in signals.columns],
    )
    rows = rows.distinct() if "text_hash" in rows.columns else rows
    values = F.array(*[F.struct(F.lit(name).alias("signal"), F.col(name).alias("bucket")) for name in SIGNALS])
    each = rows.select("lang", "source", F.explode(values).alias("v")).select("lang", "source", "v.*")
    return each.groupBy("lang", "source", "signal", "bucket").agg(F.count("*").alias("n"))


def merged(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups: counts add up."""
    return cells.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))


def _fences(cells: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Upper fence, middle and number of documents per group and signal; all in buckets."""
    by = Window.partitionBy(*keys, "signal")
    upward = by.orderBy("bucket")
    ranked = cells.select(
        "*",
        F.sum("n").over(upward).alias("upto"),
        F.sum("n").over(by).alias("total"),
        (F.lead("bucket").over(upward) - F.col("bucket")).alias("gap"),
    )
    quantile = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bucket")))
    below = (F.col("upto") >= BELOW * F.col("total")) & (F.col("gap") >= STRETCH)
    found = ranked.groupBy(*keys, "signal").agg(
        *[quantile(q).alias(c) for c, q in (("low", 0.25), ("middle", 0.5), ("high", 0.75), ("top", 0.99))],
        F.min(F.when(below, F.col("bucket"))).alias("edge"),
        F.first("total").alias("total"),
    )
    spread = F.col("high") - F.col("low")
    above = F.when(spread > 0, F.col("high") + F.greatest(SPREADS * spread, F.lit(MARGIN))).otherwise(
        F.col("top") + F.greatest(SPREADS * (F.col("top") - F.col("high")), F.lit(MARGIN))
    )
    fence = F.coalesce("edge", above).alias(f"{name}_fence")
    return found.select(*keys, "signal", fence, F.col("middle").alias(f"{name}_middle"), F.col("total").alias(f"{name}_documents"))


def fences(signals: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """One row per language and source, with a column `fence_<signal>` (a bucket) for each signal."""
    cells = sketches(signals)
    own = _fences(cells, ["lang", "source"], "own")
    by_language = _fences(merged(cells, ["lang"]), ["lang"], "lang")
    overall = _fences(merged(cells, []), [], "all")
    wider = F.when(F.col("lang_documents") >= least, F.col("lang_fence")).otherwise(F.col("all_fence"))
    bounded = F.when(F.col("own_middle") <= wider, F.least("own_fence", wider)).otherwise(F.col("own_fence"))
    chosen = F.when(F.col("own_documents") >= least, bounded).otherwise(wider)
    each = own.join(by_language, ["lang", "signal"]).join(overall, "signal").select("lang", "source", "signal", chosen.alias("fence"))
    columns = [F.max(F.when(F.col("signal") == name, F.col("fence"))).alias(f"fence_{name}") for name in SIGNALS]
    return each.groupBy("lang", "source").agg(*columns)


def judged(signals: DataFrame, bounds: DataFrame) -> DataFrame:
    """The documents with `kept`: base rules passed and no signal above its group's fence."""
    limits = [f"fence_{name}" for name in SIGNALS]
    left = signals.select(F.struct(*[c for c in signals.columns if c != "kept"]).alias("row"), _key("lang").alias("l"), _key("source").alias("s"))
    joined = left.join(bounds, (F.col("l") == F.col("lang")) & (F.col("s") == F.col("source")), "left")
    above = F.lit(False)
    for name, limit in zip(SIGNALS, limits, strict=True):
        above = above | F.coalesce(_bucket(name, "row.") > F.col(limit), F.lit(False))
    kept = ~F.when(F.col("row.base_failed"), True).otherwise(above)
    return joined.select("row.*", kept.alias("kept"))
