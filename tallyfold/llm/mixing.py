"""Mixing sources to target weights by weighted fair queueing.

Each source is shuffled by a hash and queued; a document's virtual finish time is its source's
cumulative words divided by the source's weight. The entries of all sources are range-sorted
by finish time, which interleaves them in proportion to the weights, and cut at the virtual
time at which the total budget is used up: entries that finish before it are taken whole, those
that start after it not at all, and the one document that each source has in service is taken
up to the cut, so that every source meets its target to the word. A source may be queued a few
times over (`repeats`); one that is used up leaves its share to the others. Rows are shuffled
by a hash of their content, so reruns agree, whatever ids are missing or repeated.

Defined cases: null and empty texts have size 0 and are never taken; null sources are one
source, ordered last; repeated rows are documents of their own, of which any may come first;
an empty table gives an empty result. Only doc_id, source and text are read, so names of
other columns cannot clash.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import bucketed_running, global_running, staged, word_count

WEIGHTS = (3.0, 1.0, 2.0)  # by source in order of code points, repeating
SHARE = 1.5  # the mix's size in sizes of all documents
REPEATS = 2  # how often a document may be taken

_ROW = "_mixed_row"


def sized(docs: DataFrame, size=None) -> DataFrame:
    """doc_id, source, size and a hash of the content per row, with a row number that later steps agree on."""
    size = word_count(F.col("text")) if size is None else size
    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), "source"))
    number = F.col(_ROW) if _ROW in docs.columns else F.monotonically_increasing_id()
    content = F.xxhash64("doc_id", "source", "text").alias("content")
    return staged(docs.select("doc_id", "source", size.alias("size"), key.alias("key"), content, number.alias("row")), "sizes")


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Per source its size, weight and target, and the `level` of virtual time where the budget is used up.

    Sources are sorted by the virtual time at which they are used up; running totals of what
    is used up and of the weights then give the level, without gathering the sources.
    """
    sources = rows.groupBy("key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size")
    )
    by_name = global_running(sources, [F.col("source").asc_nulls_last()], {"place": F.lit(1)}, "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = by_name.withColumn("weight", weight).withColumn("most", F.col("source_size") * repeats)
    weighed = staged(weighed.withColumn("used_up", F.col("most") / F.col("weight")).drop("place"), "weights")
    full = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, all_weights = share * (full[0] or 0), full[1] or 0.0
    in_turn = global_running(
        weighed, [F.col("used_up"), F.col("key")], {"gone": F.col("most"), "gone_weight": F.col("weight")}, "levels"
    )
    level = (F.lit(budget) - F.col("gone")) / (F.lit(all_weights) - F.col("gone_weight"))
    found = in_turn.select(level.alias("level"), "used_up").where("level <= used_up").agg(F.max("level")).first()[0]
    cut = F.lit(math.inf if found is None else found)
    reached = F.least(F.col("most").cast("double"), cut * F.col("weight"))
    return weighed.select("key", "source_size", "weight", reached.alias("target"), cut.alias("level"))


def entries(rows: DataFrame, goals: DataFrame, repeats: int = REPEATS, seed: int = 0) -> DataFrame:
    """One row per document and turn: virtual `finish`, `served` words, and `position` in the mix.

    An entry with `served` 0 lies beyond the cut.
    """
    buckets = max(1, math.isqrt(rows.count()))
    shuffled = rows.withColumn("_hash", F.xxhash64(F.lit(seed), "content"))
    shuffled = shuffled.withColumn("_bucket", F.pmod(F.shiftright("_hash", 16), F.lit(buckets)))
    queued = bucketed_running(
        shuffled, ["key"], "_bucket", [F.col("_hash"), F.col("content")], {"before": F.col("size")}
    )
    turns = queued.join(goals, "key").withColumn(
        "turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    )
    start = F.col("before") + F.col("turn") * F.col("source_size")
    timed = turns.select(
        "row", "doc_id", "source", "size", "source_size", "target", "turn", "content", "level", "weight",
        start.alias("start"), ((start + F.col("size")) / F.col("weight")).alias("finish"),
    )
    # Taken whole if it finishes before the cut; in part, if the cut comes while it is in service.
    upto = F.floor(F.col("level") * F.col("weight") + 1e-6).cast("long") - F.col("start")
    part = F.greatest(F.lit(0), F.least(F.col("size"), upto)).cast("long")
    served = F.when(F.col("finish") <= F.col("level"), F.col("size")).otherwise(part)
    order = [F.col("finish"), F.col("content"), F.col("turn")]
    cut = global_running(timed.withColumn("served", served), order, {"position": F.col("served")}, "mix")
    return cut.drop("content", "level", "weight", "start")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = 0) -> DataFrame:
    """The entries of the mix in `position` order; see `entries`."""
    rows = sized(docs)
    return entries(rows, targets(rows, weights, share, repeats), repeats, seed).where("served > 0")


def per_document(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = 0
) -> DataFrame:
    """Per document how much of it the mix takes, repeats counted, and where it first stands."""
    rows = sized(docs)
    all_entries = entries(rows, targets(rows, weights, share, repeats), repeats, seed)
    taken = F.sum("served").alias("taken")
    first = F.min(F.when(F.col("served") > 0, F.col("position"))).alias("position")
    return (
        all_entries.groupBy("row", "doc_id", "size", "source_size", "target").agg(taken, first).drop("row")
    )


def mixed_documents(docs: DataFrame, seed: int = 0, **settings) -> DataFrame:
    """The documents of the mix, one row per turn, with the columns of `docs`.

    A document cut at the end of the mix keeps its first words.
    """
    # Rows are told apart by a number given once, so ids may be missing or repeated.
    numbered = staged(docs.select(F.struct(*docs.columns).alias("_row"), F.monotonically_increasing_id().alias(_ROW)), "numbered")
    picked = mix(numbered.select("_row.doc_id", "_row.source", "_row.text", _ROW), seed=seed, **settings)
    joined = numbered.join(picked.select(F.col("row").alias(_ROW), "served", "size"), _ROW)
    whole = F.col("_row.text")
    text = F.when(F.col("served") >= F.col("size"), whole).otherwise(_first_words(whole, F.col("served")))
    own = {"text": text, "n_chars": F.length(text).cast("long")}
    return joined.select(*[own.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def _first_words(text, n):
    words = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")
