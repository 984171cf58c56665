"""Sharding by a minimax contiguous partition.

Documents with equal texts are one atomic group; groups stand in order of their smallest
doc_id. Binary search finds the smallest shard capacity for which cutting greedily needs no
more than the given number of shards. The search runs on byte totals of id ranges, of which
only those that may hold a cut are split further, down to single groups. Groups larger than
an even share are ranges of their own from the start, as the capacity hangs on them; of the
others the largest are split first. What reaches the driver in a round is at most `ROWS`
totals, not the groups.

Defined cases: a null text counts as the empty one; groups whose smallest id is equal (ids
that repeat) or missing stay together; missing ids come first; with fewer groups than shards
some shards stay empty; an empty table gives an empty result. Only doc_id and text are read,
so names of other columns cannot clash.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import bucketed_running, staged

SHARDS = 16
PARTS = 512  # parts a range of ids is split into at once
ROWS = 1 << 16  # totals that one round collects at most
MOST = 1 << 12  # ranges split in one round at most


@dataclass
class Ranges:
    """Byte totals of consecutive id ranges; a range with one id left in it is a group."""

    size: np.ndarray
    single: np.ndarray

    def __post_init__(self):
        self.upto = np.cumsum(self.size)
        self.before = self.upto - self.size


def _greedy(r: Ranges, capacity: int, shards: int, divisible: bool) -> list[int] | None:
    """Index of the range where each next shard starts; None if the shards don't suffice.

    With `divisible`, a range of several groups may be cut anywhere.
    """
    starts, at = [], 0
    for _ in range(shards):
        fits = int(np.searchsorted(r.upto, at + capacity, side="right"))
        if fits >= len(r.size):
            return starts
        if divisible and not r.single[fits]:
            at += capacity
        elif r.size[fits] <= capacity:
            at = int(r.before[fits])
        else:
            return None
        starts.append(fits)
    return None


def _earliest(r: Ranges, capacity: int, shards: int) -> list[int]:
    """No later than the greedy cuts, however the groups lie inside their ranges."""
    starts, at = [], 0
    for _ in range(shards - 1):
        fits = int(np.searchsorted(r.upto, at + capacity, side="right"))
        if fits >= len(r.size):
            break
        starts.append(fits)
        at = int(r.before[fits])
    return starts


def _smallest(r: Ranges, shards: int, divisible: bool, low: int) -> int:
    """Smallest capacity for which the greedy cut works, by binary search."""
    high = max(low, int(r.upto[-1]))
    while low < high:
        middle = (low + high) // 2
        if _greedy(r, middle, shards, divisible) is None:
            low = middle + 1
        else:
            high = middle
    return low


def _totals(spans: list[tuple[int, int]], parts: int):
    """Bytes, smallest and largest id per part of a span, of one task's groups."""
    low, high = (np.array(x, np.int64) for x in zip(*spans, strict=True))
    step = np.array([-(-(hi - lo + 1) // parts) for lo, hi in spans], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size = (batch[c].to_numpy() for c in ("first", "bytes"))
            span = np.searchsorted(low, first, side="right") - 1
            inside = (span >= 0) & (first <= high[span])
            first, size, span = first[inside], size[inside], span[inside]
            if not len(first):
                continue
            # Differences of ids may need 64 bits without a sign.
            part = ((first.view(np.uint64) - low[span].view(np.uint64)) // step[span]).astype(np.int64)
            order = np.lexsort((first, part, span))
            first, size, span, part = first[order], size[order], span[order], part[order]
            at = np.flatnonzero(np.append(True, (span[1:] != span[:-1]) | (part[1:] != part[:-1])))
            last = np.append(at[1:], len(first)) - 1
            columns = [span[at], part[at], np.add.reduceat(size, at), first[at], first[last]]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["span", "part", "bytes", "low", "high"])

    return run


def _split(items: DataFrame, spans: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
    """For each span of ids, in order and apart, the parts of it that hold groups: (low, high, bytes)."""
    parts = max(2, min(PARTS, ROWS // len(spans)))
    each = items.selectExpr("CAST(first AS BIGINT) AS first", "CAST(bytes AS BIGINT) AS bytes").mapInArrow(
        _totals(spans, parts), "span long, part long, bytes long, low long, high long"
    )
    totals = each.groupBy("span", "part").agg(F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
    found: list[list[tuple[int, int, int]]] = [[] for _ in spans]
    for row in totals.collect():
        found[row["span"]].append((row["low"], row["high"], row["bytes"]))
    return [sorted(parts) for parts in found]


def _start(items: DataFrame, shards: int) -> list[tuple[int, int, int]]:
    """Groups of more than an even share, of which there are fewer than shards, and the ids around them."""
    ends = items.agg(F.min("first"), F.max("first"), F.sum("bytes")).first()
    if ends[0] is None:
        return []
    large = items.where(F.col("bytes") * shards > F.lit(ends[2])).select("first", "bytes").collect()
    parts, at = [], ends[0]
    for first, size in sorted(map(tuple, large)):
        parts += [(at, first - 1, 0)] * (at < first) + [(first, first, size)]
        at = first + 1
    return parts + [(at, ends[1], 0)] * (at <= ends[1])


def minimax_cuts(items: DataFrame, shards: int = SHARDS) -> list[int]:
    """The first id of every shard but the first. `items`: `first` (id) and `bytes` per group."""
    parts = _start(items, shards)
    if not parts:
        return []
    # Ranges without a total yet; one id apart from large groups may be a range as well.
    undecided = [k for k, part in enumerate(parts) if not part[2]]
    while True:
        finer = dict(zip(undecided, _split(items, [parts[k][:2] for k in undecided]) if undecided else [], strict=True))
        parts = [p for k, part in enumerate(parts) for p in finer.get(k, [part])]
        size = np.array([p[2] for p in parts], np.int64)
        r = Ranges(size, np.array([low == high for low, high, _ in parts]))
        floor = _smallest(r, shards, True, -(-int(r.upto[-1]) // shards))
        capacity = _smallest(r, shards, False, floor)
        # The smallest capacity lies between the two, and each cut between these places.
        early, late = _earliest(r, floor, shards), _greedy(r, capacity, shards, True) or []
        last = len(parts) - 1
        spans = ((a, late[k] if k < len(late) else last) for k, a in enumerate(early))
        undecided = sorted({k for a, b in spans for k in range(a, b + 1) if not r.single[k]})
        if floor == capacity or not undecided:
            return [parts[k][0] for k in _even_cuts(r, capacity, shards)]
        # What is left open by the largest ranges weighs most.
        undecided = sorted(sorted(undecided, key=lambda k: -parts[k][2])[:MOST])


def _even_cuts(r: Ranges, capacity: int, shards: int) -> list[int]:
    """Cuts that keep every shard within the capacity and come as near to equal as they can.

    The greedy cut fills shards from the left and leaves the last one short; any cut between
    the greedy cut from the left and the one from the right is as good, and the one nearest
    to an equal share of what is left is taken.
    """
    total = int(r.upto[-1])
    edges = np.append(r.before, total)
    from_right, at = [], total
    for _ in range(shards - 1):
        from_right.append(int(np.searchsorted(edges, at - capacity, side="left")))
        at = int(edges[from_right[-1]])
    cuts, start = [], 0
    for k, least in enumerate(reversed(from_right)):
        at = int(edges[start])
        latest = int(np.searchsorted(edges, at + capacity, side="right")) - 1
        wanted = at + (total - at) / (shards - k)
        nearest = min(int(np.searchsorted(edges, wanted, side="left")), len(r.size))
        if nearest > 0 and wanted - edges[nearest - 1] < edges[nearest] - wanted:
            nearest -= 1
        start = max(start, min(max(nearest, least), latest))
        if start >= len(r.size):
            break
        cuts.append(start)
    return cuts


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per document: doc_id, size, text_crc32, shard and slot (gapless from 0 in the shard)."""
    text = F.coalesce("text", F.lit(""))
    keyed = staged(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("group"),
        ),
        "texts",
    )
    lowest = keyed.agg(F.min("doc_id")).first()[0]
    missing = -1 if lowest is None else max(lowest - 1, -(1 << 63))
    groups = keyed.groupBy("group").agg(
        F.coalesce(F.min("doc_id"), F.lit(missing)).alias("first"), F.sum("size").alias("bytes")
    )
    groups = staged(groups, "groups")
    cuts = minimax_cuts(groups.groupBy("first").agg(F.sum("bytes").alias("bytes")), shards)
    shard = sum([(F.col("first") >= cut).cast("int") for cut in cuts], F.lit(0))
    placed = staged(
        keyed.join(groups.select("group", "first"), "group").select("doc_id", "size", "text_crc32", "group", shard.alias("shard")),
        "placed",
    )
    buckets = max(1, math.isqrt(placed.count()))
    spread = placed.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "group"), F.lit(buckets)))
    order = [F.col("doc_id"), F.col("group")]
    return bucketed_running(spread, ["shard"], "_bucket", order, {"slot": F.lit(1)}).select(
        "doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot")
    )
