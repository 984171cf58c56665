"""Documents that share most of their four-word shingles, by a size-banded tiled join.

A document is its set of distinct four-word shingles; two link when 100 * intersection size is
at least 85 * union size. Sets that may link share one of their rarest shingles: of a set of n,
the n - ceil(0.85 n) + 1 that come first in one order of all shingles. The order is by counts
in a table of hashed counters, of a fixed size whatever the input; any order gives the same
links, this one keeps shingles that many documents share out of the way.

Sizes fall into bands such that sets of one band can only link with their own band and the
next. A tile holds the sets of two neighbouring bands that have such a shingle. Each set has a
hashed bitmap, the parity of its shingles per bit: as many bits as differ between two bitmaps
differ at least between the sets, which bounds the overlap from above. Pairs that the bound
leaves possible part a tile into groups; the sorted arrays of a group's sets are intersected
exactly, where the two still belong to different classes. Equal groups of several tiles are
settled once. Tiles of more than TILE sets are compared block by block, in as many tasks.

This is done twice: with two tiles for each set, which joins most of what belongs together,
and then with all tiles in which several classes are left. So large groups of near copies are
one class before all their tiles are looked at, and nothing is left out: every pair that links
meets in a tile, and there the bound and the exact sizes decide. Sets that are equal are one
from the start.

Defined cases: null and empty texts have no shingles and are linked with nothing; texts of
fewer than four words have their whole sequence as the one shingle; rows that repeat a doc_id
should repeat its text, and share its result; rows without a doc_id are kept and belong to no
component; an empty table gives an empty result. Only doc_id and text are read, so names of
other columns cannot clash.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import staged

SLOTS = 1 << 20  # hashed counters of shingles
TILE = 8192  # sets of a block, compared with another one in one task
FEW = 2_000_000  # ids up to which they are sent to all tasks instead of moving the texts

_BLOCK = 1 << 14  # counters in one row
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_REMEMBERED = 600_000
_SIGNED = "doc_id long, n long, a long, b long, prefix array<long>, bits binary"


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and the similarity that links: 100 * intersection >= percent * union."""

    words: int = 4
    percent: int = 85

    @property
    def band(self) -> float:
        """Width of a band of sizes; a little more than needed, so that rounding cannot part what may link."""
        return math.log(100 / self.percent) * 1.000001


RULE = Rule()


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> bytes:
        if len(self) > _REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_digest(word)
        return found


_WORDS = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, words_each: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    each = np.frombuffer(b"".join(map(_WORDS.__getitem__, words)), np.uint64)
    length = min(words_each, len(words))
    rolled = np.full(len(words) - length + 1, length, np.uint64)
    for k in range(length):
        rolled = rolled * _STEP + each[k : len(words) - length + 1 + k]
    return np.unique(_mixed(rolled))


def bitmap(found: np.ndarray, bits_each: int = 2) -> np.ndarray:
    """Parity of the shingles per bit, with at least so many bits for each shingle."""
    width = max(64, 1 << (bits_each * len(found) - 1).bit_length())
    places = (found >> np.uint64(24)) & np.uint64(width - 1)
    odd = (np.bincount(places.astype(np.int64), minlength=width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def _slot_counts(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            held, n = [], 0
            for text in batch["text"]:
                held.append(shingles(text.as_py(), words_each) & np.uint64(SLOTS - 1))
                n += len(held[-1])
                if n > SLOTS:
                    counts += np.bincount(np.concatenate(held).astype(np.int64), minlength=SLOTS)
                    held, n = [], 0
            if held:
                counts += np.bincount(np.concatenate(held).astype(np.int64), minlength=SLOTS)
        blocks = np.minimum(counts, np.iinfo(np.uint32).max).astype(np.uint32).reshape(-1, _BLOCK)
        rows = [pa.array(range(len(blocks)), pa.int32()), pa.array([x.tobytes() for x in blocks])]
        yield pa.RecordBatch.from_arrays(rows, ["block", "counts"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch["block"].to_pylist(), batch["counts"], strict=True):
            sums[block] = sums.get(block, 0) + np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64)
    whole = [np.minimum(x, np.iinfo(np.uint32).max).astype(np.uint32).tobytes() for x in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(whole, pa.binary())], ["block", "counts"])


def shingle_counts(docs: DataFrame, words_each: int) -> np.ndarray:
    """How often shingles of each slot occur: SLOTS numbers, however many documents there are."""
    kind = "block int, counts binary"
    found = docs.select("text").mapInArrow(_slot_counts(words_each), kind).repartition("block").mapInArrow(_summed, kind).toArrow()
    counts = np.zeros(SLOTS, np.uint32)
    for block, each in zip(found["block"].to_pylist(), found["counts"].to_pylist(), strict=True):
        counts[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(each, np.uint32)
    return counts


def signed(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Per document the size of its set, a 128-bit hash of the set, its rarest shingles and its bitmap."""
    counts = docs.sparkSession.sparkContext.broadcast(shingle_counts(docs, rule.words))
    names = [c.split()[0] for c in _SIGNED.split(", ")]

    def rarest(found: np.ndarray) -> np.ndarray:
        some = len(found) - (rule.percent * len(found) + 99) // 100 + 1 if len(found) else 0
        return found[np.lexsort((found, counts.value[found & np.uint64(SLOTS - 1)]))[:some]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py(), rule.words) for t in batch["text"]]
            sums = np.array([(x.sum(dtype=np.uint64), _mixed(x ^ _STEP).sum(dtype=np.uint64)) for x in found], np.uint64)
            sums = sums.reshape(len(found), 2).view(np.int64)
            first = [rarest(x).view(np.int64) for x in found]
            offsets = np.cumsum([0, *map(len, first)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, np.concatenate([*first, np.empty(0, np.int64)]))
            bits = pa.array([bitmap(x).tobytes() for x in found], pa.binary())
            sizes = pa.array([len(x) for x in found], pa.int64())
            columns = [batch["doc_id"], sizes, pa.array(sums[:, 0].copy()), pa.array(sums[:, 1].copy()), lists, bits]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SIGNED)


def _sets(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([shingles(t.as_py(), words_each).tobytes() for t in batch["text"]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc"], found], ["doc", "members"])

    return run


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows come sorted by key and may be spread over batches; one table per key."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        key = table["key"].to_numpy()
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for start, stop in zip(edges, edges[1:]):
            if held and key[start] != last:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(start, stop - start))
            last = key[start]
    if held:
        yield pa.concat_tables(held)


def _stacked(bits: list[np.ndarray]) -> np.ndarray:
    """Bitmaps folded to the narrowest one's width, which leaves the bound a bound."""
    words = min(map(len, bits))
    return np.stack([np.bitwise_xor.reduce(x.reshape(-1, words), axis=0) for x in bits])


def _possible(i: int, others: np.ndarray, marks: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Those of the others whose sizes and bitmaps leave a link with member i possible."""
    others = others[np.minimum(n[others], n[i]) * 100 >= np.maximum(n[others], n[i]) * percent]
    both = n[others] + n[i]
    overlap = (both - np.bitwise_count(marks[others] ^ marks[i]).sum(axis=1, dtype=np.int64)) // 2
    return others[(100 + percent) * overlap >= percent * both]


def _groups(percent: int):
    """Members of a tile that a link is possible between, under a name made of all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches):
            doc, label, n, side, home = (rows[c].to_numpy() for c in ("doc", "class", "n", "side", "home"))
            marks = _stacked([np.frombuffer(x.as_buffer(), np.uint64) for x in rows["bits"]])
            group, found = np.arange(len(doc)), np.zeros(len(doc), bool)
            crossing = side.min() != side.max()
            for i in range(len(doc) - 1):
                later = slice(i + 1, None)
                # Two sets of the upper band meet in its own tile, two of one block in the block's.
                open_ = (label[later] != label[i]) & (group[later] != group[i]) & (home[later] | home[i])
                if crossing:
                    open_ &= side[later] != side[i]
                for j in _possible(i, np.flatnonzero(open_) + i + 1, marks, n, percent).tolist():
                    found[i] = found[j] = True
                    if group[i] != group[j]:
                        group[group == group[j]] = group[i]
            if found.any():
                doc, group = doc[found], group[found]
                names = {g: xxhash.xxh3_64_intdigest(np.sort(doc[group == g]).tobytes()) - (1 << 63) for g in np.unique(group).tolist()}
                keys = pa.array([names[g] for g in group.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([keys, pa.array(doc)], ["key", "doc"])

    return run


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _settled(percent: int):
    """Links between classes, confirmed on full sets; no more of them than join the classes."""
    schema = pa.schema([("cx", pa.int64()), ("cy", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches):
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in rows["members"]]
            label, n = rows["class"].to_numpy().copy(), np.array([len(x) for x in sets], np.int64)
            # Wider here, so that few pairs just below the threshold are left to the sets.
            marks, links = _stacked([bitmap(x, 16) for x in sets]), []
            for i in range(len(sets) - 1):
                for j in _possible(i, np.flatnonzero(label[i + 1 :] != label[i]) + i + 1, marks, n, percent).tolist():
                    if label[i] != label[j] and _linked(sets[i], sets[j], percent):
                        links.append((int(label[i]), int(label[j])))
                        label[label == label[j]] = label[i]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], schema=schema)

    return run


class _Join:
    """Classes of sets, named by the smallest doc_id in them, and the full sets read so far."""

    def __init__(self, docs: DataFrame, signatures: DataFrame, rule: Rule, labels: DataFrame):
        self.docs, self.signatures = docs.select(F.col("doc_id").cast("long").alias("doc"), "text"), signatures
        self.rule, self.labels = rule, labels
        self.sets: DataFrame | None = None

    def with_class(self, rows: DataFrame) -> DataFrame:
        labels = self.labels.select("doc", F.col("class").alias("_class"))
        return rows.join(labels, "doc", "left").withColumn("class", F.coalesce("_class", "doc")).drop("_class")

    def _sets_of(self, ids: DataFrame) -> DataFrame:
        ids = ids.distinct()
        if self.sets is not None:
            ids = ids.join(self.sets.select("doc"), "doc", "left_anti")
        ids = staged(ids, "ids")
        n = ids.count()
        if n:
            # The ids travel to the texts as long as they are few; else both are shuffled.
            texts = self.docs.join(F.broadcast(ids) if n <= FEW else ids, "doc").mapInArrow(_sets(self.rule.words), "doc long, members binary")
            read = staged(texts, "sets")
            self.sets = read if self.sets is None else self.sets.unionByName(read)
        return self.sets.dropDuplicates(["doc"]) if self.sets is not None else None

    def _join_classes(self, links: DataFrame) -> None:
        from tallyfold.llm.near_copies import components  # which uses this join for its large nodes

        if links.isEmpty():
            return
        new = components(links).select(F.col("node").alias("class"), F.col("root").alias("_root"))
        moved = self.labels.join(new, "class", "left").select("doc", F.coalesce("_root", "class").alias("class"))
        added = new.select(F.col("class").alias("doc"), F.col("_root").alias("class"))
        self.labels = staged(moved.unionByName(added.join(self.labels.select("doc"), "doc", "left_anti")), "labels")

    def settle(self, members: DataFrame, across: bool) -> None:
        """Find the links between classes in tiles; with `across`, between the blocks of large ones too."""
        members = self.with_class(members)
        several = members.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
        units = _units(_tiles(members.join(several.select("key"), "key"), self.rule.band), across)
        described = units.join(self.signatures.select("doc", "n", "bits"), "doc")
        dealt = lambda rows: rows.repartition("key").sortWithinPartitions("key", "doc")
        columns = ["key", "doc", "class", "n", "side", "home", "bits"]
        groups = staged(dealt(described.select(*columns)).mapInArrow(_groups(self.rule.percent), "key long, doc long").distinct(), "groups")
        if groups.isEmpty():
            return
        whole = self.with_class(groups).join(self._sets_of(groups.select("doc")), "doc").select("key", "doc", "class", "members")
        self._join_classes(staged(dealt(whole).mapInArrow(_settled(self.rule.percent), "cx long, cy long").distinct(), "links"))


def _units(tiles: DataFrame, across: bool) -> DataFrame:
    """What is compared in one task: tiles with several classes, the large ones by pairs of blocks.

    A class with many members in a tile has blocks of its own, so that pairs of blocks of one
    class are left out.
    """
    sizes = tiles.groupBy("tile").agg(
        F.count("*").alias("size"), F.min("class").alias("low"), F.max("class").alias("high"), F.max("home").alias("any_home")
    )
    several = staged(tiles.join(sizes.where("low <> high AND any_home").select("tile", "size"), "tile"), "tiles")
    few = several.where(F.col("size") <= TILE).select(F.col("tile").alias("key"), "doc", "class", "home", F.lit(0).alias("side"))
    large = several.where(F.col("size") > TILE)
    if large.isEmpty():
        return few
    own = large.groupBy("tile", "class").agg(F.count("*").alias("alike"))
    crowd = F.col("alike") * 4 > TILE
    part = F.pmod(F.xxhash64("doc"), F.ceil(F.when(crowd, F.col("alike")).otherwise(F.col("size")) / TILE))
    dealt = large.join(own, ["tile", "class"]).withColumn("block", F.xxhash64(F.when(crowd, F.col("class")), part))
    dealt = staged(dealt.select("tile", "block", "doc", "class", "home"), "blocks")
    blocks = dealt.groupBy("tile", "block").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    one, two = blocks.alias("one"), blocks.alias("two")
    met = F.col("one.block") <= F.col("two.block") if across else F.col("one.block") == F.col("two.block")
    apart = F.least("one.low", "two.low") < F.greatest("one.high", "two.high")
    pairs = one.join(two, (F.col("one.tile") == F.col("two.tile")) & met & apart)
    sides = F.array(
        F.struct(F.col("one.block").alias("block"), F.lit(0).alias("side")), F.struct(F.col("two.block").alias("block"), F.lit(1).alias("side"))
    )
    sides = F.explode(F.when(F.col("one.block") == F.col("two.block"), F.slice(sides, 1, 1)).otherwise(sides)).alias("s")
    key = F.xxhash64("one.tile", "one.block", "two.block").alias("key")
    units = pairs.select(F.col("one.tile").alias("tile"), key, sides).select("tile", "key", "s.block", "s.side")
    return few.unionByName(dealt.join(units, ["tile", "block"]).select("key", "doc", "class", "home", "side"))


def _tiles(members: DataFrame, width: float) -> DataFrame:
    """Members by shingle and band: at home in their own band's tile, and as guests in the one below."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(width))
    home = F.explode(F.array(F.lit(True), F.lit(False))).alias("home")
    each = members.select("key", "doc", "class", band.alias("band"), home)
    return each.select(F.xxhash64("key", F.col("band") - (~F.col("home")).cast("int")).alias("tile"), "doc", "class", "home")


def joined_labels(docs: DataFrame, sets: DataFrame, rule: Rule, labels: DataFrame) -> DataFrame:
    """doc and class (the smallest doc_id reachable) of sets with links; `labels` has links known before.

    `sets` has doc, n, prefix and bits, one row per set, and must not be worked out anew for each use.
    """
    rows = sets.select("doc", "n", F.explode("prefix").alias("key"))
    shared = staged(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key"), "shared")
    members = staged(rows.join(shared, "key").select("key", "doc", "n"), "members")
    join = _Join(docs, sets, rule, labels)
    ends = members.groupBy("doc").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    some = members.join(ends, "doc").where("key = low OR key = high").drop("low", "high")
    join.settle(some, across=False)
    join.settle(members, across=True)
    return join.labels


def linked_components(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id."""
    found = staged(signed(docs, rule).withColumn("_row", F.monotonically_increasing_id()), "signatures")
    # Of equal sets one row stands for all: that of the smallest doc_id.
    same = found.where("n > 0").groupBy("a", "b", "n").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("first"))
    whole = found.where("n > 0").join(same, ["a", "b", "n"])
    stands = (F.col("_row") == F.col("first._row")) & F.col("doc_id").isNotNull()
    marks = [F.when(stands, F.col(name)).alias(name) for name in ("prefix", "bits")]
    classes = staged(whole.select("doc_id", "n", F.col("first.doc_id").alias("first"), *marks), "classes")
    sets = classes.where("bits IS NOT NULL").select(F.col("doc_id").alias("doc"), "n", "prefix", "bits")
    none_yet = docs.sparkSession.createDataFrame([], "doc long, class long")
    labels = joined_labels(docs, sets, rule, none_yet).withColumnRenamed("doc", "first")
    linked = classes.join(labels, "first", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class", "first").alias("component_id")
    )
    none = found.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    own = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return linked.unionByName(none).select("doc_id", "n_shingles", own)
