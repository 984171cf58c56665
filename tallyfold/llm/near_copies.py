"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of distinct five-word shingles. Several independent trees branch the
documents by minwise tokens: documents that share the token chosen by a tree go to the same
node. The first and the last member of a node (by class) are compared with all its members. If
it still holds several classes, a small node is compared exhaustively in one task. Trees are
repeated so that a pair at the threshold meets with all but a chance below 1e-9.

Nodes that are still large would branch on by further tokens. But that parts linked members
that share much with thousands of others (a template) anew at each level, and trees enough to
make up for it cannot be repeated. So their members go, all trees together, through the exact
join of `ngram_join` on their rarest shingles, which leaves out no link.

Comparing means: signatures must leave the link possible, then sizes, then the full sets
decide. Only links between different classes are looked for, so a group of thousands of
copies costs a few comparisons per member, and what is kept of it is a forest of links.
Documents with the same set are one class from the start.

Defined cases: null and empty texts have no shingles and are linked with nothing; texts of
fewer than five words have their whole sequence as the one shingle; rows that repeat a doc_id
should repeat its text, and share its result; rows without a doc_id are kept and belong to no
component; an empty table gives an empty result. Only doc_id and text are read, so names of
other columns cannot clash.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import ngram_join
from tallyfold.llm.common import staged

SHINGLE = 5
PERCENT = 75  # 100 * intersection >= 75 * union
TREES = 16
TOKENS = 64  # minwise tokens per document; trees branch by the first ones, all serve to compare
SMALL = 2048  # members of a node compared exhaustively in one task
# Equal tokens of 64 a link must show: a pair at the threshold has 48 on average, and fewer
# than this five standard deviations below that.
POSSIBLE = 30
MANY = 200_000  # candidate pairs from which the likeliest of each document go first
FEW_LINKS = 20_000  # links between classes that one task joins
FEW = 2_000_000  # ids up to which they are sent to all tasks instead of moving the texts

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_REMEMBERED = 600_000
_HASHES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, (2, TOKENS), np.uint64) * np.uint64(2) + np.uint64(1)
_WITH_TOKENS = "doc_id long, n long, a long, b long, tokens array<int>"


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


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    each = np.frombuffer(b"".join(map(_WORDS.__getitem__, words)), np.uint64)
    length = min(SHINGLE, len(words))
    rolled = np.full(len(words) - length + 1, length, np.uint64)
    for k in range(length):
        rolled = rolled * _STEP + each[k : len(words) - length + 1 + k]
    return np.unique(_mixed(rolled))


def tokens(found: np.ndarray) -> np.ndarray:
    """Minwise tokens: under each hash function, 32 bits of the smallest shingle."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        part = found[at : at + 2048]
        least = np.minimum(least, (part[None, :] * _HASHES[0][:, None] + _HASHES[1][:, None]).min(axis=1))
    return _mixed(least).astype(np.uint32).view(np.int32)


def with_tokens(docs: DataFrame) -> DataFrame:
    """Per document the size of its set, a 128-bit hash of the set, and the minwise tokens."""
    names = [c.split()[0] for c in _WITH_TOKENS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py()) for t in batch["text"]]
            sums = np.array([(x.sum(dtype=np.uint64), _mixed(x ^ _STEP).sum(dtype=np.uint64)) for x in found], np.uint64)
            sums = sums.reshape(len(found), 2).view(np.int64)
            flat = np.concatenate([*map(tokens, found), np.empty(0, np.int32)])
            lists = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * TOKENS, flat)
            sizes = pa.array([len(x) for x in found], pa.int64())
            columns = [batch["doc_id"], sizes, pa.array(sums[:, 0].copy()), pa.array(sums[:, 1].copy()), lists]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _WITH_TOKENS)


def first_nodes(active: DataFrame) -> DataFrame:
    """The nodes of all trees: tree, node key and member, for nodes of two members or more."""
    chosen = F.slice("tokens", 1, TREES)
    rows = active.select("doc", F.posexplode(chosen).alias("tree", "token"))
    rows = rows.select("tree", F.xxhash64("tree", "token").alias("key"), "doc")
    ends = rows.groupBy("key").agg(F.count("*").alias("size"), F.min("doc").alias("first"), F.max("doc").alias("last"))
    return rows.join(ends.where("size > 1"), "key")


def _matches(x: str, y: str):
    return F.size(F.filter(F.zip_with(x, y, lambda a, b: a == b), lambda same: same))


class Linker:
    """Classes of documents, the full sets read so far, and the links between classes."""

    def __init__(self, spark: SparkSession, docs: DataFrame, active: DataFrame):
        self.spark, self.docs, self.active = spark, docs.select(F.col("doc_id").cast("long").alias("doc"), "text"), active
        self.labels = spark.createDataFrame([], "doc long, class long")
        self.sets: DataFrame | None = None

    def with_class(self, rows: DataFrame, doc: str, name: str) -> DataFrame:
        """The class of a document is its own id until it is linked with a smaller one."""
        labels = self.labels.select(F.col("doc").alias("_doc"), F.col("class").alias("_class"))
        return (
            rows.join(labels, F.col(doc) == F.col("_doc"), "left")
            .withColumn(name, F.coalesce("_class", F.col(doc)))
            .drop("_doc", "_class")
        )

    def link(self, pairs: DataFrame) -> None:
        """Confirm pairs (x, y, matches) on the full sets and join the classes of those that hold.

        Of many pairs first the likeliest of each x; of the others, what still parts two
        classes then.
        """
        pairs = staged(pairs, "pairs")
        n = pairs.count()
        if n > MANY:
            best = pairs.groupBy("x").agg(F.max_by("y", F.struct("matches", "y")).alias("y"))
            self._confirm(best)
            pairs = pairs.join(best, ["x", "y"], "left_anti")
        if n:
            self._confirm(pairs)

    def _confirm(self, pairs: DataFrame) -> None:
        once = pairs.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
        apart = self.with_class(self.with_class(once, "x", "cx"), "y", "cy").where("cx <> cy")
        apart = staged(apart.select("x", "y", "cx", "cy"), "apart")
        if apart.isEmpty():
            return
        sets = self._sets_of(apart.select(F.explode(F.array("x", "y")).alias("doc")))
        left = sets.select(F.col("doc").alias("x"), F.col("members").alias("mx"))
        right = sets.select(F.col("doc").alias("y"), F.col("members").alias("my"))
        whole = apart.join(left, "x").join(right, "y").select("cx", "cy", "mx", "my")
        self._join_classes(staged(whole.mapInArrow(_holding, "cx long, cy long").distinct(), "links"))

    def _sets_of(self, ids: DataFrame) -> DataFrame:
        """Full shingle sets of documents, among others; texts not read yet are read now."""
        ids = ids.distinct()
        if self.sets is not None:
            ids = ids.join(self.sets.select("doc"), "doc", "left_anti")
        ids = staged(ids, "ids")
        n = ids.count()
        if n:
            # The ids travel to the texts as long as they are few; else both are shuffled.
            texts = self.docs.join(F.broadcast(ids) if n <= FEW else ids, "doc").mapInArrow(_members, "doc long, members binary")
            read = staged(texts.dropDuplicates(["doc"]) if n > FEW else texts, "sets")
            self.sets = read if self.sets is None else self.sets.unionByName(read)
        return self.sets

    def _join_classes(self, links: DataFrame) -> None:
        if links.isEmpty():
            return
        merged = components(links)
        new = merged.select(F.col("node").alias("class"), F.col("root").alias("_root"))
        moved = self.labels.join(new, "class", "left").select("doc", F.coalesce("_root", "class").alias("class"))
        known = self.labels.select("doc")
        added = new.select(F.col("class").alias("doc"), F.col("_root").alias("class")).join(known, "doc", "left_anti")
        self.labels = staged(moved.unionByName(added), "labels")

    def meet_ends(self, nodes: DataFrame) -> DataFrame:
        """Members of nodes with their matches with the node's first and last member."""
        tokens_of = lambda name: self.active.select(
            F.col("doc").alias(name), F.col("tokens").alias(f"t_{name}"), F.col("n").alias(f"n_{name}")
        )
        compared = (
            nodes.join(tokens_of("doc"), "doc").join(tokens_of("first"), "first").join(tokens_of("last"), "last")
            .select(
                "tree", "key", "size", "doc", "first", "last",
                _matches("t_doc", "t_first").alias("m_first"), _matches("t_doc", "t_last").alias("m_last"),
                _sizes_fit("n_doc", "n_first").alias("f_first"), _sizes_fit("n_doc", "n_last").alias("f_last"),
            )
        )
        return staged(compared, "compared")

    def settle(self, nodes: DataFrame) -> None:
        """Compare all members of small nodes that belong to different classes.

        First on their tokens; the members that may have a link come back with their full
        sets. What a node gives is links between classes, fewer than it has members.
        """
        columns = ["tree", "key", "doc", "small", "class", "n", "tokens"]
        described = lambda rows: self.with_class(rows, "doc", "class").join(self.active, "doc")
        dealt = lambda rows: rows.repartition("key").sortWithinPartitions("key", "doc")
        # The trees in which a document is in a small node, as bits.
        trees = nodes.groupBy("doc").agg(F.bit_or(F.expr("shiftleft(1L, tree)")).alias("small"))
        rows = dealt(described(nodes.select("tree", "key", "doc").join(trees, "doc")).select(*columns))
        suspects = staged(rows.mapInArrow(_suspects, "tree int, key long, doc long, small long"), "suspects")
        if suspects.isEmpty():
            return
        whole = described(suspects).join(self._sets_of(suspects.select("doc")), "doc").select(*columns, "members")
        self._join_classes(staged(dealt(whole).mapInArrow(_settle, "cx long, cy long").distinct(), "links"))

    def settle_large(self, nodes: DataFrame) -> None:
        """Find all links between members of large nodes, by a join on their rarest shingles.

        Branching on would part linked members that share much with thousands of others. The
        join of `ngram_join` leaves none out, whatever the size of a node.
        """
        ids = staged(nodes.select("doc").distinct(), "members")
        few = ids.count() <= FEW
        texts = self.docs.join(F.broadcast(ids) if few else ids, "doc").select(F.col("doc").alias("doc_id"), "text")
        rule = ngram_join.Rule(SHINGLE, PERCENT)
        signatures = staged(ngram_join.signed(texts, rule).dropDuplicates(["doc_id"]), "signatures")
        sets = signatures.select(F.col("doc_id").alias("doc"), "n", "prefix", "bits")
        self.labels = ngram_join.joined_labels(texts, sets, rule, self.labels)

    def undecided(self, nodes: DataFrame) -> DataFrame:
        """The rows of nodes whose members belong to several classes."""
        spread = self.with_class(nodes, "doc", "class").groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"))
        return nodes.join(spread.where("low <> high").select("key"), "key", "left_semi")


def _with_ends(compared: DataFrame) -> DataFrame:
    """Pairs of each member with the two ends, if tokens and sizes leave a link possible."""
    pair = lambda end: F.struct(F.col(end).alias("y"), F.col(f"m_{end}").alias("matches"), F.col(f"f_{end}").alias("fits"))
    found = compared.select(F.col("doc").alias("x"), F.explode(F.array(pair("first"), pair("last"))).alias("p"))
    return found.where(f"p.fits AND p.matches >= {POSSIBLE} AND x <> p.y").select("x", "p.y", "p.matches").distinct()


def _sizes_fit(x: str, y: str):
    return F.least(x, y) * 100 >= F.greatest(x, y) * PERCENT


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array([shingles(t.as_py()).tobytes() for t in batch["text"]], pa.binary())
        yield pa.RecordBatch.from_arrays([batch["doc"], found], ["doc", "members"])


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = ([np.frombuffer(v.as_buffer(), np.uint64) for v in batch[side]] for side in ("mx", "my"))
        holds = [_linked(a, b) for a, b in zip(*sets, strict=True)]
        yield batch.select(["cx", "cy"]).filter(pa.array(holds, pa.bool_()))


class _Node:
    """The members of a small node, and which pairs of them are to be compared there."""

    def __init__(self, rows: pa.Table):
        self.doc, self.label, self.n, self.small = (rows[c].to_numpy() for c in ("doc", "class", "n", "small"))
        self.marks = rows["tokens"].combine_chunks().flatten().to_numpy().reshape(len(self.doc), TOKENS)
        self.tree = rows["tree"][0].as_py()

    def partners(self, i: int, label: np.ndarray) -> np.ndarray:
        """Later members of other classes that a link with member i is possible with.

        A pair that shares small nodes in several trees is left to the first of them.
        """
        rest = slice(i + 1, None)
        equal = self.marks[rest] == self.marks[i]
        fits = np.minimum(self.n[rest], self.n[i]) * 100 >= np.maximum(self.n[rest], self.n[i]) * PERCENT
        maybe = np.flatnonzero((label[rest] != label[i]) & fits)
        maybe = maybe[equal[maybe].sum(axis=1) >= POSSIBLE]
        for tree in range(self.tree):
            if self.small[i] >> tree & 1:
                maybe = maybe[~equal[maybe, tree]]
        return maybe + i + 1


def _by_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows come sorted by node, a node's rows may be spread over batches; one table per node."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        key = table["key"].to_numpy()
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()]
        for start, stop in zip(edges, edges[1:]):
            yield table.slice(start, stop - start)
        held = table.slice(edges[-1])
    if held is not None:
        yield held


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of small nodes with a partner to be compared with."""
    for rows in _by_node(batches):
        node, found = _Node(rows), np.zeros(rows.num_rows, bool)
        for i in range(rows.num_rows - 1):
            partners = node.partners(i, node.label)
            found[partners] = True
            found[i] |= len(partners) > 0
        if found.any():
            yield from rows.select(["tree", "key", "doc", "small"]).filter(pa.array(found)).to_batches()


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between classes in small nodes, confirmed on full sets; no more than join the classes."""
    schema = pa.schema([("cx", pa.int64()), ("cy", pa.int64())])
    for rows in _by_node(batches):
        node = _Node(rows)
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in rows["members"]]
        label, links = node.label.copy(), []
        for i in range(rows.num_rows - 1):
            for j in node.partners(i, label):
                if label[i] != label[j] and _linked(sets[i], sets[j]):
                    links.append((label[i], label[j]))
                    label[label == label[j]] = label[i]
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([int(x) for x in c], pa.int64()) for c in zip(*links, strict=True)], schema=schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        for x, y in zip(batch["cx"].to_pylist(), batch["cy"].to_pylist(), strict=True):
            x, y = sorted((find(x), find(y)))
            root[y] = x
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(list(map(find, nodes)), pa.int64())], ["node", "root"])


def components(links: DataFrame) -> DataFrame:
    """node and root (smallest node reachable), for links (cx, cy) that have been written.

    A few links are joined in one task. More are joined by alternating star steps: a step hangs
    neighbours below the smallest neighbour, and neighbour lists are never gathered.
    """
    if links.count() <= FEW_LINKS:
        return staged(links.coalesce(1).mapInArrow(_joined, "node long, root long"), "roots")
    edges = links.select(F.greatest("cx", "cy").alias("u"), F.least("cx", "cy").alias("v")).where("u <> v").distinct()
    finished = False
    while not finished:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = staged(small.where("u <> v").distinct(), "edges")
        # Done when every node has one edge down, and none hangs below a node that does.
        ends = edges.select("u").groupBy("u").agg(F.count("*").alias("n"))
        below = edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        finished = below.isEmpty() and ends.where("n > 1").isEmpty()
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def near_copies(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id and kept."""
    spark = docs.sparkSession
    sets = staged(with_tokens(docs), "tokens")
    same = sets.where("n > 0").groupBy("a", "b", "n").agg(F.min("doc_id").alias("first"))
    marks = F.when(F.col("doc_id") == F.col("first"), F.col("tokens")).alias("tokens")
    classes = staged(sets.where("n > 0").join(same, ["a", "b", "n"]).select("doc_id", "n", "first", marks), "classes")
    first = classes.where("doc_id = first").select(F.col("doc_id").alias("doc"), "tokens", "n").dropDuplicates(["doc"])
    nodes = staged(first_nodes(first), "nodes")
    active = first.join(nodes.select("doc").distinct(), "doc", "left_semi")
    linker = Linker(spark, docs, staged(active, "active"))
    compared = linker.meet_ends(nodes)
    # The ends settle most nodes.
    linker.link(_with_ends(compared))
    rest = staged(linker.undecided(compared), "undecided")
    linker.settle(rest.where(F.col("size") <= SMALL))
    large = linker.undecided(rest.where(F.col("size") > SMALL))
    if not large.isEmpty():
        linker.settle_large(large)
    found = classes.join(linker.labels, F.col("first") == F.col("doc"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class", "first").alias("component_id")
    )
    none = sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    own = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return found.unionByName(none).select("doc_id", "n_shingles", own, kept.alias("kept"))
