"""Alignment of the tokens that two tokenizers give for the same texts.

Tokenizer A is a byte-level BPE that reads a space and the text, tokenizer B a piece BPE that
adds the space itself, so both spell the same bytes. Byte offsets where a token of A and one
of B end together are cuts: they part a text into groups of tokens that belong together, and
link the two tokens that end there.

The ends are merged in lockstep. Texts are dealt into lanes of at most LANE bytes, and a state
vector holds where every lane stands in A's and in B's ends. One step compares all pairs of
ends at once, emits a link and a cut where they are equal, advances whichever is behind, and
compacts the vector to the lanes that are not finished. A long text is many lanes, so the
number of steps is bounded by LANE, whatever the texts.

How often a pair of ids is linked over all texts is added up from the links of each text, and
brought back to them: by a lookup sent to all tasks while it has at most PAIRS_SENT rows, and
by a shuffle on the pair beyond; the results are the same.

Defined cases: null and empty texts, and texts whose bytes one of the tokenizers does not give
back, have no tokens, groups or links; repeated rows are aligned each and count each; rows
without a doc_id are kept; an empty table gives an empty result. Only doc_id and text are
read, so names of other columns cannot clash. Strings that look like special tokens are
ordinary text.
"""

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import staged

LANE = 1024  # bytes of text a lane covers
PAIRS_SENT = 1_500_000  # pairs of ids up to which their counts are sent to all tasks
_TEXTS = 1 << 20  # characters tokenized at a time
_BITS = 24  # of an id in a pair; vocabularies are smaller by far

# How the byte-level vocabulary splits a text before merging, and the bytes it
# writes as themselves; the other bytes are written as the characters from 256 on.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
AS_THEMSELVES = [*range(33, 127), *range(161, 173), *range(174, 256)]

_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups string, links array<struct<a:int,b:int,times:int>>"
_LINK = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("times", pa.int32())])
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64())]
    + [("groups", pa.string()), ("links", pa.list_(_LINK))]
)


class _Tokens:
    """Bytes of each id, and its decimal text with each of two marks behind it."""

    def __init__(self, spelled: list[bytes], inner: str, last: str):
        self.spelled = spelled
        self.lengths = np.array([len(x) for x in spelled], np.int64)
        self.texts = np.array([f"{i}{mark}" for mark in (inner, last) for i in range(len(spelled))], object)

    def spells(self, ids: list[int], data: bytes) -> bool:
        return b"".join(map(self.spelled.__getitem__, ids)) == data


class ByteLevel(_Tokens):
    """A byte-level BPE, read from its vocabulary: ids are in the order of the merges."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        others = [b for b in range(256) if b not in set(AS_THEMSELVES)]
        written = {chr(b): b for b in AS_THEMSELVES} | {chr(256 + k): b for k, b in enumerate(others)}
        # A name with other characters is a special token's; no text gives its id.
        ranks = {bytes(map(written.__getitem__, t)): i for t, i in vocabulary.items() if all(map(written.__contains__, t))}
        ranks = {t: i for t, i in ranks.items() if not (t.startswith(b"<|") and t.endswith(b"|>"))}
        self.encoding = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        spelled = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            spelled[i] = token
        super().__init__(spelled, ",", "|")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + text) for text in texts]


class Pieces(_Tokens):
    """A piece BPE with byte fallback; it puts the space before the text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

        def spelled(i: int) -> bytes:
            piece = self.model.id_to_piece(i)
            return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

        super().__init__([spelled(i) for i in range(len(self.model))], ",", ";")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def merged(ends_a: np.ndarray, ends_b: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes into both arrays of rising ends where these are equal, by merging all lanes in lockstep.

    A lane takes the ends above one value of `cuts` and up to the next.
    """
    a, b = np.searchsorted(ends_a, cuts, "right"), np.searchsorted(ends_b, cuts, "right")
    at_a, stop_a, at_b, stop_b = a[:-1], a[1:], b[:-1], b[1:]
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while True:
        open_ = (at_a < stop_a) & (at_b < stop_b)
        if not open_.all():
            at_a, stop_a, at_b, stop_b = at_a[open_], stop_a[open_], at_b[open_], stop_b[open_]
        if not len(at_a):
            break
        here_a, here_b = ends_a[at_a], ends_b[at_b]
        together = here_a == here_b
        found_a.append(at_a[together])
        found_b.append(at_b[together])
        at_a = at_a + (here_a <= here_b)
        at_b = at_b + (here_b <= here_a)
    # Ends rise, so the order of the one is the order of the other.
    return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))


def _aligned_rows(one: ByteLevel, two: Pieces, doc_ids: list, texts: list[str]) -> pa.RecordBatch:
    ids_a, ids_b = one.encode(texts), two.encode(texts)
    sizes = np.zeros(len(texts) + 1, np.int64)
    for k, text in enumerate(texts):
        data = b" " + text.encode()
        if text and one.spells(ids_a[k], data) and two.spells(ids_b[k], data):
            sizes[k + 1] = len(data)
        else:
            ids_a[k], ids_b[k] = [], []
    # All texts lie end to end on one line of bytes.
    starts = np.cumsum(sizes)
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    flat_a, flat_b = (np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids))) for ids in (ids_a, ids_b))
    ends_a, ends_b = np.cumsum(one.lengths[flat_a]), np.cumsum(two.lengths[flat_b])
    cuts = np.unique(np.concatenate([starts, np.arange(0, starts[-1], LANE)]))
    link_a, link_b = merged(ends_a, ends_b, cuts)
    # Groups in order, A's tokens before B's, each with the mark that follows it.
    last_a, last_b = np.zeros(len(flat_a), np.int64), np.zeros(len(flat_b), np.int64)
    last_a[link_a] = last_b[link_b] = 1
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    upto_a, upto_b = np.concatenate([[0], link_a + 1]), np.concatenate([[0], link_b + 1])
    parts = np.empty(len(flat_a) + len(flat_b), object)
    parts[np.arange(len(flat_a)) + upto_b[group_a]] = one.texts[flat_a + last_a * len(one.spelled)]
    parts[np.arange(len(flat_b)) + upto_a[group_b + 1]] = two.texts[flat_b + last_b * len(two.spelled)]
    edges = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
    every = parts.tolist()
    groups = ["".join(every[x:y])[:-1] for x, y in zip(edges, edges[1:])]
    # Per text its distinct pairs of linked ids.
    doc = np.searchsorted(np.cumsum(n_a), link_a, "right")
    n_links = np.bincount(doc, minlength=len(texts))
    pair = flat_a[link_a] << _BITS | flat_b[link_b]
    order = np.lexsort((pair, doc))
    pair, doc = pair[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])]) if len(pair) else pair)
    times = np.diff(np.concatenate([first, [len(pair)]])).astype(np.int32)
    fields = [(pair[first] >> _BITS).astype(np.int32), (pair[first] & ((1 << _BITS) - 1)).astype(np.int32), times]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc[first], minlength=len(texts)))]).astype(np.int32)
    links = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(x) for x in fields], fields=list(_LINK)))
    columns = [pa.array(doc_ids, pa.int64()), *map(pa.array, (n_a, n_b, n_links.astype(np.int64))), pa.array(groups, pa.string()), links]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


_WORKER: dict[tuple[str, str], tuple[ByteLevel, Pieces]] = {}


def aligned(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, groups as text, and the linked pairs of ids.

    `groups` has the ids of A and B as `a1,a2|b1;a3|b2,b3`; `links` has every distinct pair of
    ids that end together, with its number of times in this text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (byte_level, pieces) not in _WORKER:
            _WORKER[byte_level, pieces] = ByteLevel(byte_level), Pieces(pieces)
        one, two = _WORKER[byte_level, pieces]
        for batch in batches:
            doc_ids, texts, size = [], [], 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                doc_ids.append(doc_id)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= _TEXTS:
                    yield _aligned_rows(one, two, doc_ids, texts)
                    doc_ids, texts, size = [], [], 0
            if texts:
                yield _aligned_rows(one, two, doc_ids, texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _ALIGNED)


def link_counts(links: DataFrame) -> DataFrame:
    """pair, count and best, for every pair of ids linked anywhere.

    `count` is its number of links over all texts, `best` says that no pair with the same id
    of B has more. `links` has pair, b and times.
    """
    counts = staged(links.groupBy("pair", "b").agg(F.sum("times").alias("count")), "pairs")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    # One row per id of B: a vocabulary's size.
    return counts.join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def scored(found: DataFrame, pairs_sent: int = PAIRS_SENT) -> DataFrame:
    """Adds n_links, n_best and count_sum to rows with `links`, which must not be worked out anew for each use."""
    rows = staged(found.withColumn("_row", F.monotonically_increasing_id()), "aligned")
    each = rows.select("_row", F.explode("links").alias("l")).select(
        "_row",
        (F.shiftleft(F.col("l.a").cast("long"), 32) + F.col("l.b")).alias("pair"),
        F.col("l.b").alias("b"),
        F.col("l.times").alias("times"),
    )
    counts = staged(link_counts(each), "counts")
    sent = counts.count() <= pairs_sent
    times = F.col("times").cast("long")
    sums = (
        each.drop("b")
        .join(F.broadcast(counts) if sent else counts.hint("merge"), "pair")
        .groupBy("_row")
        .agg(
            F.sum(times).alias("n_links"),
            F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"),
            F.sum(times * F.col("count")).alias("count_sum"),
        )
    )
    new = [F.coalesce(name, F.lit(0)).alias(name) for name in ("n_links", "n_best", "count_sum")]
    return rows.join(sums, "_row", "left").select(*found.columns, *new)
