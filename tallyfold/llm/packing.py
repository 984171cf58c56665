"""Packing token sequences into windows by non-negative least squares.

A text becomes token ids and an end id. Whole windows are cut off its front; what is left is a
piece shorter than a window. Of the pieces only the histogram of lengths is needed for a plan,
and it has at most as many entries as the window has places. Combinations of two and three
lengths that fill the window exactly are enumerated, their repeat counts are solved against
the histogram by non-negative least squares and rounded, and the residual is packed greedily:
first into combinations that leave next to nothing open, the rest end to end, cut where a
window is full. Only the last sequence is padded. Every piece then finds its place by its rank
among the pieces of its length, so no piece ever meets the others in one task.

Defined cases: a null or empty text has the end id only; a document longer than a window lies
in several pieces; repeated rows are packed each; an empty table gives an empty result. Only
doc_id and text are read, so names of other columns cannot clash.
"""

import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm.common import bucketed_running, staged

WINDOW = 2048
END = 1
PARTNERS = 4  # triples enumerated per length
SWEEPS = 30
WASTE = WINDOW // 128  # places a combination of the residual may leave open
REMEMBERED = 1_500_000  # words whose ids a worker keeps
_TEXTS = 4 << 20  # characters tokenized at a time

_PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
_POINTS = ".,;:!?"
_MARK = "<|"  # how the strings of special tokens begin
_WORD_END = "</w>"  # how tokens that end a word are marked
_BEYOND = "\u0250"  # Latin letters below it stay as they are in any normal form that composes
# How byte-level vocabularies write bytes: visible ones as themselves, others from 256 on.
_HIDDEN = [*range(33), *range(127, 161), 173]
_SPELT = {b: 256 + k for k, b in enumerate(_HIDDEN)}


class WordIds:
    """Token ids of words, remembered from text to text.

    The tokenizer reads runs without white space one by one, so a text's ids are those of its
    words in a row, and so are those of a word and the point, comma or mark after a letter.
    Texts that may hold the string of a special token are read whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The string of a special token parts words that are read together; no word holds one.
        special = self.tokenizer.get_added_tokens_decoder()
        self._part, self._parting = next((t.content, i) for i, t in special.items() if t.content.startswith(_MARK))
        self._last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self._last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(_WORD_END)]] = True
        # A model that takes words of small Latin letters as the tokenizer hands them on is asked directly.
        self._model = self.tokenizer.model
        sample = [t.removesuffix(_WORD_END) for t in sorted(self.tokenizer.get_vocab())]
        sample = [w for w in sample if w.isascii() and w.isalpha() and w.islower()][::97]
        sample += [f"be{c}r" for c in map(chr, range(128, ord(_BEYOND))) if c.isalpha() and c == c.lower()]
        self._direct = all(np.array_equal(a, b) for a, b in zip(self._encode_letters(sample), self._encode(sample), strict=True))
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self._ids, self._starts = np.empty(0, np.uint32), np.zeros(1, np.int64)
        # An empty word stands where a text begins or ends with white space.
        self._add([""], self._ids, np.zeros(1, np.int64))

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self._ids = np.concatenate([self._ids, ids])
        self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes)])

    def _learn(self, words: list[str]) -> None:
        """Ids of new words, found together."""
        split = [w for w in words if len(w) > 1 and w[-1] in _POINTS and w[-2].isascii() and w[-2].isalpha()]
        parts = {w[:-1] for w in split} | {w[-1] for w in split} | set(words).difference(split)
        new = [w for w in parts if w not in self.known]
        plain, letters, others = [], [], []
        for w in new:
            kind = others if not w.isalpha() or w != w.lower() else plain if self._direct and max(w) < _BEYOND else letters
            kind.append(w)
        for found, encode in ((plain, self._encode_letters), (letters, self._encode_plain), (others, self._encode)):
            # Added at once, as each addition copies what is known.
            parts = [encode(found[at : at + 4096]) for at in range(0, len(found), 4096)]
            if parts:
                self._add(found, *map(np.concatenate, zip(*parts, strict=True)))
        if split:
            both = np.array([[self.known[w[:-1]], self.known[w[-1]]] for w in split], np.int64)
            ids, upto = self._gathered(both.ravel())
            self._add(split, ids, np.diff(upto[::2]))

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words in a row, and how many each has, by one call."""
        ids = np.array(self.tokenizer.encode(self._part.join(words), add_special_tokens=False).ids, np.uint32)
        bounds = np.concatenate([[-1], np.flatnonzero(ids == self._parting), [len(ids)]])
        return ids[ids != self._parting], np.diff(bounds) - 1

    def _encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only, which the tokenizer does not part: each has one end of a word."""
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, np.uint32)
        ends = np.flatnonzero(self._last[ids])
        return (ids, np.diff(ends, prepend=-1)) if len(ends) == len(words) else self._encode(words)

    def _encode_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of small Latin letters, of which only the bytes are spelt out on the way to the model."""
        ask = self._model.tokenize
        spelt = [w if w.isascii() else w.encode().decode("latin-1").translate(_SPELT) for w in words]
        found = [[token.id for token in ask(w)] for w in spelt]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum()), sizes

    def _gathered(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known words in a row, and the bounds of the words."""
        firsts = self._starts[words]
        sizes = self._starts[words + 1] - firsts
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return self._ids[np.repeat(firsts - upto[:-1], sizes) + np.arange(upto[-1])], upto

    def flat(self, texts: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in a row, each text's followed by `end`, and the bounds of the texts."""
        whole = {k: t for k, t in enumerate(texts) if _MARK in t}
        if len(self.known) > REMEMBERED:
            self._clear()
        # A-Z only; the tokenizer lowers all letters anyway.
        lowered = pc.ascii_lower(pa.array(["" if k in whole else t for k, t in enumerate(texts)], pa.string()))
        words = pc.ascii_split_whitespace(lowered)
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = list(map(self.known.get, distinct))
        if None in at:
            self._learn([w for w, i in zip(distinct, at, strict=True) if i is None])
            at = list(map(self.known.__getitem__, distinct))
        ids, upto = self._gathered(np.array(at, np.int64)[coded.indices.to_numpy()])
        counts = np.diff(upto[words.offsets.to_numpy()])
        if whole:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for k, text in whole.items():
                parts[k] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            ids, counts = np.concatenate(parts), np.array([len(x) for x in parts])
        extra = 0 if end is None else 1
        bounds = np.concatenate([[0], np.cumsum(counts + extra)])
        out = np.full(bounds[-1], 0 if end is None else end, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(texts)) * extra, counts)] = ids
        return out, bounds

    def read(self, texts: list[str]) -> list[bytes]:
        """The ids of each text (little-endian, 32 bits); words not met before are learnt together."""
        ids, bounds = self.flat(texts)
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


_WORKER: dict[str, WordIds] = {}


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END, width: int = 4) -> DataFrame:
    """Whole windows and remainders of all documents, with their ids of `width` bytes each (little-endian)."""
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def packed_rows(words: WordIds, doc_ids: list[int], texts: list[str]) -> pa.RecordBatch:
        ids, bounds = words.flat(texts, end)
        sizes = np.diff(bounds)
        times = -(-sizes // window)
        doc = np.repeat(np.arange(len(texts)), times)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(times) - times, times)) * window
        length = np.minimum(sizes[doc] - start, window)
        # The pieces lie end to end in the ids, so they are cut out of one buffer.
        places = pa.py_buffer(np.concatenate([[0], np.cumsum(width * length)]).astype(np.int32).tobytes())
        cut = pa.Array.from_buffers(pa.binary(), len(doc), [None, places, pa.py_buffer(ids.astype(f"<u{width}").tobytes())])
        columns = [pa.array(doc_ids, pa.int64()).take(pa.array(doc)), *map(pa.array, (start, length, sizes[doc])), cut]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WORKER.get(tokenizer) or _WORKER.setdefault(tokenizer, WordIds(tokenizer))
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids.append(doc_id.as_py())
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held >= _TEXTS:
                    yield packed_rows(words, ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield packed_rows(words, ids, texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES)


@dataclass
class Place:
    """Where the pieces of one length with ranks in [first, first + count) go.

    A row of `per` pieces stands from `offset` on in each sequence from `base` on; if `stream`
    is set, the pieces stand end to end from place `offset` of the stream instead.
    """

    length: int
    first: int
    count: int
    base: int
    offset: int
    per: int
    stream: bool


def enumerate_combinations(histogram: dict[int, int], window: int) -> list[dict[int, int]]:
    """Pairs of lengths that fill the window, and per length a few triples, likeliest first."""
    h = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        h[length] = n
    found = {}
    for a in range(1, window // 2 + 1):
        if h[a] and h[window - a]:
            found[(a, window - a)] = min(h[a], h[window - a])
    for a in np.flatnonzero(h[:window]):
        b = np.arange(1, max(window - a, 1))
        fit = np.minimum(h[b], h[window - a - b])
        for i in np.argsort(-fit, kind="stable")[:PARTNERS]:
            if fit[i]:
                lengths = tuple(sorted((int(a), int(b[i]), int(window - a - b[i]))))
                found[lengths] = min(int(h[x]) // lengths.count(x) for x in lengths)
    ordered = sorted(found, key=lambda x: (len(x), -found[x], x))
    return [{x: c.count(x) for x in c} for c in ordered if found[c]]


def solve_repeats(combinations: list[dict[int, int]], histogram: dict[int, int], sweeps: int = SWEEPS) -> list[float]:
    """Non-negative least squares by coordinate descent: repeats whose pieces come nearest to the histogram."""
    left = dict(histogram)
    x = [0.0] * len(combinations)
    for _ in range(sweeps):
        moved = 0.0
        for k, combination in enumerate(combinations):
            slope = sum(c * left[length] for length, c in combination.items())
            new = max(0.0, x[k] + slope / sum(c * c for c in combination.values()))
            step = new - x[k]
            if step:
                x[k] = new
                moved = max(moved, abs(step))
                for length, c in combination.items():
                    left[length] -= c * step
        if moved < 1e-3:
            break
    return x


def plan(histogram: dict[int, int], window: int = WINDOW, waste: int = WASTE) -> list[Place]:
    """Places for all pieces of the histogram."""
    left = {length: n for length, n in histogram.items() if n}
    used = dict.fromkeys(left, 0)
    places: list[Place] = []
    base = 0

    def lay(combination: dict[int, int], times: int) -> None:
        nonlocal base
        offset = 0
        for length, per in combination.items():
            places.append(Place(length, used[length], per * times, base, offset, per, False))
            used[length] += per * times
            left[length] -= per * times
            offset += per * length
        base += times

    if left.get(window):
        lay({window: 1}, left[window])
    combinations = enumerate_combinations(left, window)
    repeats = solve_repeats(combinations, left)
    for k in sorted(range(len(combinations)), key=lambda k: -repeats[k]):
        times = min(round(repeats[k]), *(left[x] // c for x, c in combinations[k].items()))
        if times > 0:
            lay(combinations[k], times)
    tail: list[int] = []
    lengths = sorted(x for x, n in left.items() if n)
    while lengths:
        longest = lengths[-1]
        combination, room, upto = {}, window, len(lengths)
        while room and (upto := bisect_right(lengths, room, 0, upto)):
            length = lengths[upto - 1]
            combination[length] = min(left[length], room // length)
            room -= length * combination[length]
            upto -= 1
        if room <= waste:
            lay(combination, min(left[x] // c for x, c in combination.items()))
        else:
            tail.append(longest)
            lengths.pop()
        lengths = [x for x in lengths if left[x]]
    position = base * window
    for length in tail:
        places.append(Place(length, used[length], left[length], 0, position, 1, True))
        position += left[length] * length
    return places


_PLACE = T.StructType(
    [T.StructField(f"_{n}", T.LongType()) for n in ("length", "first", "count", "base", "offset", "per")]
    + [T.StructField("_stream", T.BooleanType())]
)


def _width(tokenizer: str, end: int) -> int:
    """Bytes that any id of a tokenizer and the end id need, 2 or 4."""
    from tokenizers import Tokenizer

    most = max(end, *Tokenizer.from_file(tokenizer).get_vocab().values())
    return 2 if most < 1 << 16 else 4


def _widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of two bytes to ids of four, a few pieces at a time."""
    for batch in (whole.slice(at, 2048) for whole in batches for at in range(0, whole.num_rows, 2048)):
        k = batch.schema.get_field_index("ids")
        cut = batch.column(k).cast(pa.binary())
        _, places, held = cut.buffers()
        places = np.frombuffer(places, np.int32)[cut.offset : cut.offset + len(cut) + 1]
        ids = np.frombuffer(held or b"", "<u2")[places[0] // 2 : places[-1] // 2].astype("<u4")
        starts = (2 * (places - places[0])).astype(np.int32)
        wide = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(starts.tobytes()), pa.py_buffer(ids.tobytes())])
        yield batch.set_column(k, batch.schema.field(k).with_type(pa.binary()), wide)


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, ids (32 bits each, little-endian), sequence_id, offset."""
    # Ids travel in two bytes where they fit, and get their four at the end.
    width = _width(tokenizer, end)
    cut = staged(pieces(docs, tokenizer, window, end, width), "pieces")
    # At most one row per length.
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    places = plan(histogram, window)
    if not places:
        return cut.selectExpr("*", "0L AS sequence_id", "0L AS offset")
    # Combinations of at most three lengths and greedy ones: bounded by the window.
    table = docs.sparkSession.createDataFrame([tuple(vars(p).values()) for p in places], _PLACE)
    buckets = max(1, math.isqrt(sum(histogram.values())))
    spread = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    order = [F.col("doc_id"), F.col("start"), F.col("doc_tokens")]
    ranked = bucketed_running(spread, ["length"], "_bucket", order, {"_rank": F.lit(1)})
    inside = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first"))
    found = ranked.join(F.broadcast(table), inside & (F.col("_rank") < F.col("_first") + F.col("_count")))
    nth = F.col("_rank") - F.col("_first")
    at = F.when(F.col("_stream"), F.col("_offset") + nth * F.col("length")).otherwise(
        (F.col("_base") + F.floor(nth / F.col("_per"))) * window + F.col("_offset") + nth % F.col("_per") * F.col("length")
    )
    stands = found.withColumn("_at", at.cast("long"))
    # A piece of the stream that passes the end of a window goes on in the next one.
    over = F.least(F.col("length"), window - F.col("_at") % window)
    both = F.array(
        F.struct(F.lit(0).cast("long").alias("skip"), over.alias("length")),
        F.struct(over.alias("skip"), (F.col("length") - over).alias("length")),
    )
    parts = stands.withColumn("_part", F.explode(F.filter(both, lambda x: x["length"] > 0)))
    place = F.col("_at") + F.col("_part.skip")
    laid = parts.select(
        "doc_id",
        (F.col("start") + F.col("_part.skip")).alias("start"),
        F.col("_part.length").alias("length"),
        "doc_tokens",
        F.expr(f"substring(ids, CAST({width} * _part.skip + 1 AS INT), CAST({width} * _part.length AS INT))").alias("ids"),
        F.floor(place / window).cast("long").alias("sequence_id"),
        (place % window).cast("long").alias("offset"),
    )
    return laid.mapInArrow(_widened, laid.schema) if width == 2 else laid
