"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words are counted over all texts. A word's letters fall into GROUPS letter groups, and its
vector of counts per group is its path in a trie. One inserted letter adds one to one count,
one replaced letter adds one and takes one, so a depth-first search for a word may go one
above its own count once (the surplus) and one below once (the deficit). What the search
reaches are leaves whose words are verified letter by letter; of them only those are looked at
that share the word's first or its last half, as one edit leaves one of the halves alone.

The trie is cut into subtrees of at most NODE words. Words are dealt to the subtrees that
their search reaches, so that a task holds one subtree and the words looking for neighbours
in it; no task sees the whole vocabulary. A pair is searched from its shorter word only, or
from both when they are equally long, and counted for both.

Defined cases: null and empty texts have no words; repeated rows count each; a row without a
doc_id is hashed with an empty id; an empty table gives an empty result. Only doc_id and text
are read, so names of other columns cannot clash.
"""

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import staged

LEAST_LETTERS = 6
LEAST_OCCURRENCES = 5
DROPS = 199  # one of so many runs of a document loses a letter
TIMES = 5  # a form is at least so many times as frequent
GROUPS = 10
NODE = 2000  # words of a subtree; above it the trie is cut one level deeper

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# In UTF-8 the letters U+00C0 to U+00FF are this lead byte and one other.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % LEAST_LETTERS)
_HELD = 400_000  # distinct words a task counts before it passes them on


def _less_one(run: bytes, h: int) -> bytes:
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def _words_of(text: bytes, doc_id: str) -> Iterator[tuple[bytes, int]]:
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(_RUN.findall(text.translate(_LOWER))).items():
        h = zlib.crc32(run, start)
        if h % DROPS == 0:
            run = _less_one(run, h)
            if len(run) - run.count(b"\xc3") < LEAST_LETTERS:
                continue
        yield run, n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def passed_on() -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        batch = pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            if text.is_valid:
                for word, n in _words_of(text.as_buffer().to_pybytes(), "" if doc_id is None else doc_id):
                    counts[word] += n
                if len(counts) > _HELD:
                    yield passed_on()
    if counts:
        yield passed_on()


def vocabulary(docs: DataFrame, least: int = LEAST_OCCURRENCES) -> DataFrame:
    """word and n: the words of all texts with at least `least` occurrences."""
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(_counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def vector(word: str) -> bytes:
    """Letters per letter group; a count above 250 stands for all such (pairs stay within one of each other)."""
    counts = [0] * GROUPS
    for letter in word:
        counts[ord(letter) % GROUPS] += 1
    return bytes(min(c, 250) for c in counts)


def _with_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = pa.array([vector(w.as_py()).hex() for w in batch["word"]], pa.string())
        yield pa.RecordBatch.from_arrays([batch["word"], batch["n"], paths], ["word", "n", "path"])


def _count_at(level: int):
    """The word's own count at a level of its path, which has two hex digits for each."""
    return F.conv(F.substring("path", 2 * level + 1, 2), 16, 10).cast("int")


def dealt(words: DataFrame, node: int = NODE) -> DataFrame:
    """Members and searches per subtree: subtree, path, word, n, plus, minus, and member (or else a search).

    Level by level, subtrees of more than `node` words are opened: members go to the child on
    their path, searches to all children that their budget lets them reach.
    """
    both = F.explode(F.array(F.lit(True), F.lit(False))).alias("member")
    rows = words.select(F.lit("").alias("subtree"), "path", "word", "n", both, F.lit(0).alias("plus"), F.lit(0).alias("minus"))
    rest, ready = staged(rows, "searches"), []
    for level in range(GROUPS):
        # At most one row per `node` words.
        large = staged(rest.where("member").groupBy("subtree").agg(F.count("*").alias("size")).where(F.col("size") > node), "large")
        ready.append(rest.join(F.broadcast(large), "subtree", "left_anti"))
        if large.isEmpty():
            break
        opened = rest.join(F.broadcast(large.select("subtree")), "subtree")
        deltas = F.when(F.col("member"), F.array(F.lit(0))).otherwise(F.array(F.lit(-1), F.lit(0), F.lit(1)))
        count = _count_at(level) + F.col("delta")
        moved = opened.withColumn("delta", F.explode(deltas)).where(count >= 0).select(
            F.concat("subtree", F.lower(F.lpad(F.hex(count), 2, "0"))).alias("subtree"), "path", "word", "n", "member",
            (F.col("plus") + (F.col("delta") > 0).cast("int")).alias("plus"),
            (F.col("minus") + (F.col("delta") < 0).cast("int")).alias("minus"),
        )
        rest = staged(moved.where("plus < 2 AND minus < 2"), "searches")
    else:
        ready.append(rest)
    whole = ready[0]
    for part in ready[1:]:
        whole = whole.unionByName(part)
    return whole


def one_edit(short: str, long: str) -> bool:
    """Is `long` made from `short` by one inserted or one replaced letter?"""
    at = next((k for k, (x, y) in enumerate(zip(short, long)) if x != y), len(short))
    if len(long) == len(short):
        return at < len(short) and short[at + 1 :] == long[at + 1 :]
    return short[at:] == long[at + 1 :]


class _Leaf:
    """Words of one leaf by their halves; two words one edit apart share a half."""

    def __init__(self, words: list[str]):
        self.halves: dict[tuple[str, bool], list[int]] = defaultdict(list)
        for i, word in enumerate(words):
            for half in {len(word) // 2, (len(word) - 1) // 2}:
                self.halves[word[:half], True].append(i)
                self.halves[word[len(word) - half :], False].append(i)

    def near(self, word: str) -> set[int]:
        half = len(word) // 2
        return {*self.halves.get((word[:half], True), ()), *self.halves.get((word[len(word) - half :], False), ())}


def neighbours(paths: np.ndarray, words: list[str], searches: np.ndarray, plus: np.ndarray, minus: np.ndarray, texts: list[str]):
    """Pairs (search, member) one edit apart, by depth-first search of the trie over `paths` (sorted).

    All searches that reach a node go down from it together, each with what is left of its
    budget of one surplus and one deficit.
    """
    stack = [(0, 0, len(words), np.arange(len(texts)), plus.astype(bool), minus.astype(bool))]
    while stack:
        level, low, high, who, used, lent = stack.pop()
        if level == paths.shape[1]:
            leaf = _Leaf(words[low:high])
            # A deficit alone is a longer word looking for a shorter one; it is found from there.
            for k in who[used | ~lent].tolist():
                for i in leaf.near(texts[k]):
                    word = words[low + i]
                    if len(word) >= len(texts[k]) and (len(word) > len(texts[k]) or texts[k] < word) and one_edit(texts[k], word):
                        yield k, low + i
            continue
        counts = paths[low:high, level]
        edges = [0, *(np.flatnonzero(counts[1:] != counts[:-1]) + 1).tolist(), high - low]
        wanted = searches[who, level].astype(np.int16)
        for start, stop in zip(edges, edges[1:]):
            over = np.int16(counts[start]) - wanted
            goes = (over == 0) | ((over == 1) & ~used) | ((over == -1) & ~lent)
            if goes.any():
                stack.append((level + 1, low + start, low + stop, who[goes], used[goes] | (over[goes] == 1), lent[goes] | (over[goes] == -1)))


def _counts_of(paths: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(paths.to_pylist())), np.uint8).reshape(-1, GROUPS)


def _by_subtree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows come sorted by subtree and may be spread over batches; one table per subtree."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        keys = table["subtree"].to_pylist()
        edges = [k for k in range(1, len(keys)) if keys[k] != keys[k - 1]]
        if held and held[0]["subtree"][0].as_py() != keys[0]:
            yield pa.concat_tables(held)
            held = []
        for start, stop in zip([0, *edges], [*edges, len(keys)]):
            if held and start:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(start, stop - start))
    if held:
        yield pa.concat_tables(held)


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of every pair found, with the neighbour's count."""
    for rows in _by_subtree(batches):
        member = rows["member"].to_numpy()
        members, searches = rows.filter(pa.array(member)), rows.filter(pa.array(~member))
        if not members.num_rows or not searches.num_rows:
            continue
        members = members.sort_by("path")
        words, texts = members["word"].to_pylist(), searches["word"].to_pylist()
        flags = (searches[c].to_numpy() for c in ("plus", "minus"))
        # The path down to the subtree is behind the searches already.
        done = len(rows["subtree"][0].as_py()) // 2
        pairs = list(neighbours(_counts_of(members["path"])[:, done:], words, _counts_of(searches["path"])[:, done:], *flags, texts))
        if pairs:
            n, m = searches["n"].to_pylist(), members["n"].to_pylist()
            found = [(texts[k], words[i], m[i]) for k, i in pairs] + [(words[i], texts[k], n[k]) for k, i in pairs]
            columns = [pa.array(x, t) for x, t in zip(zip(*found), (pa.string(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["word", "near", "near_n"])


def near_words(words: DataFrame, node: int = NODE) -> DataFrame:
    """word, near, near_n: every pair of words one edit apart, in both directions. `words` has word and n."""
    paths = staged(words.mapInArrow(_with_paths, "word string, n long, path string"), "paths")
    rows = dealt(paths, node).repartition("subtree").sortWithinPartitions("subtree")
    return rows.mapInArrow(_searched, "word string, near string, near_n long")


def grouped(words: DataFrame, times: int = TIMES, node: int = NODE) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n. `words` has distinct words and their n."""
    words = staged(words, "words")
    near = near_words(words, node).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best")
    )
    best_n = -F.col("best.minus_n")
    has_form = F.coalesce(best_n >= times * F.col("n"), F.lit(False))
    found = staged(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has_form, F.col("best.near")).alias("form"), F.when(has_form, best_n).alias("form_n"),
        ),
        "forms",
    )
    roots = found.select("word", F.coalesce("form", "word").alias("root"))
    return found.join(_followed(roots), "word").select("word", "form", "root", "n", "n_near", "form_n")


def _followed(steps: DataFrame) -> DataFrame:
    """Each word's last step. A form is several times as frequent as its word, so ways are short."""
    onward = steps.where("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
    ended = []
    while True:
        # Words whose form has no form of its own have arrived.
        arrived = steps.join(onward.select("root"), "root", "left_anti")
        ended.append(arrived.select("word", "root"))
        steps = staged(steps.join(onward, "root").select("word", F.col("next").alias("root")), "onward")
        if steps.isEmpty():
            break
    whole = ended[0]
    for part in ended[1:]:
        whole = whole.unionByName(part)
    return whole
