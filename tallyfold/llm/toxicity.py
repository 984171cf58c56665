"""Toxicity by a classifier chain.

Linear models predict the categories one after the other; each later model also sees the
probabilities of the earlier categories. In training these are out-of-fold predictions, so
that a later model learns from probabilities as good as those it will get; features and marker
words of a fold are chosen without its documents. The models are fitted on at most `sample`
labelled documents of the table, a documented bound; every document is scored.

The labels table holds one toxic flag. From it and from the number of marker words (words
that labelled toxic documents use far more often than others) follow three categories:
`severe`, `strong`, and at the chain's end `toxic` itself.

Defined cases: a null or empty text has no words and is scored by the models' constants;
without labelled rows of both kinds, probabilities are the share of toxic rows, or 0; null
labels and ids don't take part in training; a document labelled twice counts as toxic if one
of the labels says so; repeated rows are scored each; empty tables give empty results. Only
doc_id, text and the label are read, so names of other columns cannot clash.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CATEGORIES = ("severe", "strong", "toxic")
STRONG, SEVERE = 2, 5  # distinct marker words
SAMPLE = 12_000
FEATURES = 4096
BUCKETS = 1 << 20
FOLDS = 4
LEAST_THRESHOLD, MOST_THRESHOLD = 0.1, 0.5  # bounds of the threshold chosen in training

_READ = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def word_ids(text: str | None) -> np.ndarray:
    """Hashed ids of the distinct words of a whole text."""
    words = set((text or "").encode().translate(_READ).split())
    found = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) & np.uint32(BUCKETS - 1)
    return np.unique(found).astype(np.int32)


@dataclass
class Chain:
    """Feature ids, per category the weights (features, earlier categories, constant), and the threshold."""

    features: np.ndarray
    weights: list[np.ndarray]
    threshold: float = MOST_THRESHOLD

    def __post_init__(self):
        self._at = np.full(BUCKETS, -1, np.int32)
        self._at[self.features] = np.arange(len(self.features), dtype=np.int32)

    def columns(self, ids: np.ndarray) -> np.ndarray:
        at = self._at[ids]
        return at[at >= 0]

    def predict(self, texts: list[np.ndarray]) -> np.ndarray:
        """Probabilities, one row per text and one column per category."""
        picked = [self.columns(ids) for ids in texts]
        rows = np.repeat(np.arange(len(picked)), [len(p) for p in picked])
        flat = np.concatenate([*picked, np.empty(0, np.int32)]).astype(np.int64)
        out = np.empty((len(texts), len(self.weights)))
        for k, w in enumerate(self.weights):
            out[:, k] = _probabilities(rows, flat, out[:, :k], w)
        return out


def _probabilities(rows: np.ndarray, flat: np.ndarray, earlier: np.ndarray, w: np.ndarray) -> np.ndarray:
    n, k = earlier.shape
    size = len(w) - k - 1
    z = np.bincount(rows, w[flat], n) + earlier @ w[size : size + k] + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(rows, flat, earlier, target, size, ridge=0.2, steps=200) -> np.ndarray:
    """Ridge logistic regression by gradient steps scaled per coordinate."""
    n, k = earlier.shape
    w = np.zeros(size + k + 1)
    share = min(max(target.mean(), 1e-4), 1 - 1e-4) if n else 1e-4
    w[-1] = np.log(share / (1 - share))
    if not n or target.min() == target.max():
        return w
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        miss = _probabilities(rows, flat, earlier, w) - target
        slope = np.concatenate([np.bincount(flat, miss[rows], size), earlier.T @ miss, [miss.sum()]])
        slope[:-1] += ridge * w[:-1]
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        w = w - 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w


def select_features(texts: list[np.ndarray], toxic: np.ndarray, most: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Word ids ordered by how much more often toxic documents hold them (chi-square), and the markers."""
    flat = np.concatenate([*texts, np.empty(0, np.int32)])
    lengths = [len(t) for t in texts]
    inside = np.bincount(flat[np.repeat(toxic == 1, lengths)], minlength=BUCKETS)
    total = np.bincount(flat, minlength=BUCKETS)
    n, t = max(len(texts), 1), max(int(toxic.sum()), 1)
    expected = total * t / n
    gain = np.where(total >= 2, (inside - expected) ** 2 / np.maximum(expected, 1e-9), 0)
    best = np.argsort(-gain, kind="stable")[:most]
    best = best[gain[best] > 0]
    other = (total - inside) / max(n - t, 1)
    marker = (inside >= 3) & (inside / t > 20 * np.maximum(other, 0.2 / n))
    return best.astype(np.int32), marker


@dataclass
class _Learner:
    """Features and markers chosen on some rows, and all rows as columns of these features."""

    inside: np.ndarray
    size: int
    rows: np.ndarray
    flat: np.ndarray
    targets: dict[str, np.ndarray]

    @classmethod
    def of(cls, texts: list[np.ndarray], toxic: np.ndarray, inside: np.ndarray) -> tuple["_Learner", np.ndarray]:
        features, marker = select_features([t for t, use in zip(texts, inside, strict=True) if use], toxic[inside])
        picked = list(map(Chain(features, []).columns, texts))
        rows = np.repeat(np.arange(len(texts)), [len(p) for p in picked])
        flat = np.concatenate([*picked, np.empty(0, np.int32)]).astype(np.int64)
        markers = np.array([marker[t].sum() for t in texts]) if len(texts) else np.zeros(0)
        targets = {"severe": toxic * (markers >= SEVERE), "strong": toxic * (markers >= STRONG), "toxic": toxic}
        return cls(inside, len(features), rows, flat, targets), features

    def fit(self, name: str, earlier: np.ndarray) -> np.ndarray:
        return _fit(*_part(self.rows, self.flat, earlier, self.inside), self.targets[name][self.inside], self.size)


def fit_chain(texts: list[np.ndarray], toxic: np.ndarray) -> Chain:
    """Fit the chain on labelled documents given as word ids."""
    toxic = np.asarray(toxic, float)
    earlier = out_of_fold(texts, toxic)
    whole, features = _Learner.of(texts, toxic, np.ones(len(texts), bool))
    chain = Chain(features, [whole.fit(name, earlier[:, :k]) for k, name in enumerate(CATEGORIES)])
    if len(texts):
        chain.threshold = best_threshold(earlier[:, -1], toxic)
    return chain


def out_of_fold(texts: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Probabilities per row and category from models that have not seen the row."""
    fold = np.arange(len(texts)) % FOLDS
    learners = [_Learner.of(texts, toxic, fold != f)[0] for f in range(FOLDS)]
    found = np.empty((len(texts), 0))
    for name in CATEGORIES:
        held_out = np.empty(len(texts))
        for learner in learners:
            outside = ~learner.inside
            held_out[outside] = _probabilities(*_part(learner.rows, learner.flat, found, outside), learner.fit(name, found))
        found = np.column_stack([found, held_out])
    return found


def best_threshold(held_out: np.ndarray, toxic: np.ndarray) -> float:
    """The threshold with the best F1 on out-of-fold probabilities, within its bounds."""
    steps = np.geomspace(LEAST_THRESHOLD, MOST_THRESHOLD, 33)[::-1]
    found = [(held_out >= t) for t in steps]
    f1 = [2 * (toxic * hit).sum() / max(toxic.sum() + hit.sum(), 1) for hit in found]
    return float(steps[int(np.argmax(f1))])


def _part(rows, flat, earlier, mask):
    renumbered = np.cumsum(mask) - 1
    use = mask[rows]
    return renumbered[rows[use]], flat[use], earlier[mask]


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most `sample` labelled documents, chosen by a hash of their ids, as word ids.

    They are chosen among the labels of documents that there are.
    """
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("_toxic"))
        .where("doc_id IS NOT NULL AND _toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("_toxic").alias("_toxic"))
        .join(docs.select(F.col("doc_id").cast("long")).distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # Bounded by `sample`, so it may be broadcast.
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(known), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array([word_ids(t).tobytes() for t in batch["text"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["_toxic"], ids], ["doc_id", "toxic", "words"])

    return rows.mapInArrow(run, "doc_id long, toxic int, words binary").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    rows = training_rows(docs, labels, sample).collect()
    return fit_chain([np.frombuffer(r["words"], np.int32) for r in rows], np.array([r["toxic"] for r in rows], float))


def score(docs: DataFrame, chain: Chain, threshold: float | None = None) -> DataFrame:
    """Probability per category and the verdict `toxic`, for every document."""
    threshold = chain.threshold if threshold is None else threshold
    model = docs.sparkSession.sparkContext.broadcast((chain.features, chain.weights))
    names = [f"p_{c}" for c in CATEGORIES]
    output = "doc_id long, " + ", ".join(f"{n} double" for n in names) + ", toxic boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Chain(*model.value)
        for batch in batches:
            p = fitted.predict([word_ids(t) for t in batch["text"].to_pylist()])
            found = [*map(pa.array, p.T.copy()), pa.array(p[:, -1] >= threshold)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *found], ["doc_id", *names, "toxic"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, output)
