"""Quality scores by supervised subword embeddings.

A document is the average of learned vectors of its words, of their character n-grams
and of a sign for each word that repeats the one before, all hashed to one table; a softmax layer gives its class. As the layer is
linear, a trained model folds to one weight per bucket, and a document's score to the
logistic of its mean weight. Words repeat, so their weights are remembered.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnloom.llm.common import Memo, id_texts, kept

BUCKETS = 1 << 17
DIM = 16
EPOCHS = 4
RATE = 0.5
THRESHOLD = 0.3
SAMPLE_DOCS = 4000
MEMO_WORDS = 200_000
LENGTHS = (3, 4)


#: Stands for a word that repeats the one before it.
SAME = b"\x00same"
_MARKS = [bytes([m]) for m in b",.!?;:#%$&*|()"]


def words(text: bytes) -> list[bytes]:
    """Words between white space, with common marks apart."""
    for mark in _MARKS:
        if mark in text:
            text = text.replace(mark, b" " + mark + b" ")
    return text.split()


def repeats(own: list[bytes]) -> int:
    return sum(map(bytes.__eq__, own, own[1:]))


def features(word: bytes, buckets: int = BUCKETS) -> list[int]:
    """Buckets of a word and of its character n-grams, taken over UTF-8 bytes with word ends."""
    ended = b"<" + word + b">"
    crc = zlib.crc32
    return [crc(ended) % buckets] + [
        crc(ended[i:i + n], n) % buckets for n in LENGTHS for i in range(len(ended) - n + 1)]


def bag(text: bytes, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and how often each occurs."""
    in_order = words(text)
    counts = Counter(in_order)
    counts[SAME] = repeats(in_order)
    ids, times = [], []
    for word, n in counts.items():
        own = features(word, buckets)
        ids.extend(own)
        times.extend([n] * len(own))
    total, at = np.unique(np.array(ids, np.int64), return_inverse=True)
    return total, np.bincount(at, weights=np.array(times, np.float64), minlength=len(total))


def train(texts: list[bytes], labels: list[int], buckets: int = BUCKETS, dim: int = DIM,
          epochs: int = EPOCHS, rate: float = RATE, seed: int = 42) -> np.ndarray:
    """Stochastic gradient descent over the texts; the folded weights, and last the bias.

    With no texts, or of one class only, the weights are zero and the bias is the
    smoothed share of label 1.
    """
    one = sum(labels)
    fold = np.zeros(buckets + 1, np.float32)
    fold[-1] = np.log((one + 1) / (len(labels) - one + 1))
    if not 0 < one < len(labels):
        return fold
    bags = [bag(t, buckets) for t in texts]
    dice = np.random.default_rng(seed)
    vectors = ((dice.random((buckets, dim)) - 0.5) / dim).astype(np.float32)
    layer, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in dice.permutation(len(bags)):
            ids, times = bags[i]
            now = rate * (1 - done / steps)
            done += 1
            share = (times / max(times.sum(), 1)).astype(np.float32)
            mean = share @ vectors[ids]
            out = layer @ mean + bias
            out = np.exp(out - out.max())
            error = out / out.sum()
            error[labels[i]] -= 1
            step = layer.T @ error
            layer -= now * np.outer(error, mean)
            bias -= now * error
            vectors[ids] -= now * np.outer(share, step)
    fold[:-1] = vectors @ (layer[1] - layer[0])
    fold[-1] = bias[1] - bias[0]
    return fold


class WordWeights:
    """Word to its summed weight and, as the imaginary part, its number of features."""

    def __init__(self, fold: np.ndarray) -> None:
        self.fold, self.buckets = fold, len(fold) - 1
        self.of = Memo(self.weight, MEMO_WORDS)

    def weight(self, word: bytes) -> complex:
        own = features(word, self.buckets)
        return complex(float(self.fold[own].sum(dtype=np.float64)), len(own))

    def score(self, text: bytes) -> float:
        own = words(text)
        self.of = self.of.renewed()
        total = sum(map(self.of.__getitem__, own), 0j) + repeats(own) * self.of[SAME]
        mean = total.real / total.imag if total.imag else 0.0
        return float(1 / (1 + np.exp(-(mean + float(self.fold[-1])))))


def _word_weights(fold: bytes) -> WordWeights:
    return kept(("weights", zlib.crc32(fold), len(fold)), lambda: WordWeights(np.frombuffer(fold, np.float32)))


def held_out() -> F.Column:
    """Rows never learned from: crc32 of the decimal doc_id leaves no rest by 5."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> bytes:
    """Train on the ``sample`` labelled documents, not held out, that come first by hash of doc_id.

    The sample is joined as a table of at most ``sample`` rows, and one task trains on
    it; the driver gets the folded weights alone, of fixed size. Labels other than 0 and
    1 are no labels; of several labels of a doc_id the larger counts.
    """
    own = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
           .where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out())
           .groupBy("doc_id").agg(F.max("quality").alias("quality"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    learned = id_texts(docs).join(F.broadcast(own), "doc_id").select("doc_id", "text", "quality")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((d, t.encode(), q) for part in parts for d, t, q in zip(*(c.to_pylist() for c in part.columns)))
        fold = train([t for _, t, _ in rows], [q for _, _, q in rows])
        yield pa.RecordBatch.from_arrays([pa.array([fold.tobytes()], pa.binary())], names=["fold"])

    trained = learned.repartition(1).mapInArrow(run, "fold binary").head()
    return bytes(trained[0]) if trained else train([], []).tobytes()


def scores(fold: bytes, text: F.Column) -> F.Column:
    """The score of a text column; a null or empty text has that of the bias."""

    def run(texts: pa.Array) -> pa.Array:
        weights = _word_weights(fold)
        return pa.array([weights.score(t.as_py() or b"") for t in texts.cast(pa.binary())], pa.float64())

    return F.arrow_udf(run, "double")(text)


def score(docs: DataFrame, fold: bytes, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; whole texts, text alone.

    An empty or null text has the score of the bias. Rows that repeat a doc_id are
    scored each; a row without doc_id takes no part; an empty table gives no rows.
    """
    scored = id_texts(docs).select("doc_id", scores(fold, F.col("text")).alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, threshold: float = THRESHOLD) -> DataFrame:
    """Train and score."""
    return score(docs, fit(docs, labels, sample), threshold)
