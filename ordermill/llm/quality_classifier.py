"""Quality classifier: supervised subword embeddings, trained in numpy.

Every word and every character n-gram is hashed to a row of a table of learned vectors; a
document's vector is the mean over all its words and n-grams, whole text, and a softmax layer
gives the probabilities of the two labels. Table and layer are learned together by stochastic
gradient descent. After training, table and layer are one number per row (the difference of the
two logits is linear in the mean), which is what workers get and add up.

Training uses a bounded sample: the first rows of each label in an order of hashed ids, at most
TRAIN_ROWS per label, texts of every length: whole up to TRAIN_BYTES bytes, and as many bytes
from all over a longer one, whose mean vector they estimate. The labels weigh
as often as they occur among all that can be learned, so scores do not shift where the sample
holds another share of them. Scores use whole texts and nothing but texts. Without both labels the score is the known label's share, one half without any. Null
and empty texts have no features and get the layer's bias.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, StructField

from ordermill.llm.common import (
    SpanHasher,
    chosen_texts,
    drawn,
    flat,
    label_share,
    map_texts,
    summed,
    word_spans,
)

TRAIN_ROWS = 2_500
TRAIN_BYTES = 20_000
DIMENSIONS = 16
WORD_ROWS = 1 << 15
GRAM_ROWS = 1 << 15
GRAMS = (2, 3, 4)
EPOCHS = 5
RATE = 0.5
SEED = 1
THRESHOLD = 0.3

FIELDS = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]

MULTIPLIERS = {2: 0x9E3779B1, 3: 0x85EBCA77, 4: 0xC2B2AE3D}


class Model(NamedTuple):
    """What is left of table and layer: a logit per word row, then per n-gram row; the bias."""

    logits: np.ndarray
    bias: float


class Features:
    """Rows of the table for the words and n-grams of flat texts.

    Case and symbols matter for quality, so the bytes are taken as they are. n-grams lie
    within a text; words are hashed whole.
    """

    def __init__(self) -> None:
        self.hasher = SpanHasher()

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, counts = word_spans(data, offsets)
        hashes = self.hasher.spans(self.hasher.prefix(data), starts, ends)
        return (hashes % np.uint64(WORD_ROWS)).astype(np.int32), counts

    def grams(self, data: np.ndarray, size: int) -> np.ndarray:
        """Rows of the n-grams that start at each byte, those over a text's end included."""
        value = np.zeros(max(0, len(data) - size + 1), np.uint32)
        for k in range(size):
            value <<= np.uint32(8)
            value |= data[k : k + len(value)]
        value *= np.uint32(MULTIPLIERS[size])
        value >>= np.uint32(17)
        return value.view(np.int32) + WORD_ROWS

    def per_text(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """All rows of each text, for training."""
        words, counts = self.words(data, offsets)
        ends = np.cumsum(counts)
        made = []
        grams = {size: self.grams(data, size) for size in GRAMS}
        for i in range(len(counts)):
            rows = [words[ends[i] - counts[i] : ends[i]]]
            for size in GRAMS:
                stop = max(offsets[i], offsets[i + 1] - size + 1)
                rows.append(grams[size][offsets[i] : stop])
            made.append(np.concatenate(rows))
        return made


def train(texts: list[bytes], labels: list[int], share: float | None = None, seed: int = SEED) -> Model:
    """Table and layer by gradient descent on the log loss, one document at a time.

    share is that of label 1 among all labelled rows; without it, that among these.
    """
    table_rows = WORD_ROWS + GRAM_ROWS
    own = float(np.mean(labels)) if labels else 0.5
    if not 0.0 < own < 1.0:
        constant = 0.0 if not labels else (10.0 if own else -10.0)
        return Model(np.zeros(table_rows, np.float32), constant)
    share = own if share is None else min(max(share, 1e-3), 1 - 1e-3)
    weigh = ((1 - share) / (1 - own), share / own)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (table_rows, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = np.zeros((2, DIMENSIONS), np.float32)
    bias = np.zeros(2, np.float32)
    features = Features()
    documents = []
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        rows = features.per_text(data, np.array([0, len(data)]))[0]
        found, counts = np.unique(rows, return_counts=True)
        documents.append((found, counts.astype(np.int32), len(rows)))
    steps, done = EPOCHS * len(documents), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(documents)):
            rows, counts, n = documents[i]
            rate = RATE * (1 - done / steps)
            done += 1
            weights = (counts / max(n, 1)).astype(np.float32)
            hidden = weights @ table[rows]
            odds = layer @ hidden + bias
            p = np.exp(odds - odds.max())
            p /= p.sum()
            p[labels[i]] -= 1
            p *= weigh[labels[i]]
            back = p @ layer
            layer -= rate * np.outer(p, hidden)
            bias -= rate * 0.1 * p
            table[rows] -= rate * DIMENSIONS * weights[:, None] * back
    return Model((table @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def logits(model: Model, features: Features, texts: pa.Array) -> np.ndarray:
    """The difference of the two logits for whole texts."""
    data, offsets = flat(texts)
    words, counts = features.words(data, offsets)
    total = summed(model.logits[words], counts)
    n = counts.astype(np.float64)
    lengths = np.diff(offsets)
    for size in GRAMS:
        rows = features.grams(data, size)
        own = np.maximum(lengths - size + 1, 0)
        sums = np.concatenate([[0.0], np.cumsum(model.logits[rows], dtype=np.float64)])
        first = np.minimum(offsets[:-1], len(rows))
        total += sums[np.minimum(first + own, len(rows))] - sums[first]
        n += own
    return total / np.maximum(n, 1) + model.bias


def fit(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model:
    """A model from a sample of the labelled rows; labels of other values are ignored."""
    rows = drawn(chosen_texts(df, labels, id_col, text, label, TRAIN_ROWS), TRAIN_BYTES)
    share = label_share(df, labels, id_col, label)
    return train([t for t, _ in rows], [y for _, y in rows], share)


def score_quality(
    df: DataFrame,
    model: Model,
    text: str = "text",
    threshold: float = THRESHOLD,
    drop_text: bool = False,
) -> DataFrame:
    """df with score (0 to 1, higher: label 1 likelier) and predicted (score >= threshold)."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def start() -> Callable[[pa.Array], list]:
        features = Features()

        def score(texts: pa.Array) -> list:
            with np.errstate(over="ignore"):
                p = 1 / (1 + np.exp(-logits(sent.value, features, texts)))
            return [p, (p >= threshold).astype(np.int32)]

        return score

    return map_texts(df, text, FIELDS, start, drop_text=drop_text)
