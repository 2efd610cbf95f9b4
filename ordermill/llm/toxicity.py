"""Toxicity: a bidirectional gated recurrent network with attention, over windows of words.

A word's input is a learned vector of its hash, beside the mean of learned vectors of its
character 4-grams (with its borders). A window of words goes through gated recurrent units in
both directions; attention weights pool their states, and a logistic layer scores the window.
Windows overlap by half and all windows of a text are scored, so the whole text is. A second
logistic layer gives the text's score from the mean and the maximum of its windows' scores.

Everything is trained in numpy with gradients written out, on a bounded sample: the first rows
of each label in an order of hashed ids, at most TRAIN_ROWS per label, texts of every length:
whole up to TRAIN_BYTES bytes, as many bytes from all over a longer one; of their windows at
most TRAIN_WINDOWS per label. The second layer is fitted on the mean and maximum over all windows
of whole texts, however long, and weighs the labels as often as they occur among all labelled
rows that have a document.

Words are runs of letters, digits and bytes beyond ASCII, A-Z in lower case. Null and empty
texts, and texts without a word, are one window without words. Without both labels the score
is the known label's share, one half without any.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField

from ordermill.llm.common import (
    FOLD,
    SpanHasher,
    chosen_texts,
    drawn,
    flat,
    label_share,
    map_texts,
    summed,
)

TRAIN_ROWS = 2_000
TRAIN_BYTES = 20_000
TRAIN_WINDOWS = 14_000
WINDOW, STEP = 32, 16
WORD_ROWS = 1 << 15
# Words of fewer sampled texts have no vector of their own, lest texts be learned by heart.
WORD_TEXTS = 4
GRAM_BITS = 14
GRAM_ROWS = 1 << GRAM_BITS
WIDTH = 8  # of a word's vector, a 4-gram's vector and the state of one direction
EPOCHS = 2
LEAST_STEPS = 100
BATCH = 512
TEXTS = 100  # of the sample, read at a time
RATE = 0.05
DECAY = 10.0  # of the tables' vectors, times the rate, per step
# Part of the sample's texts that the second layer is fitted on, unseen by the network.
UNSEEN = 3
SEED = 1
THRESHOLD = 0.3

FIELDS = [
    StructField("score", DoubleType()),
    StructField("predicted", IntegerType()),
    StructField("n_windows", LongType()),
]

INNER = np.zeros(256, bool)
INNER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Words(NamedTuple):
    """The words of flat texts: table rows of each, 4-gram rows end to end, counts per text."""

    rows: np.ndarray
    grams: np.ndarray
    gram_counts: np.ndarray
    counts: np.ndarray


def read_words(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> Words:
    data = FOLD[data]
    inner = INNER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inner.copy(), inner.copy()
    first[1:] &= ~inner[:-1] | edge[1:-1]
    last[:-1] &= ~inner[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = hasher.spans(hasher.prefix(data), starts, ends) & np.uint64(WORD_ROWS - 1)
    own = data.astype(np.uint32)
    before, after, second = np.zeros_like(own), np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first], after[last] = 0, 0
    second[:-1] = after[1:]
    second[last] = 0
    value = before << np.uint32(24) | own << np.uint32(16) | after << np.uint32(8) | second
    grams = ((value * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)).astype(np.int32)[inner]
    return Words(
        rows.astype(np.int32), grams, ends - starts, np.diff(np.searchsorted(starts, offsets))
    )


def read_windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and number of words of every window, and the windows per text.

    Windows start every STEP words until one reaches the text's end; each text has one at least.
    """
    per_text = 1 + np.maximum(0, -(-(counts - WINDOW) // STEP))
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), per_text)
    place = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    starts = (ends - counts)[text] + place * STEP
    return starts, np.minimum(WINDOW, ends[text] - starts), per_text


def sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


Params = dict[str, np.ndarray]


def new_params(seed: int = SEED) -> Params:
    rng = np.random.default_rng(seed)

    def random(*shape: int) -> np.ndarray:
        return (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

    made = {
        # Words never seen in training stay at zero and say nothing.
        "words": np.zeros((WORD_ROWS, WIDTH), np.float32),
        "grams": random(GRAM_ROWS, WIDTH) * 0,
        "attention": random(2 * WIDTH),
        "out": random(2 * WIDTH),
        "out_bias": np.zeros(1, np.float32),
    }
    for way in ("f", "b"):
        # Columns of the update gate, the reset gate and the candidate.
        made[f"in_{way}"] = random(2 * WIDTH, 3 * WIDTH)
        made[f"bias_{way}"] = np.zeros(3 * WIDTH, np.float32)
        made[f"state_{way}"] = random(WIDTH, 3 * WIDTH)
    return made


def gram_means(grams: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean 4-gram vector of each word; every word has a character and so a 4-gram."""
    if not len(counts):
        return np.zeros((0, WIDTH), np.float32)
    sums = np.add.reduceat(grams[rows], np.cumsum(counts) - counts, axis=0)
    return sums / counts[:, None].astype(np.float32)


def run_states(params: Params, way: str, inputs: list[np.ndarray], inside: list[np.ndarray]) -> list[tuple]:
    """Gated recurrent units over steps; a step outside its window keeps the state.

    Returns for each step the state before, the gates, the candidate's state part and the
    candidate, and the state after.
    """
    state = np.zeros((len(inside[0]), WIDTH), np.float32)
    recurrent = params[f"state_{way}"]
    steps = []
    for x, there in zip(inputs, inside, strict=True):
        back = state @ recurrent
        gates = sigmoid(x[:, : 2 * WIDTH] + back[:, : 2 * WIDTH])
        update, reset = gates[:, :WIDTH], gates[:, WIDTH:]
        candidate = np.tanh(x[:, 2 * WIDTH :] + reset * back[:, 2 * WIDTH :])
        after = candidate + update * (state - candidate)
        after = np.where(there[:, None], after, state)
        steps.append((state, gates, back[:, 2 * WIDTH :], candidate, after))
        state = after
    return steps


def window_logits(params: Params, projected: dict[str, np.ndarray], starts: np.ndarray, sizes: np.ndarray):
    """Logits of windows, and what the gradients need: states, attention, pooled."""
    n = len(projected["f"])
    steps, inside = {}, [sizes > t for t in range(WINDOW)]
    places = [np.minimum(starts + t, max(n - 1, 0)) for t in range(WINDOW)]
    if not n:
        projected = {way: np.zeros((1, 3 * WIDTH), np.float32) for way in "fb"}
    steps["f"] = run_states(params, "f", [projected["f"][p] for p in places], inside)
    steps["b"] = run_states(
        params, "b", [projected["b"][p] for p in places[::-1]], inside[::-1]
    )[::-1]
    states = np.stack(
        [np.concatenate([f[4], b[4]], axis=1) for f, b in zip(steps["f"], steps["b"], strict=True)], axis=1
    )
    there = np.stack(inside, axis=1)
    heat = np.where(there, states @ params["attention"], np.float32(-1e9))
    heat = np.exp(heat - heat.max(axis=1, keepdims=True)) * there
    total = heat.sum(axis=1, keepdims=True)
    weights = heat / np.where(total > 0, total, 1)
    pooled = (weights[:, :, None] * states).sum(axis=1)
    logits = pooled @ params["out"] + params["out_bias"][0]
    return logits, (steps, inside, places, states, weights, pooled)


def project(params: Params, words: Words) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Inputs of the words, and their products with the input weights of both directions."""
    means = gram_means(params["grams"], words.grams, words.gram_counts)
    inputs = np.concatenate([params["words"][words.rows], means], axis=1)
    return inputs, {way: inputs @ params[f"in_{way}"] + params[f"bias_{way}"] for way in "fb"}


def gradients(params: Params, words: Words, starts: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
    """The mean log loss of windows with labels, and its gradient by parameter."""
    inputs, projected = project(params, words)
    logits, (steps, inside, places, states, weights, pooled) = window_logits(params, projected, starts, sizes)
    p = sigmoid(logits)
    n = np.float32(len(labels))
    loss = -np.mean(np.log(np.where(labels > 0, p, 1 - p) + 1e-9))
    d_logit = ((p - labels) / n).astype(np.float32)
    grads = {name: np.zeros_like(value) for name, value in params.items()}
    grads["out"] = d_logit @ pooled
    grads["out_bias"][0] = d_logit.sum()
    d_pooled = d_logit[:, None] * params["out"]
    d_weights = (states * d_pooled[:, None, :]).sum(axis=2)
    d_heat = weights * (d_weights - (weights * d_weights).sum(axis=1, keepdims=True))
    grads["attention"] = np.einsum("bt,btk->k", d_heat, states)
    d_states = weights[:, :, None] * d_pooled[:, None, :] + d_heat[:, :, None] * params["attention"]
    d_inputs = np.zeros_like(inputs)
    for way in "fb":
        d_projected = np.zeros_like(projected[way])
        own = slice(0, WIDTH) if way == "f" else slice(WIDTH, 2 * WIDTH)
        recurrent = params[f"state_{way}"]
        carry = np.zeros((len(labels), WIDTH), np.float32)
        for t in range(WINDOW - 1, -1, -1) if way == "f" else range(WINDOW):
            before, gates, back, candidate, _ = steps[way][t]
            update, reset = gates[:, :WIDTH], gates[:, WIDTH:]
            d_after = carry + d_states[:, t, own]
            there = inside[t][:, None]
            d = np.where(there, d_after, 0)
            d_candidate = d * (1 - update) * (1 - candidate * candidate)
            d_update = d * (before - candidate) * update * (1 - update)
            d_reset = d_candidate * back * reset * (1 - reset)
            d_back = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
            grads[f"state_{way}"] += before.T @ d_back
            carry = np.where(there, d * update, d_after) + d_back @ recurrent.T
            d_x = np.concatenate([d_update, d_reset, d_candidate], axis=1)
            real = np.flatnonzero(inside[t])
            # A step meets each word of the sample's windows once at most per window start.
            np.add.at(d_projected, places[t][real], d_x[real])
        grads[f"in_{way}"] = inputs.T @ d_projected
        grads[f"bias_{way}"] = d_projected.sum(axis=0)
        d_inputs += d_projected @ params[f"in_{way}"].T
    np.add.at(grads["words"], words.rows, d_inputs[:, :WIDTH])
    shares = d_inputs[:, WIDTH:] / words.gram_counts[:, None].astype(np.float32)
    np.add.at(grads["grams"], words.grams, np.repeat(shares, words.gram_counts, axis=0))
    return loss, grads


class Model(NamedTuple):
    params: Params
    calibration: np.ndarray  # bias, then weights of the windows' mean and maximum
    constant: float | None = None


def read_part(texts: list[bytes]) -> Words:
    data = np.frombuffer(b"".join(texts), np.uint8)
    return read_words(data, np.cumsum([0, *map(len, texts)]), SpanHasher())


def take_windows(
    words: Words, starts: np.ndarray, sizes: np.ndarray, first: np.ndarray | None = None
) -> tuple[Words, np.ndarray]:
    """The words of some windows end to end, and the windows' new first words.

    first: each word's first 4-gram, where it is known already.
    """
    at = np.cumsum(sizes) - sizes
    index = np.repeat(starts - at, sizes) + np.arange(int(sizes.sum()))
    if first is None:
        first = np.cumsum(words.gram_counts) - words.gram_counts
    counts = words.gram_counts[index]
    begin = np.cumsum(counts) - counts
    grams = words.grams[np.repeat(first[index] - begin, counts) + np.arange(int(counts.sum()))]
    return Words(words.rows[index], grams, counts, np.zeros(0, np.int64)), at


def train(
    texts: list[bytes],
    labels: list[int],
    share: float | None = None,
    seed: int = SEED,
    measure: Callable[[Model], np.ndarray] | None = None,
) -> Model:
    """Network and second layer; share is that of label 1 among all labelled rows.

    measure gives the mean and maximum of the windows of all texts, in their order, where texts
    are only parts of what was labelled.
    """
    if len(set(labels)) < 2:
        return Model({}, np.zeros(3), float(np.mean(labels)) if labels else 0.5)
    share = float(np.mean(labels)) if share is None else share
    rng = np.random.default_rng(seed)
    y = np.array(labels)
    unseen = np.arange(len(texts)) % UNSEEN == 0
    parts = [(i, min(i + TEXTS, len(texts))) for i in range(0, len(texts), TEXTS)]
    # A few texts at a time, as reading takes many times their size; only windows are kept.
    per_text = np.concatenate([read_windows(read_part(texts[i:j]).counts)[2] for i, j in parts])
    truth = np.repeat(y, per_text)
    own = ~np.repeat(unseen, per_text)
    chosen = np.concatenate(
        [rng.permutation(np.flatnonzero((truth == k) & own))[:TRAIN_WINDOWS] for k in (0, 1)]
    )
    take = np.zeros(len(truth), bool)
    take[chosen] = True
    first_window = np.concatenate([[0], np.cumsum(per_text)])
    read, owner = [], []
    for i, j in parts:
        part = read_part(texts[i:j])
        starts, sizes, _ = read_windows(part.counts)
        some = np.flatnonzero(take[first_window[i] : first_window[j]] & (sizes > 0))
        read.append((take_windows(part, starts[some], sizes[some])[0], sizes[some]))
        owner.append(np.searchsorted(first_window, first_window[i] + some, side="right") - 1)
    words = Words(
        *(np.concatenate([getattr(w, f) for w, _ in read]) for f in ("rows", "grams", "gram_counts")),
        np.zeros(0, np.int64),
    )
    sizes, owner = np.concatenate([n for _, n in read]), np.concatenate(owner)
    starts, truth = np.cumsum(sizes) - sizes, y[owner]
    first_gram = np.cumsum(words.gram_counts) - words.gram_counts
    chosen = np.arange(len(sizes))
    params = new_params(seed)
    seen = np.unique(np.repeat(owner, sizes) * WORD_ROWS + words.rows)
    common = np.bincount(seen % WORD_ROWS, minlength=WORD_ROWS)[:, None] >= WORD_TEXTS
    means = {k: np.zeros_like(v) for k, v in params.items()}
    squares = {k: np.zeros_like(v) for k, v in params.items()}
    batches = max(1, -(-len(chosen) // BATCH))
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    total, step = epochs * batches, 0
    for _ in range(epochs):
        order = rng.permutation(chosen)
        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            own, at = take_windows(words, starts[some], sizes[some], first_gram)
            _, grads = gradients(params, own, at, sizes[some], truth[some])
            grads["words"] *= common
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for k, g in grads.items():
                means[k] += 0.1 * (g - means[k])
                squares[k] += 0.01 * (g * g - squares[k])
                size = np.sqrt(squares[k] / (1 - 0.99**step)) + 1e-7
                if k in ("words", "grams"):
                    params[k] *= 1 - rate * DECAY
                params[k] -= rate * means[k] / (1 - 0.9**step) / size
    model = Model(params, np.zeros(3))
    if measure is None:
        found = [text_features(model, read_part(texts[i:j]))[:2] for i, j in parts]
        features = np.concatenate([np.stack(pair, axis=1) for pair in found])
    else:
        features = measure(model)
    if len(set(y[unseen].tolist())) == 2:
        features, y = features[unseen], y[unseen]
    weights = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Model(params, logistic(features, y, weights))


def logistic(features: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small penalty, by Newton steps."""
    x = np.concatenate([np.ones((len(features), 1)), features], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = sigmoid(x @ w)
        slope = x.T @ (weights * (labels - p)) - 0.1 * w
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(bend, slope)
    return w


def text_features(model: Model, words: Words, batch: int = 16_384) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and maximum of the windows' scores, and the number of windows, of each text."""
    starts, sizes, per_text = read_windows(words.counts)
    _, projected = project(model.params, words)
    scores = np.concatenate(
        [np.zeros(0, np.float32)]
        + [
            sigmoid(window_logits(model.params, projected, starts[i : i + batch], sizes[i : i + batch])[0])
            for i in range(0, len(starts), batch)
        ]
    )
    mean = summed(scores, per_text) / per_text
    first = np.cumsum(per_text) - per_text
    most = np.maximum.reduceat(scores, first) if len(scores) else scores
    return mean, most, per_text


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from a sample of the labelled rows; labels of other values are ignored."""
    share = label_share(df, labels, id_col, label)
    share = min(max(share, 1e-3), 1 - 1e-3) if share is not None else None
    chosen = chosen_texts(df, labels, id_col, text, label, TRAIN_ROWS)
    rows = drawn(chosen, TRAIN_BYTES)
    return train(
        [t for t, _ in rows], [y for _, y in rows], share, measure=lambda model: whole_features(chosen, model)
    )


def whole_features(chosen: DataFrame, model: Model) -> np.ndarray:
    """Mean and maximum over all windows of the chosen whole texts, in the order of drawn."""
    sent = chosen.sparkSession.sparkContext.broadcast(model)
    fields = [StructField("_mean", DoubleType()), StructField("_most", DoubleType())]

    def start() -> Callable[[pa.Array], list]:
        hasher = SpanHasher()
        return lambda texts: list(
            text_features(sent.value, read_words(*flat(texts), hasher))[:2]
        )

    found = map_texts(chosen, "_text", fields, start, limit=500_000, drop_text=True)
    ordered = found.orderBy(F.xxhash64("_id"), "_id").select("_mean", "_most").collect()
    return np.array([tuple(row) for row in ordered], np.float64).reshape(-1, 2)


def score_batch(model: Model, hasher: SpanHasher, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Scores and numbers of windows of whole texts."""
    data, offsets = flat(texts)
    words = read_words(data, offsets, hasher)
    if model.constant is not None:
        return np.full(len(texts), model.constant), read_windows(words.counts)[2]
    mean, most, n = text_features(model, words)
    bias, by_mean, by_most = model.calibration
    return sigmoid(bias + by_mean * mean + by_most * most), n


def score_toxicity(
    df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, drop_text: bool = False
) -> DataFrame:
    """df with score (0 to 1, higher: label 1 likelier), predicted (score >= threshold) and
    n_windows."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def start() -> Callable[[pa.Array], list]:
        hasher = SpanHasher()

        def score(texts: pa.Array) -> list:
            p, n = score_batch(sent.value, hasher, texts)
            return [p, (p >= threshold).astype(np.int32), n]

        return score

    return map_texts(df, text, FIELDS, start, limit=500_000, drop_text=drop_text)


def drop_toxic(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of df that are not predicted toxic, all columns as they are.

    A model that knows no or only one label tells nothing apart and rejects no row.
    """
    if model.constant is not None:
        return df
    named = df.withColumnsRenamed({c: f"_in_{c}" for c in df.columns})
    scored = score_toxicity(named, model, f"_in_{text}", threshold).where("predicted = 0")
    return scored.select(*[F.col(f"`_in_{c}`").alias(c) for c in df.columns])
