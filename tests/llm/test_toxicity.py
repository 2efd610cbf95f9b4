import numpy as np
import pyarrow as pa
import pytest
from cases import clashing, frame, rows

from ordermill.llm import toxicity as t
from ordermill.llm.common import SpanHasher


def corpus(n, seed=3):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(200)]
    made = []
    for i in range(n):
        words = list(rng.choice(vocabulary, rng.integers(5, 120)))
        if i % 4 == 0:
            for at in rng.integers(0, len(words), 1 + len(words) // 20):
                words[at] = rng.choice(["Badword", "nastier", "vileone,"])
        made.append((i, " ".join(words), int(i % 4 == 0)))
    return made


def read(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return t.read_words(data, np.array([0, len(data)]), SpanHasher())


def random_params(seed=0):
    rng = np.random.default_rng(seed)
    return {k: rng.normal(size=v.shape, scale=0.5) for k, v in t.new_params().items()}


def slow_window(params, words, start, size):
    """One window, one word at a time."""
    grams, place = [], 0
    for count in words.gram_counts:
        grams.append(params["grams"][words.grams[place : place + count]].mean(axis=0))
        place += count
    x = [np.concatenate([params["words"][words.rows[i]], grams[i]]) for i in range(start, start + size)]
    both = {}
    k = t.WIDTH
    for way in "fb":
        h, states = np.zeros(k), []
        for v in x if way == "f" else x[::-1]:
            a = v @ params[f"in_{way}"] + params[f"bias_{way}"]
            b = h @ params[f"state_{way}"]
            z, r = t.sigmoid(a[:k] + b[:k]), t.sigmoid(a[k : 2 * k] + b[k : 2 * k])
            new = np.tanh(a[2 * k :] + r * b[2 * k :])
            h = (1 - z) * new + z * h
            states.append(h)
        both[way] = states if way == "f" else states[::-1]
    states = np.array([np.concatenate(pair) for pair in zip(both["f"], both["b"], strict=True)])
    heat = np.exp(states @ params["attention"])
    return (heat / heat.sum()) @ states @ params["out"] + params["out_bias"][0]


def test_batches_equal_one_word_at_a_time():
    params = random_params()
    words = read(" ".join(f"word{i % 17} Éé{i}" for i in range(60)))
    starts, sizes, per_text = t.read_windows(words.counts)
    assert per_text.tolist() == [len(starts)] and starts[-1] + sizes[-1] == 120
    assert (np.diff(starts) == t.STEP).all() and (starts[1:] < (starts + sizes)[:-1]).all()
    _, projected = t.project(params, words)
    found, _ = t.window_logits(params, projected, starts, sizes)
    slow = [slow_window(params, words, a, n) for a, n in zip(starts, sizes, strict=True)]
    assert np.allclose(found, slow, atol=1e-4)


def test_gradients_agree_with_differences():
    params = random_params(1)
    words = read("one two three four five six seven eight nine ten one two")
    starts, sizes, labels = np.array([0, 4, 9]), np.array([8, 8, 3]), np.array([1, 0, 1])
    _, grads = t.gradients(params, words, starts, sizes, labels)
    rng = np.random.default_rng(2)
    for name, value in params.items():
        places = np.argsort(-np.abs(grads[name]).ravel())[:3].tolist() + [int(rng.integers(value.size))]
        for at in places:
            losses = []
            for d in (1e-4, -1e-4):
                changed = {k: v.copy() for k, v in params.items()}
                changed[name].ravel()[at] += d
                losses.append(t.gradients(changed, words, starts, sizes, labels)[0])
            slope = (losses[0] - losses[1]) / 2e-4
            assert slope == pytest.approx(grads[name].ravel()[at], abs=2e-4, rel=2e-2)


def test_held_out_accuracy_and_filter(spark):
    made = corpus(500)
    docs = frame(spark, [(i, x) for i, x, _ in made])
    labels = spark.createDataFrame([(i, y) for i, _, y in made], "doc_id long, toxic int")
    model = t.fit(docs, labels.where("doc_id < 350"))
    held = docs.where("doc_id >= 350")
    found = t.score_toxicity(held, model).collect()
    truth = {i: y for i, _, y in made}
    assert np.mean([r.predicted == truth[r.doc_id] for r in found]) > 0.95
    left = t.drop_toxic(held, model)
    assert left.columns == held.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in found if not r.predicted}


def test_scores_do_not_depend_on_batches():
    made = corpus(60)
    model = t.train([x.encode() for _, x, _ in made], [y for *_, y in made])
    texts = [(x or "").encode() for _, x in rows()]
    together = t.score_batch(model, SpanHasher(), pa.array(texts, pa.large_binary()))[0]
    alone = [t.score_batch(model, SpanHasher(), pa.array([x], pa.large_binary()))[0][0] for x in texts]
    assert np.allclose(together, alone, atol=1e-5)
    assert ((together >= 0) & (together <= 1)).all()


def test_one_label_none_nulls_and_clashes(spark):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None), (3, 7)], "doc_id long, toxic int")
    only = t.fit(frame(spark), labels)
    assert {r.predicted for r in t.score_toxicity(frame(spark), only).collect()} == {1}
    none = t.fit(frame(spark, []), labels)
    scored = t.score_toxicity(clashing(spark), none, drop_text=True)
    assert {r.score for r in scored.collect()} == {0.5}
    assert [c.lower() for c in scored.columns].count("score") == 1
    assert t.drop_toxic(clashing(spark), none).columns == clashing(spark).columns
    assert t.score_toxicity(frame(spark, []), none).collect() == []


def long_corpus(n, least):
    """Texts beyond least bytes, the toxic ones with toxic words all over."""
    made = []
    for i, x, y in corpus(n):
        made.append((i, " ".join([x] * (1 + least // len(x))), y))
    return made


def test_long_texts_are_learned_from(spark):
    made = long_corpus(160, t.TRAIN_BYTES)
    assert min(len(x) for _, x, _ in made) > t.TRAIN_BYTES
    docs = frame(spark, [(i, x) for i, x, _ in made])
    # Labels of absent documents, first in the order or not, take no place in the sample.
    gone = [(10_000 + i, i % 2) for i in range(2 * t.TRAIN_ROWS)]
    labels = spark.createDataFrame([(i, y) for i, _, y in made] + gone, "doc_id long, toxic int")
    model = t.fit(docs, labels.where("doc_id < 100 OR doc_id >= 10000"))
    assert model.constant is None
    found = t.score_toxicity(docs.where("doc_id >= 100"), model).collect()
    truth = {i: y for i, _, y in made}
    assert np.mean([r.predicted == truth[r.doc_id] for r in found]) > 0.9


def test_nothing_learned_drops_nothing(spark):
    docs = frame(spark)
    for schema in ([], [(1, None)], [(1, 1), (2, 1)], [(1, 0)], [(777, 0), (778, 1)]):
        labels = spark.createDataFrame(schema, "doc_id long, toxic int")
        assert t.drop_toxic(docs, t.fit(docs, labels)).count() == docs.count()


def test_pieces_come_from_the_whole_text(spark):
    long = " ".join(f"{i:05d}" for i in range(20_000))
    chosen = spark.createDataFrame([(1, 1, long), (2, 0, "short one")], "_id long, _label int, _text string")
    found = dict((y, x) for x, y in t.drawn(chosen, 8_000))
    words = [int(w) for w in found[1].split()]
    assert found[0] == b"short one" and len(found[1]) <= 8_000
    assert words[0] == 0 and words[-1] == 19_999 and words == sorted(words)
    assert max(np.diff(words)) < 20_000 / 6
