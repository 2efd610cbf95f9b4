import numpy as np
import pyarrow as pa
from cases import clashing, frame, rows

from ordermill.llm import quality_classifier as q


def corpus(n, seed=3):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    made = []
    for i in range(n):
        words = list(rng.choice(vocabulary, 30))
        if i % 3 == 0:
            words = [w + rng.choice(["***", "%%%"]) for w in words]
        made.append((i, " ".join(words), int(i % 3 != 0)))
    return made


def test_held_out_accuracy(spark):
    made = corpus(300)
    docs = frame(spark, [(i, t) for i, t, _ in made])
    labels = spark.createDataFrame([(i, y) for i, _, y in made], "doc_id long, quality int")
    model = q.fit(docs, labels.where("doc_id < 200"))
    found = q.score_quality(docs.where("doc_id >= 200"), model).collect()
    truth = {i: y for i, _, y in made}
    assert np.mean([r.predicted == truth[r.doc_id] for r in found]) > 0.97
    again = q.fit(docs.repartition(7), labels.where("doc_id < 200"))
    assert np.array_equal(model.logits, again.logits)


def test_batches_equal_brute_force():
    model = q.Model(np.random.default_rng(0).normal(size=q.WORD_ROWS + q.GRAM_ROWS), 0.25)
    texts = [(t or "").encode() for _, t in rows()]
    found = q.logits(model, q.Features(), pa.array(texts, pa.large_binary()))
    for text, value in zip(texts, found, strict=True):
        features = q.Features()
        hashes = []
        for word in text.split():
            data = np.frombuffer(word, np.uint8)
            hashes += list(features.words(data, np.array([0, len(data)]))[0])
        for size in q.GRAMS:
            for i in range(len(text) - size + 1):
                key = int.from_bytes(text[i : i + size], "big") * q.MULTIPLIERS[size]
                hashes.append((key % 2**32 >> 17) + q.WORD_ROWS)
        mean = np.mean(model.logits[hashes]) if hashes else 0.0
        assert np.isclose(value, mean + 0.25)


def test_one_label_or_none(spark):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None), (3, 7)], "doc_id long, quality int")
    only = q.fit(frame(spark), labels)
    assert {r.predicted for r in q.score_quality(frame(spark), only).collect()} == {1}
    none = q.fit(frame(spark, []), labels)
    scored = q.score_quality(clashing(spark), none, drop_text=True)
    assert {r.score for r in scored.collect()} == {0.5}
    assert [c.lower() for c in scored.columns].count("score") == 1
    assert q.score_quality(frame(spark, []), none).collect() == []


def test_scores_agree_below_and_above_the_cap(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(300)]
    made = []
    for i in range(900):
        # Symbols in both labels, more of them in the bad one, so that many scores are in between.
        bad = i % 7 == 0
        noisy = rng.random(30) < (0.30 if bad else 0.15)
        words = [w + "***" if n else w for w, n in zip(rng.choice(vocabulary, 30), noisy, strict=True)]
        made.append((i, " ".join(words), int(not bad)))
    docs = frame(spark, [(i, t) for i, t, _ in made])
    # Labels of documents that are not there say nothing about the share.
    gone = [(5000 + i, 0) for i in range(900)]
    labels = spark.createDataFrame([(i, y) for i, _, y in made] + gone, "doc_id long, quality int")
    every = q.fit(docs, labels.where("doc_id < 5000"))
    monkeypatch.setattr(q, "TRAIN_ROWS", 128)
    capped = q.fit(docs, labels.where("doc_id < 5000"))
    scores = [
        np.array([r.score for r in q.score_quality(docs, m).orderBy("doc_id").collect()])
        for m in (every, capped)
    ]
    assert abs(scores[0].mean() - 6 / 7) < 0.05
    assert abs(scores[0].mean() - scores[1].mean()) < 0.06
    assert q.label_share(docs, labels, "doc_id", "quality") == np.mean([y for *_, y in made])
