import math
import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from cases import clashing, frame, rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import lm_scoring as lm
from ordermill.llm.common import SpanHasher, flat, held, shared_folder

FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def binary(texts):
    return pa.array([(t or "").encode() for t in texts], pa.large_binary())


def train():
    return [(i, t) for i, t in rows() if i is not None and i % 5 != 1]


@pytest.fixture(scope="module")
def model(spark):
    return lm.fit(frame(spark, train()))


def base(text, counts):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD)) + [None]
    n, v = sum(counts.values()), len(counts)
    score = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
    return len(words), sum(w in counts for w in words), n, score


@pytest.mark.parametrize("frequent", [1 << 17, 3])
def test_base_matches_brute_force(spark, model, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    counts = Counter()
    for _, t in train():
        counts.update(re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD)) + [None])
    found = lm.score_texts(frame(spark), model, drop_text=True).collect()
    expected = sorted(((i, *base(t, counts)) for i, t in rows()), key=lambda r: repr(r[:3]))
    found = sorted(
        ((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found),
        key=lambda r: repr(r[:3]),
    )
    for a, b in zip(found, expected, strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)


def test_every_context_s_code_is_complete(model):
    for context in {k // lm.CELL for k in model.code.keys.tolist()}:
        own = model.code.keys // lm.CELL == context
        assert sum(0.5 ** int(s) for s in model.code.size[own]) == pytest.approx(1.0)
    last = model.code.keys // lm.CELL == lm.CONTEXTS
    assert last.sum() == lm.SYMBOLS


def slow_decisions(code, text):
    """Decisions of one text with their context keys, from the definitions."""
    entries = {int(k): i for i, k in enumerate(code.keys)}
    made = []
    for at in range(len(text) + 1):
        before = (b"\0" * 4 + text[:at])[-4:]
        context = (before[2] % lm.CLASSES) * 256 + before[3]
        symbol = text[at] if at < len(text) else lm.END
        word = re.search(rb"[^\x20\x09-\x0D]*$", text[:at])[0][-lm.WORD_BYTES :]
        keys = [context * lm.CELL + symbol]
        if keys[0] not in entries:
            keys = [context * lm.CELL + lm.ESCAPE, lm.CONTEXTS * lm.CELL + symbol]
        for key in keys:
            if key in entries:
                i = entries[key]
                for p in range(code.first[i], code.first[i] + code.size[i]):
                    made.append((int(code.nodes[p]), int(code.bits[p]), before, word))
    return made


def test_tables_count_every_training_decision(model):
    counts = Counter()
    for _, t in train():
        if len(t or "") < 5000:
            counts.update((node, bit) for node, bit, *_ in slow_decisions(model.code, (t or "").encode()))
    coder, found = lm.Coder(model.code), Counter()
    for _, t in train():
        if len(t or "") < 5000:
            d = coder.decisions(lm.read_symbols(*flat(binary([t])), SpanHasher()))
            found.update(zip(d.node.tolist(), d.bit.tolist(), strict=True))
    assert found == counts


def test_tables_are_the_sums_over_partitions(spark, model):
    coder = lm.Coder(model.code)
    d = coder.decisions(lm.read_symbols(*flat(binary([t for _, t in train()])), SpanHasher()))
    counts = np.bincount(d.node * 2 + d.bit, minlength=2 * model.code.n_nodes)
    assert np.allclose(model.tables.nodes, lm.log_odds(counts[::2], counts[1::2]))
    again = lm.fit(frame(spark, train()).repartition(70))
    assert np.array_equal(model.tables.slots, again.tables.slots)
    slots = np.bincount(d.slots[1], minlength=lm.SLOTS)
    assert np.array_equal(model.tables.levels, np.digitize(slots, lm.LEVELS))
    for k in range(lm.HASHED):
        counts = np.bincount(d.slots[k] * 2 + d.bit, minlength=2 * lm.SLOTS)
        assert np.allclose(model.tables.slots[k], lm.log_odds(counts[::2], counts[1::2]))


def test_same_context_same_slot_and_mixing_one_by_one(model):
    scorer = lm.Scorer(model.code, model.tables)
    slots = {}
    for _, t in rows()[:40]:
        text = (t or "").encode()
        slow = slow_decisions(model.code, text)
        d = scorer.coder.decisions(lm.read_symbols(*flat(binary([t])), SpanHasher()))
        for (node, _, four, word), a, b in zip(slow, *d.slots, strict=True):
            assert slots.setdefault((node, "four", four), a) == a
            assert slots.setdefault((node, "word", word), b) == b
        weights = np.tile(lm.START, (lm.DEPTHS, 1)).astype(float)
        total, place, cut = 0.0, 0, np.cumsum(d.per_symbol)
        for block in range(0, len(cut), lm.BLOCK):
            end = cut[min(block + lm.BLOCK, len(cut)) - 1]
            change = np.zeros_like(weights)
            for i in range(place, end):
                x = np.array([model.tables.nodes[d.node[i]], *(model.tables.slots[k][d.slots[k][i]] for k in range(2))])
                gate = int(x[1] != 0) + 2 * int(model.tables.levels[d.slots[1][i]])
                gate += len(lm.START) * min(int(d.depth[i]), lm.DEPTHS - 1)
                p = 1 / (1 + math.exp(-np.clip(weights[gate] @ x, -16, 16)))
                total += math.log10(p if d.bit[i] else 1 - p)
                change[gate] += lm.RATE * (d.bit[i] - p) * x
            weights += change
            place = end
        assert scorer.score(binary([t]))[0] == pytest.approx(total, rel=1e-4, abs=1e-4)


def test_scores_do_not_depend_on_batches(model):
    scorer = lm.Scorer(model.code, model.tables)
    texts = [t for _, t in rows()]
    together = scorer.score(binary(texts))
    alone = np.array([scorer.score(binary([t]))[0] for t in texts])
    assert np.allclose(together, alone, rtol=1e-5) and (together < 0).all()


def test_it_learns(spark):
    rng = np.random.default_rng(0)
    words = ["the", "quick", "brown", "fox", "jumps", "over", "lazy", "dogs"]
    texts = [(i, " ".join(rng.choice(words, 80))) for i in range(200)]
    found = lm.score_texts(frame(spark, texts[150:]), lm.fit(frame(spark, texts[:150]))).collect()
    assert max(r.bits_per_byte for r in found) < 1.2
    assert all(r.score > r.base_score - 5 for r in found)


def test_empty_training_table_and_clashes(spark):
    model = lm.fit(frame(spark, []))
    found = lm.score_texts(clashing(spark), model)
    assert [c.lower() for c in found.columns].count("score") == 1 and "lang" in found.columns
    assert {(r.n_known, r.train_tokens, r.base_score) for r in found.collect()} == {(0, 0, 0.0)}
    assert lm.score_texts(frame(spark, []), model).collect() == []


def test_counts_beyond_32_bits_are_kept():
    counts = np.array([0, 1, 2**32 - 1, 2**32, 2**40], np.int64)
    for some in (counts[:3], counts, counts[:0]):
        assert lm._unpacked(lm._packed(some)).tolist() == some.tolist()


def test_columns_named_like_inner_ones_stay(spark):
    names = ["known", "base", "bytes", "rare", "row", "_row", "_bytes", "rare_base", "key", "n"]
    df = frame(spark).selectExpr("*", *(f"'{c}' AS {c}" for c in names))
    scored = lm.score_texts(df, lm.fit(df))
    assert scored.filter(" OR ".join(f"{c} <> '{c}'" for c in names)).isEmpty()
    assert scored.count() == df.count()


def test_slices_use_the_memory_of_those_before(model):
    import resource

    lm.keep_memory()
    texts = binary(["some words of a text, one after the other " * 50] * 100)
    scorer = lm.Scorer(model.code, model.tables)
    scorer.score(texts)
    scorer.score(texts)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
    scorer.score(texts)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before < 3000


def test_held_rows_are_made_once_and_not_taken_for_changed_files(spark, tmp_path):
    path, made = str(tmp_path / "numbers.parquet"), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    def read():
        return held(spark.read.parquet(path).mapInArrow(count, "n long"))

    pq.write_table(pa.table({"n": [1, 2]}), path)
    first = read()
    sums = first.groupBy("n").agg(F.sum("n").alias("s"))
    assert sorted(map(tuple, first.join(sums, "n", "left").collect())) == [(1, 1), (2, 2)]
    assert made.value == 2
    pq.write_table(pa.table({"n": [5]}), path)
    assert [r.n for r in read().collect()] == [5]


def test_tasks_of_the_passes_write_no_files(spark):
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    found = lm.score_texts(frame(spark), lm.fit(frame(spark, train())), drop_text=True)
    assert found.count() == len(rows())
    assert set(os.listdir(folder)) == before


@pytest.mark.parametrize("frequent", [0, 1, 5, 300, 5000])
def test_only_the_most_frequent_words_reach_the_driver(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    keys = np.random.default_rng(1).integers(2, 2**63 - 1, 4000).tolist()
    every = [(k, 1 + (i % 40 == 0) + (i == 7) * 9) for i, k in enumerate(keys)]
    words = spark.createDataFrame(every, "key long, n long").repartition(16)
    best = lm._most_frequent(words)
    assert [(r.key, r.n) for r in best.collect()] == sorted(every, key=lambda r: (-r[1], r[0]))[:frequent]
    # Those that are sorted are few more.
    monkeypatch.setattr(DataFrame, "limit", lambda self, n: self)
    assert lm._most_frequent(words).count() <= frequent + 8 * math.isqrt(frequent) + 200
    monkeypatch.undo()
    assert lm._most_frequent(words.limit(0)).collect() == []
