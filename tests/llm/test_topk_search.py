import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import topk_search
from ordermill.llm.queries import op12_topk_search
from ordermill.llm.topk_search import BallTree, top_k

NONE = 2**63 - 1


def expected(rows, every=50, k=5):
    valid = []
    for i, (own, vector) in enumerate(rows):
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        made = [math.floor(x * 256) for x in map(float, vector)]
        if sum(x * x for x in made) < 2**62:
            valid.append((i, own, made))
    found = []
    for i, query, vector in valid:
        if query is None or query % every:
            continue
        scores = [
            (-sum(x * y for x, y in zip(vector, other)), NONE if own is None else own)
            for j, own, other in valid
            if j != i
        ]
        for rank, (score, own) in enumerate(sorted(scores)[:k], 1):
            found.append((query, rank, None if own == NONE else own, -score))
    return sorted(found, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def result(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def sample(n=700, seed=5, size=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    rows = [(i, (centres[i % 6] + 0.2 * rng.normal(size=size)).tolist()) for i in range(n)]
    hot = [0.5] * size
    rows += [(n + i, hot) for i in range(n // 2)]
    rows += [(100, hot), (100, hot), rows[50], (None, hot), (None, hot), (None, rows[0][1])]
    rows += [(150, None), (200, [math.nan] * size), (250, [None] * size), (300, [math.inf] + hot[1:])]
    rows += [(350, []), (400, hot[:3]), (450, hot * 2), (500, [1e300] * size), (550, [-0.0] * size)]
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("shard, leaf, block", [(4096, 64, 8192), (40, 3, 4), (7, 1, 1)])
def test_matches_brute_force(spark, monkeypatch, shard, leaf, block):
    monkeypatch.setattr(topk_search, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk_search, "LEAF_ROWS", leaf)
    monkeypatch.setattr(topk_search, "QUERY_ROWS", block)
    rows = sample(700 if shard > 7 else 150)
    got = result(top_k(frame(spark, rows), F.col("id") % 50 == 0))
    assert got == expected(rows)


def test_registered_query_and_clashing_columns(spark, tmp_path):
    rows = sample(200)
    extra = frame(spark, rows).selectExpr("*", "1 AS id", "2 AS row", "'x' AS region", "3 AS score")
    extra.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert result(op12_topk_search(spark, str(tmp_path))) == expected(rows)


def test_few_rows_and_empty_table(spark):
    assert result(top_k(frame(spark, []), F.col("id") % 50 == 0)) == []
    for rows in ([(0, [1.0])], [(0, [1.0]), (1, [-2.0])], [(0, []), (50, [])], [(None, [1.0]), (0, None)]):
        assert result(top_k(frame(spark, rows), F.col("id") % 50 == 0)) == expected(rows)


def test_large_components_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([1, -1]) * (2.0**20 + rng.random()) for _ in range(6)]) for i in range(60)]
    assert result(top_k(frame(spark, rows), F.col("id") % 10 == 0)) == expected(rows, 10)


def test_tree_skips_what_cannot_win(monkeypatch):
    monkeypatch.setattr(topk_search, "LEAF_ROWS", 16)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(32, 16)) * 100
    vectors = (centres[np.arange(4096) % 32] + rng.normal(size=(4096, 16))).astype(np.int64)
    tree = BallTree(np.arange(4096), np.arange(4096), vectors)
    seen = []

    class Counting(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    tree.values = tree.values.view(Counting)
    best = tree.search(0, vectors[0], 5, -math.inf, NONE)
    scores = vectors @ vectors[0]
    order = np.lexsort((np.arange(4096), -scores))
    assert [x for _, x in best] == [i for i in order.tolist() if i != 0][:5]
    assert sum(seen) < 1024  # a quarter of the shard
