import random
import re

import numpy as np
import pytest
import xxhash
from cases import clashing, frame, rows

from ordermill.llm import simhash as s
from ordermill.llm.components import connected

FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    if words and not parts:
        parts = [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes) > 0)


def brute(made, radius=2):
    prints = [slow_fingerprint(t) for _, t in made]
    parent = list(range(len(made)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(made)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(made):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(
        ((doc, f"{prints[i]:016x}", least.get(find(i))) for i, (doc, _) in enumerate(made)), key=repr
    )


def near(n=150, seed=11):
    """Long texts in families that differ by few words, so fingerprints differ by few bits."""
    rng = random.Random(seed)
    made = rows()
    for family in range(6):
        base = [f"f{family}w{rng.randint(0, 500)}" for _ in range(400)]
        for k in range(n // 6):
            words = list(base)
            for _ in range(k % 4):
                words[rng.randrange(len(words))] = f"edit{rng.randint(0, 99)}"
            made.append((1000 + family * 100 + k, " ".join(words)))
    rng.shuffle(made)
    return made


def result(df):
    columns = ["doc_id", "fingerprint", "component_id"]
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [4096, 3])
def test_groups_match_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(s.links, "__defaults__", (2, size))
    made = near()
    assert result(s.near_groups(frame(spark, made))) == brute(made)


def clustered(n, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n // 10, dtype=np.uint64)
    values = base[rng.integers(0, len(base), n)]
    for _ in range(4):
        values ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    return np.unique(values)


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_tree_finds_all_within_the_radius(radius):
    values = clustered(600)
    queries = np.concatenate([values[:100], clustered(100, 4)])
    q, v = s.BKTree(values).search(queries, radius)
    found = set(zip(q.tolist(), v.tolist(), strict=True))
    apart = np.bitwise_count(queries[:, None] ^ values[None, :])
    assert found == set(zip(*(x.tolist() for x in np.nonzero(apart <= radius)), strict=True))


def test_edges_are_keyed_by_distance():
    tree = s.BKTree(clustered(300))
    for child in range(1, len(tree.values)):
        parent = tree.values[tree.parent[child]]
        assert (int(tree.values[child]) ^ int(parent)).bit_count() == tree.edge[child]
    assert len(set(zip(tree.parent[1:], tree.edge[1:], strict=True))) == len(tree.values) - 1


def test_blocks_lose_no_pair():
    for radius in (1, 2, 3):
        masks = [m % (1 << 64) for m in s._masks(radius)]
        rng = random.Random(radius)
        for _ in range(500):
            flipped = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(flipped & m == 0 for m in masks)


def test_one_row_of_each_component_stays(spark):
    made = near()
    groups = {(doc, part) for doc, _, part in brute(made)}
    left = s.drop_near_duplicates(frame(spark, made)).collect()
    assert len(left) == len({r.doc_id for r in left})
    assert {r.doc_id for r in left} == {part for _, part in groups}
    assert s.drop_near_duplicates(clashing(spark)).columns == clashing(spark).columns


def test_empty_table(spark):
    assert s.near_groups(frame(spark, [])).collect() == []
    assert s.drop_near_duplicates(frame(spark, [])).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(200, 300)] + [(7, i) for i in range(8, 60)]
    edges += [(400, 401), (401, 402), (402, 400), (500, 500), (8, 7)]
    found = connected(spark.createDataFrame(edges, "a long, b long"))
    expected = {i: 200 for i in range(200, 301)} | {i: 7 for i in range(7, 60)}
    expected |= {400: 400, 401: 400, 402: 400}
    rows_found = [tuple(r) for r in found.select("node", "component").collect()]
    assert sorted(rows_found) == sorted(expected.items())
