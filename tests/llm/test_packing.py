import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import clashing, frame, rows
from tokenizers import Tokenizer

from ordermill.llm.packing import Capacity, best_fit, pack_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(found, made, size):
    library = Tokenizer.from_file(PATH)
    expected = []
    for i, t in made:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), size)):
            part = ids[start : start + size]
            expected.append((i, piece, start, len(part), zlib.crc32(part.tobytes())))
    rest = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(rest, key=repr) == sorted(expected, key=repr)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), sum(x[3] for x in expected)


@pytest.mark.parametrize("shard", [16_384, 20])
def test_pieces_and_places(spark, shard):
    capacity = Capacity(tokens=512, documents=512, cost=512 * 512)
    found = pack_texts(frame(spark), PATH, capacity, shard_pieces=shard).collect()
    n, tokens = check(found, rows(), 512)
    assert n <= tokens / 512 * 1.02 + 1 + len(found) // shard


def test_production_size(spark):
    found = pack_texts(clashing(spark), PATH).collect()
    n, tokens = check(found, rows(), 4096)
    assert n <= -(-tokens // 4096) + 1


def used(lengths, sequence, what):
    total = np.zeros(sequence.max() + 1)
    np.add.at(total, sequence, what)
    return total


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_holds(rule):
    lengths = np.random.default_rng(1).integers(1, 60, 500)
    capacity = Capacity(100, 4, 3000, (1.0, 0.5, 0.5), rule)
    lengths = np.minimum(lengths, 54)
    sequence, offset = best_fit(lengths, capacity)
    assert used(lengths, sequence, lengths).max() <= 100
    assert used(lengths, sequence, 1).max() <= 4
    assert used(lengths, sequence, lengths**2).max() <= 3000
    with pytest.raises(ValueError):
        best_fit(np.array([60]), capacity)


def test_norm_chooses_as_brute_force_does():
    lengths = np.random.default_rng(2).integers(1, 40, 300)
    capacity = Capacity(100, 5, 6000, (1.0, 0.3, 0.2))
    sequence, _ = best_fit(lengths, capacity)
    bins: list[list[int]] = []
    most, weights = (100, 5, 6000), capacity.weights
    for i in sorted(range(300), key=lambda i: -lengths[i]):
        best = None
        for b, members in enumerate(bins):
            sums = [sum(x) for x in zip(*[(lengths[j], 1, lengths[j] ** 2) for j in [*members, i]])]
            if all(s <= m for s, m in zip(sums, most)):
                score = sum(w * ((m - s) / m) ** 2 for w, m, s in zip(weights, most, sums))
                if best is None or score < best[0] - 1e-12:
                    best = (score, b)
        if best is None:
            bins.append([i])
        else:
            bins[best[1]].append(i)
    assert sequence.max() + 1 <= len(bins) + 2


def test_empty_table(spark):
    assert pack_texts(frame(spark, []), PATH).collect() == []
