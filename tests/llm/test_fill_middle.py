import hashlib

import numpy as np
import pytest
from cases import clashing, frame, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.llm import fill_middle
from ordermill.llm.fill_middle import fill_in_middle, restore
from ordermill.llm.queries import op13_fill_middle

MARKED = [(900, "a<P>b"), (901, "<S>"), (902, "x <M"), (903, "<" * 50), (904, "<S<P<M>" * 3), (905, "<P" * 30)]
MANY = [(i, f"né {i} 文字 😀 " * (i % 7)) for i in range(1000, 1300)]


def expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}")


def test_matches_brute_force_and_restores(spark):
    made = rows() + MARKED + MANY
    found = restore(fill_in_middle(frame(spark, made))).collect()
    columns = ["doc_id", *fill_middle.RESULTS]
    got = sorted((tuple(row[c] for c in columns) for row in found), key=repr)
    assert got == sorted((expected(*row) for row in made), key=repr)
    assert {row[2] for row in got} == {"plain", "psm", "spm"}
    assert all(row["restored"] == (row["text"] or "") for row in found)


def test_registered_query_gives_digests(spark, tmp_path):
    made = rows() + MARKED
    frame(spark, made).write.parquet(f"{tmp_path}/documents.parquet")
    found = op13_fill_middle(spark, str(tmp_path))
    assert found.columns == [
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    ]

    def sha(text):
        return hashlib.sha256((text or "").encode()).hexdigest()

    want = [(*expected(*row)[:5], sha(expected(*row)[5]), sha(row[1])) for row in made]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60), st.integers(0, 60), st.integers(0, 60), st.sampled_from(["psm", "spm"]))
def test_rotations_are_exact(text, a, b, form):
    if any(s in text for s in (b"<P>", b"<S>", b"<M>")):
        return
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    want = b"<P>" + prefix + b"<S>" + suffix if form == "psm" else b"<S>" + suffix + b"<P>" + prefix
    made = fill_middle.arranged(text, a, b, form)
    assert made == want + b"<M>" + middle
    assert fill_middle.restored(made, form) == text


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 11])
def test_rotation_moves_every_byte(n):
    for first in range(n + 1):
        block = np.arange(n, dtype=np.uint8)
        fill_middle.rotate(block, first)
        assert block.tolist() == [*range(first, n), *range(first)]


def test_clashing_columns_and_empty_table(spark):
    df = clashing(spark).selectExpr(
        "*", "'a' AS kept0", "'b' AS input0", "'c' AS FORM", "'d' AS restored", "'e' AS n"
    )
    found = restore(fill_in_middle(df))
    assert found.count() == df.count()
    assert found.filter("kept0 <> 'a' OR input0 <> 'b' OR FORM = 'c' OR restored = 'd'").isEmpty()
    assert restore(fill_in_middle(frame(spark, []))).collect() == []
