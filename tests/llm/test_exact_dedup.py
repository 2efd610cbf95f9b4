import hashlib
from collections import defaultdict

import pytest
from cases import clashing, frame, rows

from ordermill.llm import exact_dedup
from ordermill.llm.exact_dedup import drop_duplicates, exact_groups

FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def expected(made):
    groups = defaultdict(list)
    for i, t in made:
        groups[(t or "").translate(FOLD)].append(i)
    found = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(norm.encode()).hexdigest()
        left = 1
        for i in sorted(ids, key=lambda i: i != keep):
            found.append((i, keep, len(ids), i == keep and left > 0, sha))
            left -= 1
    return sorted(found, key=repr)


def result(df):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)


def test_groups_match_brute_force(spark):
    assert result(exact_groups(frame(spark))) == expected(rows())


@pytest.mark.parametrize("hot_rows", [1, 3])
def test_hot_groups_are_dealt_out_and_whole(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", hot_rows)
    made = rows() + [(1000 + i, "HOT text" if i % 2 else "hot TEXT") for i in range(50)]
    made += [(1000 + i, "Hot Text") for i in (48, 49)] + [(None, "hot text")]
    assert result(exact_groups(frame(spark, made))) == expected(made)


def test_empty_table(spark):
    assert exact_groups(frame(spark, [])).collect() == []
    assert drop_duplicates(frame(spark, [])).collect() == []


def test_drop_duplicates_keeps_columns_and_one_row_each(spark):
    left = drop_duplicates(clashing(spark))
    assert left.columns == clashing(spark).columns
    kept = [row[0] for row in expected(rows()) if row[3]]
    assert sorted(map(repr, (r.doc_id for r in left.collect()))) == sorted(map(repr, kept))


def test_no_python_in_the_plan(spark):
    plan = exact_groups(frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
