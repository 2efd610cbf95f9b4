import math
import re

from cases import clashing, frame, rows

from ordermill.llm import quality_rules as rules
from ordermill.llm.quality_rules import apply_rules, binomial_tail, choose_cutoffs, text_counts


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {j for found in windows.values() if len(found) > 1 for i in found for j in range(i, i + 5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts_match_brute_force(spark):
    found = text_counts(frame(spark)).select("doc_id", *rules.COUNTS).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        ((i, *counts(t)) for i, t in rows()), key=repr
    )


def test_binomial_tail_is_exact():
    for n, k, p in ((20, 0, 0.1), (50, 2, 0.2), (300, 3, 0.03)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert math.isclose(binomial_tail(n, k, p), exact, rel_tol=1e-9)
    assert binomial_tail(10, 10, 0.1) == 1.0


def test_cutoffs_are_the_smallest_safe_ones():
    n = 5000
    exceed = [n - 100 * i if i < 49 else 0 for i in range(len(rules.CUTOFFS))]
    exceed[30:] = [0] * len(exceed[30:])
    chosen = choose_cutoffs({(0, "symbols"): [n, *exceed], (1, "symbols"): [20, *[0] * 40]})
    assert chosen == {(0, "symbols"): rules.CUTOFFS[30]}


def documents(n):
    good = [(i, f"word{i} " + " ".join(f"w{i}x{k}" for k in range(20))) for i in range(n)]
    bad = [(n + i, " ".join(f"w{i}y{k}***" for k in range(20))) for i in range(n // 5)]
    return good, bad


def test_junk_goes_and_good_texts_stay(spark):
    good, bad = documents(3000)
    labels = [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int")
    found = apply_rules(frame(spark, good + bad), labelled).collect()
    assert {r.doc_id for r in found if r.kept} == {i for i, _ in good}


def test_without_labels_only_base_rules_reject(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    found = apply_rules(clashing(spark), labels)
    assert "text" not in found.columns and found.columns.count("kept") == 1
    base = {(repr(i), n < 10 or 100 * r > 20 * n) for i, (n, _, _, _, r) in
            ((i, counts(t)) for i, t in rows())}
    assert {(repr(r.doc_id), not r.kept) for r in found.collect()} == base
    assert apply_rules(frame(spark, []), labels).collect() == []


def test_null_and_repeated_labels(spark):
    good, bad = documents(30)
    labels = [(None, 1), (1, None), (2, 1), (2, 0), (10**9, 1)]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int")
    assert all(r.kept for r in apply_rules(frame(spark, good), labelled).collect())
