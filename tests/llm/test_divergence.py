import random
import re
from collections import Counter, defaultdict

import pytest

from ordermill.llm import divergence
from ordermill.llm.divergence import audit_sources, split_terms
from ordermill.llm.queries import op11_source_divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def expected(rows, min_docs, top):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(FOLD))
        groups[lang, source].update(terms)
        docs[lang].update(set(terms))
    found = []
    for lang in {g[0] for g in groups}:
        own = {s: c for (l, s), c in groups.items() if l == lang}
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        whole = sum(own.values(), Counter())

        def p(counts, term):
            total = sum(counts[t] for t in kept)
            return 1 + 10**9 * (counts[term] + 5) // (total + 5 * len(kept))

        shares = {s: {t: p(c, t) for t in kept} for s, c in own.items()}
        q = {t: p(whole, t) for t in kept}
        for s, counts in own.items():
            pairs = [(-sum(abs(shares[s][t] - shares[o][t]) for t in kept), o) for o in own if o != s]
            pairs.sort(key=lambda x: (x[0], x[1].encode()))
            found += [(lang, s, "pair", o, -v, r) for r, (v, o) in enumerate(pairs, 1)]
            terms = [(q[t] - shares[s][t], t) for t in kept if counts[t] and shares[s][t] > q[t]]
            terms.sort(key=lambda x: (x[0], x[1].encode()))
            found += [(lang, s, "term", t, -v, r) for r, (v, t) in enumerate(terms[:top], 1)]
    return sorted(found)


def sample(n=300, seed=3, sources=9):
    rng = random.Random(seed)
    words = [f"w{c}" for c in "abcdefghijklmnop"] + ["THE", "the", "Été", "été", "ß", "文字", "😀", "don't", "x1y"]
    rows = []
    for _ in range(n):
        s = rng.randrange(sources)
        weights = [1 + (i * (s + 3)) % 7 for i in range(len(words))]
        text = " ".join(rng.choices(words, weights, k=rng.randint(0, 12)))
        lang = "en" if rng.random() < 0.7 else rng.choice(["de", None, ""])
        rows.append((text, lang, None if s == 0 else f"src{s}"))
    rows += [rows[0]] * 40 + [(None, "en", "empty"), ("", "fr", "one"), ("12 34", "xx", "a"), (None, "xx", "b")]
    rows += [("Rare " * 2000, "de", "src1"), ("y" * 3000, "de", "src2"), (None, None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(row) for row in df.collect())


@pytest.mark.parametrize("block, slice_terms, held", [(64, 8192, 300_000), (2, 5, 10), (3, 1, 1)])
def test_matches_brute_force(spark, monkeypatch, block, slice_terms, held):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "SLICE_TERMS", slice_terms)
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    rows = sample()
    got = result(audit_sources(frame(spark, rows), min_docs=3, top=4))
    assert got == expected(rows, 3, 4)
    assert {row[2] for row in got} == {"pair", "term"}


def test_ties_at_the_last_rank_go_by_utf8(spark):
    rows = [("zz é 文 😀 b a", "en", "s"), ("q", "en", "t")] * 3
    assert result(audit_sources(frame(spark, rows), min_docs=1, top=3)) == expected(rows, 1, 3)


def test_registered_query(spark, tmp_path):
    rows = sample(400)
    made = frame(spark, rows).selectExpr("monotonically_increasing_id() AS doc_id", "*")
    made.write.parquet(f"{tmp_path}/documents.parquet")
    assert result(op11_source_divergence(spark, str(tmp_path))) == expected(rows, 30, 50)


def test_no_kept_terms_empty_table_and_clashing_columns(spark):
    rows = [("a b", "en", "s"), ("c", "en", "t")]
    assert result(audit_sources(frame(spark, rows), min_docs=9)) == expected(rows, 9, 50)
    assert result(audit_sources(frame(spark, []))) == []
    extra = frame(spark, sample(60)).selectExpr("*", "'x' AS term", "1 AS n", "2 AS RANK", "'y' AS part")
    assert result(audit_sources(extra, min_docs=2)) == expected(sample(60), 2, 50)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_long_texts_are_split_between_terms(monkeypatch, size):
    monkeypatch.setattr(divergence, "PIECE_BYTES", size)
    for text in ["", " ", "One  Twö 3four-文字", "abc", "ab" * 20, "  x" * 9 + "y" * 9, "é" * 11 + " z"]:
        found = [t.decode() for part in split_terms(text.encode()) for t in part]
        assert found == TERM.findall(text.translate(FOLD))
