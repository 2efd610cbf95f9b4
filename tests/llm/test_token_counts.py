import public_tokenizers
import pytest
from cases import clashing, frame, rows
from tokenizers import Tokenizer

from ordermill.llm import token_counts
from ordermill.llm.token_counts import count_tokens, packed, unpacked

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = [
    "a  b   c \n\n d\t\te  f　g \x1c h \x85i", "it's we'll I'd can't 'S 'd's", "x²³¼Ⅷ١٢ ３",
    "<|endoftext|><|endoftext|> a<|endoftext|>b <|ENDOFTEXT|>", "naïve 文字 é ‍ 👩‍🚀 ﻿",
    "   ", "\n", " lead and trail  ", "ÀÉ Ǆ ﬁ ａ", "a\rb\x0bc\x0cd\x00e\x1ff",
]


def made():
    return rows() + [(900 + i, t) for i, t in enumerate(HARD)]


@pytest.mark.parametrize("sample,cached", [(2000, 400_000), (3, 5), (0, 400_000)])
def test_counts_are_the_library_s(spark, monkeypatch, sample, cached):
    monkeypatch.setattr(token_counts, "SAMPLE_DOCS", sample)
    monkeypatch.setattr(token_counts, "CACHED", cached)
    library = Tokenizer.from_file(PATH)
    found = count_tokens(frame(spark, made()), PATH, drop_text=True).collect()
    expected = []
    for i, t in made():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.append((i, len((t or "").encode()), n, n > 1024))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_table_round_trip():
    counts = [(" the", 1), ("文字", 3), ("x" * 60, 20)]
    assert unpacked(packed(counts)) == dict(counts)


def test_extra_columns_and_empty_table(spark):
    found = count_tokens(clashing(spark), PATH)
    assert found.columns.count("n_tokens") == 1 and "text" in found.columns
    assert found.count() == len(rows())
    assert count_tokens(frame(spark, []), PATH).collect() == []


def test_no_shuffle_of_pre_tokens(spark):
    plan = count_tokens(frame(spark), PATH)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
