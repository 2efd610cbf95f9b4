import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import clashing, frame, rows
from tokenizers import Tokenizer

from ordermill.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "ΑΣ ΣΑΣ İstanbul ǄǅǆẞSS", "é Å ́x 가", "a b　c d \x1c\x1d x\x85y",
    "<|endoftext|>a<|startoftext|>B<|ENDOFTEXT|> <|endoftext|>", "don't WE'LL 'sx 's 're're",
    "x²³¼Ⅷ١٢ ３ 1234", "aaaaaaaaaaa bababababab " + "ab" * 500, "文字化け テスト 👩‍🚀 ﬁ", "<| |> <|x",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def made():
    return rows() + [(900 + i, t) for i, t in enumerate(HARD)]


def test_digests_are_the_library_s(spark, library):
    expected = []
    for i, t in made():
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((
            i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        ))
    found = bpe.digest_texts(frame(spark, made()), PATH, drop_text=True).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_ids_and_decoded_texts(spark, library):
    for row in bpe.encode_texts(frame(spark, made()), PATH).collect():
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert ids == library.encode(row.text or "", add_special_tokens=False).ids
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def random_words(n):
    rng = random.Random(5)
    syllables = ["th", "er", "on", "an", "ing", "ed", "tion", "qu", "zx", "a", "aa", "ab", "ß", "é", "0"]
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 9))).encode() for _ in range(n)]


def test_speculation_equals_exact_merging():
    vocabulary = bpe.vocabulary(PATH)
    words = random_words(3000)
    exact = vocabulary.merge([bpe.word_symbols(w) for w in words])
    assert [bpe.raw_ids(x) for x in exact] == vocabulary.encode_words(words)
    one = [vocabulary._merge_one(bpe.word_symbols(w)) for w in words[:500]]
    assert all(np.array_equal(a, b) for a, b in zip(one, exact, strict=False))


def test_pair_check_agrees_with_merging():
    vocabulary = bpe.vocabulary(PATH)
    words = random_words(1500)
    symbols = [bpe.word_symbols(w) for w in words]
    seen = {True: 0, False: 0}
    for word, exact in zip(symbols, vocabulary.merge(symbols), strict=True):
        flat = np.array(word, np.int64)
        _, greedy = vocabulary.propose(flat, np.array([0]), np.array([len(flat)]))
        good = vocabulary.compatible(greedy[:-1], greedy[1:]).all()
        assert good == np.array_equal(greedy, exact)
        seen[bool(good)] += 1
    assert min(seen.values()) > 100


@pytest.mark.parametrize("ids", [10, 8_000_000])
def test_small_cache_gives_the_same(monkeypatch, library, ids):
    monkeypatch.setattr(bpe, "CACHED", 200)
    monkeypatch.setattr(bpe, "CACHED_IDS", ids)
    monkeypatch.setattr(bpe, "_caches", {})
    encoder = bpe.Encoder(PATH)
    texts = [(t or "") for _, t in made()]
    for i in range(0, len(texts), 3):
        part = texts[i : i + 3]
        encoded = encoder.encode(pa.array([t.encode() for t in part], pa.large_binary()))
        found = [np.frombuffer(x, "<u4").tolist() for x in bpe.split_ids(*encoded)]
        assert found == [library.encode(t, add_special_tokens=False).ids for t in part]


def test_extra_columns_and_empty_table(spark):
    found = bpe.digest_texts(clashing(spark), PATH)
    assert found.columns.count("n_tokens") == 1 and found.count() == len(rows())
    assert bpe.digest_texts(frame(spark, []), PATH).collect() == []


def test_ids_are_the_library_s_for_all_code_points(spark):
    """Letters, digits, cases and compositions that Unicode versions differ in."""
    points = [cp for cp in range(0x80, 0x32400) if not 0xD800 <= cp < 0xE000]
    made = [f"a{chr(cp)}b {chr(cp)}" for cp in points]
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = [e.ids for e in library.encode_batch(made, add_special_tokens=False)]
    rows = [(i, text) for i, text in zip(points, made, strict=True)]
    found = {r.doc_id: r.ids for r in bpe.encode_texts(frame(spark, rows), path).collect()}
    different = [hex(cp) for cp, ids in zip(points, want, strict=True) if found[cp] != np.array(ids, '<u4').tobytes()]
    assert different == []
