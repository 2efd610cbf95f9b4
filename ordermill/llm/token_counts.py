"""Token counts by a two-tier lookup on the map side, without any shuffle of pre-tokens.

The first tier is a compact table of frequent pre-tokens and their numbers of tokens, made
from a bounded sample of documents and broadcast; the second is a cache in each worker, whose
misses the tokenizer encodes in batches. The sample only decides what is fast: every text's
count is the sum over its own pre-tokens and exact. Null texts count as empty: no tokens.

Special strings inside texts are single tokens, as is the library's default.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Callable
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField

from ordermill.llm.common import map_texts, ship

# The first tier: documents that it is made from, and most entries it may have.
SAMPLE_DOCS = 2_000
FREQUENT = 65_536
# The second tier is emptied when it has this many entries (some 60 MB).
CACHED = 400_000

# The pattern that splits texts before the merges, as published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

FIELDS = [
    StructField("n_bytes", LongType()),
    StructField("n_tokens", LongType()),
    StructField("over_limit", BooleanType()),
]

_splitters: dict[bool, Callable[[str], list[str]]] = {}
_caches: dict[str, dict[str, int]] = {}


def splitter(ascii_only: bool) -> Callable[[str], list[str]]:
    """Splits a text into pre-tokens; ASCII texts by the same pattern in its ASCII form."""
    if ascii_only not in _splitters:
        if ascii_only:
            narrow = PATTERN.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")
            narrow = narrow.replace(" ?A-Za-z+", " ?[A-Za-z]+").replace(" ?0-9+", " ?[0-9]+")
            _splitters[True] = re.compile(narrow, re.ASCII).findall
        else:
            _splitters[False] = regex.compile(PATTERN).findall
    return _splitters[ascii_only]


class Counts:
    """A tokenizer's numbers of tokens by pre-token, in this worker."""

    def __init__(self, path: str, table: bytes | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.frequent = unpacked(table) if table else {}
        # The cache outlives the task: the worker process serves many.
        self.cache = _caches.setdefault(path, {})

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and the number of its special tokens."""
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return [p for part in parts for p in splitter(part.isascii())(part)], len(parts) - 1
        return splitter(text.isascii())(text), 0

    def learn(self, pieces: set[str]) -> None:
        if len(self.cache) > CACHED:
            self.cache.clear()
        missing = sorted(pieces)
        for i in range(0, len(missing), 4096):
            batch = missing[i : i + 4096]
            made = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
            self.cache.update(zip(batch, map(len, made), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        found, missing = [], set()
        frequent = self.frequent.get
        for text in texts:
            pieces, specials = self.pieces(text)
            lengths = list(map(frequent, pieces))
            rare = [p for p, n in zip(pieces, lengths, strict=True) if n is None]
            total = specials + sum(n for n in lengths if n is not None) if rare else specials + sum(lengths)
            missing.update(p for p in rare if p not in self.cache)
            found.append((total, rare))
        if missing:
            known = {p: self.cache[p] for _, rare in found for p in rare if p in self.cache}
            self.learn(missing)
            known.update((p, self.cache[p]) for p in missing)
        else:
            known = self.cache
        return [total + sum(map(known.__getitem__, rare)) for total, rare in found]


def packed(counts: list[tuple[str, int]]) -> bytes:
    """The table in a few bytes per entry: lengths of the strings, numbers of tokens, strings."""
    names = [name.encode() for name, _ in counts]
    head = np.array([[len(n) for n in names], [n for _, n in counts]], np.uint32)
    return zlib.compress(np.uint32(len(counts)).tobytes() + head.tobytes() + b"".join(names))


def unpacked(table: bytes) -> dict[str, int]:
    data = zlib.decompress(table)
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    sizes, tokens = np.frombuffer(data, np.uint32, 2 * n, 4).reshape(2, n)
    ends = 4 + 8 * n + np.cumsum(sizes, dtype=np.int64)
    return {
        data[end - size : end].decode(): count
        for end, size, count in zip(ends.tolist(), sizes.tolist(), tokens.tolist(), strict=True)
    }


def frequent_table(df: DataFrame, path: str, text: str = "text") -> bytes:
    """The first tier: the most frequent pre-tokens of the first documents.

    Each partition could make a table; first() runs the tasks it needs to get one, which is
    the first partition's unless that is empty.
    """

    def run(batches):
        counts = Counts(path)
        seen: Counter[str] = Counter()
        values = (value.as_py() or "" for batch in batches for value in batch.column(0))
        read = 0
        for read, value in enumerate(islice(values, SAMPLE_DOCS), 1):
            seen.update(counts.pieces(value)[0])
        if not read:
            return
        # Long ones are rare, whatever the sample says.
        top = [p for p, _ in seen.most_common(FREQUENT) if len(p) <= 64]
        made = counts.tokenizer.encode_batch_fast(top, add_special_tokens=False)
        table = packed([(p, len(e)) for p, e in zip(top, made, strict=True)])
        yield pa.RecordBatch.from_pydict({"made": pa.array([table], pa.binary())})

    ship(df.sparkSession)
    made = df.select(text).mapInArrow(run, "made binary").first()
    return made.made if made else packed([])


def count_tokens(
    df: DataFrame, path: str, text: str = "text", limit: int = 1024, drop_text: bool = False
) -> DataFrame:
    """df with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    path: the tokenizer's file, at the same place on every worker.
    """
    table = df.sparkSession.sparkContext.broadcast(frequent_table(df, path, text))

    def start() -> Callable[[pa.Array], list]:
        counts = Counts(path, table.value)

        def count(texts: pa.Array) -> list:
            raw = texts.to_pylist()
            tokens = counts.count([t.decode() for t in raw])
            return [list(map(len, raw)), tokens, [n > limit for n in tokens]]

        return count

    return map_texts(df, text, FIELDS, start, drop_text=drop_text)
