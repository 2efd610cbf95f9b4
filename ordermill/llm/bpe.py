"""BPE encoding by speculation: greedy longest match, a check of adjacent pairs, exact merges.

A tokenization is the one that merging gives if every token alone is encoded as itself and
every adjacent pair is compatible: when both are merged up from their symbols in order of
rank, no merge across their border ever comes first. So the words of a batch that the cache
does not know are split greedily by longest match, all at once, the pairs are checked all at
once, and only words with an incompatible pair go through exact merging, again all at once.

The tokenizer is a word BPE file: NFC, white space dropped, lower case, words by a pattern,
bytes as symbols, the last one with an end mark. Texts are cut at ASCII white space first, as
no word spans it, and cut pieces are what workers cache. Null and empty texts have no ids.
Special strings inside texts are single ids. Decoding joins the tokens' strings by a space.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField
from tokenizers import Tokenizer

from ordermill.llm.common import FOLD, SpanHasher, flat, map_texts, summed, word_spans

# Pieces, and ids of pieces, in a worker's cache before it is emptied (some 100 MB).
CACHED = 1_000_000
CACHED_IDS = 8_000_000
# Symbols of a word up to which words are handled in batches; longer ones go one by one.
BATCH_SYMBOLS = 48
BATCH_WORDS = 50_000

NONE = np.int64(2**31 - 1)

ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
# Bytes that are a word of their own when they end a piece after letters.
CLOSING = np.zeros(256, bool)
CLOSING[list(b",.;:!?")] = True


def byte_chars() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if printable."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    made = {b: chr(b) for b in plain}
    spare = iter(range(256, 512))
    return [made[b] if b in made else chr(next(spare)) for b in range(256)]


class IntMap:
    """From 64-bit keys to non-negative numbers, looked up for whole arrays at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, room: int = 0) -> None:
        bits = max(4, int(max(len(keys), room) * 2).bit_length())
        self.mask, self.shift = np.int64((1 << bits) - 1), np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NONE, np.int64)
        self.add(keys, values)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Put in keys that are not there yet, up to about room of them."""
        left = np.arange(len(keys))
        slots = self._slots(keys)
        while len(left):
            free = self.keys[slots[left]] < 0
            self.keys[slots[left[free]]] = keys[left[free]]
            won = self.keys[slots[left]] == keys[left]
            self.values[slots[left[won]]] = values[left[won]]
            left = left[~won]
            slots[left] = (slots[left] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, NONE for unknown ones."""
        slots = self._slots(keys)
        there = self.keys[slots]
        found = self.values[slots]
        found[there != keys] = NONE
        again = np.flatnonzero((there != keys) & (there >= 0))
        while len(again):
            slots[again] = (slots[again] + 1) & self.mask
            there = self.keys[slots[again]]
            hit = there == keys[again]
            found[again[hit]] = self.values[slots[again[hit]]]
            again = again[~hit & (there >= 0)]
        return found


class Vocabulary:
    """Symbols, merges and the trie of a word BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        model = made["model"]
        ids: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in made["added_tokens"]}
        self.special = special
        self.strings = [""] * (max(*ids.values(), *special.values()) + 1)
        for name, i in [*ids.items(), *special.items()]:
            self.strings[i] = name
        chars = byte_chars()
        # Symbols: a byte inside a word, or 256 more for a byte at its end.
        self.symbol_ids = np.array([ids[c] for c in chars] + [ids[c + suffix] for c in chars])
        n = len(self.strings)
        self.left, self.right = np.full(n, -1), np.full(n, -1)
        self.rank = np.full(n, -1, np.int64)
        keys, merged = [], []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            joined = ids[a + b]
            keys.append((ids[a] << 32) | ids[b])
            merged.append(joined)
            if self.rank[joined] < 0:
                self.left[joined], self.right[joined], self.rank[joined] = ids[a], ids[b], rank
        self.merge_ids = np.array([*merged, -1])
        self.merges = IntMap(np.array(keys, np.int64), np.arange(len(keys)))
        self.pairs = dict(zip(keys, range(len(keys)), strict=True))
        self._build_trie({i for i in ids.values()}, chars, suffix)
        pattern = next(
            p["pattern"]["Regex"] for p in made["pre_tokenizer"]["pretokenizers"] if "pattern" in p
        )
        self.pattern = regex.compile(pattern)
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.place = {c: b for b, c in enumerate(chars)}
        self.specials = (
            regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        )

    def _build_trie(self, ids: set[int], chars: list[str], suffix: str) -> None:
        place = {c: b for b, c in enumerate(chars)}
        nodes: dict[int, int] = {}
        tokens = {}
        for i in sorted(ids):
            name, last = self.strings[i], 0
            if name.endswith(suffix) and name != suffix:
                name, last = name[: -len(suffix)], 256
            symbols = [place[c] for c in name]
            symbols[-1] += last
            tokens[i] = symbols
        # Only tokens that merging gives for their own symbols may be proposed.
        order = sorted(tokens)
        same = {
            i for i, found in zip(order, self.merge([tokens[i] for i in order]), strict=True)
            if list(found) == [i]
        }
        ends: dict[int, int] = {}
        for i in sorted(same):
            at = 0
            for symbol in tokens[i]:
                at = nodes.setdefault(at * 512 + symbol, len(nodes) + 1)
            ends[at] = i
        self.trie = IntMap(np.fromiter(nodes, np.int64), np.fromiter(nodes.values(), np.int64))
        self.ends = np.full(len(nodes) + 1, -1, np.int64)
        for node, i in ends.items():
            self.ends[node] = i

    def merge(self, words: list[list[int]]) -> list[np.ndarray]:
        """Ids of words of symbols by exact merging: the lowest rank first, then the leftmost."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = np.array([s for w in words for s in w], np.int64)
        ids, counts = self.merge_flat(symbols, sizes)
        return np.split(ids, np.cumsum(counts)[:-1]) if words else []

    def merge_flat(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of words whose symbols lie end to end, by exact merging."""
        starts = np.cumsum(sizes) - sizes
        number, found = [], []
        for i in np.flatnonzero(sizes > BATCH_SYMBOLS):
            ids = self._merge_one(symbols[starts[i] : starts[i] + sizes[i]].tolist())
            number.append(np.full(len(ids), i))
            found.append(ids)
        batch = np.flatnonzero(sizes <= BATCH_SYMBOLS)
        batch = batch[np.argsort(sizes[batch], kind="stable")]
        for first in range(0, len(batch), 4096):
            some = batch[first : first + 4096]
            ids, counts = self._merge_batch(gathered(symbols, starts[some], sizes[some]), sizes[some])
            number.append(np.repeat(some, counts))
            found.append(ids)
        return in_order(number, found, len(sizes))

    def _merge_batch(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = int(sizes.max(initial=0))
        ids = np.full((len(sizes), width + 1), -1, np.int64)
        inside = np.arange(width + 1) < sizes[:, None]
        ids[inside] = self.symbol_ids[symbols]
        place = np.arange(width + 1)

        def ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            found = np.full(a.shape, NONE)
            real = (a >= 0) & (b >= 0)
            found[real] = self.merges.get((a[real] << 32) | b[real])
            return found

        todo = np.arange(len(sizes))
        rank = ranks(ids[:, :-1], ids[:, 1:]) if width else np.zeros((len(sizes), 0), np.int64)
        done = ids.copy()
        while len(todo) and rank.shape[1]:
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(todo)), at]
            more = best < NONE
            if not more.all():
                done[todo[~more]] = ids[~more]
                todo, ids, rank, at, best = todo[more], ids[more], rank[more], at[more], best[more]
                if not len(todo):
                    break
            row = np.arange(len(todo))
            ids[row, at] = self.merge_ids[best]
            moved = np.minimum(place + (place > at[:, None]), width)
            tail = ids[:, -1].copy()
            ids = np.take_along_axis(ids, moved, axis=1)
            ids[:, -1] = np.where(at == width, tail, -1)
            rank = np.take_along_axis(rank, np.minimum(moved[:, :-1], width - 1), axis=1)
            rank[:, -1] = NONE
            rank[row, at] = ranks(ids[row, at], ids[row, np.minimum(at + 1, width)])
            before = np.maximum(at - 1, 0)
            rank[row, before] = ranks(ids[row, before], ids[row, before + 1])
        done[todo] = ids
        return done[done >= 0], (done >= 0).sum(axis=1)

    def _merge_one(self, symbols: list[int]) -> np.ndarray:
        """Exact merging of one long word with a heap, in n log n steps."""
        ids = [int(i) for i in self.symbol_ids[np.array(symbols)]]
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        alive = [True] * len(ids)
        heap: list[tuple[int, int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] >= 0:
                a, b = ids[at], ids[after[at]]
                rank = self.pairs.get((a << 32) | b)
                if rank is not None:
                    heapq.heappush(heap, (rank, at, a, b))

        for at in range(len(ids)):
            offer(at)
        while heap:
            rank, at, a, b = heapq.heappop(heap)
            if not alive[at] or ids[at] != a or after[at] < 0 or ids[after[at]] != b:
                continue
            gone = after[at]
            ids[at] = int(self.merge_ids[rank])
            alive[gone] = False
            after[at] = after[gone]
            if after[at] >= 0:
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return np.array([i for i, there in zip(ids, alive, strict=True) if there], np.int64)

    def propose(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple:
        """Greedy longest matches in all words at once: the words' numbers and the ids, in order."""
        at, word = starts.copy(), np.arange(len(starts))
        node = np.zeros(len(starts), np.int64)
        best, best_end = np.full(len(starts), -1, np.int64), starts.copy()
        reach = starts.copy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(word):
            inside = reach < ends[word]
            step = np.full(len(word), NONE)
            step[inside] = self.trie.get(node[inside] * 512 + symbols[reach[inside]])
            on = step < NONE
            node[on] = step[on]
            reach[on] += 1
            end = self.ends[node]
            hit = on & (end >= 0)
            best[hit], best_end[hit] = end[hit], reach[hit]
            off = np.flatnonzero(~on)
            # Every symbol alone is a token, so something has matched.
            found.append((word[off], at[off], best[off]))
            at[off] = reach[off] = best_end[off]
            node[off] = 0
            left = np.ones(len(word), bool)
            left[off] = at[off] < ends[word[off]]
            if not left.all():
                word, at, node, reach = word[left], at[left], node[left], reach[left]
                best, best_end = best[left], best_end[left]
        words, places, ids = (np.concatenate(x) if found else np.zeros(0, np.int64)
                              for x in (zip(*found, strict=True) if found else ((), (), ())))
        order = np.argsort(places, kind="stable")
        return words[order], ids[order]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the symbols of a and b together gives a and b.

        Backwards in time, the later of the two border tokens is undone. A merge of the two
        that exist at one time must not come before the next merge on either side; of equal
        ranks the left one comes first.
        """
        good = np.ones(len(a), bool)
        row = np.arange(len(a))
        x, y = a.copy(), b.copy()
        x_next, y_next = np.full(len(a), NONE), np.full(len(a), NONE)
        while len(row):
            rank = self.merges.get((x << 32) | y)
            bad = (rank < NONE) & (rank < x_next) & (rank <= y_next)
            good[row[bad]] = False
            x_rank, y_rank = self.rank[x], self.rank[y]
            left = ~bad & ((x_rank >= 0) | (y_rank >= 0))
            row, x, y, x_next, y_next = row[left], x[left], y[left], x_next[left], y_next[left]
            x_rank, y_rank = x_rank[left], y_rank[left]
            undo = x_rank > y_rank
            x_next = np.where(undo, x_rank, x_next)
            y_next = np.where(undo, y_next, y_rank)
            x, y = np.where(undo, self.right[x], x), np.where(undo, y, self.left[y])
        return good

    def encode_flat(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of words whose symbols lie end to end: speculate, verify, repair."""
        starts = np.cumsum(sizes) - sizes
        short = np.flatnonzero((sizes <= BATCH_SYMBOLS) & (sizes > 0))
        number, found = [], []
        failed = [np.flatnonzero(sizes > BATCH_SYMBOLS)]
        for first in range(0, len(short), BATCH_WORDS):
            some = short[first : first + BATCH_WORDS]
            own = gathered(symbols, starts[some], sizes[some])
            ends = np.cumsum(sizes[some])
            word, ids = self.propose(own, ends - sizes[some], ends)
            inner = np.flatnonzero(word[1:] == word[:-1])
            bad = np.zeros(len(some), bool)
            bad[word[inner[~self.compatible(ids[inner], ids[inner + 1])]]] = True
            good = ~bad[word]
            number.append(some[word[good]])
            found.append(ids[good])
            failed.append(some[bad])
        again = np.concatenate(failed)
        ids, counts = self.merge_flat(gathered(symbols, starts[again], sizes[again]), sizes[again])
        number.append(np.repeat(again, counts))
        found.append(ids)
        return in_order(number, found, len(sizes))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words (the bytes of one pattern match each), little-endian and 32 bits wide."""
        sizes = np.array(list(map(len, words)), np.int64)
        symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        symbols[np.cumsum(sizes)[sizes > 0] - 1] += 256
        return split_ids(*self.encode_flat(symbols, sizes))

    def words(self, piece: bytes) -> list[bytes | int]:
        """Words of a piece without ASCII white space; special strings as their ids."""
        if piece.isascii() and b"<|" not in piece:
            return [w.encode() for w in self.pattern.findall(piece.decode().lower())]
        made: list[bytes | int] = []
        parts = self.specials.split(piece.decode()) if self.specials else [piece.decode()]
        for i, part in enumerate(parts):
            if i % 2:
                made.append(self.special[part])
            else:
                # The library's own tables: Python's and regex's know other Unicode versions.
                folded = self.normalizer.normalize_str(part)
                words = self.splitter.pre_tokenize_str(folded)
                made += [bytes(map(self.place.__getitem__, w)) for w, _ in words]
        return made


def in_order(number: list[np.ndarray], found: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids sorted by their words' numbers, which keep their order within a word; and the counts."""
    numbers = np.concatenate([*number, np.zeros(0, np.int64)])
    ids = np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64)
    return ids[np.argsort(numbers, kind="stable")], np.bincount(numbers, minlength=n)


def plain_letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where flat texts have a-z, A-Z or a letter of U+00C0 to U+00FF, and the bytes in lower
    case there. Such letters have one lower case, no composition, and form words as they are."""
    letter = ASCII_LETTER[data]
    folded = FOLD[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    after = data[lead + 1]
    real = (after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)
    lead, after = lead[real], after[real]
    letter[lead] = letter[lead + 1] = True
    folded[lead + 1] = np.where((after < 0x9F), after + 32, after)
    return letter, folded


def raw_ids(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def word_symbols(word: bytes) -> list[int]:
    return [*word[:-1], word[-1] + 256]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The file's vocabulary, once per worker process."""
    return Vocabulary(path)


def gathered(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of pool end to end."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


class PieceCache:
    """Ids of pieces by 63-bit hash, in arrays: the hash table, and the ids end to end."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, np.int64)
        self.index = IntMap(none, none, room=CACHED)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)
        self.used = 0

    def full(self, more: int) -> bool:
        return len(self.starts) + more > CACHED or self.used > CACHED_IDS

    def add(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        if self.used + len(ids) > len(self.pool):
            room = np.zeros(max(2 * len(self.pool), self.used + len(ids)), np.uint32)
            room[: self.used] = self.pool[: self.used]
            self.pool = room
        self.pool[self.used : self.used + len(ids)] = ids
        self.index.add(keys, len(self.starts) + np.arange(len(keys)))
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.used += len(ids)


_caches: dict[str, PieceCache] = {}


class Encoder:
    """Encodes whole texts, with a worker's cache of pieces.

    Pieces are found in the cache by a 63-bit hash, so two of a worker's pieces share ids by
    mistake with a probability of some 10**-7.
    """

    def __init__(self, path: str) -> None:
        self.vocabulary = vocabulary(path)
        # The cache outlives the task: the worker process serves many.
        self.cache = _caches.setdefault(path, PieceCache())
        self.hasher = SpanHasher()

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Put pieces of data that the cache lacks into it."""
        letter, folded = plain_letters(data)
        letters = np.concatenate([[0], np.cumsum(letter)])
        sizes = ends - starts
        other = sizes - (letters[ends] - letters[starts])
        closed = (other == 1) & (sizes > 1) & CLOSING[data[ends - 1]]
        simple = (other == 0) | closed
        # A simple piece is one word of letters, or this word and a closing mark.
        at, tail = np.flatnonzero(simple), closed[simple]
        rows = np.repeat(np.arange(len(at)), 1 + tail)
        mark = np.zeros(len(rows), bool)
        mark[np.cumsum(1 + tail)[tail] - 1] = True
        begin = np.where(mark, ends[at][rows] - 1, starts[at][rows])
        end = np.where(mark | ~tail[rows], ends[at][rows], ends[at][rows] - 1)
        symbols = gathered(folded, begin, end - begin).astype(np.int64)
        symbols[np.cumsum(end - begin) - 1] += 256
        ids, counts = self.vocabulary.encode_flat(symbols, end - begin)
        self.cache.add(keys[at], ids, np.bincount(rows, counts, minlength=len(at)).astype(np.int64))

        at = np.flatnonzero(~simple)
        raw = data.tobytes()
        bounds = zip(starts[at].tolist(), ends[at].tolist(), strict=True)
        split = [self.vocabulary.words(raw[a:b]) for a, b in bounds]
        words = list({w for found in split for w in found if isinstance(w, bytes)})
        known: dict = dict(zip(words, self.vocabulary.encode_words(words), strict=True))
        known.update({i: i.to_bytes(4, "little") for i in self.vocabulary.special.values()})
        made = [b"".join(map(known.__getitem__, found)) for found in split]
        counts = np.array([len(x) // 4 for x in made], np.int64)
        self.cache.add(keys[at], np.frombuffer(b"".join(made), "<u4"), counts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the numbers of ids of each."""
        data, offsets = flat(texts)
        starts, ends, counts = word_spans(data, offsets)
        hashes = self.hasher.spans(self.hasher.prefix(data), starts, ends)
        keys = (hashes >> np.uint64(1)).astype(np.int64)
        cache = self.cache
        place = cache.index.get(keys)
        lost = np.flatnonzero(place == NONE)
        if len(lost):
            new, first = np.unique(keys[lost], return_index=True)
            if cache.full(len(new)):
                cache.clear()
                lost = np.arange(len(keys))
                new, first = np.unique(keys, return_index=True)
            at = lost[first]
            self._learn(new, data, starts[at], ends[at])
            place[lost] = cache.index.get(keys[lost])
        sizes = cache.sizes[place]
        ids = gathered(cache.pool, cache.starts[place], sizes)
        return ids, summed(sizes, counts).astype(np.int64)


class Strings:
    """Strings by id as bytes, to be joined by spaces for many texts at once."""

    def __init__(self, strings: list[str]) -> None:
        raw = [s.encode() + b" " for s in strings]
        self.pool = np.frombuffer(b"".join(raw), np.uint8)
        self.sizes = np.array(list(map(len, raw)), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The strings of each text's ids, joined by a space."""
        sizes = self.sizes[ids]
        whole = gathered(self.pool, self.starts[ids], sizes).tobytes()
        ends = np.cumsum(summed(sizes, counts).astype(np.int64)).tolist()
        return [whole[a : max(a, b - 1)] for a, b in zip([0, *ends], ends, strict=False)]


FIELDS = [
    StructField("n_tokens", LongType()),
    StructField("ids", BinaryType()),
    StructField("decoded", StringType()),
]
DIGESTS = [
    StructField("n_tokens", LongType()),
    StructField("ids_sha256", StringType()),
    StructField("decoded_sha256", StringType()),
]


def encode_texts(df: DataFrame, path: str, text: str = "text", drop_text: bool = False) -> DataFrame:
    """df with n_tokens, ids (little-endian unsigned 32-bit) and decoded, the text of the ids."""

    def start() -> Callable[[pa.Array], list]:
        encoder = Encoder(path)
        strings = Strings(encoder.vocabulary.strings)

        def encode(texts: pa.Array) -> list:
            ids, counts = encoder.encode(texts)
            decoded = [d.decode() for d in strings.joined(ids, counts)]
            return [counts, split_ids(ids, counts), decoded]

        return encode

    return map_texts(df, text, FIELDS, start, drop_text=drop_text)


def split_ids(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Each text's ids, little-endian and 32 bits wide."""
    raw, ends = raw_ids(ids), (4 * np.cumsum(counts)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def digest_texts(df: DataFrame, path: str, text: str = "text", drop_text: bool = False) -> DataFrame:
    """df with n_tokens and hex SHA-256 of the decimal ids, joined by spaces, and of decoded."""

    def start() -> Callable[[pa.Array], list]:
        encoder = Encoder(path)
        strings = Strings(encoder.vocabulary.strings)
        decimal = Strings([str(i) for i in range(len(encoder.vocabulary.strings))])

        def digest(texts: pa.Array) -> list:
            ids, counts = encoder.encode(texts)
            shas = [
                [hashlib.sha256(part).hexdigest() for part in kind.joined(ids, counts)]
                for kind in (decimal, strings)
            ]
            return [counts, *shas]

        return digest

    return map_texts(df, text, DIGESTS, start, drop_text=drop_text)
