"""LM scoring by logistic mixing of hashed-context bit predictors, and a word baseline.

A text is coded byte by byte, then by an end symbol; each symbol is a path of binary decisions
in a code tree that the two bytes before it choose, so frequent symbols take few decisions.
Three predictors know, for every decision, how often it went which way in the training texts:
at this node at all, after these four bytes (hashed), and after the last WORD_BYTES bytes of the
word so far (hashed). Their log odds are combined with weights that a gate selects (how much the predictors
know, and how deep the decision lies), and the weights are learned online: they begin the
same in every text and follow the gradient after each block of its symbols. The sum over the
decisions is the text's log probability; trees and predictors are proper, so all texts
together have a probability of at most one.

All counts cover all training texts: three passes, for the trees, for the predictors' tables
(of fixed size, summed block by block over the shuffle) and for the scores. The baseline's
word counts are exact; the FREQUENT most frequent words are broadcast, others are joined.

Null texts count as empty: the end alone. Scores do not depend on batches or partitions.
Without training texts every predictor is silent and each decision costs one bit.
"""

from __future__ import annotations

import ctypes
import heapq
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField

from ordermill.llm.bpe import NONE, IntMap
from ordermill.llm.common import (
    FOLD,
    BREAK,
    SpanHasher,
    flat,
    free_name,
    held,
    map_texts,
    ship,
    slices,
    summed,
    without,
    word_spans,
)

END = 256
SYMBOLS = 257
ESCAPE = 257
# Contexts of the code trees: 64 classes of the byte before the last, times the last byte.
CLASSES = 64
CONTEXTS = CLASSES * 256
TREES = 4096
CELL = 258  # symbols of a context, the escape included
MAX_WEIGHT = 1 << 20

SLOT_BITS = 21
SLOTS = 1 << SLOT_BITS
BLOCK_SLOTS = 1 << 14
WORD_BYTES = 6
HASHED = 2  # predictors with tables, after the one by node
DELTA = 0.4

BLOCK = 256  # symbols between updates of the weights
DEPTHS = 3
# How much is known after the word so far: nothing, or this many decisions and more.
LEVELS = (1, 8, 128)
RATE = 0.006
# Weights at the start, by twice the level, plus one if the four bytes are known.
START = np.array(
    [
        [0.95, 0.0, 0.0], [0.35, 0.7, 0.0],
        [0.6, 0.0, 0.4], [0.0, 0.7, 0.4],
        [0.4, 0.0, 0.65], [0.0, 0.65, 0.45],
        [0.2, 0.0, 0.85], [0.0, 0.5, 0.6],
    ],
    np.float32,
)
GATES = len(START) * DEPTHS

FREQUENT = 1 << 17
END_KEY = 1
FLUSH_KEYS = 1_000_000
SLICE = 250_000
# Codes and bytes for the C library: freed memory that it keeps, and arrays that it takes from it.
KEPT = ((-1, 1 << 28), (-3, 1 << 25))


def keep_memory() -> None:
    """Let the C library keep what arrays give back, for those of the next slice.

    Otherwise it goes back to the system, which clears every page before it is used again.
    Elsewhere than with glibc nothing changes.
    """
    try:
        library = ctypes.CDLL(None)
        for code, size in KEPT:
            library.mallopt(code, size)
    except (OSError, AttributeError):
        pass


class Symbols(NamedTuple):
    """Symbols of texts end to end, ends included, with what comes before each."""

    symbol: np.ndarray
    context: np.ndarray  # of the code tree
    four: np.ndarray  # the four bytes before
    word: np.ndarray  # hash of the word so far
    sizes: np.ndarray  # symbols per text


def _laid_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts apart from each other, which places are ends, and which are symbols."""
    lengths = np.diff(offsets)
    n = len(lengths)
    # Four zero bytes before each text and one after it, for the end.
    places = np.arange(len(data)) + np.repeat(np.arange(n) * 5 + 4, lengths)
    wide = np.zeros(len(data) + 5 * n, np.uint8)
    wide[places] = data
    is_end = np.zeros(len(wide), bool)
    is_end[offsets[1:] + 5 * np.arange(n) + 4] = True
    inside = is_end.copy()
    inside[places] = True
    return wide, is_end, inside


def _contexts(last: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Contexts of the code trees, from the last two bytes."""
    return (second & (CLASSES - 1)).astype(np.int64) << 8 | last


def cell_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The context and symbol of every symbol, ends included, as context * CELL + symbol."""
    wide, is_end, inside = _laid_out(data, offsets)
    at = np.flatnonzero(inside)
    symbol = wide[at].astype(np.int64)
    symbol[is_end[at]] = END
    return _contexts(wide[at - 1], wide[at - 2]) * CELL + symbol


def read_symbols(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> Symbols:
    lengths = np.diff(offsets)
    wide, is_end, inside = _laid_out(data, offsets)
    at = np.flatnonzero(inside)
    wide32 = wide.astype(np.uint32)
    # Of every place, then of the symbols: neighbours are cheaper than lookups.
    before = np.zeros(len(wide), np.uint32)
    before[4:] = wide32[3:-1] << np.uint32(24)
    for back in (2, 3, 4):
        before[4:] |= wide32[4 - back : len(wide) - back] << np.uint32(32 - 8 * back)
    four = before[at]
    context = _contexts(four >> np.uint32(24), four >> np.uint32(16) & np.uint32(255))
    starts = np.where(BREAK[wide] | ~inside | is_end, np.arange(1, len(wide) + 1, dtype=np.int32), np.int32(0))
    starts[is_end] = 0
    starts = np.maximum.accumulate(starts)
    # The word before a symbol begins after the last break before it; of a longer one, its
    # last bytes are taken, or most slots would be used by words that are never seen again.
    begin = np.maximum(np.minimum(starts[at - 1], at), at - WORD_BYTES)
    word = hasher.spans(hasher.prefix(wide), begin, at)
    symbol = wide[at].astype(np.int64)
    symbol[is_end[at]] = END
    return Symbols(symbol, context, four, word, lengths + 1)


class Code(NamedTuple):
    """Paths of nodes and bits. Entries: a context's symbols and its escape, by CELL key; the
    last context is for symbols after an escape and has all of them."""

    keys: np.ndarray
    first: np.ndarray
    size: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray
    depth: np.ndarray
    n_nodes: int


def _huffman(weights: list[tuple[int, int]], node: int) -> tuple[dict[int, list[tuple[int, int]]], int]:
    """Paths from the root by symbol, of (symbol, weight); nodes are numbered from node."""
    heap = [(w, s, s) for s, w in sorted(weights)]
    heapq.heapify(heap)
    order = 1 << 20
    trees: dict[int, tuple] = {}
    while len(heap) > 1:
        (w0, _, a), (w1, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        order += 1
        trees[order] = (a, b)
        heapq.heappush(heap, (w0 + w1, order, order))
    paths: dict[int, list[tuple[int, int]]] = {}
    stack = [(heap[0][2], [])] if heap else []
    while stack:
        at, path = stack.pop()
        if at in trees:
            own, node = node, node + 1
            for bit in (0, 1):
                stack.append((trees[at][bit], [*path, (own, bit)]))
        else:
            paths[at] = path
    return paths, node


def build_code(cells: dict[int, int]) -> Code:
    """Trees for the TREES most frequent contexts, and the one after an escape, from counts by
    context * CELL + symbol."""
    by_context: dict[int, list[tuple[int, int]]] = {}
    every = dict.fromkeys(range(SYMBOLS), 1)
    for key, n in cells.items():
        by_context.setdefault(key // CELL, []).append((key % CELL, n))
        every[key % CELL] += n
    top = sorted(by_context, key=lambda c: (-sum(n for _, n in by_context[c]), c))[:TREES]
    by_context = {c: by_context[c] + [(ESCAPE, 1)] for c in top} | {CONTEXTS: list(every.items())}
    keys, first, size, nodes, bits, depth = [], [], [], [], [], []
    node = 0
    for context in sorted(by_context):
        found = by_context[context]
        scale = max(1, sum(n for _, n in found) // MAX_WEIGHT)
        paths, node = _huffman([(s, max(1, n // scale)) for s, n in found], node)
        for symbol in sorted(paths):
            keys.append(context * CELL + symbol)
            first.append(len(nodes))
            size.append(len(paths[symbol]))
            nodes += [at for at, _ in paths[symbol]]
            bits += [bit for _, bit in paths[symbol]]
            depth += range(len(paths[symbol]))
    return Code(
        np.array(keys, np.int64), np.array(first, np.int64), np.array(size, np.int64),
        np.array(nodes, np.int32), np.array(bits, np.uint8), np.array(depth, np.uint8), node,
    )


class Decisions(NamedTuple):
    """Decisions of symbols in order: node, bit, depth, and the slot of each hashed predictor."""

    node: np.ndarray
    bit: np.ndarray
    depth: np.ndarray
    slots: list[np.ndarray]
    per_symbol: np.ndarray


class Coder:
    """Turns symbols into decisions."""

    def __init__(self, code: Code) -> None:
        self.code = code
        self.entries = np.full((CONTEXTS + 1) * CELL, NONE, np.int32)
        self.entries[code.keys] = np.arange(len(code.keys))

    def decisions(self, symbols: Symbols) -> Decisions:
        code = self.code
        entry = self.entries[symbols.context * CELL + symbols.symbol]
        lost = np.flatnonzero(entry == NONE)
        # A symbol that its tree lacks is an escape, if there is a tree, then one of all symbols.
        if len(lost):
            owner = np.arange(len(entry))
            escape = self.entries[symbols.context[lost] * CELL + ESCAPE]
            plain = self.entries[CONTEXTS * CELL + symbols.symbol[lost]]
            entry[lost] = escape
            entry = np.insert(entry, lost + 1, plain)
            owner = np.insert(owner, lost + 1, lost)
            real = entry != NONE
            entry, owner = entry[real], owner[real]
        sizes = code.size[entry]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        # As wide as places are, for three lookups, and inside, so that none has to be checked.
        path = np.repeat(code.first[entry] - (ends - sizes), sizes)
        path += np.arange(total)
        per_symbol = sizes
        if len(lost):
            per_symbol = np.bincount(owner, weights=sizes, minlength=len(symbols.symbol)).astype(np.int64)
        node = code.nodes.take(path, mode="clip")
        with np.errstate(over="ignore"):
            mixed = node.astype(np.uint32) * np.uint32(0x85EBCA6B)
            own = [
                symbols.four * np.uint32(0x9E3779B1),
                (symbols.word >> np.uint64(32)).astype(np.uint32),
            ]
            slots = []
            for values in own:
                h = np.repeat(values, per_symbol)
                h ^= mixed
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x2C1B3C6D)
                h >>= np.uint32(32 - SLOT_BITS)
                slots.append(h.view(np.int32))
        bit, depth = code.bits.take(path, mode="clip"), code.depth.take(path, mode="clip")
        return Decisions(node, bit, depth, slots, per_symbol)


class Tables(NamedTuple):
    """Log odds of a one: by node, then by slot of each hashed predictor; 0 is unknown. levels
    has the place among LEVELS of what is known, by slot of the word so far."""

    nodes: np.ndarray
    slots: np.ndarray
    levels: np.ndarray


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    odds = np.log(ones + DELTA) - np.log(zeros + DELTA)
    # Where something is known the value must not be the zero that says unknown.
    return np.where((zeros + ones > 0) & (odds == 0), 1e-6, odds).astype(np.float32)


class Scorer:
    """Log10 probabilities of whole texts, many at once, each by its own weights."""

    def __init__(self, code: Code, tables: Tables) -> None:
        self.coder, self.tables, self.hasher = Coder(code), tables, SpanHasher()

    def score(self, texts: pa.Array) -> np.ndarray:
        symbols = read_symbols(*flat(texts), self.hasher)
        n = len(symbols.sizes)
        # All texts' first blocks, then all second blocks, and so on.
        blocks = -(-symbols.sizes // BLOCK)
        text = np.repeat(np.arange(n), blocks)
        number = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = (np.cumsum(symbols.sizes) - symbols.sizes)[text] + number * BLOCK
        size = np.minimum(BLOCK, symbols.sizes[text] - number * BLOCK)
        # Longer texts come first, so those that have a block of some number stand side by side.
        by_length = np.argsort(-blocks, kind="stable")
        place = np.empty(n, np.int64)
        place[by_length] = np.arange(n)
        order = np.lexsort((place[text], number))
        number, start, size = number[order], start[order], size[order]
        ends = np.cumsum(size)
        at = np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if n else 0)
        found = self.coder.decisions(
            Symbols(symbols.symbol[at], symbols.context[at], symbols.four[at], symbols.word[at], size)
        )
        decided = np.concatenate([[0], np.cumsum(found.per_symbol)])
        per_block = np.diff(decided[np.concatenate([[0], ends])])
        known = np.empty((HASHED + 1, len(found.node)), np.float32)
        # All places are inside; checking them would copy what is taken.
        self.tables.nodes.take(found.node, out=known[0], mode="clip")
        for k in range(HASHED):
            self.tables.slots[k].take(found.slots[k], out=known[k + 1], mode="clip")
        gate = self.tables.levels.take(found.slots[1], mode="clip") * np.uint8(2)
        gate += (known[1] != 0).view(np.uint8)
        gate += np.uint8(len(START)) * np.minimum(found.depth, np.uint8(DEPTHS - 1))
        # 1 where the bit is zero, else -1: times the log odds of a one, those of the other bit.
        other = found.bit.astype(np.float32)
        other *= -2
        other += 1
        weights = np.ascontiguousarray(np.tile(START, (n * DEPTHS, 1)).T)
        total = np.zeros(n)
        steps = np.searchsorted(number, np.arange(int(blocks.max(initial=0)) + 1))
        cut = np.concatenate([[0], np.cumsum(per_block)])
        for first, last in zip(steps, steps[1:], strict=False):
            here = slice(cut[first], cut[last])
            counts = per_block[first:last]
            active = len(counts)
            # As wide as places are, or each use would widen it again.
            row = np.repeat(np.arange(active, dtype=np.intp) * GATES, counts)
            row += gate[here]
            inputs = known[:, here]
            logit = weights[0].take(row, mode="clip")
            logit *= inputs[0]
            for k in range(1, HASHED + 1):
                part = weights[k].take(row, mode="clip")
                part *= inputs[k]
                logit += part
            np.clip(logit, -16, 16, out=logit)
            logit *= other[here]
            # One and the odds of the other bit: its logarithm is what the bit costs.
            whole = np.exp(logit, out=logit)
            whole += 1
            # Every block has a symbol and every symbol a decision, so no stretch is empty.
            begins = cut[first:last] - cut[first]
            total[:active] -= np.add.reduceat(np.log(whole), begins, dtype=np.float64)
            if last == len(number):
                break
            # The probability of the other bit, with the sign of the bit.
            miss = np.reciprocal(whole, out=whole)
            miss -= 1
            miss *= other[here]
            for k in range(HASHED + 1):
                moved = np.bincount(row, miss * inputs[k], minlength=active * GATES)
                weights[k, : active * GATES] += RATE * moved
        return total[place] / math.log(10)


def _partition_counts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Rows (kind, key, n): 0 for cells of the code trees, 1 for words of the baseline."""
    keep_memory()
    hasher = SpanHasher()
    cells = np.zeros((CONTEXTS + 1) * CELL, np.int64)
    words: list[tuple[np.ndarray, np.ndarray]] = []
    held = texts_seen = 0

    def rows(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(counts.astype(np.int64))],
            names=["kind", "key", "n"],
        )

    def merged() -> pa.RecordBatch:
        keys, place = np.unique(np.concatenate([k for k, _ in words]), return_inverse=True)
        return rows(1, keys, np.bincount(place, np.concatenate([c for _, c in words])))

    for batch in batches:
        for _, texts in slices(batch, text, SLICE):
            data, offsets = flat(texts)
            np.add.at(cells, cell_keys(data, offsets), 1)
            texts_seen += len(texts)
            keys, counts = np.unique(word_keys(data, offsets, hasher)[0], return_counts=True)
            words.append((keys, counts))
            held += len(keys)
            if held > FLUSH_KEYS:
                yield merged()
                words, held = [], 0
    if texts_seen:
        yield rows(1, np.array([END_KEY]), np.array([texts_seen]))
        if words:
            yield merged()
        there = np.flatnonzero(cells)
        yield rows(0, there, cells[there])


def word_keys(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes of the words, A-Z in lower case, and the words per text."""
    data = FOLD[data]
    starts, ends, counts = word_spans(data, offsets)
    hashes = hasher.spans(hasher.prefix(data), starts, ends)
    return np.maximum(hashes >> np.uint64(1), np.uint64(END_KEY + 1)).astype(np.int64), counts


def _packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest takes, behind their type and number."""
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    head = kind.char.encode() + len(counts).to_bytes(8, "little")
    return head + pa.compress(counts.astype(kind).tobytes(), "zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    kind, n = np.dtype(raw[:1].decode()), int.from_bytes(raw[1:9], "little")
    data = pa.decompress(raw[9:], n * kind.itemsize, "zstd", asbytes=True)
    return np.frombuffer(data, kind).astype(np.int64)


def _added(tables: list[np.ndarray] | None, narrow: list[np.ndarray]) -> list[np.ndarray]:
    """The sums in 64 bits, or the narrow counts where there are no others yet."""
    if tables is None:
        return narrow
    return [a.astype(np.int64) + b for a, b in zip(tables, narrow, strict=True)]


def _partition_tables(code: Code, text: str) -> Callable:
    """Rows (part, salt, counts): the partition's counts by slot and bit, a block at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        coder, hasher = Coder(code), SpanHasher()
        lengths = [2 * code.n_nodes, *[2 * SLOTS] * HASHED]
        # Narrow counts stay closer to the core; they are added up before one can overflow.
        tables, narrow, counted = None, [np.zeros(n, np.uint32) for n in lengths], 0
        any_text = False
        for batch in batches:
            for _, texts in slices(batch, text, SLICE):
                any_text = True
                found = coder.decisions(read_symbols(*flat(texts), hasher))
                if counted + len(found.node) >= 1 << 32:
                    tables = _added(tables, narrow)
                    narrow, counted = [np.zeros(n, np.uint32) for n in lengths], 0
                counted += len(found.node)
                for few, slot in zip(narrow, [found.node, *found.slots], strict=True):
                    np.add.at(few, slot.astype(np.intp) * 2 + found.bit, np.uint32(1))
        if any_text:
            part = 0
            for table in _added(tables, narrow):
                for at in range(0, len(table), 2 * BLOCK_SLOTS):
                    raw = _packed(table[at : at + 2 * BLOCK_SLOTS])
                    yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([raw], pa.binary())], names=["part", "counts"])
                    part += 1

    return run


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each key of a sorted partition, adding up one row after the other."""
    key, total = None, None
    names = ["part", "salt", "counts"]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([_packed(total)], pa.binary())], names=names
        )

    for batch in batches:
        for part, salt, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (part, salt) != key:
                if key is not None:
                    yield row()
                key, total = (part, salt), _unpacked(raw)
            else:
                total = total + _unpacked(raw)
    if key is not None:
        yield row()


def _summed_parts(parts: DataFrame) -> DataFrame:
    grouped = parts.select("part", "salt", "counts").repartition("part", "salt")
    return grouped.sortWithinPartitions("part", "salt").mapInArrow(
        _sum_parts, "part long, salt long, counts binary"
    )


class Model(NamedTuple):
    """Trees and tables (of bounded size), and the baseline's counts as a table that Spark holds."""

    code: Code
    tables: Tables
    words: DataFrame
    tokens: int
    distinct: int


def fit(df: DataFrame, text: str = "text") -> Model:
    """The model of all texts of df."""
    spark = df.sparkSession
    ship(spark)
    texts = df.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    counted = texts.mapInArrow(
        lambda batches: _partition_counts(batches, "_text"), "kind int, key long, n long"
    )
    counts = held(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")))
    # At most CONTEXTS * SYMBOLS rows, some ten thousand with natural texts.
    cells = {r.key: r.n for r in counts.where("kind = 0").collect()}
    code = build_code(cells)
    words = counts.where("kind = 1").select("key", "n")
    known = words.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("distinct")).first()

    sent = spark.sparkContext.broadcast(code)
    parts = texts.mapInArrow(
        lambda batches: _partition_tables(sent.value, "_text")(batches), "part long, counts binary"
    )
    # Two levels, so that no task adds up more than the square root of all partitions' blocks.
    salted = parts.withColumn("salt", F.spark_partition_id().cast("long") % 64)
    once = _summed_parts(salted)
    total = _summed_parts(once.withColumn("salt", F.lit(0).cast("long")))
    # The tables have a fixed size, whatever the texts are.
    raw = {r.part: _unpacked(r.counts) for r in total.collect()}
    node_parts = -(-code.n_nodes // BLOCK_SLOTS)
    if raw:
        every = [raw[i] for i in range(node_parts)]
        nodes = np.concatenate([*every, np.zeros(0, np.int64)])
        slots = [
            np.concatenate([raw[node_parts + k * (SLOTS // BLOCK_SLOTS) + i] for i in range(SLOTS // BLOCK_SLOTS)])
            for k in range(HASHED)
        ]
    else:
        nodes, slots = np.zeros(2 * code.n_nodes, np.int64), [np.zeros(2 * SLOTS, np.int64)] * HASHED
    tables = Tables(
        log_odds(nodes[::2], nodes[1::2]),
        np.stack([log_odds(s[::2], s[1::2]) for s in slots]),
        np.searchsorted(LEVELS, slots[1][::2] + slots[1][1::2], side="right").astype(np.uint8),
    )
    return Model(code, tables, words, known.tokens or 0, known.distinct or 0)


def _most_frequent(words: DataFrame) -> DataFrame:
    """The FREQUENT most frequent words, those with the smallest keys where the last are equal.

    Sorting with a limit sends as many rows of every partition to the driver. So the others are
    left out before: those less frequent than the last, and of the equally frequent ones those
    whose keys, which are hashes and so evenly spread, are far beyond the ones still needed.
    """
    # As many rows as there are different counts, at most the root of twice the tokens.
    many = words.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()
    left, found = FREQUENT, F.lit(True)
    for n, equal in sorted(((r.n, r.words) for r in many), reverse=True):
        if equal > left:
            bound = min((left + 8 * math.isqrt(left) + 64) * (1 << 63) // equal, (1 << 63) - 1)
            found = (F.col("n") > n) | (F.col("n") == n) & (F.col("key") <= bound)
            break
        left -= equal
    return words.where(found).orderBy(F.desc("n"), "key").limit(FREQUENT)


def score_texts(df: DataFrame, model: Model, text: str = "text", drop_text: bool = False) -> DataFrame:
    """df with n_tokens, n_known, train_tokens, base_score, score and bits_per_byte."""
    spark = df.sparkSession
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    # Names that no column of df has.
    own_known, own_base, own_bytes, own_rare, own_row, rare_base, rare_known = (
        free_name(df, n) for n in ("known", "base", "bytes", "rare", "row", "rare_base", "rare_known")
    )
    fields = [
        StructField("n_tokens", LongType()),
        StructField(own_known, LongType()),
        StructField(own_base, DoubleType()),
        StructField("score", DoubleType()),
        StructField(own_bytes, LongType()),
        StructField(own_rare, ArrayType(LongType())),
    ]
    top = _most_frequent(model.words).collect()
    frequent = (np.array([r.key for r in top], np.int64), np.array([r.n for r in top], np.int64))
    whole = model.tokens + 0.5 * (model.distinct + 1)
    sent = spark.sparkContext.broadcast((model.code, model.tables, frequent))

    def start() -> Callable[[pa.Array], list]:
        keep_memory()
        code, tables, (keys, counts) = sent.value
        scorer, index = Scorer(code, tables), IntMap(keys, np.arange(len(keys)))
        logs = np.log10((counts + 0.5) / whole)
        ends = int(index.get(np.array([END_KEY]))[0])

        def score(texts: pa.Array) -> list:
            data, offsets = flat(texts)
            found, sizes = word_keys(data, offsets, scorer.hasher)
            place = index.get(found)
            rare = place == NONE
            value = logs[np.where(rare, 0, place)] if len(logs) else np.zeros(len(found))
            base = summed(np.where(rare, 0.0, value), sizes)
            known = summed(~rare, sizes).astype(np.int64)
            base += logs[ends] if ends != NONE else 0.0
            known += ends != NONE
            cuts = np.cumsum(summed(rare, sizes).astype(np.int64))[:-1]
            rest = np.split(found[rare], cuts) if len(sizes) else []
            if ends == NONE:
                rest = [np.append(r, END_KEY) for r in rest]
            return [sizes + 1, known, base, scorer.score(texts), np.diff(offsets), rest]

        return score

    numbered = without(df, names).withColumn(own_row, F.monotonically_increasing_id())
    scored = held(map_texts(numbered, text, fields, start, limit=SLICE, drop_text=drop_text))
    rare = scored.select(own_row, F.explode(own_rare).alias("key"))
    n = F.coalesce("n", F.lit(0))
    sums = (
        rare.join(model.words, "key", "left")
        .groupBy(own_row)
        .agg(
            F.sum(F.log10((n + 0.5) / F.lit(whole))).alias(rare_base),
            F.count("n").alias(rare_known),
        )
    )
    every = scored.join(sums, own_row, "left")
    bits = F.when(F.col(own_bytes) > 0, -F.col("score") * math.log2(10) / F.col(own_bytes))
    taken = {own_row, own_known, own_base, own_bytes, own_rare, "n_tokens", "score"}
    return every.select(
        *[F.col(f"`{c}`") for c in scored.columns if c not in taken],
        "n_tokens",
        (F.col(own_known) + F.coalesce(rare_known, F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col(own_base) + F.coalesce(rare_base, F.lit(0.0))).alias("base_score"),
        "score",
        bits.alias("bits_per_byte"),
    )
