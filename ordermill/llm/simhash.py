"""SimHash near-dedup: 64-bit fingerprints of 3-word shingles, linked through BK-trees.

A BK-tree holds fingerprints; each child hangs on its parent by an edge keyed by their Hamming
distance. A search for all within a radius r of q, at distance d of a node, follows only edges
from d - r to d + r, by the triangle inequality.

Trees are sharded: two fingerprints at r or fewer bits differ in at most r of r + 2 blocks of
bits, so some two blocks are equal. Every pair of blocks gives a key, and fingerprints with
one key form a shard; a large shard is cut into trees of bounded size. A tree is sent to
every slice of queries of its shard, over the shuffle and not through the driver, which must
not see all fingerprints; so each task holds small trees and the queries for them only. A task
returns a spanning forest of the links it finds, not all pairs. Components of the links are
then found by repeated shuffles of edges.

Equal fingerprints are one node from the start. Null and empty texts have fingerprint zero,
which links like any other. A component is named by its smallest id; null ids count only in
being named (a component of null ids alone is null).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from ordermill.llm.common import keep_once, map_texts, ship, stored
from ordermill.llm.components import connected

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
# Fingerprints of a tree, and of a slice of queries.
TREE_SIZE = 4096


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as an unsigned number: a bit is set if it is in over half of the
    shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = list(map(len, words))
    ends = list(accumulate(sizes, lambda end, size: end + 1 + size))
    starts = [0, *(end + 1 for end in ends[:-1])]
    parts = map(joined.__getitem__, map(slice, starts, islice(ends, shingle - 1, None)))
    n = len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for first in range(0, n, 1 << 15):
        some = hashes[first : first + (1 << 15)].astype(">u8").view(np.uint8)
        counts += np.unpackbits(some).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def _fingerprints(shingle: int) -> Callable[[], Callable[[pa.Array], list]]:
    def start() -> Callable[[pa.Array], list]:
        def make(texts: pa.Array) -> list:
            raw = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64)
            return [raw.view(np.int64)]

        return make

    return start


class BKTree:
    """A BK-tree in arrays, searched for many queries at once, level by level."""

    def __init__(self, values: np.ndarray) -> None:
        """values: distinct unsigned fingerprints; the first is the root.

        All values go down together: those at one node and one distance of it share an edge,
        the first of them becomes the child there and the others go on below it.
        """
        self.values = values
        n = len(values)
        self.parent, self.edge = np.full(n, -1), np.zeros(n, np.int64)
        at, left = np.zeros(n, np.int64), np.arange(1, n)
        while len(left):
            apart = np.bitwise_count(values[left] ^ values[at[left]]).astype(np.int64)
            place = at[left] * (BITS + 1) + apart
            _, first, group = np.unique(place, return_index=True, return_inverse=True)
            child = left[first]
            self.parent[child], self.edge[child] = at[child], apart[first]
            below = child[group]
            stay = below != left
            at[left] = below
            left = left[stay]
        order = np.lexsort((self.edge, self.parent))
        self.children = order[1:] if n else order
        self.first = np.searchsorted(self.parent[self.children], np.arange(n + 1))
        # Edges in order of parent, then distance: one range of them for each search step.
        self.place = self.parent[self.children] * (BITS + 1) + self.edge[self.children]

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and value, as places, at radius or fewer bits."""
        query, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        if not len(self.values):
            query = query[:0]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(query):
            apart = np.bitwise_count(queries[query] ^ self.values[node]).astype(np.int64)
            near = apart <= radius
            found.append((query[near], node[near]))
            low = node * (BITS + 1) + np.maximum(apart - radius, 0)
            high = node * (BITS + 1) + np.minimum(apart + radius, BITS)
            start = np.searchsorted(self.place, low)
            counts = np.searchsorted(self.place, high, side="right") - start
            total = int(counts.sum())
            ends = np.cumsum(counts)
            inner = np.arange(total) - np.repeat(ends - counts, counts)
            node = self.children[np.repeat(start, counts) + inner]
            query = np.repeat(query, counts)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = zip(*found, strict=True)
        return np.concatenate(a), np.concatenate(b)


def _masks(radius: int) -> list[int]:
    """Bits of every pair of blocks, as signed numbers."""
    blocks = radius + 2
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = [x | y for x, y in combinations(parts, 2)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _forest(values: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each value or query with the first of its component in this group."""
    every = np.concatenate([values, queries])
    # Without queries of another slice, the tree's own values are the queries.
    shift = len(values) if len(queries) else 0
    a, b = BKTree(values).search(queries if len(queries) else values, radius)
    a = a + shift
    least = np.arange(len(every))
    while True:
        before = least.copy()
        low = np.minimum(least[a], least[b])
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        np.minimum.at(least, before, least.copy())
        least = least[least]
        if np.array_equal(before, least):
            break
    moved = np.flatnonzero(least != np.arange(len(every)))
    return every[moved], every[least[moved]]


GROUP = ["_shard", "_mask", "_tree", "_slice"]


def _search(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Forests of the groups of a partition that is sorted by GROUP, one group at a time."""

    def links(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        values = group.column("fp").to_numpy().view(np.uint64)
        member = group.column("_member").to_numpy().astype(bool)
        found = _forest(values[member], values[~member], radius)
        return found[0].view(np.int64), found[1].view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([kept, table]) if kept is not None else table
            keys = np.stack([table.column(c).to_numpy() for c in GROUP])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            bounds = [0, *cuts.tolist()]
            made = [
                links(table.slice(start, end - start))
                for start, end in zip(bounds, bounds[1:], strict=False)
            ]
            # The last group may go on in the next batch.
            kept = table.slice(bounds[-1]) if table.num_rows else None
            yield from _edges(made)
        if kept is not None and kept.num_rows:
            yield from _edges([links(kept)])

    return run


def _edges(made: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    if made:
        a, b = (np.concatenate(x) for x in zip(*made, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(fingerprints: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints (column fp) as all links within
    radius do: a spanning forest per tree and slice of queries."""
    ship(fingerprints.sparkSession)
    keys = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("_shard"), F.col("fp").bitwiseAND(mask).alias("_mask"))
                for i, mask in enumerate(_masks(radius))
            ]
        )
    )
    keyed = fingerprints.select("fp", keys.alias("_key")).select("fp", "_key.*")
    shards = keyed.groupBy("_shard", "_mask").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    trees = F.ceil(F.col("_n") / tree_size).cast("int")
    own = (
        keyed.join(shards, ["_shard", "_mask"])
        .withColumn("_trees", trees)
        .withColumn("_own", F.pmod(F.xxhash64("fp"), F.col("_trees")).cast("int"))
    )
    # A tree goes to its own slice of queries and the earlier ones, so each pair meets once.
    members = own.select(
        "fp", "_shard", "_mask", F.col("_own").alias("_tree"),
        F.explode(F.sequence(F.lit(0), F.col("_own"))).alias("_slice"), F.lit(1).alias("_member"),
    )
    queries = own.where("_own < _trees - 1").select(
        "fp", "_shard", "_mask",
        F.explode(F.sequence(F.col("_own") + 1, F.col("_trees") - 1)).alias("_tree"),
        F.col("_own").alias("_slice"), F.lit(0).alias("_member"),
    )
    grouped = members.unionByName(queries).repartition(*GROUP).sortWithinPartitions(*GROUP)
    return grouped.mapInArrow(_search(radius), "a long, b long")


def _sha(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)


def near_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """Every row's id_col with fingerprint (16 hex digits), component_id, _label and _sha.

    _label is the component's least fingerprint, which names it even where ids repeat; _sha is
    the digest of the text as it is.
    """
    raw = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    hashed = raw.withColumn("_sha", _sha("_text"))
    field = StructField("_fp", LongType())
    rows = stored(
        map_texts(hashed, "_text", [field], _fingerprints(shingle), drop_text=True), "fingerprints"
    )
    nodes = stored(
        rows.groupBy(F.col("_fp").alias("fp")).agg(F.min("_id").alias("least")), "nodes"
    )
    parts = connected(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    named = nodes.join(parts, "fp", "left").withColumn("_label", F.coalesce("component", "fp"))
    least = named.groupBy("_label").agg(F.min("least").alias("component_id"))
    of = stored(
        named.join(least, "_label").select(F.col("fp").alias("_fp"), "_label", "component_id"),
        "labels",
    )
    return rows.join(of, "_fp").select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "_label",
        "_sha",
    )


def drop_near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """One row of each component, the one with its smallest id, all columns as they are."""
    groups = near_groups(df, id_col, text, shingle, radius)
    first = groups.where(F.col(id_col).eqNullSafe(F.col("component_id")))
    # Texts decide where rows of a component share its smallest id.
    kept = first.groupBy("_label", F.col(id_col).alias("_id")).agg(F.min("_sha").alias("_sha"))
    return keep_once(df, _sha(text), id_col, kept.select("_id", "_sha"))
