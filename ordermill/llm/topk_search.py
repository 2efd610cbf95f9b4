"""Exact top-k by inner product: ball-tree branch and bound over shards.

Components x become floor(scale * x). Rows go to regions, around centres fitted on a bounded
sample, and large regions are dealt out over several shards, so that no vector, however common,
fills one. Each shard gets a ball tree, built once and written as a table. Every query first
searches the shard that it lies in. Its kth score so far then goes with it: it is sent only to
the shards whose ball can beat that score, and prunes their trees from the start. In a tree,
nodes are visited by the upper bound <q, centre> + |q| * radius of their inner products.

Scores are exact integers. Bounds are floats with a margin, and a node that can only tie is
left out only if all its ids are larger, so ties go to the smaller id (null ids last).

A query is a row, and its candidates are all other rows, also those with the same id or the
same vector; rows that repeat an id are separate queries. Null vectors, and those with null or
non-finite components or so large that a score may not fit a long (a squared norm of 2^62),
take no part; shorter vectors count as padded with zeros. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import ship, stored

# Rows of a shard and of a block of queries that meets it, and rows of a leaf.
SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 4096, 8192, 64
# Regions at most, and about how many rows of the table their centres are fitted on.
REGIONS, SAMPLE_ROWS = 512, 4096
# An inner product is exact in floats below this product of norms.
FLOAT_EXACT = 2.0**53
NO_ID = np.iinfo(np.int64).max

_VECTORS = "row long, id long, vector binary"
_PLACED = f"{_VECTORS}, region int, distance double"
_FOUND = "row long, query long, id long, score long"


def scaled(vectors: pa.Array, scale: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the valid vectors of a list array, and floor(scale * x) of their components."""
    places, found = [], []
    for i, vector in enumerate(vectors):
        if not vector.is_valid or vector.values.null_count:
            continue
        with np.errstate(over="ignore", invalid="ignore"):
            made = np.floor(vector.values.to_numpy().astype(np.float64) * scale)
            if made @ made < 2.0**62:  # also false if a component is not finite
                places.append(i)
                found.append(made.astype(np.int64))
    return np.array(places, np.int64), found


def width(vectors: pa.ChunkedArray | pa.Array) -> int:
    """Components of the longest of these binary vectors, 1 at least."""
    return max(1, (pc.max(pc.binary_length(vectors)).as_py() or 0) // 8)


def matrix(vectors: pa.ChunkedArray | pa.Array, wide: int) -> np.ndarray:
    """Rows of integers from binary vectors, padded with zeros."""
    parts = [np.frombuffer(v.as_buffer(), np.int64) for v in vectors]
    made = np.zeros((len(parts), wide), np.int64)
    for row, part in zip(made, parts, strict=True):
        row[: len(part)] = part
    return made


def fit_centres(vectors: np.ndarray, k: int) -> np.ndarray:
    """k centres or fewer for these vectors: spread starting points, then a few mean steps."""
    centres = [vectors[0]]
    nearest = np.full(len(vectors), np.inf)
    while len(centres) < k:
        nearest = np.minimum(nearest, ((vectors - centres[-1]) ** 2).sum(axis=1))
        far = int(nearest.argmax())
        if nearest[far] == 0:
            break
        centres.append(vectors[far])
    made = np.array(centres)
    for _ in range(4):
        own = nearest_centre(vectors, made)[0]
        for c in range(len(made)):
            if (own == c).any():
                made[c] = vectors[own == c].mean(axis=0)
    return made


def nearest_centre(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the nearest centre, and an upper bound of its distance to it."""
    own = ((centres**2).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1)
    distance = np.sqrt(((vectors - centres[own]) ** 2).sum(axis=1))
    return own, padded(distance)


def padded(values: np.ndarray) -> np.ndarray:
    """Upper bounds of values that rounding may have made too small."""
    return values * (1 + 1e-9) + 1e-6


def upper_bounds(query: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """At least the largest inner product of the query with any vector in each ball."""
    norm = math.sqrt(float(query @ query))
    along = centres @ query
    slack = norm * (np.sqrt((centres**2).sum(axis=1)) + radii)
    return along + norm * radii + 1e-9 * slack + 1e-6


class BallTree:
    """A shard's vectors in the order of the leaves, and its nodes: the root, then pairs."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.lexsort((rows, ids))
        values = vectors.astype(np.float64)
        spans, children, centres, radii, least = [(0, len(rows))], [], [], [], []
        for start, stop in spans:  # spans grows while nodes are split
            own = values[order[start:stop]]
            centre = own.mean(axis=0)
            away = np.sqrt(((own - centre) ** 2).sum(axis=1))
            centres.append(centre)
            radii.append(away.max())
            least.append(ids[order[start:stop]].min())
            if stop - start <= LEAF_ROWS:
                children.append(-1)
                continue
            if away.max() > 0:
                # Between the point farthest from the centre and the point farthest from that.
                pole = own[away.argmax()]
                other = own[((own - pole) ** 2).sum(axis=1).argmax()]
                side = np.argsort(own @ (other - pole), kind="stable")
                order[start:stop] = order[start:stop][side]
            middle = (start + stop) // 2
            children.append(len(spans))
            spans += [(start, middle), (middle, stop)]
        self.rows, self.ids, self.vectors = rows[order], ids[order], vectors[order]
        self.spans, self.children = np.array(spans), np.array(children)
        self.centres, self.radii = np.array(centres), padded(np.array(radii))
        self.least = np.array(least)
        self.prepare()

    def prepare(self) -> None:
        self.values = self.vectors.astype(np.float64)
        squares = (self.values**2).sum(axis=1)
        self.norm = float(np.sqrt(squares.max())) if len(squares) else 0.0
        self.lists = [x.tolist() for x in (self.spans[:, 0], self.spans[:, 1], self.children, self.least)]

    PARTS = ("rows", "ids", "vectors", "spans", "children", "centres", "radii", "least")

    def packed(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() for name in self.PARTS}

    @classmethod
    def unpacked(cls, parts: dict[str, bytes]) -> BallTree:
        tree = cls.__new__(cls)
        for name in cls.PARTS:
            kind = np.float64 if name in ("centres", "radii") else np.int64
            setattr(tree, name, np.frombuffer(parts[name], kind))
        tree.vectors = tree.vectors.reshape(len(tree.rows), -1)
        tree.centres = tree.centres.reshape(len(tree.radii), -1)
        tree.spans = tree.spans.reshape(-1, 2)
        tree.prepare()
        return tree

    def search(
        self, row: int, query: np.ndarray, k: int, score: float, worst: int
    ) -> list[tuple[int, int]]:
        """The best (score, id), k at most, of other rows that beat a kth (score, worst id)."""
        if len(query) != self.vectors.shape[1]:
            wide = np.zeros(self.vectors.shape[1], np.int64)
            shared = min(len(query), len(wide))
            wide[:shared] = query[:shared]
            query = wide
        values = query.astype(np.float64)
        # Sums of products stay below the product of norms, so floats are exact below it.
        exact = self.norm * math.sqrt(float(values @ values)) < FLOAT_EXACT
        left, right = (self.values, values) if exact else (self.vectors, query)
        bounds = upper_bounds(values, self.centres, self.radii).tolist()
        starts, stops, children, least = self.lists
        best: list[tuple[int, int]] = []
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < score:
                break
            if -bound < score + 1 and least[node] >= worst:
                continue
            child = children[node]
            if child >= 0:
                for c in (child, child + 1):
                    if bounds[c] >= score:
                        heapq.heappush(queue, (-min(bounds[c], -bound), c))
                continue
            start, stop = starts[node], stops[node]
            scores = left[start:stop] @ right
            for i in np.flatnonzero(scores >= score).tolist():
                own, other = int(scores[i]), int(self.ids[start + i])
                if (own > score or other < worst) and self.rows[start + i] != row:
                    best.append((own, other))
            if len(best) >= k:
                best.sort(key=lambda x: (-x[0], x[1]))
                del best[k:]
                score, worst = best[-1]
        best.sort(key=lambda x: (-x[0], x[1]))
        return best


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Ids as integers; a null one, which comes last, as the largest."""
    return pc.fill_null(column, NO_ID).to_numpy()


def _vectors(df: DataFrame, vector: str, id_col: str, scale: float) -> DataFrame:
    """Valid rows with a number each, the numbers stored with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, found = scaled(batch.column(2), scale)
            own = [batch.column(i).take(pa.array(places)) for i in (0, 1)]
            made = pa.array([v.tobytes() for v in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*own, made], names=["row", "id", "vector"])

    ship(df.sparkSession)
    given = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    return stored(given.mapInArrow(run, _VECTORS), "vectors")


def _sample(vectors: DataFrame, rows: int) -> np.ndarray:
    """About SAMPLE_ROWS vectors from all over the table, twice as many at most."""
    every = max(1, rows // SAMPLE_ROWS)
    chosen = vectors.where(F.pmod(F.xxhash64("row"), F.lit(every)) == 0)
    found = chosen.select("vector").limit(2 * SAMPLE_ROWS).toArrow()["vector"]
    if not len(found):
        return np.zeros((0, 1))
    return matrix(found, width(found)).astype(np.float64)


def _placed(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Every vector with its nearest region and an upper bound of its distance to the centre.

    The centres, REGIONS at most, go with the function.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            wide = max(centres.shape[1], width(batch.column(2)))
            around = np.pad(centres, ((0, 0), (0, wide - centres.shape[1])))
            own, distance = nearest_centre(matrix(batch.column(2), wide).astype(np.float64), around)
            made = [pa.array(own, pa.int32()), pa.array(distance, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made], names=["row", "id", "vector", "region", "distance"]
            )

    return stored(vectors.mapInArrow(run, _PLACED), "placed")


def _trees(placed: DataFrame) -> DataFrame:
    """(region, shard, and the tree's arrays), one row for each shard."""

    def build(key: tuple, table: pa.Table) -> pa.Table:
        vectors = matrix(table["vector"], width(table["vector"]))
        tree = BallTree(table["row"].to_numpy(), _ids(table["id"]), vectors)
        parts = {name: pa.array([part], pa.binary()) for name, part in tree.packed().items()}
        own = {n: pa.array([k.as_py()], pa.int32()) for n, k in zip(("region", "shard"), key, strict=True)}
        return pa.table(own | parts)

    schema = "region int, shard int, " + ", ".join(f"{name} binary" for name in BallTree.PARTS)
    return stored(placed.groupBy("region", "shard").applyInArrow(build, schema), "trees")


def _searched(trees: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """What the queries find in the shards they were sent to: k candidates a shard at most.

    A shard's queries come in blocks, each with a copy of its tree. Queries bring their kth
    score and id, or nulls.
    """

    def search(key: tuple, trees: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(queries):
            parts = {name: trees[name][0].as_buffer() for name in BallTree.PARTS}
            tree = BallTree.unpacked(parts)
            scores, worst = queries["kth"].to_pylist(), _ids(queries["worst"]).tolist()
            names = queries["row"].to_pylist(), queries["id"].to_pylist()
            for i, (row, query, vector) in enumerate(zip(*names, queries["vector"], strict=True)):
                own = np.frombuffer(vector.as_buffer(), np.int64)
                score = -math.inf if scores[i] is None else scores[i]
                best = tree.search(row, own, k, score, worst[i])
                found += [(row, query, None if x == NO_ID else x, s) for s, x in best]
        columns = zip(*found, strict=True) if found else ((), (), (), ())
        names = ("row", "query", "id", "score")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    key = ["region", "shard", "block"]
    # New names, as both sides of the grouping may come from the same table.
    trees = trees.select(*[F.col(c).alias(c) for c in (*key, *BallTree.PARTS)])
    queries = queries.select(*key, "row", "id", "vector", "kth", "worst")
    return trees.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(search, _FOUND)


def _first_k(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _routed(queries: DataFrame, centres: np.ndarray, regions: list) -> DataFrame:
    """One row for each query and shard, but its own, whose ball can beat its kth score."""
    radius, least, shards = (np.zeros(len(centres)), np.full(len(centres), NO_ID), [0] * len(centres))
    for found in regions:
        radius[found.region], shards[found.region] = found.radius, found.shards
        least[found.region] = NO_ID if found.least is None else found.least
    radius = padded(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {n: batch.column(n).to_pylist() for n in ("region", "shard", "kth")}
            worst = _ids(batch.column("worst"))
            places, region, shard = [], [], []
            for i, vector in enumerate(batch.column("vector")):
                query = np.frombuffer(vector.as_buffer(), np.int64).astype(np.float64)
                wide = max(len(query), centres.shape[1])
                around = np.pad(centres, ((0, 0), (0, wide - centres.shape[1])))
                bounds = upper_bounds(np.pad(query, (0, wide - len(query))), around, radius)
                kth = -math.inf if own["kth"][i] is None else own["kth"][i]
                better = (bounds >= kth + 1) | ((bounds >= kth) & (least < worst[i]))
                for r in np.flatnonzero(better).tolist():
                    others = [s for s in range(shards[r]) if (r, s) != (own["region"][i], own["shard"][i])]
                    places += [i] * len(others)
                    region += [r] * len(others)
                    shard += others
            names = ["row", "id", "vector", "kth", "worst"]
            taken = [batch.column(n).take(pa.array(places, pa.int64())) for n in names]
            made = [pa.array(region, pa.int32()), pa.array(shard, pa.int32())]
            yield pa.RecordBatch.from_arrays(taken + made, names=[*names, "region", "shard"])

    return queries.mapInArrow(run, f"{_VECTORS}, kth long, worst long, region int, shard int")


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each query.

    is_query is a condition on the column id, the rows' ids as long.
    """
    vectors = _vectors(df, vector, id_col, scale)
    rows = vectors.count()
    sample = _sample(vectors, rows)
    wanted = min(REGIONS, max(1, math.ceil(rows / SHARD_ROWS)))
    centres = fit_centres(sample, wanted) if len(sample) else np.zeros((1, 1))
    placed = _placed(vectors, centres)
    regions = placed.groupBy("region").agg(
        F.max("distance").alias("radius"),
        F.min("id").alias("least"),
        F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards"),
    )
    regions = stored(regions, "regions")
    dealt = placed.drop("distance").join(F.broadcast(regions.select("region", "shards")), "region")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("row"), F.col("shards")).cast("int"))
    trees = _trees(dealt)
    queries = stored(dealt.where(is_query).drop("shards"), "queries")

    unknown = {n: F.lit(None).cast("long") for n in ("kth", "worst")}
    first = queries.withColumns(unknown | {"block": F.lit(0)})
    found = stored(_searched(trees.withColumn("block", F.lit(0)), first, k), "found")
    # The kth candidate; with fewer, every shard can add some.
    order = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.coalesce("id", F.lit(NO_ID)).alias("i"))))
    kth = found.groupBy("row").agg(order.alias("best")).where(F.size("best") == k)
    last = F.col("best")[k - 1]
    kth = kth.select("row", (-last["s"]).alias("kth"), last["i"].alias("worst"))
    known = queries.join(kth, "row", "left")
    routed = stored(_routed(known, centres, regions.collect()), "routed")
    load = routed.groupBy("region", "shard").agg(
        F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("blocks")
    )
    load = stored(load, "load")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    copies = trees.join(load, ["region", "shard"]).withColumn("block", every)
    block = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    sent = routed.join(load, ["region", "shard"]).withColumn("block", block)
    return _first_k(found.unionByName(_searched(copies, sent, k)), k).select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"
    )
