"""Connected components by repeated shuffles of edges, for graphs of any size and shape.

Large-star and small-star rounds: each node hangs its larger neighbours, then its smaller ones,
on the smallest it knows, until nothing changes and every node hangs on its component's
smallest. Minima are pre-aggregated, each round is a written table, and the driver sees only
a count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ordermill.llm.common import stored


def _measured(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct edges as a written table, with their number and a checksum."""
    seen = Observation()
    checksum = F.bit_xor(F.xxhash64("a", "b")).alias("sum")
    observed = edges.distinct().observe(seen, F.count(F.lit(1)).alias("n"), checksum)
    table = stored(observed, "edges")
    return table, (seen.get["n"], seen.get["sum"])


def _star(neighbours: DataFrame, larger: bool) -> DataFrame:
    """Hang neighbours b of each a on the least that a knows, itself included."""
    least = neighbours.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    hung = neighbours.join(least, "a")
    if larger:
        moved = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.select("a", F.col("m").alias("b")))
    return moved.where("a != b")


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Every node of edges (two columns of numbers) as node, with component, its least node.

    Edges to itself and repeated edges change nothing; no edges give an empty table.
    """
    high, low = F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    now, before = _measured(edges.select(high, low).where("a != b"))
    while before[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large, _ = _measured(_star(both, larger=True))
        now, after = _measured(_star(large, larger=False))
        if after == before:
            break
        before = after
    hung = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return hung.union(now.select("b", "b").distinct())
