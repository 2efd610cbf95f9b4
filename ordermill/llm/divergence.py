"""How the sources of each language differ in the words they use: an audit in exact integers.

Terms are runs of ASCII letters (only A-Z lower-cased) and of code points beyond ASCII. Each
language keeps the V terms that occur in at least min_docs of its documents. A (lang, source)
group gives a kept term p = 1 + floor(10^9 * (count + 5) / (N + 5 * V)), N its count of all kept
terms; a language does so with the counts of all its sources. Two lists come out:

pair   for each group every other source of its language, by the sum of |p - p'| over all
       kept terms;
term   for each group the terms it uses more than its language does, by p - q.

Terms of a group with equal counts, in the group and in the language, share one value. So the
term list is made of count cells: a cell is evaluated once, cells of equal value are merged,
ranked by cumulative multiplicity, and only those that reach the first ranks are expanded to
their terms, in UTF-8 order. Sums over pairs are added up in blocks of sources by slices of
terms, each task holding one dense block; terms that no source of a block has are added by
their number, as their summand is the same. So no pairs are made term by term.

Null texts, languages and sources count as empty ones, repeated rows are separate documents,
and a group without terms takes part with counts of zero. A language without kept terms has
pairs of value 0. Ties are ranked by item in UTF-8 order. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import ship, stored

SCALE, EXTRA = 1_000_000_000, 5
# Distinct terms that a task counts before it hands them on.
HELD_TERMS = 300_000
# Bytes of a text that are split at once, and rows of an emitted batch.
PIECE_BYTES, BATCH_ROWS = 1_000_000, 50_000
# Sources on a side of a dense block, and about how many terms it has.
BLOCK, SLICE_TERMS = 64, 8192

# Everything but ASCII letters and bytes of longer code points parts terms.
_LETTERS = bytes(range(97, 123))
_FOLD = bytes(
    b if b >= 128 or b in _LETTERS else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
_BREAK = re.compile(rb"[^A-Za-z\x80-\xff]")

_COUNTED = "lang string, source string, term string, n long, docs long"


def split_terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    start = 0
    while start < len(text):
        cut = _BREAK.search(text, start + PIECE_BYTES)
        stop = cut.start() if cut else len(text)
        yield text[start:stop].translate(_FOLD).split()
        start = stop


class TermCounts:
    """Counts of terms and of documents by group, handed on when there are many."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.held = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts, docs = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before = len(counts)
        seen: set[bytes] = set()
        for terms in split_terms(text):
            counts.update(terms)
            seen.update(terms)
        docs.update(seen)
        self.held += len(counts) - before

    def take(self) -> Iterator[pa.RecordBatch]:
        """All counts, and a row without a term for each group; nothing is held afterwards."""
        for (lang, source), (counts, docs) in self.groups.items():
            terms = list(counts)
            for start in range(0, max(1, len(terms)), BATCH_ROWS):
                part = terms[start : start + BATCH_ROWS]
                rows = [*part, None] if start == 0 else part
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(rows), pa.string()),
                        pa.array([source] * len(rows), pa.string()),
                        pa.array(rows, pa.binary()).cast(pa.string()),
                        pa.array([counts[t] for t in rows], pa.int64()),
                        pa.array([docs[t] for t in rows], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )
        self.groups.clear()
        self.held = 0


def term_counts(df: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs) over all texts, and one row per group without a term."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = TermCounts()
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, value in enumerate(batch.column(2)):
                counts.add(langs[i], sources[i], value.as_buffer().to_pybytes())
                if counts.held >= HELD_TERMS:
                    yield from counts.take()
        yield from counts.take()

    columns = [
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
        for c, name in ((lang, "lang"), (source, "source"), (text, "text"))
    ]
    found = df.select(*columns).mapInArrow(run, _COUNTED)
    return found.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + EXTRA) / (total + EXTRA * terms)), null without terms."""

    def exact(column: Column) -> Column:
        return column.cast("decimal(19,0)")

    above = (exact(count) + F.lit(EXTRA)) * F.lit(SCALE)
    below = F.nullif(exact(total) + exact(F.lit(EXTRA) * terms), F.lit(0).cast("decimal(21,0)"))
    return F.lit(1) + F.call_function("div", above, below)


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """Counts of the kept terms with lang_n, and first for one row of each term of a language."""
    same = Window.partitionBy("lang", "term")
    marked = counts.where("term IS NOT NULL").select(
        "lang",
        "source",
        "term",
        "n",
        F.sum("n").over(same).alias("lang_n"),
        F.sum("docs").over(same).alias("lang_docs"),
        (F.row_number().over(same.orderBy("source")) == 1).cast("int").alias("first"),
    )
    return marked.where(F.col("lang_docs") >= min_docs).drop("lang_docs")


def group_totals(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """Every group with its place among its language's and with the totals of both."""
    groups = counts.where("term IS NULL").select("lang", "source")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    all_own = kept.groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.sum("first").alias("terms")
    )
    placed = groups.join(own, ["lang", "source"], "left").join(all_own, "lang", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("total", "lang_total", "terms")}
    peers = Window.partitionBy("lang")
    return (
        placed.withColumns(zero)
        .withColumn("place", F.row_number().over(peers.orderBy("source")) - 1)
        .withColumn("peers", F.count(F.lit(1)).over(peers))
        .withColumn("unseen", share(F.lit(0), F.col("total"), F.col("terms")))
    )


def ranked_terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The first terms of each group, by way of count cells."""
    cell = ["lang", "source", "n", "lang_n"]
    totals = groups.select("lang", "source", "total", "lang_total", "terms")
    excess = share(F.col("n"), F.col("total"), F.col("terms")) - share(
        F.col("lang_n"), F.col("lang_total"), F.col("terms")
    )
    cells = (
        kept.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("many"))
        .join(totals, ["lang", "source"])
        .select(*cell, "many", excess.alias("value"))
        .where("value > 0")
    )
    cells = stored(cells, "cells")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # Each value has a term at least, so only the first values can reach the first ranks.
    values = (
        cells.groupBy("lang", "source", "value")
        .agg(F.sum("many").alias("many"))
        .withColumn("number", F.row_number().over(best))
        .where(F.col("number") <= top)
        .withColumn("reached", F.sum("many").over(best.rowsBetween(Window.unboundedPreceding, -1)))
        .where(F.coalesce(F.col("reached"), F.lit(0)) < top)
        .select("lang", "source", "value")
    )
    chosen = stored(cells.join(values, ["lang", "source", "value"]).drop("many"), "chosen")
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        kept.join(chosen, cell)
        .select("lang", "source", F.col("term").alias("item"), "value")
        .withColumn("rank", F.row_number().over(ranks))
        .where(F.col("rank") <= top)
        .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    )


def block_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums of |p - p'| by pair of places, over the terms that a block has, and their number."""
    # Bound here, as the tasks get the function without the module's later changes.
    block = BLOCK
    blocks = F.ceil(F.col("peers") / block).cast("int")
    parts = F.greatest(F.ceil(F.col("terms") / SLICE_TERMS), F.lit(1)).cast("int")
    spread = groups.where("peers > 1 AND terms > 0").select(
        "lang", "source", "place", "total", "terms", "unseen", parts.alias("parts"),
        F.floor(F.col("place") / block).cast("int").alias("block"),
        F.sequence(F.lit(0), blocks - 1).alias("others"),
    )
    low, high = F.least("block", "other"), F.greatest("block", "other")
    entries = (
        kept.join(spread, ["lang", "source"])
        .select(
            "lang", "term", "place", "block", "others",
            share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
            F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("slice"),
        )
        .withColumn("other", F.explode("others"))
        .select("lang", low.alias("low"), high.alias("high"), "slice", "term", "place", "p")
    )
    bases = (
        spread.withColumn("other", F.explode("others"))
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        # New names, as both sides of the grouping come from the same table.
        .select(
            F.col("lang").alias("lang"), low.alias("low"), high.alias("high"), "slice",
            F.col("place").alias("at"), F.col("unseen").alias("base"),
        )
    )

    def add(key: tuple, entries: pa.Table, bases: pa.Table) -> pa.Table:
        lang, low, high = (value.as_py() for value in key[:3])
        order = np.argsort(bases["at"].to_numpy())
        places = bases["at"].to_numpy()[order]
        terms = entries["term"].combine_chunks().dictionary_encode()
        dense = np.tile(bases["base"].to_numpy()[order], (len(terms.dictionary), 1))
        columns = np.searchsorted(places, entries["place"].to_numpy())
        dense[terms.indices.to_numpy(), columns] = entries["p"].to_numpy()
        left, right = (np.flatnonzero(places // block == side) for side in (low, high))
        found = []
        for i in left:
            later = right[right > i]
            sums = np.abs(dense[:, later] - dense[:, i : i + 1]).sum(axis=0)
            found += [(places[i], places[j], s) for j, s in zip(later, sums, strict=True)]
        a, b, sums = zip(*found, strict=True) if found and len(dense) else ((), (), ())
        return pa.table(
            {
                "lang": pa.array([lang] * len(a), pa.string()),
                "a": pa.array(a, pa.int64()),
                "b": pa.array(b, pa.int64()),
                "sum": pa.array(sums, pa.int64()),
                "seen": pa.array([len(dense)] * len(a), pa.int64()),
            }
        )

    ship(kept.sparkSession)
    key = ["lang", "low", "high", "slice"]
    made = entries.groupBy(*key).cogroup(bases.groupBy(*key)).applyInArrow(
        add, "lang string, a long, b long, sum long, seen long"
    )
    return made.groupBy("lang", "a", "b").agg(F.sum("sum").alias("sum"), F.sum("seen").alias("seen"))


def ranked_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """For each group all other sources of its language; these pairs are the result's rows."""
    sums = block_sums(kept, groups)
    places = F.sequence(F.lit(0).cast("long"), F.col("peers") - 1)
    own = groups.select("lang", "source", "place", "terms", "unseen", F.explode(places).alias("to"))
    others = groups.select(
        "lang", F.col("place").cast("long").alias("to"), F.col("source").alias("item"),
        F.col("unseen").alias("to_unseen"),
    )
    pairs = (
        own.where("place <> to")
        .join(others, ["lang", "to"])
        .withColumns({"a": F.least("place", "to"), "b": F.greatest("place", "to")})
        .join(sums, ["lang", "a", "b"], "left")
    )
    unseen = F.col("terms") - F.coalesce(F.col("seen"), F.lit(0))
    rest = unseen * F.abs(F.col("unseen") - F.col("to_unseen"))
    value = F.coalesce(F.col("sum"), F.lit(0)) + F.coalesce(rest, F.lit(0))
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
        .withColumn("rank", F.row_number().over(ranks))
    )


def audit_sources(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = 30,
    top: int = 50,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of both lists; terms only to rank top."""
    counts = stored(term_counts(df, text, lang, source), "counts")
    kept = stored(kept_terms(counts, min_docs), "kept")
    groups = stored(group_totals(counts, kept), "groups")
    return ranked_pairs(kept, groups).unionByName(ranked_terms(kept, groups, top))
