"""Helpers the operators share: shared storage, shipped code, and text batches.

Conventions that every operator keeps:

* A null text counts as an empty one. Null ids are kept as they are.
* Repeated rows are separate rows and get the same values.
* Empty tables give empty results with the same schema.
* An operator that adds columns replaces input columns of these names, whatever their case.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Text bytes that one call of a batch function gets; a longer single text comes alone.
SLICE_BYTES = 1_000_000
# Pieces that a sample takes of a text too long for the driver.
PIECES = 8

WORD_BREAKS = "\\x20\\x09-\\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_folders: dict[str, str] = {}
_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local session without it, as in tests, gets its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id")
    if app not in _folders:
        _folders[app] = tempfile.mkdtemp(prefix="ordermill-llm-")
    return _folders[app]


def stored(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: evaluated once, its lineage cut."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held(df: DataFrame) -> DataFrame:
    """df on the executors' disks, where Spark keeps it: evaluated once, a lost block again.

    Tasks write no files here. On a local file system Hadoop starts a process for every file that
    is made (chmod), which shares the executor's memory until it runs, so the executor seems
    twice its size; stages that read whole texts are the worst place for that.
    """
    # A condition of its own, or Spark would take rows that it keeps for an equal plan, though
    # the files may have changed since.
    own = df.where(F.lit(uuid.uuid4().hex).isNotNull()).persist(StorageLevel.DISK_ONLY)
    own.count()
    return own


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as the functions need it."""
    app = spark.conf.get("spark.app.id")
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="ordermill-code-"), "ordermill_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, top))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """df without the columns of these names, whatever their case."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores as no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_once(df: DataFrame, sha: Column, id_col: str, kept: DataFrame) -> DataFrame:
    """Rows of df whose id and digest are in kept (_id, _sha), one of those that repeat.

    Of rows that differ in other columns only, the one with the least hash of all its columns
    stays. One key column serves the join and the window, so df is shuffled once; df's columns
    are one struct meanwhile, so that none can have the name of another.
    """

    def key(id_value: Column, digest: Column) -> Column:
        return F.concat_ws(":", digest, F.coalesce(id_value.cast("string"), F.lit("null")))

    keys = kept.select(key(F.col("_id"), F.col("_sha")).alias("key"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    found = df.select(row, key(F.col(f"`{id_col}`"), sha).alias("key")).join(keys, "key", "left_semi")
    once = Window.partitionBy("key").orderBy(F.xxhash64("row"))
    copies = found.withColumn("copy", F.row_number().over(once)).where("copy = 1")
    return copies.select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns])


def learnable(df: DataFrame, labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """Ids (_id) with label 0 or 1 (_label) that have a row in df.

    An id labelled both ways counts as 1; a null id has no label.
    """
    once = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label).cast("int").alias("_label"))
    )
    return once.join(df.select(F.col(f"`{id_col}`").alias("_id")), "_id", "left_semi")


def label_share(df: DataFrame, labels: DataFrame, id_col: str, label: str) -> float | None:
    """The share of label 1 among all ids that can be learned from, None without any."""
    return learnable(df, labels, id_col, label).agg(F.avg("_label").alias("share")).first().share


def chosen_texts(
    df: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, rows: int
) -> DataFrame:
    """A bounded sample of labelled texts (_id, _label, _text), the same ones in every run.

    Of each label, 0 and 1, the first ids in an order of hashes that have a row in df, rows at
    most, with texts of every length, whole; of rows with one id, the least text is taken. They
    are written once to the shared folder.
    """
    known = stored(learnable(df, labels, id_col, label), "labelled")
    order = [F.xxhash64("_id"), F.col("_id")]
    zeros, ones = (known.where(F.col("_label") == y).orderBy(*order).limit(rows) for y in (0, 1))
    texts = df.select(
        F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text")
    )
    # At most 2 * rows ids.
    found = texts.join(F.broadcast(zeros.unionByName(ones)), "_id")
    return stored(found.groupBy("_id", "_label").agg(F.min("_text").alias("_text")), "sample")


def drawn(chosen: DataFrame, size: int) -> list[tuple[bytes, int]]:
    """The chosen texts and labels for the driver, in an order of hashed ids.

    Texts of at most size bytes come whole. Longer ones give PIECES pieces, size bytes together,
    spread evenly from their first to their last byte, without words that the cuts go through.
    """
    raw, part = F.col("_text").cast("binary"), size // PIECES
    span = F.octet_length("_text").cast("long") - part
    starts = [F.floor(span * i / (PIECES - 1)).cast("int") for i in range(PIECES)]
    pieces = [raw.substr(start + 1, F.lit(part)) for start in starts]
    cut = F.when(F.octet_length("_text") <= size, F.array(raw)).otherwise(F.array(*pieces))
    found = chosen.select("_id", "_label", cut.alias("_pieces")).orderBy(F.xxhash64("_id"), "_id")
    return [(_whole_words([bytes(p) for p in row["_pieces"]]), row["_label"]) for row in found.collect()]


def _whole_words(pieces: list[bytes]) -> bytes:
    """Pieces of a text end to end, without the words cut at their borders, if others are left."""
    kept = []
    for i, piece in enumerate(pieces):
        words = piece.split()
        first, last = int(i > 0), len(words) - int(i < len(pieces) - 1)
        kept.append(piece if len(pieces) == 1 or last <= first else b" ".join(words[first:last]))
    return b" ".join(kept)


def slices(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of the batch with about limit bytes of text, and their texts as binary."""
    texts = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        part = batch.slice(start, stop - start)
        own = texts.slice(start, stop - start)
        yield part, pc.fill_null(own.cast(pa.large_binary()), b"")
        start = stop


def map_texts(
    df: DataFrame,
    text: str,
    fields: list[StructField],
    start: Callable[[], Callable[[pa.Array], list]],
    limit: int = SLICE_BYTES,
    drop_text: bool = False,
) -> DataFrame:
    """df with fields that a function makes from batches of whole texts.

    start is called once per task; the function it returns gets a binary array of texts
    without nulls and gives one list or array per field. Memory is bounded by limit bytes
    of text, or by the longest single text.
    """
    ship(df.sparkSession)
    names = [f.name for f in fields]
    kept = without(df, [n for n in names if n.lower() != text.lower()])
    carried = [c for c in kept.columns if not (drop_text and c.lower() == text.lower())]
    schema = StructType([kept.schema[c] for c in carried] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        types = None
        for batch in batches:
            if types is None:
                from pyspark.sql.pandas.types import to_arrow_schema

                types = to_arrow_schema(schema)
            for part, texts in slices(batch, text, limit):
                made = make(texts)
                own = [part.column(part.schema.get_field_index(c)) for c in carried]
                new = [
                    pa.array(values, type=types.field(name).type)
                    for name, values in zip(names, made, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(own + new, names=carried + names)

    return kept.mapInArrow(run, schema)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_binary array end to end, and the offsets of its texts."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
BREAK = np.zeros(256, bool)
BREAK[[9, 10, 11, 12, 13, 32]] = True
ODD = np.uint64(0x9E3779B97F4A7C15)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of flat texts, and the number of words per text."""
    inner = ~BREAK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inner.copy()
    first[1:] &= ~inner[:-1] | edge[1:-1]
    last = inner.copy()
    last[:-1] &= ~inner[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n; base is odd."""
    made = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(max(n, 1), factor, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=np.uint64)[:n])
    return made[0], made[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a hash depend on all of its input."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


class SpanHasher:
    """64-bit hashes of byte spans, in numpy, from prefix sums of byte * base**position."""

    def __init__(self, base: int = 0x9E3779B97F4A7C15) -> None:
        self.base = base
        self.up, self.down = powers(0, base)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) < len(data) + 1:
            self.up, self.down = powers(len(data) + 1 + SLICE_BYTES, self.base)
        with np.errstate(over="ignore"):
            sums = (data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)]
            return np.concatenate([np.zeros(1, np.uint64), np.cumsum(sums, dtype=np.uint64)])

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((prefix[ends] - prefix[starts]) * self.down[starts])


def summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of values with these lengths, empty runs included."""
    ends = np.cumsum(counts)
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[ends] - total[ends - counts]
