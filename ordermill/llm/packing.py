"""Best-fit packing of tokenized documents into sequences, with a vector of capacities.

Each document's ids and an end id are cut into pieces of at most the sequence length, only
where it is longer. A sequence has three capacities: tokens, documents and attention cost
(the sum of squared lengths). Pieces are taken longest first; of the open sequences that can
take a piece under every constraint, the one is chosen whose residual vector, as shares of
the capacities and weighted, is shortest afterwards ("norm"), or whose residual has the
largest weighted dot product with the piece ("dot"). If none can, a sequence is opened.

Pieces are dealt out evenly to shards of bounded size and each shard is packed by a task, so
nothing global is gathered; a shard leaves about one sequence unfilled. By default only the
tokens bind, as the other capacities allow whatever fits. Null texts count as empty and are
the end id alone; repeated rows are packed each.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from ordermill.llm.bpe import Encoder, split_ids
from ordermill.llm.common import map_texts, ship, stored

SHARD_PIECES = 16_384


class Capacity(NamedTuple):
    """What a sequence can hold, and how much each part counts when choosing one."""

    tokens: int = 4096
    documents: int = 4096
    cost: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"


PIECE_FIELDS = [
    StructField("_lengths", ArrayType(LongType())),
    StructField("_crcs", ArrayType(LongType())),
]


def cut_pieces(
    df: DataFrame, path: str, size: int, end_id: int = 1, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows of id_col, piece (from 0), start, length and ids_crc32."""
    end = end_id.to_bytes(4, "little")

    def start() -> Callable[[pa.Array], list]:
        encoder = Encoder(path)

        def cut(texts: pa.Array) -> list:
            lengths, crcs = [], []
            for ids in split_ids(*encoder.encode(texts)):
                ids += end
                parts = [ids[i : i + 4 * size] for i in range(0, len(ids), 4 * size)]
                lengths.append([len(p) // 4 for p in parts])
                crcs.append([zlib.crc32(p) for p in parts])
            return [lengths, crcs]

        return cut

    made = map_texts(df.select(id_col, text), text, PIECE_FIELDS, start, drop_text=True)
    pieces = made.select(id_col, F.posexplode(F.arrays_zip("_lengths", "_crcs")))
    return pieces.select(
        id_col,
        F.col("pos").alias("piece"),
        (F.col("pos").cast("long") * size).alias("start"),
        F.col("col._lengths").alias("length"),
        F.col("col._crcs").alias("ids_crc32"),
    )


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """The sequence (from 0) and the offset there of each piece."""
    most = np.array([capacity.tokens, capacity.documents, capacity.cost], np.float64)
    weights = np.array(capacity.weights)
    order = np.argsort(-lengths, kind="stable")
    sequence = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    shortest = int(lengths.min(initial=1))
    # Open sequences: what is left of each capacity, as columns, and their numbers.
    left = np.zeros((3, 1024))
    numbers = np.zeros(1024, np.int64)
    n_open, opened = 0, 0
    for i in order:
        length = int(lengths[i])
        need = np.array([length, 1.0, float(length) * length])
        if (need > most).any():
            raise ValueError(f"a piece of {length} tokens exceeds a sequence's capacity")
        rest = left[:, :n_open] - need[:, None]
        fits = np.flatnonzero((rest >= 0).all(axis=0))
        if len(fits):
            if capacity.rule == "dot":
                shares = left[:, fits] / most[:, None]
                at = fits[np.argmax((weights * need / most) @ shares)]
            else:
                shares = rest[:, fits] / most[:, None]
                at = fits[np.argmin(weights @ (shares * shares))]
        else:
            if n_open == left.shape[1]:
                left = np.concatenate([left, np.zeros_like(left)], axis=1)
                numbers = np.concatenate([numbers, np.zeros_like(numbers)])
            at = n_open
            left[:, at] = most
            numbers[at] = opened
            n_open += 1
            opened += 1
        sequence[i] = numbers[at]
        offset[i] = capacity.tokens - int(left[0, at])
        left[:, at] -= need
        if left[0, at] < shortest or left[1, at] < 1:
            # Nothing fits any more: the last open one takes its place.
            n_open -= 1
            left[:, at], numbers[at] = left[:, n_open], numbers[n_open]
    return sequence, offset


def pack_pieces(pieces: DataFrame, capacity: Capacity, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """pieces, which has a length, with sequence_id and offset."""
    ship(pieces.sparkSession)
    fixed = stored(pieces, "pieces")
    shards = max(1, math.ceil(fixed.count() / shard_pieces))
    # Row numbers of a written table are the same when a task is run again.
    dealt = fixed.withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    schema = pieces.schema.add("sequence_id", LongType()).add("offset", LongType())
    names = schema.names

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = best_fit(rows["length"].to_numpy(), capacity)
        rows["sequence_id"] = (int(key[0]) << 32) + sequence
        rows["offset"] = offset
        return rows[names]

    return dealt.groupBy("_shard").applyInPandas(pack, schema)


def pack_texts(
    df: DataFrame,
    path: str,
    capacity: Capacity = Capacity(),
    end_id: int = 1,
    id_col: str = "doc_id",
    text: str = "text",
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """id_col, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    pieces = cut_pieces(df, path, capacity.tokens, end_id, id_col, text)
    return pack_pieces(pieces, capacity, shard_pieces)
