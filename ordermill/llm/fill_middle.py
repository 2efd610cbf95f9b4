"""Fill-in-the-middle texts by in-place block rotation, and their exact restoration.

A text of n code points is cut into prefix, middle and suffix at two places that hashes of its
id choose. The text is put into one bytearray, sentinels are inserted at the cuts, and blocks
change places by rotations, each made of three reversals:

    psm   <P>prefix [<M>middle][<S>suffix]  ->  <P>prefix<S>suffix<M>middle
    spm   [<P>prefix<M>middle][<S>suffix]   ->  <S>suffix<P>prefix<M>middle

Restoring finds the sentinels, rotates back and deletes them. They cannot be mistaken: a text
that contains one stays plain, and a sentinel has its "<" only in front, so none can arise
across a border.

Null texts count as empty, empty texts stay plain, a null id counts as an empty text in its
hash, and repeated rows get equal results. Memory is bounded by a batch, or by one long text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ordermill.llm.common import SLICE_BYTES, flat, ship, slices, without

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Of 100 texts, from which on they stay plain, and below which the others put the suffix first.
PLAIN_FROM, SPM_BELOW = 90, 20

RESULTS = ["n", "form", "prefix_chars", "middle_chars", "fim_text"]


def reverse(block: np.ndarray) -> None:
    """Reverse the bytes of a view in place."""
    half = len(block) // 2
    if half:
        front = block[:half].copy()
        block[:half] = block[: -half - 1 : -1]
        block[-half:] = front[::-1]


def rotate(block: np.ndarray, first: int) -> None:
    """Exchange the first bytes of a view and the rest of it, in place."""
    reverse(block[:first])
    reverse(block[first:])
    reverse(block)


def arranged(text: bytes, cut: int, end: int, form: str) -> bytearray:
    """The text with its middle, text[cut:end], at the end, in the order of the form."""
    buffer = bytearray(text)
    buffer[end:end] = SUFFIX
    buffer[cut:cut] = MIDDLE
    buffer[0:0] = PREFIX
    suffix = end + len(PREFIX) + len(MIDDLE)
    start = len(PREFIX) + cut if form == PSM else 0
    rotate(np.frombuffer(buffer, np.uint8)[start:], suffix - start)
    return buffer


def restored(output: bytes, form: str) -> bytearray:
    """The text that arranged() was given."""
    buffer = bytearray(output)
    if form == PLAIN:
        return buffer
    start = buffer.index(SUFFIX)
    # The block after the suffix is the first one again.
    first = buffer.index(MIDDLE if form == PSM else PREFIX)
    rotate(np.frombuffer(buffer, np.uint8)[start:], first - start)
    for sentinel in (PREFIX, MIDDLE, SUFFIX):
        at = buffer.index(sentinel)
        del buffer[at : at + len(sentinel)]
    return buffer


def byte_places(texts: pa.Array, chars: np.ndarray) -> np.ndarray:
    """Byte offsets, within each text, of the code point with this number (or of its end)."""
    data, offsets = flat(texts)
    leads = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    return leads[np.searchsorted(leads, offsets[:-1]) + chars] - offsets[:-1]


def _mapped(df: DataFrame, inputs: list[Column], outputs: list[StructField], make, kept: list[str]):
    """df's kept columns and what make returns from slices of the inputs, the first a text.

    Inside, columns go by their places, so that no name of df's can clash with another.
    """
    ship(df.sparkSession)
    placed = [F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(kept)]
    frame = df.select(*placed, *[c.alias(f"input{i}") for i, c in enumerate(inputs)])
    others = [f"input{i}" for i in range(1, len(inputs))]
    carried = [f"kept{i}" for i in range(len(kept))]
    schema = StructType([frame.schema[c] for c in carried] + outputs)
    types = {"string": pa.string(), "bigint": pa.int64()}
    arrow = [types[f.dataType.simpleString()] for f in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "input0", SLICE_BYTES):
                values = [part.column(c) for c in others]
                made = [
                    pa.array(column, type=kind)
                    for column, kind in zip(make(texts, *values), arrow, strict=True)
                ]
                own = [part.column(c) for c in carried]
                yield pa.RecordBatch.from_arrays(own + made, names=schema.names)

    mapped = frame.mapInArrow(run, schema)
    names = kept + [f.name for f in outputs]
    return mapped.select(
        *[F.col(c).alias(n) for c, n in zip(schema.names, names, strict=True)]
    )


def fill_in_middle(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", drop_text: bool = False
) -> DataFrame:
    """df with n, form, prefix_chars, middle_chars (code points, null if plain) and fim_text.

    Input columns of these names are replaced.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = F.concat(F.lit("1:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    digest = F.sha2(key, 256)
    h1, h2, h3, h4 = (
        F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)
    )
    n = F.char_length(whole).cast("long")
    marked = [F.contains(whole, F.lit(s.decode())) for s in (PREFIX, SUFFIX, MIDDLE)]
    stays = (n == 0) | marked[0] | marked[1] | marked[2] | (h3 % 100 >= PLAIN_FROM)
    form = F.when(stays, PLAIN).when(h4 % 100 < SPM_BELOW, SPM).otherwise(PSM)
    cut, end = F.least(h1 % (n + 1), h2 % (n + 1)), F.greatest(h1 % (n + 1), h2 % (n + 1))

    def make(texts: pa.Array, n: pa.Array, form: pa.Array, cut: pa.Array, end: pa.Array) -> list:
        chars = cut.to_numpy(), end.to_numpy()
        places = [byte_places(texts, c).tolist() for c in chars]
        forms = form.to_pylist()
        made = [
            value if kind == PLAIN else bytes(arranged(value, a, b, kind))
            for value, kind, a, b in zip(texts.to_pylist(), forms, *places, strict=True)
        ]
        plain = np.array([kind == PLAIN for kind in forms], bool)
        prefix = pa.array(chars[0], mask=plain)
        middle = pa.array(chars[1] - chars[0], mask=plain)
        return [n, form, prefix, middle, pa.array(made, pa.binary()).cast(pa.string())]

    outputs = [StructField(c, LongType()) for c in RESULTS]
    outputs[1], outputs[4] = (StructField(c, StringType()) for c in ("form", "fim_text"))
    gone = RESULTS + ([text] if drop_text else [])
    return _mapped(df, [whole, n, form, cut, end], outputs, make, without(df, gone).columns)


def restore(df: DataFrame, text: str = "fim_text", form: str = "form") -> DataFrame:
    """df with restored, the text that fill_in_middle had, from its output and form alone."""

    def make(texts: pa.Array, forms: pa.Array) -> list:
        made = [
            bytes(restored(value, kind))
            for value, kind in zip(texts.to_pylist(), forms.to_pylist(), strict=True)
        ]
        return [pa.array(made, pa.binary()).cast(pa.string())]

    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    shape = F.coalesce(F.col(f"`{form}`"), F.lit(PLAIN))
    kept = without(df, ["restored"]).columns
    return _mapped(df, [whole, shape], [StructField("restored", StringType())], make, kept)
