"""Exact dedup by sorting contents: equal texts become neighbours and are compared whole.

Texts are equal when they are identical after lower-casing A-Z. Sampled splitters
range-partition the normalised texts, each partition is sorted (spilling to disk as needed),
and a window over neighbours with the whole text as its key finds the equal ones. A text
that very many rows share is first found by its digest and dealt out over several keys;
its parts are then compared again, one row per part.

Null texts count as empty, empty texts are equal to each other. Of equal texts the largest
id stays (a null id only if no other is there); of rows that share this id, one stays.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import LOWER, UPPER, keep_once, stored

# Bytes of text for a sorted partition. A group is dealt out from HOT_ROWS rows on, or from
# a share of 1 / HOT_TEXTS of all rows, so that at most HOT_TEXTS digests are broadcast.
PARTITION_BYTES = 32_000_000
HOT_ROWS = 500
HOT_TEXTS = 100_000
# Characters of a text that the sampled splitters compare.
BEGIN_CHARS = 48


def normalised(text: str) -> Column:
    """The text with A-Z in lower case; lower() does the same where all is ASCII."""
    whole = F.coalesce(F.col(text), F.lit(""))
    ascii_only = F.octet_length(whole) == F.char_length(whole)
    return F.when(ascii_only, F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's id with keep_id, group_size, kept and text_sha256.

    Other input columns are not returned; join the result, or use drop_duplicates.
    """
    texts = df.select(F.col(id_col).alias("_id"), normalised(text).alias("_norm"))
    digests = texts.select(
        F.sha2("_norm", 256).alias("text_sha256"), F.octet_length("_norm").alias("size")
    )
    counts = stored(
        digests.groupBy("text_sha256").agg(
            F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")
        ),
        "digests",
    )
    total = counts.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    width = max(1, math.ceil((total.bytes or 0) / PARTITION_BYTES))
    hot_rows = max(HOT_ROWS, (total.n or 0) // HOT_TEXTS)
    hot = counts.where(F.col("n") > hot_rows).select(
        "text_sha256", F.ceil(F.col("n") / hot_rows).cast("int").alias("_parts")
    )
    keyed = (
        texts.withColumn("text_sha256", F.sha2("_norm", 256))
        .join(F.broadcast(hot), "text_sha256", "left")
        .withColumn(
            "_part",
            F.when(F.col("_parts") > 1, F.pmod(F.xxhash64("_id"), F.col("_parts"))).otherwise(0),
        )
    )
    # The driver samples splitters, so what they compare is short: the text's beginning, then
    # its digest. Rows are sorted by these, and neighbours are equal if their whole texts are.
    # The window needs the order and the partitions that the sort has made already.
    keyed = keyed.withColumn("_begin", F.substring("_norm", 1, BEGIN_CHARS))
    place = ["_begin", "text_sha256", "_part"]
    ranged = keyed.repartitionByRange(max(2, width), *place).sortWithinPartitions(
        *place, "_norm", F.desc_nulls_last("_id")
    )
    equal = Window.partitionBy(*place, "_norm")
    ordered = equal.orderBy(F.desc_nulls_last("_id"))
    whole = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = ranged.select(
        "_id",
        "text_sha256",
        "_parts",
        "_part",
        F.row_number().over(ordered).alias("_rank"),
        F.max("_id").over(whole).alias("_top"),
        F.count(F.lit(1)).over(whole).alias("_size"),
        F.when(F.col("_parts").isNotNull() & (F.row_number().over(ordered) == 1), F.col("_norm"))
        .alias("_head"),
    )
    local = stored(local, "sorted")
    # One row for each part of a hot text, with the text itself: compared whole once more.
    heads = (
        local.where(F.col("_head").isNotNull())
        .groupBy("_head", "text_sha256")
        .agg(
            F.max("_top").alias("_all_top"),
            F.sum("_size").alias("_all_size"),
            F.max_by("_part", F.struct(F.col("_top"), -F.col("_part"))).alias("_first"),
        )
        .drop("_head")
    )
    merged = local.drop("_head").join(F.broadcast(heads), "text_sha256", "left")
    return merged.select(
        F.col("_id").alias(id_col),
        F.coalesce("_all_top", "_top").alias("keep_id"),
        F.coalesce("_all_size", "_size").cast("long").alias("group_size"),
        ((F.col("_rank") == 1) & F.coalesce(F.col("_part") == F.col("_first"), F.lit(True)))
        .alias("kept"),
        "text_sha256",
    )


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df whose text stays, all columns as they are.

    Rows that repeat one id and text are one row afterwards.
    """
    groups = exact_groups(df, id_col, text).where("kept")
    kept = groups.select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha"))
    return keep_once(df, F.sha2(normalised(text), 256), id_col, kept)
