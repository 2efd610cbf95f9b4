"""Surrogate keys and file row numbers without a one-task window.

Gapless numbers: rows are numbered inside each task while they are written to shared
storage. The written rows are counted per task, and the running sum of these counts
(one row per task) shifts the numbers of each task behind those of the tasks before it.

Numbers with gaps, as a sequence gives them, need none of this and no second write.
"""

from __future__ import annotations

from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.schemas import KEY_RANGES
from ordermill.shared import broadcast_if_small, cut
from ordermill.sources import tables

SLOT = "_slot"
_TASK_BITS = 33  # monotonically_increasing_id keeps the task above, the row below
_SPACING = 1 << 24  # more tasks than a stage can have
_noting = Lock()


def _task(slot: Column) -> Column:
    return F.shiftright(slot, _TASK_BITS)


def _row_in_task(slot: Column) -> Column:
    return slot.bitwiseAND(F.lit((1 << _TASK_BITS) - 1))


def label_rows(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Write rows to shared storage with the slot each one had in its task."""
    return cut(rows.withColumn(SLOT, F.monotonically_increasing_id()), "labelled", path)


def number_labelled(labelled: DataFrame, key: str, start: int = 1) -> DataFrame:
    """Replace the slots of label_rows by gapless numbers from start on."""
    counts = labelled.groupBy(_task(F.col(SLOT)).alias("_task")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    # One row per writing task, so neither the window nor the broadcast grows with rows.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    number = F.col("_offset") + _row_in_task(F.col(SLOT)) + F.lit(start)
    columns = [c for c in labelled.columns if c != SLOT]
    return (
        labelled.withColumn("_task", _task(F.col(SLOT)))
        .join(F.broadcast(offsets), "_task")
        .select(number.cast("bigint").alias(key), *columns)
    )


def assign_keys(rows: DataFrame, key: str, order_by: list[str], start: int = 1) -> DataFrame:
    """Rows with a new first column key: start, start + 1, ... in the given order.

    NULLs come last. One range shuffle and a sort within each task.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return number_labelled(label_rows(ordered), key, start)


def spaced_key(start: int = 1) -> Column:
    """Unique key from start on, made in the pass that writes the rows.

    Task t takes start + t and every _SPACING-th number after it, so the tasks share the
    range without knowing of each other. A task that is repeated writes other rows under
    its numbers only if those of the first attempt were thrown away.
    """
    slot = F.monotonically_increasing_id()
    key = F.lit(start) + _row_in_task(slot) * _SPACING + _task(slot)
    return F.when(_task(slot) < _SPACING, key).otherwise(
        F.raise_error(F.lit("more tasks than key spaces"))
    )


def next_key(existing: DataFrame, key: str) -> int:
    """One more than the largest key in use."""
    return existing.agg(F.coalesce(F.max(key), F.lit(0))).first()[0] + 1


def next_start(ranges: DataFrame, table: str, load_id: str) -> int:
    """The key behind all ranges of a table's other loads: one row per load is read."""
    others = ranges.filter((F.col("table_name") == table) & (F.col("load_id") != load_id))
    return next_key(others, "last_key")


def note_range(
    spark: SparkSession, ranges: str, table: str, load_id: str, first: int, last: int
) -> None:
    """Note the keys that a load has used; one that is repeated may be noted again."""
    made = spark.createDataFrame([(table, load_id, first, last)], KEY_RANGES)
    # Two appends to one folder at a time would remove each other's unfinished files.
    with _noting:
        tables.append(made, ranges)


def number_file_rows(
    labelled: DataFrame, file: str, block: str, number: str, key: str, start: int = 1
) -> DataFrame:
    """Add number, the 1-based position of each row in its file, and the unique key.

    labelled comes from label_rows over a file scan. A task reads a block of a file
    from front to back, so rows are in order within a block; counts per block give
    what comes before it in the file. A large file stays spread over its blocks.
    """
    blocks = labelled.groupBy(F.col(file).alias("_f"), F.col(block).alias("_b")).agg(
        F.min(SLOT).alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    in_file = Window.partitionBy("_f").orderBy("_b")
    overall = Window.orderBy("_first")  # one row per block of a file, not per order

    def rows_before(window: Window) -> Column:
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_rows").over(earlier), F.lit(0))

    offsets = broadcast_if_small(
        blocks.select(
            "_f", "_b", "_first",
            rows_before(in_file).alias("_before_in_file"),
            rows_before(overall).alias("_before"),
        )
    )
    position = F.col(SLOT) - F.col("_first")
    return (
        labelled.join(offsets, (F.col(file) == F.col("_f")) & (F.col(block) == F.col("_b")))
        .withColumns(
            {
                number: (F.col("_before_in_file") + position + 1).cast("bigint"),
                key: (F.col("_before") + position + F.lit(start)).cast("bigint"),
            }
        )
        .drop("_f", "_b", "_first", "_before_in_file", "_before", SLOT)
    )
