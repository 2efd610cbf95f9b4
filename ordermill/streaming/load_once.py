"""Load each landing file exactly once.

A stream of file names remembers in its checkpoint those it has seen. Every batch is one
partition of the source table, named by query and batch, and is written by replacing
that partition: a batch that is repeated after a failure leaves no second copy.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.keys import next_key, next_start, note_range
from ordermill.rules import DEFAULT, Market, Rules
from ordermill.shared import JobFailure, exists, scratch, together
from ordermill.sources import landing, tables

LOAD_ID = "load_id"
# Ends the names of the reject partitions that list unreadable files.
SET_ASIDE = "-set-aside"


@dataclass(frozen=True)
class Load:
    """What one batch did."""

    load_id: str
    rows_written: int
    rows_rejected: int


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the stream, which lives as long as its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _start(spark: SparkSession, table: str, load_id: str, ranges: str | None) -> int:
    """The first key of a load: behind the ranges of all others, or behind the table's keys."""
    if ranges:
        return next_start(spark.table(ranges), table, load_id)
    return next_key(spark.table(table).filter(F.col(LOAD_ID) != load_id), "sales_order_key")


def write_files(
    spark: SparkSession,
    root: str,
    paths: list[str],
    load_id: str,
    market: Market,
    table: str,
    rejects: str,
    rules: Rules = DEFAULT,
    ranges: str | None = None,
) -> Load:
    """Write the rows of these files to the source table and the rejects table.

    Files that cannot be read have one row each among the rejects, and the others go on without
    them. Compressed text, which may not unpack, is tested first: other text can always be read,
    and an attempt that meets such a file near its end has parsed all others in vain. When an
    attempt fails, all its files are tested, and it is repeated without those that fail again.
    If none does, the failure is not theirs, and is raised.
    """
    start = _start(spark, table, load_id, ranges)
    packed = landing.compressed(sorted(paths), market.file_format)
    damaged = set(landing.unreadable(spark, packed, market.file_format)) if packed else set()
    left = sorted(set(paths) - damaged)
    load = None
    while left:
        with scratch(spark, "staged"):
            try:
                staged, more = landing.stage_files(spark, root, left, market, rules, start)
                damaged.update(more)
                load = _write(staged, load_id, market, table, rejects, start) if staged else None
                break
            except JobFailure:
                found = landing.unreadable(spark, left, market.file_format)
                if not found:
                    raise
                damaged.update(found)
                left = [path for path in left if path not in set(found)]
    written, bad, last = load or (0, 0, start - 1)
    if damaged:
        rows = landing.set_aside(spark, sorted(damaged))
        bad += tables.replace_partition(rows, rejects, LOAD_ID, f"{load_id}{SET_ASIDE}")
    if ranges:
        note_range(spark, ranges, table, load_id, start, last)
    return Load(load_id, written, bad)


def _write(
    staged: DataFrame, load_id: str, market: Market, table: str, rejects: str, start: int
) -> tuple[int, int, int]:
    """Rows written and rejected, and the last key in use."""
    last = F.coalesce(F.max("sales_order_key"), F.lit(start - 1))

    def orders() -> dict[str, object]:
        rows = landing.accepted(staged, market)
        return tables.replace_and_see(rows, table, LOAD_ID, load_id, rows=F.count(F.lit(1)), last=last)

    def others() -> dict[str, object]:
        rows = landing.rejected(staged)
        return tables.replace_and_see(rows, rejects, LOAD_ID, load_id, rows=F.count(F.lit(1)))

    seen, bad = together((orders, others))
    return seen["rows"], bad["rows"], seen["last"]


def _set_aside(spark: SparkSession, rejects: str) -> set[str]:
    """Files that some load could not read; only partitions of such files are scanned."""
    rows = spark.table(rejects).filter(F.col(LOAD_ID).like(f"%{SET_ASIDE}"))
    names = rows.filter(F.col(landing.BAD_FIELDS) == landing.UNREADABLE).select("_metadata_file_name")
    return {row[0] for row in names.distinct().collect()}


def load_new_files(
    spark: SparkSession,
    root: str,
    market: Market,
    table: str,
    rejects: str,
    checkpoint: str,
    rules: Rules = DEFAULT,
    on_load: Callable[[Load], None] | None = None,
    ranges: str | None = None,
    **limits: object,
) -> list[Load]:
    """Load all files of a market that arrived since the last call.

    limits are options such as maxFilesPerTrigger or maxBytesPerTrigger, which cut a
    large backlog into several batches. A market without a folder has no files yet. Files that
    could not be read are tried again in each call, as loads of their own, until they can be.
    """
    if not exists(spark, landing.landing_path(root, market)):
        return []
    loads: list[Load] = []

    def write(paths: list[str], load_id: str) -> None:
        load = write_files(spark, root, paths, load_id, market, table, rejects, rules, ranges)
        if on_load:
            on_load(load)
        loads.append(load)

    def handle(batch: DataFrame, batch_id: int) -> None:
        paths = [row.path for row in batch.collect()]
        write(paths, f"{_query_id(spark, checkpoint)}-{batch_id}")

    known = _set_aside(spark, rejects)
    query = (
        landing.file_names(spark, root, market, **limits)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    held = {row[0] for row in tables.partition_values(spark, table).collect()} if known else set()
    for path in sorted(known):
        load_id = f"{_query_id(spark, checkpoint)}-again-{sha256(path.encode()).hexdigest()[:16]}"
        if load_id in held or not exists(spark, path):
            continue
        if not landing.unreadable(spark, [path], market.file_format):
            write([path], load_id)
    return loads
