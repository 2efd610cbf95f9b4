"""Latest file of each day: rank orders by the time their file was last modified.

All orders of a file tie, so a day's rank partition can hold any share of the rows.
None of the forms below brings a day into one task: the ranking runs on one row per
day and file time, which is counted before the shuffle and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.shared import broadcast_if_small

DAY = ("country", "order_dt")
MODIFIED = "_metadata_last_modified"


def _same(orders: DataFrame, other: DataFrame, columns: tuple[str, ...]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition &= orders[name].eqNullSafe(other[f"_{name}"])
    return condition


def latest_file_per_day(orders: DataFrame) -> DataFrame:
    """Orders of the newest file(s) of each country and day; ties are kept."""
    newest = orders.groupBy(*(F.col(c).alias(f"_{c}") for c in DAY)).agg(
        F.max(MODIFIED).alias(f"_{MODIFIED}")
    )
    newest = broadcast_if_small(newest)
    return orders.join(newest, _same(orders, newest, (*DAY, MODIFIED)), "left_semi")


def rank_files(orders: DataFrame) -> DataFrame:
    """Orders with order_rank, the rank of their file time within country and day."""
    columns = (*DAY, MODIFIED)
    files = orders.groupBy(*(F.col(c).alias(f"_{c}") for c in columns)).agg(
        F.count(F.lit(1)).alias("_orders")
    )
    newer = (
        Window.partitionBy(*(f"_{c}" for c in DAY))
        .orderBy(F.col(f"_{MODIFIED}").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = files.withColumn(
        "order_rank", F.coalesce(F.sum("_orders").over(newer), F.lit(0)) + 1
    ).drop("_orders")
    ranks = broadcast_if_small(ranks)
    joined = orders.join(ranks, _same(orders, ranks, columns), "inner")
    return joined.drop(*(f"_{c}" for c in columns))


def latest_by_rank(orders: DataFrame) -> DataFrame:
    """Same rows as latest_file_per_day, with the rank they were chosen by."""
    return rank_files(orders).filter(F.col("order_rank") == 1)


def latest_by_self_join(orders: DataFrame) -> DataFrame:
    """Same rows again: the survivors' keys, joined back to the orders."""
    survivors = latest_by_rank(orders).select(
        F.col("country").alias("_unique_country"),
        F.col("sales_order_key").alias("_unique_key"),
    )
    return orders.join(
        survivors,
        (orders["country"] == F.col("_unique_country"))
        & (orders["sales_order_key"] == F.col("_unique_key")),
        "inner",
    ).drop("_unique_country", "_unique_key")
