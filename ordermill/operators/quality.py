"""Checks that the declared keys and rates hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.operators.dimensions import Dimension
from ordermill.operators.facts import FOREIGN_KEYS


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def orphans(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Foreign key values without a dimension row, with the fact rows that carry them.

    One pass over the six key columns. Values are counted before they are shuffled and
    compared, so a value on a third of all rows is one row by then.
    """
    by_table: dict[str, Dimension] = {d.table: d for d in FOREIGN_KEYS.values()}
    pairs = ", ".join(
        f"'{dimension.table}', cast({key} as string)" for key, dimension in FOREIGN_KEYS.items()
    )
    used = (
        fact.selectExpr(f"stack({len(FOREIGN_KEYS)}, {pairs}) as (dimension, key_value)")
        .filter(F.col("key_value").isNotNull())
        .groupBy("dimension", "key_value")
        .agg(F.count(F.lit(1)).alias("fact_rows"))
    )
    known = None
    for name, members in dimensions.items():
        keys = members.select(
            F.lit(name).alias("dimension"),
            F.col(by_table[name].key).cast("string").alias("key_value"),
        )
        known = keys if known is None else known.union(keys)
    return used.join(known, ["dimension", "key_value"], "left_anti")


def missing_rates(curated: DataFrame) -> DataFrame:
    """Curated orders per country, and how many of them have no dollar amount."""
    return curated.groupBy("country").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("us_total_order_amt").isNull()).alias("without_rate"),
    )


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """df itself, after making sure that no key value repeats."""
    example = duplicate_keys(df, *keys).first()
    if example is not None:
        raise ValueError(f"duplicate {', '.join(keys)}: {example.asDict()}")
    return df
