"""Do two layers hold the same orders? Checksums that do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Content that an order keeps from its source row to its curated row.
SOURCE_CONTENT = {
    "sales_order_key": "sales_order_key",
    "order_id": "order_id",
    "order_quantity": "order_quantity",
    "final_order_amount": "local_total_order_amt",
    "tax_amount": "local_tax_amt",
    "promotion_code": "promotion_code",
    "customer_name": "customer_name",
}

# Content that an order keeps from its curated row to its fact row.
FACT_CONTENT = {
    "order_id": "order_code",
    "order_quantity": "order_quantity",
    "local_total_order_amt": "local_total_order_amt",
    "local_tax_amt": "local_tax_amt",
    "exchange_rate": "exchange_rate",
    "us_total_order_amt": "us_total_order_amt",
    "usd_tax_amt": "usd_tax_amt",
}


def row_hash(*columns: str) -> Column:
    """64-bit hash of some columns; a NULL differs from any value and from its neighbours'."""
    parts = [p for c in columns for p in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*parts)


def checksums(rows: DataFrame, by: list[str], content: list[str]) -> DataFrame:
    """Rows, sum and xor of row hashes of each group.

    Tasks add up their own rows first, so a group with a third of all rows is one row per
    task by then. The sum tells a row that is there twice from one that is not there, which the
    xor alone cannot; decimals do not overflow below 10^19 rows a group.
    """
    hashed = rows.select(*by, row_hash(*content).alias("_hash"))
    return hashed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("_hash").cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("_hash").alias("hash_xor"),
    )


def unequal(expected: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """Groups whose checksums differ, with the rows on both sides and a verdict.

    A verdict is 'lost' where rows are missing, 'doubled' where there are too many, and
    'changed' where the number is right but not the content. A group that only one side has
    counts as empty on the other; NULLs in by match.
    """
    sums = ("rows", "hash_sum", "hash_xor")
    left = expected.select(*(F.col(c).alias(f"_left_{c}") for c in (*by, *sums)))
    right = found.select(*(F.col(c).alias(f"_right_{c}") for c in (*by, *sums)))
    same = F.lit(True)
    for c in by:
        same &= F.col(f"_left_{c}").eqNullSafe(F.col(f"_right_{c}"))
    equal = F.lit(True)
    for c in sums:
        equal &= F.col(f"_left_{c}").eqNullSafe(F.col(f"_right_{c}"))
    expected_rows = F.coalesce("_left_rows", F.lit(0))
    found_rows = F.coalesce("_right_rows", F.lit(0))
    verdict = (
        F.when(found_rows < expected_rows, "lost")
        .when(found_rows > expected_rows, "doubled")
        .otherwise("changed")
    )
    return left.join(right, same, "full").filter(~equal).select(
        *(F.coalesce(f"_left_{c}", f"_right_{c}").alias(c) for c in by),
        expected_rows.alias("expected_rows"),
        found_rows.alias("found_rows"),
        verdict.alias("verdict"),
    )


def differences(
    before: DataFrame, after: DataFrame, by: list[str], content: dict[str, str]
) -> DataFrame:
    """Groups in which two layers differ; content maps the columns of one to the other's."""
    return unequal(
        checksums(before, by, list(content)),
        # Types decide on hashes, so the later layer's columns are read as the earlier one's.
        checksums(
            after.select(
                *by, *(F.col(b).cast(before.schema[a].dataType).alias(a) for a, b in content.items())
            ),
            by,
            list(content),
        ),
        by,
    )
