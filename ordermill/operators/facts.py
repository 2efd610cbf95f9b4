"""Sales fact: orders with the keys of their dimension members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.text import promotion_or_default
from ordermill.operators.dimensions import (
    CUSTOMER,
    DATE,
    PAYMENT,
    PRODUCT,
    PROMO_CODE,
    REGION,
    Dimension,
    match,
    new_members,
)
from ordermill.operators.keys import assign_keys, spaced_key
from ordermill.rules import DEFAULT, Rules
from ordermill.schemas import SALES_FACT

FOREIGN_KEYS = {
    "date_id_fk": DATE,
    "region_id_fk": REGION,
    "customer_id_fk": CUSTOMER,
    "payment_id_fk": PAYMENT,
    "product_id_fk": PRODUCT,
    "promo_code_id_fk": PROMO_CODE,
}

# The customers are the only members that may be too many to broadcast. They come last,
# when the other natural keys have been replaced, so that narrower rows are shuffled.
LOOKUPS = sorted(FOREIGN_KEYS, key=lambda name: FOREIGN_KEYS[name] is CUSTOMER)

# Identity of an order among those of all markets, then of its fact rows.
FACT_ORDER = ("country", "sales_order_key", *FOREIGN_KEYS)


def union_orders(*curated: DataFrame) -> DataFrame:
    """Orders of several curated tables, each once however often it was appended."""
    first, *others = curated
    for other in others:
        first = first.union(other.select(*first.columns))
    return first.distinct()


def _lookup(
    orders: DataFrame, members: DataFrame, dimension: Dimension, foreign_key: str, rules: Rules
) -> DataFrame:
    """Inner join with a dimension, keeping only its key.

    No hint: dimensions are tables, so the optimizer broadcasts those whose files are
    small and sorts and merges the others, splitting skewed partitions.
    """
    keys = _lookup_keys(dimension, rules)
    null_safe = rules.null_safe_members and dimension is not DATE
    side = members.select(
        F.col(dimension.key).alias(foreign_key), *(F.col(k).alias(f"_dim_{k}") for k in keys)
    )
    joined = orders.join(
        side, match(orders, side, {k: f"_dim_{k}" for k in keys}, null_safe), "inner"
    )
    return joined.drop(*(f"_dim_{k}" for k in keys))


def _lookup_keys(dimension: Dimension, rules: Rules) -> tuple[str, ...]:
    if dimension is CUSTOMER:
        return rules.customer_keys
    if dimension is PRODUCT:
        return ("mobile_key",)
    return dimension.natural_key


def fact_rows(
    orders: DataFrame, dimensions: dict[str, DataFrame], rules: Rules = DEFAULT
) -> DataFrame:
    """Fact rows without their own key; country and sales_order_key are kept."""
    rows = orders.withColumn("promotion_code", promotion_or_default(F.col("promotion_code")))
    for foreign_key in LOOKUPS:
        dimension = FOREIGN_KEYS[foreign_key]
        rows = _lookup(rows, dimensions[dimension.table], dimension, foreign_key, rules)
    measures = SALES_FACT.fieldNames()[8:]
    return rows.select(
        "country",
        "sales_order_key",
        F.col("order_id").alias("order_code"),
        *FOREIGN_KEYS,
        *measures,
    )


def unseen_fact_rows(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Fact rows that are not in the fact table yet.

    The dollar columns belong to the identity: an order priced late is a new row, as
    it is in the curated orders.
    """
    dollars = ["exchange_rate", "us_total_order_amt", "usd_tax_amt"]
    return new_members(rows, existing, ["order_code", *FOREIGN_KEYS, *dollars])


def build_fact(
    orders: DataFrame,
    dimensions: dict[str, DataFrame],
    existing: DataFrame | None = None,
    rules: Rules = DEFAULT,
    start: int = 1,
    ordered: bool = True,
) -> DataFrame:
    """Fact rows to append, keys included.

    ordered=False takes spaced keys, which cost neither a shuffle nor a second write of
    the whole fact; they are unique, but have gaps and no particular order.
    """
    rows = fact_rows(orders, dimensions, rules)
    if existing is not None and rules.incremental_fact:
        rows = unseen_fact_rows(rows, existing)
    if ordered:
        keyed = assign_keys(rows, "order_id_pk", list(FACT_ORDER), start)
    else:
        keyed = rows.withColumn("order_id_pk", spaced_key(start))
    return keyed.select(*SALES_FACT.fieldNames())
