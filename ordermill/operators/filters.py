"""Row selection and constant tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.rules import Market


def where_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose column has the given value; a NULL never has."""
    return df.filter(F.col(column) == F.lit(value))


def paid_and_delivered(orders: DataFrame) -> DataFrame:
    paid = where_equal(orders, "payment_status", "Paid")
    return where_equal(paid, "shipping_status", "Delivered")


def tag_market(orders: DataFrame, market: Market) -> DataFrame:
    """Add the country and region that a source table leaves out."""
    return orders.withColumns(
        {"country": F.lit(market.country), "region": F.lit(market.region)}
    )
