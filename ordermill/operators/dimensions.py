"""Dimension members: candidates from the orders, minus those already known."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill import schemas
from ordermill.functions import calendar, text
from ordermill.operators.keys import assign_keys, next_key
from ordermill.rules import DEFAULT, Rules

ACTIVE = "Y"


def distinct_members(orders: DataFrame, *columns: str | Column) -> DataFrame:
    """Distinct combinations; each task first removes its own repetitions."""
    return orders.select(*columns).distinct()


def member_counts(orders: DataFrame, *columns: str) -> DataFrame:
    """Number of orders of each combination; NULLs form a combination of their own."""
    return orders.groupBy(*columns).count()


def match(left: DataFrame, right: DataFrame, pairs: dict[str, str], null_safe: bool) -> Column:
    """Equality of all pairs of left and right columns."""
    condition = F.lit(True)
    for mine, other in pairs.items():
        same = left[mine].eqNullSafe(right[other]) if null_safe else left[mine] == right[other]
        condition &= same
    return condition


def new_members(
    candidates: DataFrame, existing: DataFrame, keys: list[str], null_safe: bool = True
) -> DataFrame:
    """Candidates whose keys are not in existing."""
    known = existing.select(*(F.col(k).alias(f"_known_{k}") for k in keys))
    pairs = {k: f"_known_{k}" for k in keys}
    return candidates.join(known, match(candidates, known, pairs, null_safe), "left_anti")


def region_members(orders: DataFrame, rules: Rules, as_of: dt.date) -> DataFrame:
    stamp = calendar.date_stamp(F.lit(as_of), rules.padded_region_key)
    return distinct_members(orders, "country", "region").withColumn(
        "region_id_pk", text.region_key(F.col("region"), F.col("country"), stamp)
    )


def product_members(orders: DataFrame, rules: Rules, as_of: dt.date) -> DataFrame:
    # The parts follow from the key, so they are cut out after the shuffle.
    return distinct_members(orders, "mobile_key").withColumns(
        text.product_parts(F.col("mobile_key"))
    )


def promo_code_members(orders: DataFrame, rules: Rules, as_of: dt.date) -> DataFrame:
    code = text.promotion_or_default(F.col("promotion_code")).alias("promotion_code")
    return distinct_members(orders, code, "country", "region")


def customer_members(orders: DataFrame, rules: Rules, as_of: dt.date) -> DataFrame:
    return distinct_members(
        orders, "customer_name", "contact_no", "shipping_address", "country", "region"
    )


def payment_members(orders: DataFrame, rules: Rules, as_of: dt.date) -> DataFrame:
    return distinct_members(orders, "payment_method", "payment_provider", "country", "region")


def date_members(orders: DataFrame, rules: Rules, as_of: dt.date) -> DataFrame:
    """Every day from the first to the last order, with its calendar attributes."""
    bounds = order_date_bounds(orders)
    day, first = F.col("order_dt"), F.col("first_dt")
    days = bounds.select(
        "first_dt",
        F.explode(calendar.every_day(F.col("first_dt"), F.col("last_dt"))).alias("order_dt"),
    )
    return days.select(
        "order_dt",
        F.year(day).alias("order_year"),
        F.month(day).alias("order_month"),
        F.quarter(day).alias("order_quarter"),
        F.dayofmonth(day).alias("order_day"),
        F.weekday(day).alias("order_dayofweek"),
        F.date_format(day, "EEEE").alias("order_dayname"),
        F.dayofmonth(day).alias("order_dayofmonth"),
        calendar.weekday_label(day).alias("order_weekday"),
        calendar.day_counter(day, first, rules.running_day_counter)
        .cast("bigint")
        .alias("day_counter"),
    )


def order_date_bounds(orders: DataFrame) -> DataFrame:
    """First and last order day and the number of orders, as one row."""
    return orders.agg(
        F.min("order_dt").alias("first_dt"),
        F.max("order_dt").alias("last_dt"),
        F.count(F.lit(1)).alias("orders"),
    )


@dataclass(frozen=True)
class Dimension:
    table: str
    schema: T.StructType
    natural_key: tuple[str, ...]
    members: Callable[[DataFrame, Rules, dt.date], DataFrame]
    active_flag: bool = True

    @property
    def key(self) -> str:
        return self.schema.fieldNames()[0]

    @property
    def has_sequence(self) -> bool:
        return not isinstance(self.schema[self.key].dataType, T.StringType)


REGION = Dimension("region_dim", schemas.REGION_DIM, ("country", "region"), region_members)
PRODUCT = Dimension(
    "product_dim",
    schemas.PRODUCT_DIM,
    ("mobile_key", *text.PRODUCT_PARTS),
    product_members,
)
PROMO_CODE = Dimension(
    "promo_code_dim",
    schemas.PROMO_CODE_DIM,
    ("promotion_code", "country", "region"),
    promo_code_members,
)
CUSTOMER = Dimension(
    "customer_dim",
    schemas.CUSTOMER_DIM,
    ("customer_name", "contact_no", "shipping_address", "country", "region"),
    customer_members,
)
PAYMENT = Dimension(
    "payment_dim",
    schemas.PAYMENT_DIM,
    ("payment_method", "payment_provider", "country", "region"),
    payment_members,
)
DATE = Dimension("date_dim", schemas.DATE_DIM, ("order_dt",), date_members, active_flag=False)

DIMENSIONS = (DATE, REGION, PRODUCT, PROMO_CODE, CUSTOMER, PAYMENT)


def build_dimension(
    dimension: Dimension,
    orders: DataFrame,
    existing: DataFrame | None = None,
    rules: Rules = DEFAULT,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Rows to append to a dimension for these orders, keys included."""
    if dimension is DATE and existing is not None:
        # The calendar goes on from the days it has, also if orders are only the new ones.
        orders = orders.select("order_dt").union(existing.select("order_dt"))
    rows = dimension.members(orders, rules, as_of or dt.date.today())
    if existing is not None:
        rows = new_members(rows, existing, list(dimension.natural_key), rules.null_safe_members)
    if dimension.active_flag:
        rows = rows.withColumn("isActive", F.lit(ACTIVE))
    if dimension.has_sequence:
        start = 1 if existing is None else next_key(existing, dimension.key)
        rows = assign_keys(rows, dimension.key, list(dimension.natural_key), start)
    names = dimension.schema.fieldNames()
    return rows.select(*names, *(c for c in rows.columns if c not in names))
