"""Joining orders with the exchange rates of their day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.money import to_usd
from ordermill.rules import DEFAULT, Rules
from ordermill.schemas import EXCHANGE_RATE
from ordermill.shared import broadcast_if_small


def with_rates(orders: DataFrame, rates: DataFrame) -> DataFrame:
    """Orders with the rates of their day, NULL where the day has none.

    Rates have one row per day, so they pass the broadcast check and the orders
    stay where they are.
    """
    rates = broadcast_if_small(rates)
    return orders.join(rates, orders["order_dt"] == rates["rate_dt"], "left")


def with_rates_full(orders: DataFrame, rates: DataFrame) -> DataFrame:
    """Full outer join of orders and rates on the day.

    A full outer join has to bring all orders of a day into one task. Its two halves
    need not: orders with their rates, then the rates of days without an order, found
    against the distinct order days.
    """
    rates = broadcast_if_small(rates)
    priced = orders.join(rates, orders["order_dt"] == rates["rate_dt"], "left")
    order_days = orders.select(F.col("order_dt").alias("_day")).distinct()
    unused = rates.join(order_days, F.col("rate_dt") == F.col("_day"), "left_anti")
    return priced.unionByName(unused, allowMissingColumns=True)


# Rates have seven decimals; whole units keep medians exact.
UNITS = 10_000_000
BASE = "usd2usd"


def _twice_median(values: str) -> Column:
    """Sum of the two middle values of a sorted array, NULL if it is empty."""
    return F.expr(
        f"get({values}, int((size({values}) - 1) div 2)) + get({values}, int(size({values}) div 2))"
    )


def rate_outliers(
    rates: DataFrame,
    days: int = 30,
    at_least: int = 10,
    deviations: int = 8,
    share: int = 50,
    stale_days: int = 5,
) -> DataFrame:
    """Rates that are unlike the days before: kind is 'swapped', 'jump' or 'stale'.

    A jump lies off the median of the last days listed (at_least of them) by more than the given
    number of median absolute deviations and by more than one part in share of the median. It
    is swapped where another currency's rate of that day would fit. A rate is stale from the
    stale_days-th listed day on which it has not moved. The base currency must be 1 and is never
    stale. NULL rates are left out, see quality.missing_rates.

    A currency's days are one window partition: one row a day, however many orders there are.
    """
    currencies = EXCHANGE_RATE.fieldNames()[1:]
    units = [(F.col(c) * UNITS).cast("bigint") for c in currencies]
    listed = rates.select("rate_dt", F.array(*units).alias("_all"), *currencies)
    listed = listed.unpivot(["rate_dt", "_all"], currencies, "currency", "rate")
    listed = listed.filter(F.col("rate").isNotNull())
    ordered = Window.partitionBy("currency").orderBy("rate_dt")
    value = (F.col("rate") * UNITS).cast("bigint")
    moved = F.coalesce((F.lag("_units").over(ordered) != F.col("_units")).cast("int"), F.lit(1))
    runs = Window.partitionBy("currency", "_run").orderBy("rate_dt")
    seen = (
        listed.withColumn("_units", value)
        .withColumn(
            "_last", F.array_sort(F.collect_list("_units").over(ordered.rowsBetween(-days, -1)))
        )
        .withColumn("_moved", moved)
        .withColumn("_run", F.sum("_moved").over(ordered))
        .withColumn("_unmoved", F.row_number().over(runs))
        .withColumn("_median2", _twice_median("_last"))
        .withColumn("_far", F.expr("array_sort(transform(_last, x -> abs(2 * x - _median2)))"))
        .withColumn("_spread2", _twice_median("_far"))
        .withColumn("_off", F.abs(2 * F.col("_units") - F.col("_median2")))
    )
    jump = (
        (F.size("_last") >= at_least)
        & (2 * F.col("_off") > deviations * F.col("_spread2"))
        & (share * F.col("_off") > F.col("_median2"))
    ) | ((F.col("currency") == BASE) & (F.col("_units") != UNITS))
    fits = F.expr(f"exists(_all, x -> abs(2 * x - _median2) * {share} <= _median2)")
    kind = (
        F.when(jump & fits, "swapped")
        .when(jump, "jump")
        .when((F.col("currency") != BASE) & (F.col("_unmoved") >= stale_days), "stale")
    )
    half = F.lit("0.00000005").cast("decimal(9,8)")
    median = (F.col("_median2").cast("decimal(18,0)") * half).cast("decimal(18,8)")
    found = seen.select("rate_dt", "currency", "rate", median.alias("median"), kind.alias("kind"))
    return found.filter(F.col("kind").isNotNull())


def wrong_dollars(curated: DataFrame, rates: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Curated orders whose rate or dollars are not those of their day.

    An order without any dollars is waiting for its rate and not wrong.
    """
    priced = with_rates(curated, rates)

    def of_market(column: str) -> Column:
        cases = (F.when(F.col("country") == m.country, F.col(getattr(m, column))) for m in rules.markets)
        return F.coalesce(*cases)

    expected = {
        "exchange_rate": of_market("rate_column"),
        "us_total_order_amt": to_usd(F.col("local_total_order_amt"), of_market("divisor_column")),
        "usd_tax_amt": to_usd(F.col("local_tax_amt"), of_market("divisor_column")),
    }
    types = {f.name: f.dataType for f in curated.schema}
    right = F.lit(True)
    for name, value in expected.items():
        right &= F.col(name).eqNullSafe(value.cast(types[name]))
    waiting = F.coalesce(*(F.col(name).cast("string") for name in expected)).isNull()
    wrong = priced.filter(~right & ~waiting)
    return wrong.select(
        *curated.columns, *(v.cast(types[n]).alias(f"expected_{n}") for n, v in expected.items())
    )
