"""Curated orders: paid, delivered, of the latest file of their day, in US dollars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.money import to_usd
from ordermill.operators.filters import paid_and_delivered, tag_market
from ordermill.operators.latest import latest_file_per_day
from ordermill.operators.rates import with_rates
from ordermill.rules import DEFAULT, Market, Rules
from ordermill.schemas import CURATED_ORDERS


def _per_market(rules: Rules, choose: Callable[[Market], str]) -> Column:
    """The expression chosen for the market of each row."""
    cases = " ".join(f"WHEN '{m.country}' THEN {choose(m)}" for m in rules.markets)
    return F.expr(f"CASE country {cases} END")


def curate_orders(orders: DataFrame, rates: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Curate orders that carry country, region and contact_no, of any markets."""
    latest = latest_file_per_day(paid_and_delivered(orders))
    priced = with_rates(latest, rates)
    rate = _per_market(rules, lambda m: m.rate_column)
    divisor = _per_market(rules, lambda m: m.divisor_column)
    values: dict[str, Column] = {
        "local_currency": _per_market(rules, lambda m: f"'{m.currency}'"),
        "local_unit_price": F.col("unit_price"),
        "local_total_order_amt": F.col("final_order_amount"),
        "local_tax_amt": F.col("tax_amount"),
        "exchange_rate": rate,
        "us_total_order_amt": to_usd(F.col("final_order_amount"), divisor),
        "usd_tax_amt": to_usd(F.col("tax_amount"), divisor),
    }
    return priced.select(
        *(
            values.get(field.name, F.col(field.name)).cast(field.dataType).alias(field.name)
            for field in CURATED_ORDERS
        )
    )


def curate_market(
    source: DataFrame, rates: DataFrame, market: Market, rules: Rules = DEFAULT
) -> DataFrame:
    """Curate one source table."""
    contact = rules.market(market.reads_from).contact_field
    tagged = tag_market(source.withColumnRenamed(contact, "contact_no"), market)
    return curate_orders(tagged, rates, rules)
