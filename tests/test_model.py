"""Dimensions, fact and checks on hand-made curated orders."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.operators import dimensions as dims
from ordermill.operators import facts, quality
from ordermill.operators.keys import next_key
from ordermill.rules import DEFAULT, PARITY
from ordermill.shared import cut

AS_OF = dt.date(2026, 1, 23)


def _order(key, **changes):
    values = {
        "sales_order_key": key,
        "order_id": f"O{key}",
        "order_dt": dt.date(2023, 1, 1) + dt.timedelta(days=key),
        "customer_name": "Ann",
        "mobile_key": "b/m/c/64",
        "country": "IN",
        "region": "APAC",
        "order_quantity": 1,
        "local_currency": "INR",
        "local_unit_price": Decimal(1),
        "promotion_code": None,
        "local_total_order_amt": Decimal("1.00"),
        "local_tax_amt": Decimal("0.10"),
        "exchange_rate": Decimal(80),
        "us_total_order_amt": Decimal("0.0125"),
        "usd_tax_amt": Decimal("0.00125"),
        "payment_status": "Paid",
        "shipping_status": "Delivered",
        "payment_method": "card",
        "payment_provider": "visa",
        "contact_no": "1",
        "shipping_address": "Main St",
    }
    values.update(changes)
    return tuple(values.values())


@pytest.fixture(scope="module")
def orders(spark):
    rows = [
        _order(1),
        _order(1),
        _order(2, contact_no="2", payment_provider=None),
        _order(3, mobile_key="b/m", promotion_code="P1"),
        _order(4, order_dt=None, mobile_key=None, customer_name=None),
        _order(5, country="US", region="NA", shipping_address=None),
    ]
    return cut(spark.createDataFrame(rows, schemas.CURATED_ORDERS))


def _build(orders, rules=DEFAULT, known=None):
    known = known or {}
    return {
        d.table: cut(dims.build_dimension(d, orders, known.get(d.table), rules, AS_OF))
        for d in dims.DIMENSIONS
    }


@pytest.fixture(scope="module")
def members(orders):
    return _build(orders)


def test_members(members):
    counts = {name: df.count() for name, df in members.items()}
    assert counts == {
        "date_dim": 5,
        "region_dim": 2,
        "product_dim": 3,
        "promo_code_dim": 3,
        "customer_dim": 4,
        "payment_dim": 3,
    }
    for dimension in dims.DIMENSIONS:
        df = members[dimension.table]
        declared = dimension.schema.fieldNames()
        assert df.columns[: len(declared)] == declared
        assert quality.duplicate_keys(df, dimension.key).isEmpty()


def test_loading_again_adds_nothing(orders, members):
    again = _build(orders, known=members)
    assert {name: df.count() for name, df in again.items()} == dict.fromkeys(members, 0)


def test_plain_matching_adds_members_with_null_again(orders, members):
    again = _build(orders, PARITY, members)
    added = {name: df.count() for name, df in again.items()}
    # Members with a NULL: a short and a missing product, no provider, no name or address.
    assert added == {
        "date_dim": 0,
        "region_dim": 0,
        "product_dim": 2,
        "promo_code_dim": 0,
        "customer_dim": 2,
        "payment_dim": 1,
    }


def test_keys_go_on_after_the_largest(spark, orders, members):
    more = spark.createDataFrame([_order(9, customer_name="Bob")], schemas.CURATED_ORDERS)
    added = dims.build_dimension(
        dims.CUSTOMER, orders.union(more), members["customer_dim"], DEFAULT, AS_OF
    )
    assert [(r["customer_id_pk"], r["customer_name"]) for r in added.collect()] == [(5, "Bob")]


def test_calendar_goes_on_without_holes(spark, members):
    """Later orders alone still fill the days in between and keep counting."""
    later = spark.createDataFrame(
        [_order(9, order_dt=dt.date(2024, 1, 2))], schemas.CURATED_ORDERS
    )
    added = dims.build_dimension(dims.DATE, later, members["date_dim"], DEFAULT, AS_OF)
    first, last, n = added.agg(F.min("order_dt"), F.max("order_dt"), F.count("*")).first()
    assert (first, last, n) == (dt.date(2023, 1, 7), dt.date(2024, 1, 2), 361)
    assert added.filter("order_dt = date'2024-01-02'").first()["day_counter"] == 366


def test_no_orders_give_no_days(orders):
    assert dims.build_dimension(dims.DATE, orders.limit(0)).isEmpty()


def test_fact_has_each_dated_order_once(orders, members):
    fact = cut(facts.build_fact(facts.union_orders(orders), members))
    assert sorted(r["order_code"] for r in fact.collect()) == ["O1", "O2", "O3", "O5"]
    assert fact.columns == schemas.SALES_FACT.fieldNames()
    assert quality.orphans(fact, members).isEmpty()


def test_parity_fact_fans_out_and_drops(orders, members):
    """Ann has two contacts in India: her orders double. O2 has no provider."""
    fact = facts.build_fact(facts.union_orders(orders), members, rules=PARITY)
    codes = sorted(r["order_code"] for r in fact.collect())
    assert codes == ["O1", "O1", "O3", "O3", "O5"]


def test_fact_is_appended_once(orders, members):
    distinct = facts.union_orders(orders)
    fact = cut(facts.build_fact(distinct, members, ordered=False))
    start = next_key(fact, "order_id_pk")
    assert facts.build_fact(distinct, members, fact, start=start).isEmpty()
    again = facts.build_fact(distinct, members, fact, PARITY, start)
    assert sorted(r["order_id_pk"] for r in again.collect()) == list(range(start, start + 5))


def test_late_rate_is_a_new_fact_row(spark, orders, members):
    unpriced = spark.createDataFrame(
        [_order(1, exchange_rate=None, us_total_order_amt=None, usd_tax_amt=None)],
        schemas.CURATED_ORDERS,
    )
    fact = cut(facts.build_fact(unpriced, members))
    added = facts.build_fact(facts.union_orders(orders), members, fact, start=2)
    assert "O1" in {r["order_code"] for r in added.collect()}


def test_orphans_and_duplicates_are_found(orders, members):
    fact = facts.fact_rows(facts.union_orders(orders), members)
    damaged = dict(members)
    damaged["region_dim"] = members["region_dim"].filter("country <> 'US'")
    damaged["date_dim"] = members["date_dim"].filter("order_dt <> date'2023-01-02'")
    found = {r["dimension"]: r["fact_rows"] for r in quality.orphans(fact, damaged).collect()}
    assert found == {"region_dim": 1, "date_dim": 1}
    doubled = members["region_dim"].union(members["region_dim"].limit(1))
    assert quality.duplicate_keys(doubled, "region_id_pk").first()["count"] == 2


def test_missing_key_is_no_orphan(orders, members):
    fact = facts.fact_rows(facts.union_orders(orders), members)
    blank = fact.withColumn("payment_id_fk", F.lit(None).cast("bigint"))
    assert quality.orphans(blank, members).isEmpty()


def test_missing_rates(spark):
    rows = [_order(1), _order(2, us_total_order_amt=None)]
    df = spark.createDataFrame(rows, schemas.CURATED_ORDERS)
    assert quality.missing_rates(df).first().asDict() == {
        "country": "IN",
        "orders": 2,
        "without_rate": 1,
    }


def test_member_counts_keep_nulls_together(orders):
    counts = dims.member_counts(orders, "payment_provider").collect()
    assert {r["payment_provider"]: r["count"] for r in counts} == {"visa": 5, None: 1}


def test_order_date_bounds(orders):
    assert tuple(dims.order_date_bounds(orders).first()) == (
        dt.date(2023, 1, 2),
        dt.date(2023, 1, 6),
        6,
    )
