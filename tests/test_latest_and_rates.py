"""Latest file per day and the rate join on small hand-made orders."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermill.operators import latest, quality, rates
from ordermill.operators.filters import paid_and_delivered, where_equal
from ordermill.plans.curate import curate_market
from ordermill.rules import DEFAULT, PARITY
from ordermill.shared import broadcast_if_small

DAY = dt.date(2023, 1, 1)
NOON = dt.datetime(2023, 1, 1, 12)


def _hours(n):
    return NOON + dt.timedelta(hours=n)


@pytest.fixture(scope="module")
def orders(spark):
    """A tie, a loser, undated orders, and a file without a time."""
    rows = [
        ("IN", 1, DAY, _hours(2)),
        ("IN", 2, DAY, _hours(2)),
        ("IN", 3, DAY, _hours(1)),
        ("US", 1, DAY, _hours(0)),
        ("IN", 4, None, _hours(1)),
        ("IN", 5, None, _hours(3)),
        ("FR", 1, DAY, None),
        ("FR", 2, DAY, _hours(0)),
        ("FR", 3, dt.date(2023, 1, 2), None),
    ]
    return spark.createDataFrame(
        rows,
        "country string, sales_order_key bigint, order_dt date, "
        "_metadata_last_modified timestamp_ntz",
    )


def _keys(df):
    return sorted((r["country"], r["sales_order_key"]) for r in df.collect())


def _literal(orders):
    window = Window.partitionBy("country", "order_dt").orderBy(
        F.col("_metadata_last_modified").desc_nulls_last()
    )
    return orders.withColumn("order_rank", F.rank().over(window))


def test_all_forms_keep_the_same_rows(orders):
    expected = _keys(_literal(orders).filter("order_rank = 1"))
    assert expected == [("FR", 2), ("FR", 3), ("IN", 1), ("IN", 2), ("IN", 5), ("US", 1)]
    assert _keys(latest.latest_file_per_day(orders)) == expected
    assert _keys(latest.latest_by_rank(orders)) == expected
    assert _keys(latest.latest_by_self_join(orders)) == expected


def test_ranks_equal_those_of_the_window(orders):
    ranked = latest.rank_files(orders)
    assert ranked.exceptAll(_literal(orders).select(*ranked.columns)).isEmpty()
    assert ranked.count() == orders.count()


def test_forms_agree_when_nothing_is_broadcast(orders, monkeypatch):
    monkeypatch.setattr(latest, "broadcast_if_small", lambda df: broadcast_if_small(df, 0))
    assert _keys(latest.latest_file_per_day(orders)) == _keys(latest.latest_by_rank(orders))


def test_null_status_is_dropped(spark):
    rows = [("Paid", "Delivered"), (None, "Delivered"), ("Paid", None), ("Paid", "Lost")]
    df = spark.createDataFrame(rows, "payment_status string, shipping_status string")
    assert paid_and_delivered(df).count() == 1
    assert where_equal(df, "payment_status", "Paid").count() == 3


def test_full_join_equals_the_literal_one(spark, orders):
    days = [(DAY, Decimal(2)), (dt.date(2024, 1, 1), Decimal(3))]
    daily = spark.createDataFrame(days, "rate_dt date, usd2inr decimal(10,7)")
    found = rates.with_rates_full(orders, daily)
    literal = orders.join(daily, orders["order_dt"] == daily["rate_dt"], "full")
    literal = literal.select(*found.columns)
    assert found.exceptAll(literal).isEmpty()
    assert literal.exceptAll(found).isEmpty()
    assert found.filter("rate_dt = date'2024-01-01' and order_dt is null").count() == 1


@pytest.fixture(scope="module")
def source(spark):
    """One row of a source table, for each market's contact column."""
    def make(contact):
        values = {
            "sales_order_key": 1,
            "order_id": "A",
            "customer_name": "Ann",
            "mobile_key": "b/m/c/64",
            "order_quantity": 1,
            "unit_price": Decimal(100),
            "order_value": Decimal(100),
            "promotion_code": None,
            "final_order_amount": Decimal("100.00"),
            "tax_amount": Decimal("10.00"),
            "order_dt": DAY,
            "payment_status": "Paid",
            "shipping_status": "Delivered",
            "payment_method": "card",
            "payment_provider": None,
            contact: "0",
            "shipping_address": "x",
            "_metadata_file_name": "f",
            "_metadata_row_number": 1,
            "_metadata_last_modified": NOON,
        }
        from ordermill.schemas import source_orders

        return spark.createDataFrame([tuple(values.values())], source_orders(contact))

    return make


@pytest.fixture(scope="module")
def daily(spark):
    row = (DAY, *(Decimal(v) for v in ("1", "1.25", "1.3", "0.8", "80", "130")))
    from ordermill.schemas import EXCHANGE_RATE

    return spark.createDataFrame([row], EXCHANGE_RATE)


@pytest.mark.parametrize(
    ("rules", "country", "stored", "usd"),
    [
        (DEFAULT, "IN", "80", "1.25"),
        (DEFAULT, "US", "1", "100"),
        (DEFAULT, "FR", "1.25", "80"),
        (PARITY, "IN", "80", "1.25"),
        (PARITY, "US", "80", "100"),  # the rupee rate is stored, dollars are kept
        (PARITY, "FR", "1.25", "80"),
    ],
)
def test_rate_and_divisor_of_each_market(source, daily, rules, country, stored, usd):
    market = rules.market(country)
    contact = rules.market(market.reads_from).contact_field
    row = curate_market(source(contact), daily, market, rules).first()
    assert row["exchange_rate"] == Decimal(stored)
    assert row["us_total_order_amt"] == Decimal(usd)
    assert (row["country"], row["region"]) == (market.country, market.region)
    assert row["contact_no"] == "0"


def test_strict_parity_takes_french_orders_from_the_us_table():
    assert PARITY.market("FR").reads_from == "US"
    assert DEFAULT.market("FR").reads_from == "FR"


def test_order_without_rate_is_kept(source, daily):
    rates_of_another_day = daily.withColumn("rate_dt", F.lit(dt.date(2020, 1, 1)))
    row = curate_market(source("mobile"), rates_of_another_day, DEFAULT.market("IN")).first()
    assert row["us_total_order_amt"] is None


def test_repeated_rate_day_is_an_error(daily):
    with pytest.raises(ValueError, match="rate_dt"):
        quality.require_unique(daily.union(daily), "rate_dt")
