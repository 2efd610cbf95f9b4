"""Reconciliation of layers, and checks of rates and dollars."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ordermill.operators.rates import rate_outliers, wrong_dollars
from ordermill.operators.reconcile import checksums, differences, unequal
from ordermill.schemas import CURATED_ORDERS, EXCHANGE_RATE

CONTENT = {"code": "code", "amount": "amount"}


def _orders(spark, *rows):
    return spark.createDataFrame(rows, "load string, code string, amount long")


def _found(rows):
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_each_planted_fault_names_its_load(spark):
    before = [(f"load {n}", f"{n}-{i}", i) for n in range(6) for i in range(5)]
    before += [(None, "x", None), (None, None, 1)]
    after = [r for r in before if r[1] != "1-3"]  # lost
    after += [("load 2", "2-0", 0)] * 2  # doubled
    after = [("load 3", "3-1", 99) if r[1] == "3-1" else r for r in after]  # changed
    # One lost and another doubled: as many rows, the xor of two equal ones is not enough.
    after = [("load 4", "4-0", 0) if r[1] == "4-1" else r for r in after]
    after += [("load 7", "new", 1)]
    found = differences(_orders(spark, *before), _orders(spark, *after), ["load"], CONTENT)
    assert _found(found) == [
        ("load 1", 5, 4, "lost"),
        ("load 2", 5, 7, "doubled"),
        ("load 3", 5, 5, "changed"),
        ("load 4", 5, 5, "changed"),
        ("load 7", 0, 1, "doubled"),
    ]


def test_checksums_ignore_order_and_partitions_but_not_nulls(spark):
    rows = [("a", "x", None), ("a", None, 1), ("a", "x", 1), ("a", "x", 1)]
    one = checksums(_orders(spark, *rows).coalesce(1), ["load"], list(CONTENT))
    other = checksums(_orders(spark, *reversed(rows)).repartition(7), ["load"], list(CONTENT))
    assert unequal(one, other, ["load"]).isEmpty()
    swapped = [("a", None, None), ("a", "x", 1), ("a", "x", 1), ("a", "x", 1)]
    found = differences(_orders(spark, *rows), _orders(spark, *swapped), ["load"], CONTENT)
    assert _found(found) == [("a", 4, 4, "changed")]
    empty = _orders(spark, *rows).limit(0)
    assert differences(empty, empty, ["load"], CONTENT).isEmpty()


def _rates(spark, *values):
    """Rates from 2023-01-01 on; values are those of the euro, the rupee and the yen."""
    rows = []
    for i, (euro, rupee, yen) in enumerate(values):
        day = dt.date(2023, 1, 1) + dt.timedelta(days=i)
        numbers = ("1", euro, str(Decimal("1.3") + i % 3), None, rupee, yen)
        rows.append((day, *(Decimal(n) if n is not None else None for n in numbers)))
    return spark.createDataFrame(rows, EXCHANGE_RATE)


def test_rate_outliers(spark):
    days = [(f"0.9{i % 7}", f"80.{i % 9}", f"13{i % 3}") for i in range(40)]
    days[5] = ("0.95", "160", "131")  # too early to say
    days[20] = ("80.4", "0.93", "131")  # swapped
    days[25] = ("0.95", "8.05", "131")  # a lost digit
    days[30:36] = [("0.95" if i % 2 else "0.94", "80.4", "131") for i in range(6)]
    days[38] = ("0.95", None, "131")
    found = rate_outliers(_rates(spark, *days)).select("rate_dt", "currency", "kind")
    other = {(r["rate_dt"].timetuple().tm_yday - 1, r["currency"]): r["kind"] for r in found.collect()}
    assert other == {
        (20, "usd2eu"): "swapped",
        (20, "usd2inr"): "swapped",
        (25, "usd2inr"): "jump",
        (34, "usd2inr"): "stale",
        (35, "usd2inr"): "stale",
        **{(i, "usd2jp"): "stale" for i in (34, 35)},
    }
    assert rate_outliers(_rates(spark, *days).limit(0)).isEmpty()


def test_base_currency_is_one(spark):
    rates = _rates(spark, ("0.9", "80", "130")).withColumn("usd2usd", F.lit(2).cast("decimal(10,7)"))
    found = rate_outliers(rates).select("currency", "kind")
    assert _found(found) == [("usd2usd", "jump")]


def test_wrong_dollars(spark):
    rates = _rates(spark, ("0.9", "80", "130"))
    cases = [  # key, day, rate, dollars, dollars of tax
        (1, 1, "80", "1.25", "0.1"),
        (2, 1, "0.9", "1.25", "0.1"),
        (3, 1, "80", "1.24999999", "0.1"),
        (4, 1, None, None, None),  # waits for its rate
        (5, 2, None, None, None),
        (6, 2, "80", "1.25", "0.1"),  # dollars on a day without a rate
    ]
    rows = []
    for key, day, *values in cases:
        known = dict(
            sales_order_key=key, order_dt=dt.date(2023, 1, day), country="IN",
            local_total_order_amt=Decimal("100.00"), local_tax_amt=Decimal("8.00"),
        )
        names = ("exchange_rate", "us_total_order_amt", "usd_tax_amt")
        known |= {n: Decimal(v) if v else None for n, v in zip(names, values, strict=True)}
        rows.append(tuple(known.get(f.name) for f in CURATED_ORDERS))
    found = wrong_dollars(spark.createDataFrame(rows, CURATED_ORDERS), rates)
    assert sorted(r["sales_order_key"] for r in found.collect()) == [2, 3, 6]
