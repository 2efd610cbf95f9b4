"""Column functions on values chosen by hand."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.functions import calendar, casts, text
from ordermill.functions.money import to_usd


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("kind", "raw", "expected"),
    [
        ("whole", "199.99", Decimal(200)),
        ("whole", "2.5", Decimal(3)),
        ("whole", "-2.5", Decimal(-3)),
        ("whole", "abc", None),
        ("count", "7", 7),
        ("count", "7.5", 8),
        ("count", "99999999999999999999", None),
        ("money", "12.345", Decimal("12.35")),
        ("money", "123456789.00", None),
        ("whole_money", "10.50", Decimal("11.00")),
        ("date", "2023-01-05", dt.date(2023, 1, 5)),
        ("date", "05/01/2023", None),
        ("text", "x", "x"),
    ],
)
def test_casts(spark, kind, raw, expected):
    assert _one(spark, casts.CASTS[kind](F.lit(raw))) == expected


def test_cast_of_double_rounds_half_away_from_zero(spark):
    assert _one(spark, casts.to_whole(F.lit(2.5))) == 3
    assert _one(spark, casts.to_whole(F.lit(-2.5))) == -3


def test_tokens_to_null(spark):
    from ordermill.sources.landing import JSON_NULLS

    for token in JSON_NULLS:
        assert _one(spark, casts.tokens_to_null(F.lit(token), JSON_NULLS)) is None
    assert _one(spark, casts.tokens_to_null(F.lit("n"), JSON_NULLS)) == "n"


def test_calendar_labels(spark):
    sunday = F.lit(dt.date(2023, 4, 30))
    assert _one(spark, F.weekday(sunday)) == 6
    assert _one(spark, calendar.weekday_label(sunday)) == "Weekend"
    friday = F.lit(dt.date(2023, 4, 28))
    assert _one(spark, calendar.weekday_label(friday)) == "Weekday"


def test_day_counter_modes_differ_over_new_year(spark):
    first, day = F.lit(dt.date(2022, 12, 30)), F.lit(dt.date(2023, 1, 2))
    assert _one(spark, calendar.day_counter(day, first, running=True)) == 4
    assert _one(spark, calendar.day_counter(day, first, running=False)) == 2 - 364 + 1


def test_unpadded_stamp_is_ambiguous_and_padded_is_not(spark):
    days = [dt.date(2026, 12, 3), dt.date(2026, 1, 23)]
    assert {_one(spark, calendar.date_stamp(F.lit(d), False)) for d in days} == {
        "2026123"
    }
    assert {_one(spark, calendar.date_stamp(F.lit(d), True)) for d in days} == {
        "20261203",
        "20260123",
    }


def test_product_parts_past_the_end_are_null(spark):
    row = spark.range(1).select(
        *(c.alias(n) for n, c in text.product_parts(F.lit("Acme/One/Red")).items())
    ).first()
    assert row.asDict() == {"brand": "Acme", "model": "One", "color": "Red", "memory": None}


def test_region_key(spark):
    key = text.region_key(F.lit("APAC"), F.lit("IN"), F.lit("20260123"))
    assert _one(spark, key) == "REG_AC_IN_20260123"


@settings(max_examples=30, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 10**10 - 1), st.integers(1, 10**10 - 1)),
        min_size=50,
        max_size=200,
    )
)
def test_usd_is_the_exact_quotient_rounded_half_up(spark, pairs):
    rows = [(Decimal(a).scaleb(-2), Decimal(r).scaleb(-7)) for a, r in pairs]
    df = spark.createDataFrame(rows, "amount decimal(10,2), rate decimal(10,7)")
    found = df.select(to_usd(F.col("amount"), F.col("rate")).alias("usd")).collect()
    for (amount, rate), row in zip(pairs, found, strict=True):
        units = (2 * amount * 10**13 + rate) // (2 * rate)
        assert row["usd"] == Decimal(units).scaleb(-8)
