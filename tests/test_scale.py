"""Plans: what is pushed down, what is shuffled, and what happens to hot keys."""

import datetime as dt
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.operators import dimensions as dims
from ordermill.operators import facts, latest, quality
from ordermill.operators.rates import with_rates_full
from ordermill.plans.curate import curate_orders
from ordermill.shared import broadcast_if_small, cut, shuffles_for

HOT_DAY = dt.date(2023, 1, 1)


@contextmanager
def settings(spark, **values):
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def source(spark):
    """A source table in which one day, one customer and one product hold a third."""
    key = F.col("id")
    hot = key % 3 == 0
    columns = {
        "sales_order_key": key,
        "order_id": F.concat(F.lit("O"), key.cast("string")),
        "customer_name": F.when(hot, "Guest").otherwise(
            F.concat(F.lit("C"), (key % 5000).cast("string"))
        ),
        "mobile_key": F.when(hot, "b/m/c/1").otherwise(
            F.concat(F.lit("b/m/c/"), (key % 40).cast("string"))
        ),
        "order_quantity": F.lit(1).cast("bigint"),
        "unit_price": F.lit(1).cast("decimal(38,0)"),
        "order_value": F.lit(1).cast("decimal(38,0)"),
        "promotion_code": F.lit(None).cast("string"),
        "final_order_amount": F.lit(80).cast("decimal(10,2)"),
        "tax_amount": F.lit(8).cast("decimal(10,2)"),
        "order_dt": F.when(hot, F.lit(HOT_DAY)).otherwise(
            F.date_add(F.lit(HOT_DAY), (key % 300 + 1).cast("int"))
        ),
        "payment_status": F.when(key % 10 == 0, "Pending").otherwise("Paid"),
        "shipping_status": F.lit("Delivered"),
        "payment_method": F.lit("card"),
        "payment_provider": F.lit(None).cast("string"),
        "contact_no": F.when(hot, "0").otherwise((key % 5000).cast("string")),
        "shipping_address": F.lit("x"),
        "_metadata_last_modified": F.lit(dt.datetime(2023, 1, 1)).cast("timestamp_ntz"),
        "country": F.lit("IN"),
        "region": F.lit("APAC"),
    }
    rows = spark.range(0, 60_000, 1, 8)
    return cut(rows.select(*(c.alias(n) for n, c in columns.items())), "source")


@pytest.fixture(scope="module")
def daily(spark):
    days = spark.range(301).select(
        F.date_add(F.lit(HOT_DAY), F.col("id").cast("int")).alias("rate_dt"),
        *(F.lit(80).cast("decimal(10,7)").alias(f.name) for f in schemas.EXCHANGE_RATE[1:]),
    )
    return cut(days, "rates")


@pytest.fixture(scope="module")
def curated(source, daily):
    return cut(curate_orders(source, daily), "curated")


def test_curation_shuffles_no_orders(source, daily):
    text = plan(curate_orders(source, daily))
    assert "Exchange hashpartitioning" not in text
    assert "Window" not in text
    assert text.count("BroadcastHashJoin") == 2


def test_status_filters_reach_the_files(spark, source, daily):
    with settings(spark, maxMetadataStringLength="10000"):
        text = plan(curate_orders(source, daily))
    assert "EqualTo(payment_status,Paid)" in text
    assert "EqualTo(shipping_status,Delivered)" in text


def test_dimension_reads_only_its_columns(curated):
    members = dims.customer_members(curated, None, None)
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan(members)).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "customer_name",
        "contact_no",
        "shipping_address",
        "country",
        "region",
    }


def test_repetitions_are_removed_before_the_shuffle(curated):
    members = dims.product_members(curated, None, None)
    members.collect()
    assert plan(members).count("HashAggregate") >= 2


def test_no_window_over_orders_when_ranking(source):
    """The window sees one row per day and file time, not the orders."""
    ranked = latest.rank_files(source)
    assert "Window" not in plan(ranked)
    assert ranked.filter("order_rank = 1").count() == 60_000


def test_full_join_of_a_hot_day_stays_spread(source, daily):
    text = plan(with_rates_full(source, daily))
    assert "FullOuter" not in text
    assert "BroadcastHashJoin" in text


def test_larger_sides_are_not_broadcast(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert "strategy=broadcast" in broadcast_if_small(df, 1600)._jdf.queryExecution().toString()
    large = broadcast_if_small(df, 1599)
    assert "strategy=broadcast" not in large._jdf.queryExecution().toString()
    assert large.count() == 100


def test_hot_customer_is_split_when_nothing_is_broadcast(spark, curated):
    members = {d.table: cut(dims.build_dimension(d, curated), d.table) for d in dims.DIMENSIONS}
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        adaptive__skewJoin__skewedPartitionFactor="2.0",
        adaptive__advisoryPartitionSizeInBytes="100KB",
        files__maxPartitionBytes="500KB",
    ):
        rows = facts.fact_rows(spark.createDataFrame(curated.rdd, curated.schema), members)
        assert len(rows.collect()) == curated.count()
        assert "SortMergeJoin(skew=true)" in plan(rows)


def test_hot_values_are_counted_before_they_are_shuffled(spark, curated):
    members = {d.table: cut(dims.build_dimension(d, curated), d.table) for d in dims.DIMENSIONS}
    fact = cut(facts.fact_rows(curated, members), "fact")
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        found = quality.orphans(fact, members)
        found.collect()
        # Read from the top: the comparison, then both halves of the count, then the files.
        text = plan(found).split("== Initial Plan ==")[0]
    assert text.index("LeftAnti") < text.index("HashAggregate")
    assert text.count("HashAggregate") >= 2


def test_large_loads_start_with_more_partitions(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    sizes = {}
    for rows in (10, 50_000_000, 10**13):
        with shuffles_for(spark, rows):
            sizes[rows] = spark.conf.get(name)
    assert sizes == {10: "8", 50_000_000: "100", 10**13: "20000000"}
    assert spark.conf.get(name, None) is None
