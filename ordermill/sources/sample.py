"""Sales orders shaped out of the TPC-H-like tables, one row per order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Every region key of the sample tables, and the market its orders are given to.
REGION_MARKETS = {
    0: ("FR", "EU"),
    1: ("US", "NA"),
    2: ("IN", "APAC"),
    3: ("FR", "EU"),
    4: ("IN", "APAC"),
}

# Invented rates, one row per quarter, in the column order of the rate table.
RATE_COLUMNS = ("usd2usd", "usd2eu", "usd2can", "usd2uk", "usd2inr", "usd2jp")
QUARTER_RATES = {
    1: ("1", "0.9125", "1.4010", "0.7705", "70.1250", "118.5000"),
    2: ("1", "0.9250", "1.4120", "0.7610", "71.3750", "119.2500"),
    3: ("1", "0.9375", "1.4230", "0.7515", "72.6250", "120.7500"),
    4: ("1", "0.9500", "1.4340", "0.7420", "73.8750", "121.1250"),
}
DAY_WITHOUT_RATE = 13

# The columns used of the sample tables.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


_REGION_CASE = "CASE n_regionkey {} END"

# The columns of the source tables, as expressions over the joined sample tables.
ORDER_COLUMNS = (
    "o_orderkey AS sales_order_key",
    "concat('ORD-', o_orderkey) AS order_id",
    "cast(o_orderdate AS date) AS order_dt",
    "c_name AS customer_name",
    # Some keys lack their last part.
    "concat_ws('/', p_brand, p_name, p_type, if(p_partkey % 50 = 0, null, p_size)) AS mobile_key",
    _REGION_CASE.format(" ".join(f"WHEN {k} THEN '{m[0]}'" for k, m in REGION_MARKETS.items()))
    + " AS country",
    _REGION_CASE.format(" ".join(f"WHEN {k} THEN '{m[1]}'" for k, m in REGION_MARKETS.items()))
    + " AS region",
    "o_orderkey % 4 + 1 AS order_quantity",
    "cast(o_orderkey % 900 + 100 AS decimal(38,0)) AS unit_price",
    "cast((o_orderkey % 900 + 100) * (o_orderkey % 4 + 1) AS decimal(38,0)) AS order_value",
    "if(o_orderkey % 5 = 0, null, concat('PROMO', o_orderkey % 7)) AS promotion_code",
    "cast(o_totalprice AS decimal(10,2)) AS final_order_amount",
    "cast(o_orderkey % 1000 AS decimal(10,2)) AS tax_amount",
    "if(o_orderstatus = 'F', 'Paid', 'Pending') AS payment_status",
    "if(o_orderpriority = '5-LOW', 'Shipped', 'Delivered') AS shipping_status",
    "o_orderpriority AS payment_method",
    "nullif(c_mktsegment, 'MACHINERY') AS payment_provider",
    "concat('PH-', o_custkey, '-', o_orderkey % 2) AS contact_no",
    "concat(n_name, '-', c_custkey) AS shipping_address",
    "o_orderdate + make_dt_interval(cast(o_orderkey % 3 AS int)) AS _metadata_last_modified",
)


def sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of all three markets in the shape of the source tables."""
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    # Orders are spread over all parts, whose keys run from 0. The count comes from the
    # files' footers, and the optimizer decides on the joins by the sizes of the files.
    parts = table(spark, sf_dir, "part")
    joined = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(parts, F.col("p_partkey") == F.col("o_orderkey") % max(1, parts.count()))
    )
    return joined.selectExpr(*ORDER_COLUMNS)


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate row for each order day, except the thirteenth of each month."""
    days = (
        table(spark, sf_dir, "orders")
        .selectExpr("cast(o_orderdate AS date) AS rate_dt")
        .filter(f"dayofmonth(rate_dt) <> {DAY_WITHOUT_RATE}")
        .distinct()
    )
    rates = []
    for position, name in enumerate(RATE_COLUMNS):
        cases = " ".join(f"WHEN {q} THEN '{row[position]}'" for q, row in QUARTER_RATES.items())
        rates.append(f"cast(CASE quarter(rate_dt) {cases} END AS decimal(10,7)) AS {name}")
    return days.selectExpr("rate_dt", *rates)
