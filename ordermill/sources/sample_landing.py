"""Writes the sample orders as landing files, with planted faults."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.rules import DEFAULT, Market
from ordermill.shared import storage, together
from ordermill.sources.landing import CSV_NULL, FIELDS, landing_path
from ordermill.sources.sample import daily_rates, sales_orders

# Orders whose key is a multiple of these get a fault or an oddity.
BAD_QUANTITY, BAD_DATE, BAD_AMOUNT = 97, 101, 103
HALF_PRICE, NULL_TOKEN, CENTS_IN_TAX = 11, 10, 4

# An array file holds the orders of one key range, so its size is bounded.
KEYS_PER_ARRAY = 50_000


def landing_date(order_dt: Column) -> Column:
    """Files are dropped once a year, to keep the number of folders small."""
    return F.trunc(order_dt, "year")


def file_fields(orders: DataFrame, market: Market) -> DataFrame:
    """The sixteen fields as text, as they stand in the files, and their folder."""
    key = F.col("sales_order_key")

    def every(n: int) -> Column:
        return key % n == 0

    values = {f.column: F.col(f.column).cast("string") for f in FIELDS}
    values["order_quantity"] = F.when(every(BAD_QUANTITY), "abc").otherwise(
        values["order_quantity"]
    )
    values["unit_price"] = F.concat(
        values["unit_price"], F.when(every(HALF_PRICE), ".50").otherwise("")
    )
    values["final_order_amount"] = F.when(every(BAD_AMOUNT), "123456789012.00").otherwise(
        values["final_order_amount"]
    )
    values["tax_amount"] = F.when(
        every(CENTS_IN_TAX), (F.col("tax_amount") + F.lit("0.50").cast("decimal(3,2)")).cast("string")
    ).otherwise(values["tax_amount"])
    values["order_dt"] = F.when(
        every(BAD_DATE), F.date_format("order_dt", "dd/MM/yyyy")
    ).otherwise(values["order_dt"])
    values["customer_name"] = F.concat(values["customer_name"], F.lit(', "client"'))
    if market.file_format == "csv":
        code = F.col("promotion_code")
        values["promotion_code"] = F.when(code.isNull() & every(NULL_TOKEN), CSV_NULL).otherwise(
            code
        )
    return orders.filter(F.col("country") == market.country).select(
        key.alias("_key"),
        landing_date(F.col("order_dt")).alias("date"),
        *(v.alias(name) for name, v in values.items()),
    )


def write_files(
    rows: DataFrame, market: Market, root: str, compression: str | None = None
) -> None:
    """Add rows of file_fields to the landing area in the market's format."""
    by_label = [F.col(f.column).alias(f.label) for f in FIELDS]
    if market.file_format == "json":
        record = F.to_json(F.struct(*by_label))
        chunk = (F.col("_key") / KEYS_PER_ARRAY).cast("bigint")
        arrays = (
            rows.groupBy("date", chunk.alias("_chunk"))
            .agg(F.concat_ws(",\n", F.array_sort(F.collect_list(record))).alias("_body"))
            .select(F.concat(F.lit("[\n"), "_body", F.lit("\n]")).alias("value"), "date")
        )
        writer = arrays.write.option("maxRecordsPerFile", 1).format("text")
    elif market.file_format == "parquet":
        writer = rows.select(*by_label, "date").write.format("parquet")
    else:
        plain = rows.select(*(f.column for f in FIELDS), "date")
        writer = (
            plain.write.format("csv")
            .options(header=True, escape='"', quoteAll=False, emptyValue='""')
        )
    # Each market has a folder of its own to commit to, so several can be written at once.
    if compression:
        writer = writer.option("compression", compression)
    writer.partitionBy("date").mode("append").save(landing_path(root, market))


def write_landing(
    spark: SparkSession, sf_dir: str, root: str, markets: tuple[Market, ...] = DEFAULT.markets
) -> None:
    """Land the sample orders of the given markets."""
    orders = sales_orders(spark, sf_dir)
    together(
        partial(write_files, file_fields(orders, market), market, root) for market in markets
    )


def write_rates(spark: SparkSession, sf_dir: str, path: str, day_header: str) -> None:
    """Write the sample rates as CSV files under the given name of the day column."""
    rates = daily_rates(spark, sf_dir).withColumnRenamed("rate_dt", day_header)
    rates.write.option("header", True).csv(path)




def stamp_new_files(spark: SparkSession, root: str, moment: dt.datetime) -> None:
    """Give the files below root that have today's time another one, earlier ones keep theirs."""
    folder, system = storage(spark, root)
    found = system.listFiles(folder, True)
    stamp = int(moment.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    while found.hasNext():
        status = found.next()
        if status.getModificationTime() > stamp + 30 * 86_400_000:
            system.setTimes(status.getPath(), stamp, -1)
