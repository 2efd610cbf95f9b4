"""The daily exchange-rate file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators.quality import require_unique
from ordermill.schemas import EXCHANGE_RATE

# Headers under which the day column is found.
DAY_HEADERS = ("date", "rate_dt", "exchange_rate_dt", "echange_rate_dt")


def canonical_rates(rates: DataFrame) -> DataFrame:
    """Rates with the day under its canonical name and all columns in declared types."""
    day = next(c for c in rates.columns if c.lower() in DAY_HEADERS)
    renamed = rates.withColumnRenamed(day, "rate_dt")
    return renamed.select(*(F.col(f.name).cast(f.dataType) for f in EXCHANGE_RATE))


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """Rates from CSV files, bound by position; one row per day or an error."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in EXCHANGE_RATE])
    rates = spark.read.schema(text).option("header", True).csv(path)
    return require_unique(canonical_rates(rates), "rate_dt")
