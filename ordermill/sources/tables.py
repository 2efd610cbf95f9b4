"""Catalog databases and tables: creating, reading and appending by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.shared import counted


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: str | None = None
) -> None:
    """Create a Parquet table unless it exists; loaded data is never dropped."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({partition_by})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}")


def add_column(spark: SparkSession, table: str, name: str, kind: T.DataType) -> None:
    """Add a column unless the table has it; rows already there read NULL."""
    if name not in spark.table(table).columns:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` {kind.simpleString()})")


def scan(spark: SparkSession, table: str, *columns: str) -> DataFrame:
    df = spark.table(table)
    return df.select(*columns) if columns else df


def append(df: DataFrame, table: str, *partition_by: str) -> int:
    """Append by column name and return the rows written, counted while writing."""
    rows, seen = counted(df)
    rows.write.mode("append").partitionBy(*partition_by).saveAsTable(table)
    return seen.get["rows"]


def append_new(df: DataFrame, table: str) -> int:
    """append, but nothing is written where there is nothing new; df is cheap to read again."""
    return 0 if df.isEmpty() else append(df, table)


def partition_values(spark: SparkSession, table: str) -> DataFrame:
    """Values of the table's only partition column, from the catalog: no data are read."""
    shown = spark.sql(f"SHOW PARTITIONS {table}")
    value = F.substring_index("partition", "=", -1)
    # The catalog escapes characters as a URL does, but for the plus sign.
    return shown.select(F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))).alias("value"))


def replace_partition(df: DataFrame, table: str, partition: str, value: str) -> int:
    """Write df as one partition, replacing what an earlier attempt left in it.

    The partition is fixed in the statement, so all others stay as they are.
    """
    return replace_and_see(df, table, partition, value, rows=F.count(F.lit(1)))["rows"]


def replace_and_see(
    df: DataFrame, table: str, partition: str, value: str, **seen: Column
) -> dict[str, object]:
    """replace_partition; returns aggregates of the rows, taken while they are written."""
    spark = df.sparkSession
    columns = [c for c in spark.table(table).columns if c != partition]
    found = Observation()
    rows = df.select(*columns).observe(found, *(c.alias(name) for name, c in seen.items()))
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({partition} = '{value}') SELECT * FROM {{rows}}",
        rows=rows,
    )
    return found.get
