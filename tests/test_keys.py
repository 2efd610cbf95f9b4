"""Surrogate keys and file row numbers over many tasks and blocks."""

import pytest
from pyspark.sql import functions as F

from ordermill.operators import keys


@pytest.fixture
def many_tasks(spark):
    """Shuffles keep all their partitions, so that the numbers cross task borders."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_ordered_keys_equal_row_number(spark, many_tasks):
    rows = spark.range(0, 5000, 1, 7).select(
        F.when(F.col("id") % 3 != 0, (F.col("id") * 7919 % 50).cast("string")).alias("a"), "id"
    )
    keyed = keys.assign_keys(rows, "pk", ["a", "id"], start=11)
    expected = rows.selectExpr(
        "row_number() over (order by a asc nulls last, id) + 10L as pk", "a", "id"
    )
    assert keyed.exceptAll(expected).isEmpty()
    assert keyed.count() == 5000


def test_spaced_keys_are_unique_and_start_where_told(spark, tmp_path):
    rows = spark.range(0, 3000, 1, 5).filter("id % 7 <> 0").withColumn("pk", keys.spaced_key(100))
    rows.write.parquet(str(tmp_path / "keyed"))
    keyed = spark.read.parquet(str(tmp_path / "keyed"))
    low, n, distinct = keyed.agg(F.min("pk"), F.count("pk"), F.count_distinct("pk")).first()
    assert low == 100
    assert n == distinct == rows.count()


def test_keys_stay_the_same_when_read_again(spark):
    keyed = keys.assign_keys(spark.range(1000).select(F.rand().alias("x"), "id"), "pk", ["id"])
    assert keyed.exceptAll(keyed).isEmpty()
    assert sorted(r[0] for r in keyed.collect()) == list(range(1, 1001))


def test_no_rows_give_no_keys(spark):
    assert keys.assign_keys(spark.range(0), "pk", ["id"]).isEmpty()


def test_next_key(spark):
    df = spark.range(3).withColumnRenamed("id", "pk")
    assert keys.next_key(df, "pk") == 3
    assert keys.next_key(df.limit(0), "pk") == 1
