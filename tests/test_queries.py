"""Every registered query against its SQL."""

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from compare import difference

from ordermill.catalogue.oracle import SQL
from ordermill.catalogue.queries import QUERIES


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, sf_dir, name):
    assert difference(spark, queries()[name], oracle_sql()[name], sf_dir) is None


def test_entry_is_the_flagship(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["sales_order_key", "order_id", "order_dt"]


def test_every_query_of_the_catalogue_has_sql():
    assert set(QUERIES) == set(SQL) <= set(queries())
