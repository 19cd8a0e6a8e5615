"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import frame, oracle
from payfeed.catalog.all_queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    got = frame(queries()[name](spark, sf_dir).toPandas())
    relation = con.sql(oracle_sql()[name])
    want = frame(pd.DataFrame(relation.fetchall(), columns=relation.columns))
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(got, want)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
