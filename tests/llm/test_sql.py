"""Registered queries of the subpackage against their SQL in DuckDB."""

import pandas as pd
import pytest

from check import frame, oracle
from payfeed.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    got = frame(QUERIES[name](spark, sf_dir).toPandas())
    con = oracle(sf_dir)
    relation = con.sql(ORACLES[name])
    want = frame(pd.DataFrame(relation.fetchall(), columns=relation.columns))
    pd.testing.assert_frame_equal(got, want)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
