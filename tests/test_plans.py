"""What the physical plans must and must not hold."""

import re

import pytest

from __spark_entry__ import oracle_sql, queries
from payfeed.catalog.all_queries import ORACLES, QUERIES
from payfeed.catalog.star_schema import hr_tables

FEEDS = sorted(n for n in queries() if n.startswith(("feed_", "payload_")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", FEEDS)
def test_no_cross_joins_and_no_global_windows(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"^.*\bWindow\b", text, re.M)
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(queries()["changed_strict"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), GreaterThan\(ts,", text)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
    text = plan(queries()["changed_inclusive"](spark, sf_dir))
    assert "GreaterThanOrEqual(l_shipdate," in text


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_hr_tables_are_lazy(spark, sf_dir):
    tables = hr_tables(spark, sf_dir)
    assert not tables._built and len(tables) == 15
    assert tables["rostering"] is tables["rostering"]
    assert set(tables._built) == {"rostering"}
