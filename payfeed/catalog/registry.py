"""Where queries and their oracle SQL are registered side by side."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from payfeed.catalog.views import with_views
from payfeed.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Parameters that fit the time range of the test tables.
ROSTER_AS_OF = dt.datetime(2024, 1, 31)
ROSTER_MARK = dt.datetime(2024, 1, 15)
SALARY_AS_OF = dt.datetime(2001, 11, 5)
SALARY_MARK = dt.datetime(2001, 1, 1)
VARIABLE_AS_OF = dt.datetime(2001, 8, 2)
VARIABLE_MARK = dt.datetime(1998, 1, 1)
COUNTRY = 103


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` may use the HR views."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register
