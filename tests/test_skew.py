"""A third of all rows on one employee: the join is split, and nothing is lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from payfeed.catalog.star_schema import hr_tables
from payfeed.plans import attendance, onboarding, overtime
from payfeed.plans.increment import FEEDS, batches_of
from payfeed.session import materialize

SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def splitting(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_PARTITIONS}
    for key, value in SMALL_PARTITIONS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot_tables(spark, tmp_path):
    """The HR tables with 40 % of salaries and roster rows moved to one employee."""
    tables = dict(hr_tables(spark, "/root/testdata/sf0.01"))
    for name, employee in (("salary_master", "E15"), ("rostering", "E10")):
        part = F.pmod(F.xxhash64(*tables[name].columns), F.lit(10))
        moved = tables[name].withColumn("EmpCode", F.when(part < 4, employee).otherwise(F.col("EmpCode")))
        moved.repartition(8).write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    return tables


def run(df):
    """Rows, and the plan as it was executed."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("feed", ["india", "philippines"])
def test_hot_employee_in_onboarding(splitting, hot_tables, feed):
    build = {"india": onboarding.onboarding_india_feed, "philippines": onboarding.onboarding_philippines_feed}[feed]
    options = {"present_only": False} if feed == "philippines" else {}
    rows, plan = run(build(hot_tables, dt.datetime(2001, 1, 1), **options))
    assert "skew=true" in plan
    hot = [r for r in rows if r.EmployeeCode == "E15"]
    assert len(hot) > len(rows) / 4
    splitting.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plain, _ = run(build(hot_tables, dt.datetime(2001, 1, 1)))
    finally:
        splitting.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert sorted(map(str, rows)) == sorted(map(str, plain))


@pytest.mark.parametrize("feed", [attendance.attendance_feed, overtime.overtime_feed])
def test_hot_employee_in_the_roster(splitting, hot_tables, feed):
    rows, plan = run(feed(hot_tables, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 31)))
    assert "skew=true" in plan
    assert len(rows) > 1000


def test_hot_employee_is_one_batch(spark, hot_tables):
    feed = FEEDS["overtime"]
    rows = feed.build(hot_tables, mark=None, as_of=dt.datetime(2024, 1, 31)).withColumn("source_db", F.lit("db"))
    rows = materialize(rows, "rows")
    batches, records = batches_of(rows, feed, {"db": "s"}, dt.datetime(2024, 1, 31))
    assert sum(r.batch_size for r in batches.collect()) == records.count() == rows.count()
    assert batches.count() == -(-rows.select("EmployeeCode").distinct().count() // feed.batch_size)
