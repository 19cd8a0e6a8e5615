"""Change capture."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from payfeed.operators import changes, predicates

T0 = dt.datetime(2024, 1, 10)


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        ("a", dt.date(2024, 1, 9), T0 - dt.timedelta(microseconds=1)),
        ("a", dt.date(2024, 1, 9), T0),
        ("b", dt.date(2024, 1, 10), T0 + dt.timedelta(microseconds=1)),
        ("b", dt.date(2023, 1, 1), T0 + dt.timedelta(days=1)),
        ("c", dt.date(2024, 1, 10), None),
    ]
    return spark.createDataFrame(data, "k string, day date, upd timestamp_ntz")


def test_strict_and_inclusive(rows):
    assert changes.changed_since(rows, "upd", T0).count() == 2
    assert changes.changed_since(rows, "upd", T0, inclusive=True).count() == 3


def test_first_run_compares_dates_as_midnights(rows):
    noon = dt.datetime(2024, 1, 10, 12)
    got = changes.changed_since(rows, "upd", None, backfill_col="day", days=1, as_of=noon)
    assert {r.day for r in got.collect()} == {dt.date(2024, 1, 10)}
    midnight = changes.changed_since(rows, "upd", None, backfill_col="day", days=1, as_of=T0)
    assert midnight.count() == 4


def test_first_run_by_update_time_cuts_the_bound_to_seconds(rows):
    as_of = T0 + dt.timedelta(days=90, microseconds=900)
    assert changes.changed_since(rows, "upd", None, inclusive=True, as_of=as_of).count() == 3
    with pytest.raises(ValueError):
        changes.changed_since(rows, "upd", None)


def test_first_run_of_everything(rows):
    assert changes.changed_since(rows, "upd", None, days=None).count() == 5


def test_bound_reaches_the_scan(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = changes.changed_since(stored, "upd", T0)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(upd), GreaterThan(upd," in plan
    first = changes.changed_since(stored, "upd", None, backfill_col="day", as_of=dt.datetime(2024, 1, 31, 5))
    assert "GreaterThanOrEqual(day," in first._jdf.queryExecution().executedPlan().toString()


def test_only_changed_keeps_all_rows_of_changed_keys(rows):
    keys = changes.changed_keys(rows, "k", "upd", T0)
    assert keys.count() == 2
    assert [r.k for r in changes.only_changed(rows, keys, "k").collect()] == ["b", "b"]


def test_changed_days_and_copies_per_update_time(spark):
    day = dt.date(2024, 1, 1)
    rows = spark.createDataFrame([(1, day, "x"), (1, day, "y"), (2, day, "z")], "k int, day date, v string")
    changed = spark.createDataFrame([(1, day, T0), (1, day, T0 + dt.timedelta(1))], "k int, day date, t timestamp_ntz")
    days = changes.changed_days(rows, changed, ["k", "day"])
    assert sorted((r.v, r.changed_times) for r in days.collect()) == [("x", 2), ("y", 2)]
    repeated = changes.repeat_rows(days, "changed_times")
    assert repeated.columns == rows.columns
    assert sorted(r.v for r in repeated.collect()) == list("xxyy")


def test_country_of(spark):
    signups = spark.createDataFrame([("one", 101), ("two", 103), ("two", 101)], "organizationName string, CountryID int")
    assert predicates.country_of(signups, predicates.organisation_of("DB_one", "DB_")) == 101
    assert predicates.country_of(signups, "none") is None
    with pytest.raises(ValueError):
        predicates.country_of(signups, "two")


def test_batch_max_time(spark):
    rows = spark.createDataFrame(
        [(1, "2024-01-01T00:00:00"), (1, "2024-01-02T00:00:00.5"), (2, None), (2, ""), (3, "2024-01-01"), (3, "junk")],
        "b int, t string",
    )
    now = dt.datetime(2025, 1, 1)
    got = {r.b: r.max_timestamp for r in predicates.batch_max_time(rows, ["b"], "t").collect()}
    assert got == {1: dt.datetime(2024, 1, 2, 0, 0, 0, 500000), 2: None, 3: None}
    filled = {r.b: r.max_timestamp for r in predicates.batch_max_time(rows, ["b"], "t", now).collect()}
    assert filled[2] == now and filled[3] == now
    dated, undated = predicates.split_dated(predicates.batch_max_time(rows, ["b"], "t"))
    assert dated.count() == 1 and undated.count() == 2


def test_current_salary(spark):
    rows = spark.createDataFrame(
        [(1.0, None), (0.0, None), (None, None), (1.0, T0)], "MonthlyRate double, ToDate timestamp_ntz"
    )
    assert predicates.current_salary(rows).count() == 1
    assert predicates.current_salary(rows.where(F.lit(False))).columns == ["MonthlyRate", "ToDate"]
