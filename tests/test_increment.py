"""Increments end to end, in batch and as a stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from payfeed.catalog.star_schema import PROPERTY_CODES, hr_tables, read, rostering
from payfeed.plans.increment import FEEDS, batches_of, cut, pack, record_outcomes, run_increment, shape_records
from payfeed.session import materialize
from payfeed.sources.marks import read_mark
from payfeed.sources.outbox import message_bodies
from payfeed.streaming.stream import arriving, stream_increment

ROSTER = dt.datetime(2024, 1, 31)
SALARY = dt.datetime(2001, 11, 5)
MARK = "ID int, last_timestamp timestamp_ntz, source_db string"

OPTIONS = {
    "salary_philippines": {"country_id": 103, "codes": list(PROPERTY_CODES)},
    "salary_thailand": {"country_id": 103, "codes": list(PROPERTY_CODES)},
    "variable_philippines": {"country_id": 103, "codes": list(PROPERTY_CODES)},
    "variable_thailand": {"country_id": 103, "codes": list(PROPERTY_CODES)},
}


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return hr_tables(spark, sf_dir)


@pytest.mark.parametrize("name", sorted(FEEDS))
def test_every_feed_sends_all_its_rows_once(spark, tables, tmp_path, name):
    feed, as_of = FEEDS[name], ROSTER if name in ("attendance", "overtime") else SALARY
    options = OPTIONS.get(name, {})
    marks = spark.createDataFrame([(1, dt.datetime(1998, 1, 1), "db")], MARK)
    sent = run_increment(feed, {"db": tables}, {"db": "sub"}, marks, as_of, str(tmp_path), **options)
    rows = feed.build(tables, mark=dt.datetime(1998, 1, 1), as_of=as_of, **{**feed.options, **options}).collect()
    envelopes = [e for e in sent.collect() if e.batch_no >= 0]
    folder = envelopes[0].payload.split("#")[0]
    records = spark.read.parquet(folder)
    bodies = [json.loads(r.body) for r in message_bodies(sent, records, feed.record_key).collect()]
    assert len(rows) > 0
    assert sum(len(b[feed.record_key]) for b in bodies) == sum(e.batch_size for e in envelopes) == len(rows)
    assert {b["subscription_name"] for b in bodies} == {"sub"}
    assert len({e.batch_id for e in envelopes}) == len(envelopes)
    assert all(e.error is None and e.max_timestamp is not None for e in envelopes)
    if feed.batch_key is None:
        assert all(e.batch_size == feed.batch_size for e in envelopes if e.batch_no < len(envelopes) - 1)
    else:
        keys = {r[feed.batch_key] for r in rows}
        assert len({e.batch_no for e in envelopes}) == -(-len(keys) // feed.batch_size)


def test_failed_batches_are_sent_again_and_nothing_else_is_lost(spark, tables, tmp_path):
    feed = FEEDS["attendance"]
    marks = spark.createDataFrame([(1, dt.datetime(2024, 1, 20), "db")], MARK)
    source = ({"db": tables}, {"db": "sub"})
    first = run_increment(feed, *source, marks, ROSTER, f"{tmp_path}/out", batch_size=20)
    results = first.select(
        "batch_id", F.when(F.col("batch_no") % 3 == 1, 500).otherwise(200).alias("status_code"), F.lit("answer").alias("response")
    )
    log, new = record_outcomes(feed, first, results, marks, ROSTER)
    log.write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    ids = {r.batch_id for r in log.where("Status = 'SUCCESS'").collect()}
    assert 0 < len(ids) < first.count()

    again = run_increment(feed, *source, marks, ROSTER + dt.timedelta(hours=1), f"{tmp_path}/out", log=log, batch_size=20)
    assert {r.batch_id for r in again.collect()} == {r.batch_id for r in first.collect()} - ids

    moved = marks.unionByName(new)
    assert read_mark(moved, "db") >= dt.datetime(2024, 1, 20)
    failed_from = min(r.min_timestamp for r in first.where("batch_no % 3 = 1").collect())
    assert read_mark(moved, "db") < failed_from


def test_one_mark_for_all_sources(spark, tables, tmp_path):
    feed = FEEDS["salary_india"]
    marks = spark.createDataFrame([(1, dt.datetime(2001, 6, 1), None)], MARK)
    sent = run_increment(feed, {"a": tables, "b": tables}, {"a": "s1", "b": "s2"}, marks, SALARY, str(tmp_path))
    results = sent.select("batch_id", F.lit(200).alias("status_code"), F.lit("").alias("response"))
    log, new = record_outcomes(feed, sent, results, marks, SALARY)
    assert log.where("Status = 'SUCCESS' AND IsBatchComplete").count() == sent.count()
    newest = max(r.max_timestamp for r in sent.collect())
    assert read_mark(marks.unionByName(new)) == newest


def test_batches_with_unreadable_values_are_errors(spark, tables):
    feed = FEEDS["salary_philippines"]
    rows = spark.createDataFrame(
        [("E1", 1, 5.0, None), ("E2", 2, 5.0, 6.0)], "EmployeeCode string, EmployeeID int, MonthlyRate double, YearlyRate double"
    ).withColumn("source_db", F.lit("db"))
    packed = {r.batch_no: r for r in pack(shape_records(cut(rows, feed), feed, SALARY), feed, {"db": "s"}, SALARY).collect()}
    assert packed[0].error == "unreadable yearly_rate" and packed[1].error is None
    assert packed[0].max_timestamp == SALARY and packed[0].min_timestamp is None


def test_attendance_without_update_time_is_not_sent(spark):
    feed = FEEDS["attendance"]
    rows = spark.createDataFrame(
        [(1, "E1", dt.date(2024, 1, 1), 1.0, None, "db")],
        "EmployeeID int, EmployeeCode string, AttendanceDate date, Attendance double, updateDate_timestamp timestamp_ntz, source_db string",
    )
    shaped = shape_records(cut(rows, feed), feed, ROSTER)
    assert pack(shaped, feed, {"db": "s"}, ROSTER).first().error == "no readable update time"


def test_stream_equals_batch_and_goes_on(spark, sf_dir, tables, tmp_path):
    events = read(spark, sf_dir, "events").repartition(3)
    arrived = str(tmp_path / "arrived")
    events.where("event_id % 4 <> 0").write.parquet(arrived)
    feed, seen = FEEDS["attendance"], []

    envelopes = arriving(feed, tables, "rostering", "db", "s", adapt=rostering, now=lambda: ROSTER)

    def shape(rows, epoch):
        seen.append(epoch)
        return envelopes(rows, epoch)

    def run():
        stream_increment(
            spark, shape, arrived, events.schema, str(tmp_path / "out"), str(tmp_path / "state"), files_per_batch=1
        )

    def records():
        return sorted(r.record for r in spark.read.parquet(str(tmp_path / "out" / "records")).collect())

    run()
    assert len(seen) == 3
    events.where("event_id % 4 = 0").coalesce(1).write.mode("append").parquet(arrived)
    run()
    assert len(seen) == 4
    run()
    assert len(seen) == 4

    whole = feed.build(tables, mark=dt.datetime(1900, 1, 1), as_of=ROSTER).withColumn("source_db", F.lit("db"))
    want = sorted(r.record for r in batches_of(materialize(whole, "whole"), feed, {"db": "s"}, ROSTER)[1].collect())
    assert records() == want


def test_salary_rows_arriving_as_a_stream(spark, tables, tmp_path):
    """Only the salary table arrives; groups, rules and persons are the tables at hand."""
    feed, arrived = FEEDS["salary_india"], str(tmp_path / "arrived")
    changed = tables["salary_master"].where(F.col("updateDate") >= dt.datetime(2001, 6, 1))
    changed.write.parquet(arrived)
    shape = arriving(feed, tables, "salary_master", "db", "s", now=lambda: SALARY)
    stream_increment(spark, shape, arrived, changed.schema, str(tmp_path / "out"), str(tmp_path / "state"))
    sent = spark.read.parquet(str(tmp_path / "out" / "batches"))
    want = feed.build(tables, mark=dt.datetime(2001, 6, 1), as_of=SALARY).count()
    assert want > 0
    assert sent.agg(F.sum("batch_size")).first()[0] == want


def test_increments_remove_what_they_staged(spark, tables, tmp_path):
    from pathlib import Path

    from payfeed.session import shared_dir

    own = Path(shared_dir(spark)) / "payfeed" / spark.sparkContext.applicationId
    before = set(own.iterdir()) if own.exists() else set()
    marks = spark.createDataFrame([(1, dt.datetime(2024, 1, 20), "db")], MARK)
    sent = run_increment(FEEDS["overtime"], {"db": tables}, {"db": "s"}, marks, ROSTER, str(tmp_path))
    assert sent.count() > 0
    assert (set(own.iterdir()) if own.exists() else set()) == before


def test_a_batch_of_any_size_is_one_batch(spark, tmp_path):
    """20,000 rows of 100 employees, half of them of one: one id, one row, all records."""
    feed = FEEDS["overtime"]
    names = ["EmployeeCode", "Date", "Code", "ExtraHrs", "Conversion", "ExtraTimePay", "updateDate_timestamp"]
    rows = spark.range(20_000).selectExpr(
        "concat('E', if(id % 2 = 0, 0, id % 100)) AS EmployeeCode", "date_add(date'2024-01-01', cast(id % 28 AS int)) AS Date",
        "cast(id AS string) AS Code", "1.5D AS ExtraHrs", "'H' AS Conversion", "2.0D AS ExtraTimePay",
        "timestamp_ntz'2024-01-10 00:00:00' AS updateDate_timestamp",
    ).select(*names).withColumn("source_db", F.lit("db"))
    batches, records = batches_of(materialize(rows, "rows"), feed, {"db": "s"}, ROSTER)
    (only,) = batches.collect()
    assert only.batch_size == 20_000
    assert records.select("batch_id").distinct().collect()[0].batch_id == only.batch_id
    assert records.count() == 20_000
    plan = batches._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
    again = batches_of(materialize(rows.repartition(7), "rows"), feed, {"db": "s"}, ROSTER)[0].first()
    assert again.batch_id == only.batch_id


def test_unreadable_overtime_is_reported_and_holds_the_mark(spark, tables, tmp_path):
    feed = FEEDS["overtime"]
    roster = tables["rostering"]
    late = roster.where("OT_Param_json IS NOT NULL AND OT_UpdatedDate > '2024-01-25'").orderBy("OT_UpdatedDate").first()
    bad = (F.col("EmpCode") == late.EmpCode) & (F.col("OT_UpdatedDate") == F.lit(late.OT_UpdatedDate))
    text = F.when(bad, '[{"ParameterCode":"click","ParameterValue":"x","Conversion":"H"}]').otherwise(F.col("OT_Param_json"))
    changed = {**tables, "rostering": roster.withColumn("OT_Param_json", text)}
    marks = spark.createDataFrame([(1, dt.datetime(2024, 1, 20), "db")], MARK)
    sent = run_increment(feed, {"db": changed}, {"db": "s"}, marks, ROSTER, str(tmp_path))
    rejects = [r for r in sent.collect() if r.batch_no == -1]
    assert len(rejects) == 1 and rejects[0].batch_size >= 1 and "minutes" in rejects[0].error
    results = sent.select("batch_id", F.lit(200).alias("status_code"), F.lit("").alias("response"))
    log, new = record_outcomes(feed, sent, results, marks, ROSTER)
    assert log.where("Status = 'ERROR'").count() == 1
    assert read_mark(marks.unionByName(new), "db") < late.OT_UpdatedDate
    records = spark.read.parquet(*{r.payload.split("#")[0] for r in sent.collect() if r.payload})
    assert records.where(F.get_json_object("record", "$.ExtraHrs").isNull()).isEmpty()
