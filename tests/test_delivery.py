"""Messages, outcomes, log and marks."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from payfeed.sources import delivery, marks, outbox, tables

T0 = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)
MICRO = dt.timedelta(microseconds=1)
RECORD = StructType([StructField("a", IntegerType()), StructField("b", StringType())])

GOOD = {"records": [{"a": 1, "b": None}, {"a": 2, "b": "x"}], "source_db": "A", "subscription_name": "s", "max_timestamp": "2024-01-01T00:00:00"}


def message(**changes):
    body = {**GOOD, **changes}
    return json.dumps({k: v for k, v in body.items() if v != "absent"})


MESSAGES = {
    "fine": message(),
    "no records": message(records=[]),
    "no list": message(records="absent"),
    "no source": message(source_db="absent"),
    "blank source": message(source_db=""),
    "no time": message(max_timestamp=None),
    "bad time": message(max_timestamp="soon"),
    "no subscription": message(subscription_name="absent"),
    "broken": '{"records": [',
    "list": "[1]",
}


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame(list(MESSAGES.items()), "name string, message string")


def test_parse_names_what_is_missing(messages):
    got = {r["name"]: r["error"] for r in outbox.parse_envelopes(messages, RECORD).collect()}
    assert got == {
        "fine": None,
        "no records": "no records",
        "no list": "no records",
        "no source": "missing source_db",
        "blank source": "missing source_db",
        "no time": "missing max_timestamp",
        "bad time": "unreadable max_timestamp",
        "no subscription": "missing subscription_name",
        "broken": "invalid JSON",
        "list": "invalid JSON",
    }


def test_subscription_family_needs_less(messages):
    got = outbox.parse_envelopes(messages, RECORD, outbox.REQUIRED_BY_SUBSCRIPTION)
    assert {r["name"] for r in got.where("error IS NULL").collect()} == {
        "fine", "no source", "blank source", "no time", "bad time",
    }


def test_decode_keeps_positions_and_nulls(messages):
    got = outbox.decode_envelopes(messages, RECORD, keep=("name",)).orderBy("position").collect()
    assert [(r["name"], r.position, r.a, r.b) for r in got] == [("fine", 0, 1, None), ("fine", 1, 2, "x")]


def test_message_round_trip_keeps_nulls(spark):
    df = spark.createDataFrame(
        [([(1, None)], "A", "s", T0 + MICRO)],
        "records array<struct<a int, b string>>, source_db string, subscription_name string, max_timestamp timestamp_ntz",
    )
    text = df.select(outbox.envelope_message()).first()[0]
    assert json.loads(text) == {
        "records": [{"a": 1, "b": None}], "source_db": "A", "subscription_name": "s",
        "max_timestamp": "2024-01-01T00:00:00.000001",
    }
    short = df.select(outbox.envelope_message(outbox.REQUIRED_BY_SUBSCRIPTION)).first()[0]
    assert set(json.loads(short)) == {"records", "subscription_name"}


@pytest.fixture(scope="module")
def sent(spark):
    return spark.createDataFrame(
        [("b1", 3, None, "{}"), ("b2", 2, None, "{}"), ("b3", 1, None, "{}"), ("b4", 1, "unreadable x", "{}"), ("b5", 1, None, "{}")],
        "batch_id string, batch_size bigint, error string, payload string",
    )


@pytest.fixture(scope="module")
def results(spark):
    return spark.createDataFrame(
        [("b1", 200, "ok"), ("b2", 500, "é" * 1500), ("b3", 0, "timeout"), ("b4", 200, "ok")],
        "batch_id string, status_code int, response string",
    )


def test_outcomes_and_log(sent, results):
    outcomes = delivery.apply_outcomes(sent, results, "salary")
    assert {r.batch_id: r.status for r in outcomes.collect()} == {
        "b1": "SUCCESS", "b2": "FAILED", "b3": "FAILED", "b4": "ERROR", "b5": "PENDING",
    }
    log = {r.batch_id: r for r in delivery.batch_log(outcomes, T0, "salary").collect()}
    assert set(log) == {"b1", "b2", "b3", "b4"}
    assert (log["b1"].IsBatchComplete, log["b2"].IsBatchComplete, log["b4"].IsBatchComplete) == (True, False, False)
    assert (log["b1"].Details, log["b2"].Details, log["b4"].Details) == ("", "é" * 1000, "unreadable x")
    assert log["b1"].Payload == "{}" and log["b1"].Timestamp == T0 and log["b1"].BatchSize == 3


def test_attendance_flags_are_the_other_way_round(sent, results):
    outcomes = delivery.apply_outcomes(sent, results, "attendance")
    log = {r.batch_id: r for r in delivery.batch_log(outcomes, T0, "attendance").collect()}
    assert (log["b1"].IsBatchComplete, log["b2"].IsBatchComplete) == (False, True)
    assert (log["b1"].Details, log["b1"].Payload, log["b2"].Payload) == ("ok", "0", "{}")


def test_delivered_batches_are_not_offered_again(sent, results):
    log = delivery.batch_log(delivery.apply_outcomes(sent, results, "salary"), T0, "salary")
    assert {r.batch_id for r in outbox.new_batches(sent, log).collect()} == {"b2", "b3", "b4", "b5"}


# ---- marks -----------------------------------------------------------------------

MARK = "ID int, last_timestamp timestamp_ntz, source_db string"
OUTCOME = "source_db string, batch_no int, status string, min_timestamp timestamp_ntz, max_timestamp timestamp_ntz"


def test_latest_mark_may_be_empty(spark):
    rows = spark.createDataFrame([(1, T0, "A"), (2, None, "A"), (3, T0 - HOUR, "B")], MARK)
    assert dict(marks.latest_mark(rows).collect()) == {"A": None, "B": T0 - HOUR}
    assert marks.read_mark(rows, "A") is None and marks.read_mark(rows, "B") == T0 - HOUR
    assert marks.read_mark(rows) == T0 - HOUR and marks.read_mark(rows, "C") is None


def outcome(spark, *rows):
    return spark.createDataFrame([("A", i, s, T0 + lo * HOUR, T0 + hi * HOUR) for i, (s, lo, hi) in enumerate(rows)], OUTCOME)


def test_last_success_can_skip_a_failure(spark):
    old = spark.createDataFrame([(1, T0, "A")], MARK)
    got = marks.next_mark(outcome(spark, ("SUCCESS", 1, 9), ("FAILED", 2, 3), ("SUCCESS", 4, 5)), old, "last_success")
    assert got.first().last_timestamp == T0 + 5 * HOUR
    bumped = marks.next_mark(outcome(spark, ("SUCCESS", 1, 9)), old, "last_success", bump=True)
    assert bumped.first().last_timestamp == T0 + 9 * HOUR + MICRO


@pytest.mark.parametrize(
    "rows, want",
    [
        ([("SUCCESS", 1, 4), ("SUCCESS", 2, 3)], T0 + 4 * HOUR),
        ([("SUCCESS", 1, 4), ("FAILED", 2, 3)], T0 + 2 * HOUR - MICRO),
        ([("SUCCESS", 1, 4), ("PENDING", 3, 9)], T0 + 3 * HOUR - MICRO),
        ([("SUCCESS", 1, 4), ("FAILED", -5, 3)], T0),
        ([("FAILED", 1, 4)], T0),
        ([("SUCCESS", -9, -8)], T0),
    ],
)
def test_safe_mark(spark, rows, want):
    old = spark.createDataFrame([(1, T0, "A")], MARK)
    assert marks.next_mark(outcome(spark, *rows), old).first().last_timestamp == want


def test_safe_mark_stays_when_an_undated_batch_failed(spark):
    old = spark.createDataFrame([(1, T0, "A")], MARK)
    rows = spark.createDataFrame([("A", 0, "SUCCESS", T0, T0 + HOUR), ("A", 1, "FAILED", None, T0 + HOUR)], OUTCOME)
    assert marks.next_mark(rows, old).first().last_timestamp == T0


def test_safe_mark_never_goes_back_or_past_a_failure(spark):
    random.seed(11)
    old, rows = [], []
    for n in range(60):
        old.append((n, T0 + random.randint(-5, 20) * HOUR if n % 4 else None, f"s{n}"))
        for b in range(random.randint(1, 5)):
            lo = random.randint(-5, 20)
            rows.append((f"s{n}", b, random.choice(["SUCCESS", "SUCCESS", "FAILED"]), T0 + lo * HOUR, T0 + (lo + random.randint(0, 5)) * HOUR))
    got = dict(marks.next_mark(spark.createDataFrame(rows, OUTCOME), spark.createDataFrame(old, MARK)).collect())
    for _, before, source in old:
        mine = [r for r in rows if r[0] == source]
        after = got[source]
        if before is not None:
            assert after >= before
        failed = [r[4] for r in mine if r[3] == "FAILED"]
        if failed and after != before:
            assert after < min(failed)


def test_commit_appends_newer_ids(spark):
    old = spark.createDataFrame([(7, T0, "A"), (3, T0, "B")], MARK)
    new = spark.createDataFrame([("B", T0 + HOUR), ("A", None)], "source_db string, last_timestamp timestamp_ntz")
    rows = marks.commit_mark(old, new)
    assert rows.dtypes == old.dtypes
    assert sorted(map(tuple, rows.collect())) == [(8, None, "A"), (9, T0 + HOUR, "B")]
    assert dict(marks.latest_mark(old.unionByName(rows)).collect()) == {"A": None, "B": T0 + HOUR}
    first = marks.commit_mark(old.where(F.lit(False)), new)
    assert sorted(r.ID for r in first.collect()) == [1, 2]


# ---- sources ---------------------------------------------------------------------


def test_fan_in_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(2,)], "k int")
    got = tables.fan_in({"A": a, "B": b}).collect()
    assert sorted((r.k, r.v, r.source_db) for r in got) == [(1, "x", "A"), (2, None, "B")]
    with pytest.raises(ValueError):
        tables.fan_in({})


def test_route_takes_the_first_of_several(spark):
    sources = spark.createDataFrame(
        [("db1", "s1", "INDIA"), ("db2", "s1", "THAILAND"), ("db3", "s3", "PHILIPPINES")],
        "name string, subscription_name string, country string",
    )
    sent = spark.createDataFrame([("s1", "db2"), ("s2", "db9"), (None, None)], "subscription_name string, source_db string")
    got = {r.subscription_name: (r.source_country, r.route_error) for r in tables.route(sent, sources).collect()}
    assert got == {
        "s1": ("INDIA", None),
        "s2": (None, "no source configured for s2"),
        None: (None, "no source configured for null"),
    }
    by_name = {r.source_db: r.source_country for r in tables.route(sent, sources, by="source_db").collect()}
    assert by_name == {"db2": "THAILAND", "db9": None, None: None}


def test_bind_tables_from_files_and_catalog(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "emp"))
    bound = tables.bind_tables(spark, str(tmp_path), names={"rostering": "emp"}, tables=("rostering",))
    assert bound["rostering"].count() == 3
    bound["rostering"].createOrReplaceTempView("roster_view")
    spark.sql("CREATE DATABASE IF NOT EXISTS hr LOCATION '" + str(tmp_path / "hr") + "'")
    spark.sql("CREATE TABLE hr.roster USING parquet AS SELECT * FROM roster_view")
    listed = tables.bind_tables(spark, catalog="hr", names={"rostering": "roster"}, tables=("rostering",))
    assert listed["rostering"].count() == 3
    spark.sql("DROP TABLE hr.roster")
    with pytest.raises(ValueError):
        tables.bind_tables(spark)


# ---- marks committed by several programs --------------------------------------------


def new_marks(spark, **marks_of):
    return spark.createDataFrame(list(marks_of.items()), "source_db string, last_timestamp timestamp_ntz")


def state(spark, path):
    return {r.source_db: (r.ID, r.last_timestamp) for r in marks.stored_marks(spark, path).collect()}


def test_commits_are_numbered_and_repeat_nothing(spark, tmp_path):
    path = f"{tmp_path}/marks"
    assert marks.stored_marks(spark, path).count() == 0
    assert marks.commit_marks(new_marks(spark, A=T0, B=None), path) == [1, 2]
    assert marks.commit_marks(new_marks(spark, A=T0, B=None), path) == []
    assert marks.commit_marks(new_marks(spark, B=T0 + MICRO), path) == [3]
    assert state(spark, path) == {"A": (1, T0), "B": (3, T0 + MICRO)}
    assert marks.commit_marks(new_marks(spark, A=T0 - HOUR, B=None), path) == []
    assert marks.commit_marks(new_marks(spark, A=T0 - HOUR), path, forward=False) == [4]
    assert state(spark, path)["A"] == (4, T0 - HOUR)
    assert marks.read_mark(marks.stored_marks(spark, path), "B") == T0 + MICRO
    assert {r.ID for r in marks.stored_marks(spark, path, 1).collect()} == {1, 2}


def test_two_interleaved_commits(spark, tmp_path, monkeypatch):
    """Both programs have read the same state; the second one finds its number taken and starts from what the first has written."""
    path, real, seen = f"{tmp_path}/marks", marks._create_new, []
    marks.commit_marks(new_marks(spark, A=T0, B=T0), path)

    def overtaken(session, name, text):
        if not seen:
            seen.append(name)
            monkeypatch.setattr(marks, "_create_new", real)
            assert marks.commit_marks(new_marks(spark, A=T0 + 3 * HOUR, C=T0), path) == [3, 4]
        return real(session, name, text)

    monkeypatch.setattr(marks, "_create_new", overtaken)
    assert marks.commit_marks(new_marks(spark, A=T0 + HOUR, B=T0 + HOUR), path) == [5]
    assert state(spark, path) == {"A": (3, T0 + 3 * HOUR), "B": (5, T0 + HOUR), "C": (4, T0)}
    assert sorted(p.name for p in (tmp_path / "marks").iterdir() if not p.name.startswith(".")) == [f"{n:020d}.json" for n in (1, 2, 3)]


def test_many_programs_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = f"{tmp_path}/marks"
    made = [new_marks(spark, **{f"S{k % 3}": T0 + k * HOUR, f"own{k}": T0}) for k in range(6)]
    with ThreadPoolExecutor(6) as pool:
        ids = [i for found in pool.map(lambda m: marks.commit_marks(m, path), made) for i in found]
    assert len(ids) == len(set(ids))
    got = state(spark, path)
    assert {s: t for s, (_, t) in got.items()} == {**{f"S{k % 3}": T0 + k * HOUR for k in range(3, 6)}, **{f"own{k}": T0 for k in range(6)}}
    assert len({i for i, _ in got.values()}) == len(got)


def test_an_empty_commit_and_a_hopeless_one(spark, tmp_path, monkeypatch):
    assert marks.commit_marks(new_marks(spark, A=T0).limit(0), f"{tmp_path}/m") == []
    monkeypatch.setattr(marks, "_create_new", lambda *a: False)
    with pytest.raises(RuntimeError, match="changed by others"):
        marks.commit_marks(new_marks(spark, A=T0), f"{tmp_path}/m", attempts=3)


# ---- a log kept by day ---------------------------------------------------------------


def test_only_the_days_of_new_rows_are_compared(spark, sent, results, tmp_path):
    path = f"{tmp_path}/log"
    rows = lambda at: delivery.batch_log(delivery.apply_outcomes(sent, results, "salary"), at, "salary")
    for day in (0, 1, 2, 2):
        delivery.append_log(rows(T0 + day * 24 * HOUR), path)
    stored = spark.read.parquet(path)
    assert stored.groupBy("day").count().count() == 3 and stored.count() == 12
    before = {p.name for p in (tmp_path / "log").glob("day=*/*.parquet")}
    delivery.append_log(rows(T0).limit(0), path)
    assert {p.name for p in (tmp_path / "log").glob("day=*/*.parquet")} == before
    guard = outbox.new_batches(sent, stored, T0 + 24 * HOUR)
    plan = guard._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day" in plan
    assert {r.batch_id for r in guard.collect()} == {"b2", "b3", "b4", "b5"}


def test_a_log_without_days_goes_on_as_it_is(spark, sent, results, tmp_path):
    path = f"{tmp_path}/log"
    rows = delivery.batch_log(delivery.apply_outcomes(sent, results, "salary"), T0, "salary")
    rows.write.parquet(path)
    delivery.append_log(rows, path)
    assert spark.read.parquet(path).count() == 4 and "day" not in spark.read.parquet(path).columns


def test_long_responses_are_not_broadcast(spark, tmp_path):
    """Responses that repeat are small as files and large as rows; logs are long. Neither may go through the driver."""
    ids = spark.range(200).select(F.col("id").cast("string").alias("batch_id"))
    sent = ids.select("batch_id", F.lit(1).alias("batch_size"), F.lit("p").alias("payload"))
    results = ids.select(
        "batch_id", F.when(F.col("batch_id") % 2 == 0, 200).otherwise(500).alias("status_code"), F.repeat(F.lit("late "), 400).alias("response")
    )
    results.write.parquet(f"{tmp_path}/results")
    results = spark.read.parquet(f"{tmp_path}/results")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for feed, quiet in (("onboarding", ""), ("attendance", "late " * 400)):
        outcomes = delivery.apply_outcomes(sent, results, feed)
        assert "Broadcast" not in plan(outcomes)
        got = {r["batch_id"]: (r["status"], r["details"]) for r in outcomes.collect()}
        assert got["2"] == ("SUCCESS", quiet) and got["3"] == ("FAILED", "late " * 400) and len(got) == 200
    delivery.append_log(delivery.batch_log(outcomes, T0, "attendance"), f"{tmp_path}/log")
    left = outbox.new_batches(sent, spark.read.parquet(f"{tmp_path}/log"))
    assert "Broadcast" not in plan(left)
    assert left.count() == 100


def test_a_response_without_code_is_still_shown(spark):
    sent = spark.createDataFrame([("a", 1, "p")], "batch_id string, batch_size int, payload string")
    results = spark.createDataFrame([("a", None, "no code")], "batch_id string, status_code int, response string")
    got = delivery.apply_outcomes(sent, results, "onboarding").first()
    assert (got["status"], got["details"]) == ("PENDING", "no code")
