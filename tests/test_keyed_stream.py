"""Feeds of several changing tables as a stream, against the batch run on the same files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from payfeed.catalog.star_schema import PROPERTY_CODES, hr_tables
from payfeed.plans.increment import FEEDS, run_increment
from payfeed.streaming.keyed import Watch, changes, keyed, stream_changes

AS_OF = dt.datetime(2001, 11, 5)
MARK = dt.datetime(1998, 6, 1)
MARKS = "ID int, last_timestamp timestamp_ntz, source_db string"
CODES = {"codes": list(PROPERTY_CODES)}


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    t = hr_tables(spark, sf_dir)
    return {name: t[name] for name in t}


def records(spark, path):
    return sorted(r.record for r in spark.read.parquet(f"{path}/records").select("record").collect())


def batch_records(spark, tables, name, tmp_path, **options):
    marks = spark.createDataFrame([(1, MARK, "db")], MARKS)
    sent = run_increment(FEEDS[name], {"db": tables}, {"db": "s"}, marks, AS_OF, f"{tmp_path}/batch", **options)
    return records(spark, sent.first().payload.rsplit("/", 1)[0])


def pay_watch(tables, tmp_path, **more):
    arrived = tables["salary_master"].where(F.col("updateDate") > F.lit(MARK).cast("timestamp_ntz"))
    arrived.repartition(3, "EmpCode").write.parquet(f"{tmp_path}/pay")
    return Watch("salary_master", f"{tmp_path}/pay", arrived.schema, F.col("EmpCode"), **more)


@pytest.mark.parametrize("name, options, per_batch", [("onboarding_india", {}, 1), ("onboarding_philippines", CODES, None)])
def test_stream_equals_batch(spark, tables, tmp_path, name, options, per_batch):
    shape = keyed(FEEDS[name], lambda: tables, "db", "s", now=lambda: AS_OF, **options)
    stream_changes(spark, [pay_watch(tables, tmp_path, files_per_batch=per_batch)], shape, f"{tmp_path}/out", f"{tmp_path}/state")
    # Files are dealt by employee, so nobody is named in two micro-batches.
    assert records(spark, f"{tmp_path}/out") == batch_records(spark, tables, name, tmp_path, **options)
    assert (len(list((tmp_path / "out" / "records").glob("epoch=*"))) > 1) == (per_batch == 1)


@pytest.mark.parametrize("name", ["salary_philippines", "salary_thailand"])
def test_revisions_equal_batch(spark, tables, tmp_path, name):
    options = {"country_id": 103, **CODES}
    shape = keyed(FEEDS[name], lambda: tables, "db", "s", revised={"salary_master": "updateDate"}, mark=dt.datetime.min, now=lambda: AS_OF, **options)
    watch = pay_watch(tables, tmp_path, time=F.col("updateDate"))
    stream_changes(spark, [watch], shape, f"{tmp_path}/out", f"{tmp_path}/state")
    later = {**tables, "salary_master": tables["salary_master"].where(F.col("updateDate") > F.lit(MARK).cast("timestamp_ntz"))}
    want = batch_records(spark, later, name, tmp_path, **options)
    assert want and records(spark, f"{tmp_path}/out") == want


def test_variable_pay_of_all_equals_batch(spark, tables, tmp_path):
    staff = tables["employee_details"]
    staff.write.parquet(f"{tmp_path}/staff")
    options = {"country_id": 103, **CODES}
    shape = keyed(FEEDS["variable_philippines"], lambda: tables, "db", "s", now=lambda: AS_OF, **options)
    stream_changes(spark, [Watch("employee_details", f"{tmp_path}/staff", staff.schema, F.col("ED_EMPCode"))], shape, f"{tmp_path}/out", f"{tmp_path}/state")
    want = batch_records(spark, tables, "variable_philippines", tmp_path, **options)
    assert want and records(spark, f"{tmp_path}/out") == want


def test_a_change_in_another_table_sends_the_whole_employee(spark, tables, tmp_path):
    """An attribute arrives for some, pay for others, both for a few; and rows that name nobody."""
    attributes = tables["employee_attribute_details"]
    code = F.regexp_extract("EmployeeCode", r"\d+", 0).cast("int")
    some = attributes.where(code <= 20)
    some.unionByName(some.limit(3).withColumn("EmployeeCode", F.lit(None).cast("string"))).write.parquet(f"{tmp_path}/attributes")
    pay = tables["salary_master"].where((F.col("EmpCode").isin("E13", "E16", "E22", "E25")) & F.col("updateDate").isNotNull())
    pay.write.parquet(f"{tmp_path}/pay")
    watches = [
        Watch("employee_attribute_details", f"{tmp_path}/attributes", attributes.schema, F.col("EmployeeCode")),
        Watch("salary_master", f"{tmp_path}/pay", pay.schema, F.col("EmpCode")),
    ]
    shape = keyed(FEEDS["onboarding_india"], lambda: tables, "db", "s", now=lambda: AS_OF)
    stream_changes(spark, watches, shape, f"{tmp_path}/out", f"{tmp_path}/state")
    named = {f"E{k}" for k in range(21)} | {"E22", "E25"}
    whole = FEEDS["onboarding_india"].build(tables, mark=None, as_of=AS_OF)
    want = whole.where(F.col("EmployeeCode").isin(*named)).count()
    batches = spark.read.parquet(f"{tmp_path}/out/batches")
    assert want > 0 and batches.agg(F.sum("batch_size")).first()[0] == want
    codes = {r[0] for r in spark.read.parquet(f"{tmp_path}/out/records").select(F.get_json_object("record", "$.employee_code")).distinct().collect()}
    assert codes <= named and codes & {"E22", "E25"} and codes - {"E22", "E25", "E13", "E16"}


def test_a_failed_micro_batch_is_replaced(spark, tables, tmp_path):
    watch = pay_watch(tables, tmp_path)
    real = keyed(FEEDS["onboarding_india"], lambda: tables, "db", "s", now=lambda: AS_OF)
    tries = []

    def failing(rows, epoch):
        tries.append(epoch)
        found = real(rows, epoch)
        if len(tries) == 1:  # one table is written, then the driver is lost
            return {"batches": found["batches"], "records": spark.range(1).select(F.raise_error(F.lit("lost")).cast("string").alias("record"))}
        return found

    with pytest.raises(Exception, match="lost"):
        stream_changes(spark, [watch], failing, f"{tmp_path}/out", f"{tmp_path}/state")
    stream_changes(spark, [watch], failing, f"{tmp_path}/out", f"{tmp_path}/state")
    assert tries == [0, 0]
    want = batch_records(spark, tables, "onboarding_india", tmp_path)
    assert records(spark, f"{tmp_path}/out") == want
    stream_changes(spark, [watch], failing, f"{tmp_path}/out", f"{tmp_path}/state")
    assert tries == [0, 0]  # nothing new, nothing sent
    assert spark.read.parquet(f"{tmp_path}/out/batches").agg(F.sum("batch_size")).first()[0] == len(want)


def test_one_query_for_all_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="no tables"):
        changes(spark, [])
