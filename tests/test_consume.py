"""Messages of several countries in one pass."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql.types import StructType

from payfeed.plans import payloads
from payfeed.plans.consume import consume

AS_OF = dt.datetime(2026, 3, 1)
INDIA = "EmployeeCode string, EmployeeID bigint, MonthlyAmount double, PayHead string, DOJ string"
THERE = "EmployeeCode string, EmployeeID bigint, MonthlyRate double, DOJ string, `odd.name` int"


def text(subscription, records):
    return json.dumps({"subscription_name": subscription, "records": records})


@pytest.fixture(scope="module")
def sources(spark):
    rows = [("a", "in", "INDIA"), ("b", "ph", "PHILIPPINES"), ("c", "th", "THAILAND"), ("d", "lost", None), ("e", None, "INDIA")]
    return spark.createDataFrame(rows, "name string, subscription_name string, country string")


def schemas():
    return {"INDIA": StructType.fromDDL(INDIA), "PHILIPPINES": StructType.fromDDL(THERE)}


def run(spark, sources, messages):
    df = spark.createDataFrame(list(messages.items()), "message_id string, message string")
    return consume(df, "onboarding", sources, schemas(), AS_OF)


def test_each_country_gets_its_payload(spark, sources):
    one, two = {"EmployeeCode": "E1", "EmployeeID": 7, "MonthlyAmount": 12.5, "PayHead": "B"}, {"EmployeeCode": "E2", "MonthlyRate": 1e15}
    got = run(spark, sources, {"m1": text("in", [one, {**one, "EmployeeID": None}]), "m2": text("ph", [two])}).collect()
    by = {(r.message_id, r.position): r for r in got}
    assert set(by) == {("m1", 0), ("m1", 1), ("m2", 0)} and all(r.error is None for r in got)
    for country, sent, key in (("INDIA", one, ("m1", 0)), ("PHILIPPINES", two, ("m2", 0))):
        schema = schemas()[country]
        plain = spark.createDataFrame([tuple(sent.get(n) for n in schema.fieldNames())], schema)
        want = payloads.project(plain, "onboarding", country, as_of=AS_OF).first().asDict()
        assert json.loads(by[key].record) == want
    assert by["m2", 0].country == "PHILIPPINES" and by["m2", 0].subscription_name == "ph"


def test_every_message_that_gives_no_record_gives_an_error(spark, sources):
    record = {"EmployeeCode": "E"}
    messages = {
        "broken": '{"subscription_name":"in","records":[{"EmployeeCode":', "null": None, "empty": "", "list": "[1]",
        "nobody": text("nobody", [record]), "unnamed": json.dumps({"records": [record]}), "blank": text("", [record]),
        "no country": text("lost", [record]), "unserved": text("th", [record]), "no records": text("in", []), "missing": json.dumps({"subscription_name": "in"}),
    }
    got = {r.message_id: r for r in run(spark, sources, messages).collect()}
    assert set(got) == set(messages)
    assert all(r.record is None and r.position is None for r in got.values())
    assert {k: r.error for k, r in got.items()} == {
        "broken": "invalid JSON", "null": "invalid JSON", "empty": "invalid JSON", "list": "invalid JSON",
        "nobody": "no source configured for nobody", "unnamed": "no source configured for null", "blank": "no source configured for ",
        "no country": "unsupported country: null", "unserved": "unsupported country: THAILAND", "no records": "no records", "missing": "no records",
    }


def test_a_bad_record_leaves_the_others(spark, sources):
    got = run(spark, sources, {"m": '{"subscription_name":"in","records":[{"EmployeeCode":"A"}, 5, null, {"EmployeeCode":"B","EmployeeID":"x"}]}'}).collect()
    assert [(r.position, r.error) for r in sorted(got, key=lambda r: r.position)] == [(0, None), (1, "record is no object"), (2, "record is no object"), (3, None)]
    assert [json.loads(r.record)["employee_code"] for r in got if r.error is None] == ["A", "B"]


def test_records_are_kept_to_the_letter(spark, sources):
    """Text of a record survives until its schema is known: numbers, escapes, nested text."""
    got = run(spark, sources, {"m": '{"subscription_name":"in","records":[{"EmployeeCode":"\\u00e9\\"]}","EmployeeID":9007199254740993,"MonthlyAmount":0.1}]}'}).first()
    record = json.loads(got.record)
    assert record["employee_code"] == 'é"]}' and record["employee_id"] == 9007199254740993


def test_messages_are_read_once(spark, sources, tmp_path):
    path = str(tmp_path / "messages")
    spark.createDataFrame([("m", text("in", [{"EmployeeCode": "E"}]))], "message_id string, message string").write.parquet(path)
    found = consume(spark.read.parquet(path), "onboarding", sources, schemas(), AS_OF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == 1 and "Union" not in plan
    assert found.count() == 1
