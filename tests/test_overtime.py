"""Overtime parameters: what can be read, and what is rejected."""

import datetime as dt

import pytest

from payfeed.plans import overtime

DAY = dt.date(2024, 1, 1)

CASES = {
    "fine": '[{"ParameterCode":"a","ParameterValue":"90","Conversion":"Hours"},{"ParameterCode":"b","ParameterValue":30}]',
    "nested": '[{"ParameterCode":{"x":1},"ParameterValue":"1"}]',
    "null value": '[{"ParameterCode":"a","ParameterValue":null}]',
    "null item": "[null]",
    "empty": "[]",
    "blank minutes": '[{"ParameterCode":"a","ParameterValue":""}]',
    "json null": "null",
    "object": '{"ParameterCode":"a"}',
    "broken": '[{"ParameterCode":"a"},',
    "text": "abc",
    "numbers": "[1,2]",
    "trailing": '[{"ParameterCode":"a"}] x',
    "words": '[{"ParameterCode":"a","ParameterValue":"ten"}]',
    "absent": None,
}


@pytest.fixture(scope="module")
def roster(spark):
    return spark.createDataFrame([(k, DAY, v) for k, v in CASES.items()], "EmpCode string, Date date, OT_Param_json string")


def test_explode_params(roster):
    got = {}
    for r in overtime.explode_params(roster, ("EmpCode",)).collect():
        got.setdefault(r.EmpCode, []).append((r.Code, r.Minutes, r.Conversion))
    assert got == {
        "fine": [("a", "90", "Hours"), ("b", "30", None)],
        "nested": [(None, "1", None)],
        "null value": [("a", None, None)],
        "null item": [(None, None, None)],
        "blank minutes": [("a", "", None)],
    }


def test_rejects(roster):
    got = {r.EmpCode: r.reason for r in overtime.overtime_rejects(roster).collect()}
    unreadable = {"json null", "object", "broken", "text", "numbers", "trailing"}
    assert set(got) == unreadable | {"words"}
    assert got["words"] == "minutes are not a number"


def test_unknown_codes_are_dropped(spark, roster):
    rates = spark.createDataFrame([("b", 2.0)], "Name string, Rate double")
    params = overtime.explode_params(roster, ("EmpCode",))
    assert [(r.EmpCode, r.ExtraTimePay) for r in overtime.overtime_rates(params, rates).collect()] == [("fine", 2.0)]


def test_the_text_is_parsed_once(spark):
    roster = spark.createDataFrame([("E", "[]", 1), ("F", None, 2)], "EmpCode string, OT_Param_json string, OT_UpdatedDate int")
    plan = overtime.explode_params(roster, ("EmpCode",))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_nulls_in_a_list_are_rows_and_empty_lists_are_none(spark):
    rows = [("nulls", '[null,{"ParameterCode":"a"}]'), ("empty", "[]"), ("none", None), ("bad", "[{")]
    found = overtime.explode_params(spark.createDataFrame(rows, "EmpCode string, OT_Param_json string"), ("EmpCode",))
    assert sorted(((r.EmpCode, r.Code) for r in found.collect()), key=str) == [("nulls", "a"), ("nulls", None)]
