"""Sizes far above what configuration usually has change nothing."""

import pytest
from pyspark.sql import functions as F

from payfeed.functions.fields import round_money
from payfeed.operators.attributes import configured_dimensions
from payfeed.operators.properties import distinct_codes, property_matrix
from payfeed.plans.overtime import explode_params, overtime_rejects


def test_every_configured_dimension_counts(spark):
    rows = [(1, "CompensationAndBenefits", "CompensationAndBenefits", "B|A" if i < 300 else "C") for i in range(301)]
    config = spark.createDataFrame(rows, "Applicable int, ModuleCode string, SubModuleCode string, AttributeBasedOnDesc string")
    assert configured_dimensions(config) == ["A", "B", "C"]
    many = spark.createDataFrame([(1, *rows[0][1:3], "|".join(f"D{i:03}" for i in range(250)))], config.schema)
    assert len(configured_dimensions(many)) == 250


def test_long_codes_are_read(spark):
    long = "c" * 5000
    text = '[{"ParameterCode":"%s","ParameterValue":"60","Conversion":"H"}]' % long
    roster = spark.createDataFrame([("E", text), ("F", "[]")], "EmpCode string, OT_Param_json string")
    assert [r.Code for r in explode_params(roster, ("EmpCode",)).collect()] == [long]
    assert overtime_rejects(roster).isEmpty()


def test_a_row_with_bad_minutes_sends_nothing(spark):
    text = '[{"ParameterCode":"a","ParameterValue":"60","Conversion":"H"},{"ParameterCode":"b","ParameterValue":"?","Conversion":"H"}]'
    roster = spark.createDataFrame([("E", text)], "EmpCode string, OT_Param_json string")
    assert explode_params(roster, ("EmpCode",)).isEmpty()
    assert [r.reason for r in overtime_rejects(roster).collect()] == ["minutes are not a number"]


def test_many_property_codes(spark):
    rows = spark.range(600).select(F.lit(1).alias("g"), F.format_string("C%03d", "id").alias("GPP_PropertyCode"), F.lit(True).alias("PropertyChecked"))
    assert len(distinct_codes(rows)) == 600
    matrix = property_matrix(rows)
    assert len(matrix.columns) == 601 and matrix.first()["C599"] == 1


@pytest.mark.parametrize("size", [1.0, 1e6, 1e11, 1e12, 8e12, 1e13, 6e13, 7.1e13, 1e14, 1e15, 1e17])
def test_amounts_round_like_python_at_any_size(spark, size):
    values = [sign * (size + step) for sign in (1, -1) for step in (0.0, 0.005, 0.015, 0.025, 0.125, 0.375, 0.625, 0.875, 0.25, 0.995, 0.004, 2.675)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_money(F.col("v")).alias("r")).collect()
    assert [(r.v, r.r) for r in got] == [(v, round(v, 2)) for v in values]
