"""Payload projection."""

import datetime as dt

import pytest

from payfeed.plans import payloads


def test_unknown_country_raises(spark):
    with pytest.raises(payloads.UnsupportedCountry):
        payloads.project(spark.range(1), "onboarding", "THAILAND")


def test_field_counts_and_no_repeats():
    counts = {key: len(payloads.fields(*key)) for key in payloads.SPECS}
    assert counts == {
        ("onboarding", "INDIA"): 34,
        ("onboarding", "PHILIPPINES"): 26,
        ("salary", "INDIA"): 27,
        ("salary", "PHILIPPINES"): 28,
        ("salary", "THAILAND"): 27,
        ("variable", "INDIA"): 15,
        ("variable", "PHILIPPINES"): 13,
        ("variable", "THAILAND"): 13,
    }
    for key in payloads.SPECS:
        outputs = [f.output for f in payloads.fields(*key)]
        assert len(outputs) == len(set(outputs))


def test_columns_that_a_feed_lacks(spark):
    row = payloads.project(spark.range(1), "onboarding", "INDIA").first()
    assert (row.DOJ, row.employee_code, row.gender, row.employee_id, row.ot_applicable, row.monthly_rate) == ("", "", 1, 0, 1, 0.0)


def test_nulls_in_text(spark):
    df = spark.createDataFrame([(None, None, None, "Male")], "DOJ date, EmployeeCode string, PayHead string, Gender string")
    row = payloads.project(df, "onboarding", "INDIA").first()
    assert (row.DOJ, row.employee_code, row.payhead_code, row.gender) == ("None", "None", "none", 0)
    kept = payloads.project(df, "onboarding", "INDIA", null_text=None).first()
    assert (kept.DOJ, kept.employee_code, kept.payhead_code) == (None, None, None)


SALARY = "EmployeeCode string, PayHead string, PayHeadID int, MonthlyAmount double, YearlyAmount double, IsTaxApplicable int, IsOTApplicable int"


def test_salary_india_corrected_and_literal(spark):
    as_of = dt.datetime(2026, 4, 5)
    df = spark.createDataFrame([("E1", "BASIC", 9, 2.675, 32.1, 0, 0)], SALARY)
    good = payloads.project(df, "salary", "INDIA", as_of=as_of).first()
    assert (good.payhead_code, good.payhead_id, good.monthly_rate, good.yearly_rate) == ("basic", 9, 2.67, 32.1)
    assert (good.income_tax_applicable, good.ot_applicable, good.from_date, good.fin_year) == (0, 0, "2026-04-05", "2026-2027")
    plain = payloads.project(df, "salary", "INDIA", as_of=as_of, corrected=False).first()
    assert (plain.payhead_code, plain.payhead_id, plain.monthly_rate, plain.yearly_rate) == ("", 1, 0.0, 0.0)
    assert (plain.income_tax_applicable, plain.ot_applicable) == (1, 1)
    thai = payloads.project(df, "salary", "THAILAND", as_of=as_of).first()
    assert thai.fin_year == "2026-2026" and thai.payhead_code == ""


def test_flags_of_onboarding_philippines_follow_the_feed_names(spark):
    df = spark.createDataFrame([(1, 1, None)], "Sssemployee int, Otapplicable int, Philhealthemployee int")
    good = payloads.project(df, "onboarding", "PHILIPPINES").first()
    assert (good.sss_employee, good.ot_applicable, good.philhealth_employee, good.sss_employer) == (1, 1, 0, 0)
    assert payloads.project(df, "onboarding", "PHILIPPINES", corrected=False).first().sss_employee == 0


def test_strict_fields_report_errors(spark):
    df = spark.createDataFrame([(1.0, 12.0), (None, 12.0), (1.0, None)], "MonthlyRate double, YearlyRate double")
    got = payloads.project(df, "salary", "PHILIPPINES", with_errors=True).collect()
    assert [r[payloads.ERROR] for r in got] == [None, "monthly_rate", "yearly_rate"]


def test_variable_philippines(spark):
    df = spark.createDataFrame(
        [(7, "E7", 12345678.5, dt.datetime(2024, 2, 3, 4), None), (None, None, None, None, 0)],
        "EmployeeID int, EmployeeCode string, Amount double, ApprovedDate timestamp_ntz, TaxApplicable int",
    )
    first, second = payloads.project(df, "variable", "PHILIPPINES").collect()
    assert (first.Amount, first.ApprovedDate, first.TaxApplicable, first.Type) == ("12345678.5", "2024-02-03", 1, 1)
    assert (second.EmployeeID, second.EmployeeCode, second.Amount, second.ApprovedDate, second.TaxApplicable) == (0, "None", "0.0", None, 0)


def test_variable_india_unreadable_number_is_an_error(spark):
    df = spark.createDataFrame([("x", "1"), ("5", "y"), (None, "2.5")], "EmployeeID string, Amount string")
    got = payloads.project(df, "variable", "INDIA", with_errors=True).collect()
    assert [r[payloads.ERROR] for r in got] == ["EmployeeID", "Amount", None]
    assert (got[2].EmployeeID, got[2].Amount) == (0, 2.5)


def test_day_of_the_run_must_be_given(spark):
    with pytest.raises(ValueError, match="as_of"):
        payloads.project(spark.range(1), "salary", "INDIA")
