"""Onboarding feeds: pay of new or changed employees, India and Philippines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payfeed.functions.fields import ONBOARDING_FLOOR, date_floor
from payfeed.operators.attributes import MODULE
from payfeed.operators.changes import changed_since
from payfeed.operators.predicates import (
    STATUS_ACTIVE_AND_NOTICE,
    STATUS_ONBOARDING_INDIA,
    current_salary,
    with_status,
)
from payfeed.plans import stars
from payfeed.session import materialize

ORDER = ("EmployeeID",)

# Country of the Philippines feed, and its joining date until go-live.
PHILIPPINES_ID = 103
GO_LIVE = dt.date(2026, 1, 1)
# A mark that the India feed takes for no mark.
EMPTY_MARK = dt.datetime(1900, 1, 1)


def proper(code: str) -> str:
    """Column name of a property code."""
    return code[:1].upper() + code[1:].lower()


def _changed_employees(tables, mark: dt.datetime | None) -> DataFrame | None:
    """Employees with any changed salary row; None for all of them, on a first run.

    Limiting the employee roll to them also limits the salaries joined to it.
    """
    if mark is None:
        return None
    changed = changed_since(tables["salary_master"], "updateDate", mark, days=None)
    return materialize(changed.select("EmpCode").distinct(), "changed")


def onboarding_india_feed(
    tables: dict[str, DataFrame],
    mark: dt.datetime | None,
    as_of: dt.datetime | None = None,
    module: str = MODULE,
    with_update_time: bool = False,
) -> DataFrame:
    salary = current_salary(tables["salary_master"]).select(
        "EmpCode", "HeadCode", "MonthlyRate", "YearlyValue", "FromDate", "ToDate", "EffDate", "updateDate"
    )
    staff = with_status(stars.people_with_finance(tables), STATUS_ONBOARDING_INDIA)
    mark = None if mark == EMPTY_MARK else mark
    roll = stars.employee_roll(tables, staff, module, _changed_employees(tables, mark))
    rows = stars.rule_star(salary, roll, stars.head_rules(tables).where(F.col("GrossNetApp") == 1))
    salutation, first, middle, last, dob, gender = stars.names(include_gender_code=False)
    columns = [
        F.lit("Daily").alias("InputType"),
        F.col("ED_EMPID").alias("EmployeeID"),
        F.col("EmpCode").alias("EmployeeCode"),
        F.col("ED_CountryID").alias("CountryId"),
        salutation,
        first,
        middle,
        last,
        F.col("EFD_StateId").alias("StateID"),
        dob,
        F.col("ED_DOJ").alias("DOJ"),
        gender,
        F.col("HeadCode").alias("PayHead"),
        F.col("PayHeadID"),
        F.col("PayHeadCategoryID"),
        F.col("MonthlyRate").alias("MonthlyAmount"),
        F.col("YearlyValue").alias("YearlyAmount"),
        F.col("FromDate"),
        F.col("ToDate"),
        F.col("EffDate").alias("effDate"),
        F.col("ED_Status"),
        F.col("ED_DOL"),
        F.col("PfApp").alias("IsPFApplicable"),
        F.col("EFD_PFApplicable").alias("IsPFApplicableForEmployee"),
        F.col("EsicApp").alias("IsESICApplicable"),
        F.col("EFD_ESICApplicable").alias("IsESICApplicableForEmployee"),
        F.col("PtApp").alias("IsPTApplicable"),
        F.col("EFD_PTApplicable").alias("IsPTApplicableForEmployee"),
        F.col("LwfApp").alias("IsLWFApplicable"),
        F.col("EFD_LwfApplicable").alias("IsLWFApplicableForEmployee"),
        # One flag feeds both provident-fund outputs.
        F.col("PfApp").alias("IsVPFApplicable"),
        F.col("EFD_VPFApplicable").alias("IsVPFApplicableForEmployee"),
        F.col("OTApplicable").alias("IsOTApplicable"),
        F.col("TaxApp").alias("IsTaxApplicable"),
        F.col("SpotTaxApp"),
        F.col("GrossNetApp"),
        F.col("GratuityApp").alias("gratuity_applicable"),
    ]
    if with_update_time:
        columns.append(F.col("updateDate").alias("updateDate_timestamp"))
    return rows.select(*columns)


def onboarding_philippines_feed(
    tables: dict[str, DataFrame],
    mark: dt.datetime | None,
    as_of: dt.datetime | None = None,
    codes: list[str] | None = None,
    override_date: dt.date | None = GO_LIVE,
    country_id: int = PHILIPPINES_ID,
    module: str = MODULE,
    present_only: bool = True,
) -> DataFrame:
    """``override_date`` replaces joining and start date; None keeps the floored dates."""
    salary = current_salary(tables["salary_master"]).select(
        "EmpCode", "HeadCode", "MonthlyRate", "YearlyValue", "ToDate", "EffDate", "updateDate"
    )
    lookup, codes = stars.property_lookup(tables, country_id, codes, proper)
    staff = with_status(stars.people(tables), STATUS_ACTIVE_AND_NOTICE)
    roll = stars.employee_roll(tables, staff, module, _changed_employees(tables, mark))
    rows = stars.rule_star(salary, roll, lookup)
    joined = date_floor(F.col("ED_DOJ"), ONBOARDING_FLOOR) if override_date is None else F.lit(override_date)
    flags = [proper(c) for c in codes]
    salutation, first, middle, last, dob, gender = stars.names()
    feed = stars.merge_flags(
        rows.select(
            F.col("ED_EMPID").alias("EmployeeID"),
            F.col("EmpCode").alias("EmployeeCode"),
            "CountryId",
            salutation,
            first,
            middle,
            last,
            dob,
            joined.alias("DOJ"),
            gender,
            F.col("HeadCode").alias("PayheadCode"),
            "PayHeadCategoryID",
            F.col("PayHeadID").alias("PayheadId"),
            "MonthlyRate",
            F.col("YearlyValue").alias("YearlyRate"),
            joined.alias("FromDate"),
            F.col("ToDate").cast("date").alias("ToDate"),
            F.col("EffDate").cast("date").alias("EffDate"),
            *stars.HEAD_FLAGS,
            F.col("updateDate").alias("updateDate_timestamp"),
            *[f"`{f}`" for f in flags],
        ),
        flags,
    )
    return stars.drop_absent(feed, flags) if present_only else feed
