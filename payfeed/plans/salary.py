"""Salary-revision feeds: salary rows changed since a mark, by country."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payfeed.functions.fields import date_floor, effective_date, year_start_floor
from payfeed.operators.attributes import MODULE
from payfeed.operators.changes import changed_since
from payfeed.operators.predicates import (
    STATUS_ACTIVE,
    STATUS_ACTIVE_AND_NOTICE,
    current_salary,
    with_status,
)
from payfeed.plans import stars
from payfeed.plans.onboarding import proper

ORDER = ("EmployeeID",)

_SALARY = ("EmpCode", "HeadCode", "MonthlyRate", "YearlyValue", "FromDate", "ToDate", "EffDate", "updateDate")


def _revised(tables, mark, as_of) -> tuple[DataFrame, DataFrame]:
    """Changed current salaries, staged, and their employees."""
    changed = changed_since(tables["salary_master"], "updateDate", mark, inclusive=True, as_of=as_of)
    return stars.stage_changes(current_salary(changed).select(*_SALARY))


def salary_india_feed(
    tables: dict[str, DataFrame],
    mark: dt.datetime | None,
    as_of: dt.datetime,
    module: str = MODULE,
) -> DataFrame:
    staff = with_status(stars.people_with_finance(tables), STATUS_ACTIVE_AND_NOTICE)
    salary, keys = _revised(tables, mark, as_of)
    roll = stars.employee_roll(tables, staff, module, keys)
    rows = stars.rule_star(salary, roll, stars.head_rules(tables))
    salutation, first, middle, last, dob, gender = stars.names()
    return rows.select(
        F.col("ED_EMPID").alias("EmployeeID"),
        F.col("updateDate").alias("updateDate_timestamp"),
        F.col("EmpCode").alias("EmployeeCode"),
        F.col("ED_CountryID").alias("CountryId"),
        salutation,
        first,
        middle,
        last,
        F.col("EFD_StateId").alias("StateID"),
        dob,
        F.col("FromDate").cast("date").alias("FromDate"),
        gender,
        F.col("HeadCode").alias("PayHead"),
        "PayHeadID",
        "PayHeadCategoryID",
        F.col("MonthlyRate").alias("MonthlyAmount"),
        F.col("YearlyValue").alias("YearlyAmount"),
        F.col("ToDate").cast("date").alias("ToDate"),
        effective_date("INDIA", F.col("EffDate"), F.col("FromDate")).alias("EffDate"),
        F.col("PfApp").alias("IsPFApplicable"),
        F.col("EFD_PFApplicable").alias("IsPFApplicableForEmployee"),
        F.col("EsicApp").alias("IsESICApplicable"),
        F.col("EFD_ESICApplicable").alias("IsESICApplicableForEmployee"),
        F.col("PtApp").alias("IsPTApplicable"),
        F.col("EFD_PTApplicable").alias("IsPTApplicableForEmployee"),
        F.col("LwfApp").alias("IsLWFApplicable"),
        F.col("EFD_LwfApplicable").alias("IsLWFApplicableForEmployee"),
        F.col("PfApp").alias("IsVPFApplicable"),
        F.col("EFD_VPFApplicable").alias("IsVPFApplicableForEmployee"),
        F.col("OTApplicable").alias("IsOTApplicable"),
        F.col("TaxApp").alias("IsTaxApplicable"),
        "SpotTaxApp",
        "GrossNetApp",
        F.col("GratuityApp").alias("gratuity_applicable"),
        "LeenPayApp",
    )


def _salary_with_properties(
    tables, mark, as_of, country_id, codes, module, *, country, status, with_rules, with_update_time, present_only
) -> DataFrame:
    lookup, codes = stars.property_lookup(tables, country_id, codes, proper, with_rules)
    staff = with_status(stars.people(tables), status)
    salary, keys = _revised(tables, mark, as_of)
    rows = stars.rule_star(salary, stars.employee_roll(tables, staff, module, keys), lookup)
    joined = date_floor(F.col("ED_DOJ"), year_start_floor(as_of))
    start = F.lit(as_of.date()) if country == "PHILIPPINES" else joined
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
            start.alias("FromDate"),
            F.col("ToDate").cast("date").alias("ToDate"),
            effective_date(country, F.col("EffDate"), F.col("FromDate")).alias("EffDate"),
            *(stars.HEAD_FLAGS if with_rules else ()),
            *[f"`{f}`" for f in flags],
            *([F.col("updateDate").alias("updateDate_timestamp")] if with_update_time else []),
        ),
        flags,
        newest="updateDate_timestamp" if with_update_time else None,
    )
    return stars.drop_absent(feed, flags) if present_only else feed


def salary_philippines_feed(
    tables: dict[str, DataFrame],
    mark: dt.datetime | None,
    as_of: dt.datetime,
    country_id: int,
    codes: list[str] | None = None,
    module: str = MODULE,
    with_update_time: bool = False,
    present_only: bool = True,
) -> DataFrame:
    return _salary_with_properties(
        tables, mark, as_of, country_id, codes, module,
        country="PHILIPPINES", status=STATUS_ACTIVE, with_rules=False,
        with_update_time=with_update_time, present_only=present_only,
    )


def salary_thailand_feed(
    tables: dict[str, DataFrame],
    mark: dt.datetime | None,
    as_of: dt.datetime,
    country_id: int,
    codes: list[str] | None = None,
    module: str = MODULE,
    with_update_time: bool = False,
    present_only: bool = True,
) -> DataFrame:
    return _salary_with_properties(
        tables, mark, as_of, country_id, codes, module,
        country="THAILAND", status=STATUS_ACTIVE_AND_NOTICE, with_rules=True,
        with_update_time=with_update_time, present_only=present_only,
    )
