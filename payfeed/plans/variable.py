"""Variable-pay feeds: changed rows for India, the full set for Philippines and Thailand."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payfeed.functions.fields import signed_amount
from payfeed.operators.attributes import MODULE
from payfeed.operators.changes import changed_since
from payfeed.operators.predicates import current_salary
from payfeed.operators.properties import PF_CODES, SSC_CODES, VPF_CODES, resolved_flag
from payfeed.plans import stars
from payfeed.session import materialize

ORDER = ("EmployeeID",)


def variable_rows(
    variable: DataFrame, mark: dt.datetime | None, as_of: dt.datetime
) -> DataFrame:
    """Changed variable-pay rows with an update time and a non-zero amount."""
    changed = changed_since(variable, "UpdatedDate", mark, inclusive=True, as_of=as_of)
    return changed.where(F.col("UpdatedDate").isNotNull() & (F.col("Amount") != 0))


def variable_india_feed(
    tables: dict[str, DataFrame],
    mark: dt.datetime | None,
    as_of: dt.datetime,
    module: str = MODULE,
    with_update_time: bool = False,
) -> DataFrame:
    changed, keys = stars.stage_changes(
        variable_rows(tables["emp_variable"], mark, as_of).select(
            "EmpCode", "HeadCode", "Amount", "UpdatedDate"
        )
    )
    roll = stars.employee_roll(tables, stars.people_with_finance(tables), module, keys)
    rows = stars.rule_star(changed, roll, stars.head_rules(tables))

    def flag(column: str, alias: str):
        return F.coalesce(F.col(column), F.lit(0)).alias(alias)

    columns = [
        F.col("ED_EMPID").alias("EmployeeID"),
        F.col("EmpCode").alias("EmployeeCode"),
        F.col("ED_CountryID").alias("CountryId"),
        F.col("HeadCode").alias("PayHeadCode"),
        F.col("PayHeadID"),
        F.col("UpdatedDate").alias("ApprovedDate"),
        signed_amount(F.col("PayHeadCategoryID"), F.col("Amount")).alias("Amount"),
        F.col("PayHeadCategoryID").alias("Type"),
        flag("EFD_PFApplicable", "PFApplicable"),
        flag("EFD_PTApplicable", "PTApplicable"),
        flag("EFD_LwfApplicable", "LWFApplicable"),
        flag("EFD_ESICApplicable", "ESICApplicable"),
        flag("EFD_VPFApplicable", "VPFApplicable"),
        flag("TaxApp", "TaxApplicable"),
        flag("SpotTaxApp", "SpotTaxApplicable"),
        flag("OTApplicable", "OTApplicable"),
    ]
    if with_update_time:
        columns.append(F.col("UpdatedDate").alias("updateDate_timestamp"))
    return rows.select(*columns)


def applicability(
    tables: dict[str, DataFrame], country_id: int, codes: list[str] | None = None, module: str = MODULE
) -> DataFrame:
    """Different sets of flags that apply to an employee through any current pay head.

    Salaries matter only through the heads they name, so they are reduced to distinct
    heads before anything is joined.
    """
    lookup, codes = stars.property_lookup(tables, country_id, codes)
    heads = current_salary(tables["salary_master"]).select("EmpCode", "HeadCode").distinct()
    ids = stars.people(tables).select("EmpCode", "ED_EMPID")
    rows = stars.rule_star(heads, stars.employee_roll(tables, ids, module), lookup)
    per_head = rows.groupBy("EmpCode", "ED_EMPID", "PayHeadID", *stars.HEAD_FLAGS).agg(
        *[F.max(f"`{c}`").alias(c) for c in codes]
    )
    # An alias counts only if some row of the result has it, so the rows are staged to see which do.
    per_head = materialize(per_head, "heads")
    used = stars.filled(per_head, codes)
    return per_head.select(
        "ED_EMPID",
        resolved_flag(used, PF_CODES).alias("PFApplicable"),
        resolved_flag(used, SSC_CODES).alias("SSCApplicable"),
        resolved_flag(used, VPF_CODES).alias("VPFApplicable"),
        *stars.HEAD_FLAGS,
    ).distinct()


def variable_philippines_feed(
    tables: dict[str, DataFrame],
    mark: dt.datetime | None = None,
    as_of: dt.datetime | None = None,
    *,
    country_id: int,
    codes: list[str] | None = None,
    module: str = MODULE,
) -> DataFrame:
    """Distinct variable-pay rows with every set of flags of the employee.

    Always the full set, whatever the mark. Each side of the join holds distinct rows
    of columns that all reach the output, so the output is distinct without another pass.
    """
    variable = tables["emp_variable"].select("EmpCode", "HeadCode", "CreatedDate", "Amount").distinct()
    heads = (
        tables["payhead_master"]
        .select("PayHeadID", F.col("PayHeadCode").alias("HeadCode"), "PayHeadCategoryID")
        .distinct()
    )
    ids = stars.people(tables).select("EmpCode", "ED_EMPID").distinct()
    rows = variable.join(heads, "HeadCode").join(ids, "EmpCode")
    return rows.join(applicability(tables, country_id, codes, module), "ED_EMPID").select(
        F.col("ED_EMPID").alias("EmployeeID"),
        F.col("EmpCode").alias("EmployeeCode"),
        "PayHeadID",
        F.col("HeadCode").alias("PayheadCode"),
        "PayHeadCategoryID",
        F.col("CreatedDate").alias("ApprovedDate"),
        signed_amount(F.col("PayHeadCategoryID"), F.col("Amount")).alias("Amount"),
        F.lit(1).alias("Type"),
        "PFApplicable",
        "SSCApplicable",
        "VPFApplicable",
        "LeenPayApp",
        F.col("TaxApp").alias("TaxApplicable"),
        F.col("SpotTaxApp").alias("SpotTaxApplicable"),
    )
