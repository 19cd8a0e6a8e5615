"""Configuration, attributes, properties and the joins between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payfeed.catalog.registry import COUNTRY, VARIABLE_AS_OF, VARIABLE_MARK, query
from payfeed.catalog.star_schema import PROPERTY_CODES, hr_tables, read
from payfeed.operators import attributes, properties
from payfeed.operators.attributes import MODULE
from payfeed.operators.predicates import current_salary
from payfeed.plans import attendance, overtime, stars, variable

CODES = list(PROPERTY_CODES)


@query(
    "join_roster_employee",
    """SELECT r.EmpCode, d.ED_EMPID, r."Date", r.UpdatedDate FROM rostering r JOIN employee_details d
    ON r.EmpCode = d.ED_EMPCode""",
)
def join_roster_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    rows = t["rostering"].select("EmpCode", "Date", "UpdatedDate")
    return attendance.join_employees(rows, t["employee_details"]).select("EmpCode", "ED_EMPID", "Date", "UpdatedDate")


@query(
    "overtime_rates",
    """SELECT p.EmpCode, p.OT_UpdatedDate, p.Code, m.Rate AS ExtraTimePay FROM roster_params p
    JOIN ot_parameter_master m ON p.Code = m.Name""",
)
def overtime_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    params = overtime.explode_params(t["rostering"], ("EmpCode", "OT_UpdatedDate"))
    rated = overtime.overtime_rates(params, t["ot_parameter_master"])
    return rated.select("EmpCode", "OT_UpdatedDate", "Code", "ExtraTimePay")


def organisation_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attribute configuration per customer, as if each were an organisation."""
    k = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        k.alias("OrganisationID"),
        F.when(k % 5 == 0, "OtherModule").otherwise(MODULE).alias("ModuleCode"),
        F.lit(MODULE).alias("SubModuleCode"),
        F.when(k % 3 == 0, "1|2").when(k % 3 == 1, " 2 ||3").otherwise("1").alias("AttributeBasedOn"),
        F.when(k % 7 == 0, 0).otherwise(1).alias("Applicable"),
    )


@query(
    "config_dimensions",
    """SELECT c.c_custkey AS "OrganisationID", trim(i.item) AS "Items", t.AttributeTypeCode, t.AttributeTypeDescription
    FROM customer c, unnest(string_split(CASE c.c_custkey % 3 WHEN 0 THEN '1|2' WHEN 1 THEN ' 2 ||3' ELSE '1' END, '|')) AS i(item)
    JOIN attribute_type_master t ON CAST(t.AttributeTypeID AS VARCHAR) = trim(i.item) AND t.Applicable = 1
    WHERE c.c_custkey % 5 <> 0 AND c.c_custkey % 7 <> 0""",
)
def config_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = hr_tables(spark, sf_dir)["attribute_type_master"]
    dims = attributes.config_dimensions(organisation_configs(spark, sf_dir), types, carry=("OrganisationID",))
    return dims.select("OrganisationID", "Items", "AttributeTypeCode", "AttributeTypeDescription")


@query(
    "pay_group_units",
    """SELECT CombinationID, PayGroupID, Items, AttributeTypeID, AttributeTypeUnitCode, AttributeTypeUnitDescription
    FROM group_units""",
)
def pay_group_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    units = attributes.pay_group_units(
        t["unit_type_configuration"], t["pay_group_master"], t["attribute_unit_master"]
    )
    return units.select(
        "CombinationID",
        "PayGroupID",
        "Items",
        "AttributeTypeID",
        "AttributeTypeUnitCode",
        "AttributeTypeUnitDescription",
    )


def _employee_matrix(t: dict[str, DataFrame], dims: list[str]) -> DataFrame:
    rows = attributes.attribute_rows(
        t["employee_attribute_details"], t["attribute_type_master"], t["attribute_unit_master"]
    )
    return attributes.employee_matrix(rows, dims)


def _pay_group_matrix(t: dict[str, DataFrame], dims: list[str]) -> DataFrame:
    return attributes.pay_group_matrix(
        attributes.config_dimensions(t["type_configuration"], t["attribute_type_master"]),
        attributes.pay_group_units(t["unit_type_configuration"], t["pay_group_master"], t["attribute_unit_master"]),
        dims,
    )


@query("employee_matrix", "SELECT * FROM emp_matrix")
def employee_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    return _employee_matrix(t, attributes.configured_dimensions(t["type_configuration"]))


@query("pay_group_matrix", "SELECT * FROM group_matrix")
def pay_group_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    return _pay_group_matrix(t, attributes.configured_dimensions(t["type_configuration"]))


@query("assign_pay_groups", "SELECT * FROM assigned")
def assign_pay_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    dims = attributes.configured_dimensions(t["type_configuration"])
    return attributes.assign_pay_groups(_employee_matrix(t, dims), _pay_group_matrix(t, dims), dims)


@query(
    "salary_star",
    """SELECT EmpCode, PayGroupID, PayHeadID, HeadCode, MonthlyRate, updateDate, StateID AS "EFD_StateId", TaxApp FROM ruled_pay""",
)
def salary_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    salary = current_salary(t["salary_master"]).select("EmpCode", "HeadCode", "MonthlyRate", "updateDate")
    rows = stars.rule_star(salary, stars.employee_roll(t, stars.people_with_finance(t)), stars.head_rules(t))
    return rows.select(
        "EmpCode", "PayGroupID", "PayHeadID", "HeadCode", "MonthlyRate", "updateDate", "EFD_StateId", "TaxApp"
    )


@query(
    "property_star",
    """SELECT EmpCode, PayGroupID, PayHeadID, HeadCode, MonthlyRate, updateDate, CountryId,
    max(CASE code WHEN 'SSSEMPLOYEE' THEN flag END) AS "SSSEMPLOYEE",
    max(CASE code WHEN 'PHILHEALTHEMPLOYEE' THEN flag END) AS "PHILHEALTHEMPLOYEE",
    max(CASE code WHEN 'OTAPPLICABLE' THEN flag END) AS "OTAPPLICABLE"
    FROM property_pay GROUP BY 1, 2, 3, 4, 5, 6, 7""",
)
def property_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    salary = current_salary(t["salary_master"]).select("EmpCode", "HeadCode", "MonthlyRate", "updateDate")
    lookup, codes = stars.property_lookup(t, COUNTRY, CODES, with_rules=False)
    rows = stars.rule_star(salary, stars.employee_roll(t, stars.people(t).select("EmpCode")), lookup)
    return stars.merge_flags(
        rows.select(
            "EmpCode", "PayGroupID", "PayHeadID", "HeadCode", "MonthlyRate", "updateDate", "CountryId", *codes
        ),
        codes,
    )


@query(
    "variable_star",
    """SELECT a.EmpCode, a.PayGroupID, p.PayHeadID, v.HeadCode, v.Amount, v.UpdatedDate, g.OTApplicable, d.ED_EMPID
    FROM assigned a JOIN emp_variable v ON a.EmpCode = v.EmpCode
    JOIN payhead_master p ON v.HeadCode = p.PayHeadCode AND p.Applicable = 1
    JOIN pay_group_payhead_details g ON a.PayGroupID = g.PayGroupID AND p.PayHeadID = g.PayHeadID
    JOIN employee_details d ON v.EmpCode = d.ED_EMPCode JOIN employee_fin_details f ON d.ED_EMPID = f.EFD_ED_EMPID
    WHERE v.UpdatedDate >= TIMESTAMP '1998-01-01 00:00:00' AND v.Amount <> 0""",
)
def variable_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    rows, keys = stars.stage_changes(
        variable.variable_rows(t["emp_variable"], VARIABLE_MARK, VARIABLE_AS_OF).select(
            "EmpCode", "HeadCode", "Amount", "UpdatedDate"
        )
    )
    roll = stars.employee_roll(t, stars.people_with_finance(t), keys=keys)
    star = stars.rule_star(rows, roll, stars.head_rules(t))
    return star.select(
        "EmpCode", "PayGroupID", "PayHeadID", "HeadCode", "Amount", "UpdatedDate", "OTApplicable", "ED_EMPID"
    )


def _salary_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salary rows with one row per property that their head has in the employee's pay group."""
    t = hr_tables(spark, sf_dir)
    props = t["payhead_properties"].where(F.col("GPP_CountryID") == COUNTRY)
    heads = stars.active_heads(t).select(F.col("PayHeadID").alias("PM_PayheadID"), "HeadCode")
    lookup = props.withColumnRenamed("APGD_PaygroupID", "PayGroupID").join(heads, "PM_PayheadID")
    salary = current_salary(t["salary_master"]).select("EmpCode", "HeadCode", "MonthlyRate", "FromDate")
    return stars.rule_star(salary, stars.employee_roll(t, stars.people(t).select("EmpCode")), lookup)


@query(
    "property_matrix",
    """SELECT EmpCode, HeadCode, MonthlyRate, FromDate, PayHeadID AS "PM_PayheadID",
    max(CASE code WHEN 'SSSEMPLOYEE' THEN flag END) AS "SSSEMPLOYEE",
    max(CASE code WHEN 'PHILHEALTHEMPLOYEE' THEN flag END) AS "PHILHEALTHEMPLOYEE",
    max(CASE code WHEN 'OTAPPLICABLE' THEN flag END) AS "OTAPPLICABLE"
    FROM property_pay GROUP BY 1, 2, 3, 4, 5""",
)
def property_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _salary_properties(spark, sf_dir).select(
        "EmpCode", "HeadCode", "MonthlyRate", "FromDate", "PM_PayheadID", "GPP_PropertyCode", "PropertyChecked"
    )
    return properties.property_matrix(rows, CODES)


@query(
    "property_codes",
    """SELECT string_agg(code, ',' ORDER BY code) AS property_codes FROM (SELECT DISTINCT code FROM property_pay) x""",
)
def property_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return properties.property_codes(_salary_properties(spark, sf_dir))


@query(
    "resolve_property",
    """SELECT EmployeeID, PayheadId, MonthlyRate, coalesce(Sssemployee, 0) AS pf, coalesce(Philhealthemployee, 0) AS ssc, 0 AS vpf
    FROM (SELECT DISTINCT EmployeeID, PayheadId, MonthlyRate, Sssemployee, Philhealthemployee FROM applicability_rows) a""",
)
def resolve_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = hr_tables(spark, sf_dir)
    salary = current_salary(t["salary_master"]).select("EmpCode", "HeadCode", "MonthlyRate")
    lookup, codes = stars.property_lookup(t, COUNTRY, None, with_rules=False)
    roll = stars.employee_roll(t, stars.people(t).select("EmpCode", "ED_EMPID"))
    rows = stars.rule_star(salary, roll, lookup)
    merged = stars.merge_flags(
        rows.select(
            F.col("ED_EMPID").alias("EmployeeID"), F.col("PayHeadID").alias("PayheadId"), "MonthlyRate", *codes
        ),
        codes,
    )
    return merged.select(
        "EmployeeID",
        "PayheadId",
        "MonthlyRate",
        properties.resolved_flag(codes, properties.PF_CODES).alias("pf"),
        properties.resolved_flag(codes, properties.SSC_CODES).alias("ssc"),
        properties.resolved_flag(codes, properties.VPF_CODES).alias("vpf"),
    )
