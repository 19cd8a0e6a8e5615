"""Whole feeds and their payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from payfeed.catalog.registry import (
    COUNTRY,
    ROSTER_AS_OF,
    ROSTER_MARK,
    SALARY_AS_OF,
    SALARY_MARK,
    VARIABLE_AS_OF,
    VARIABLE_MARK,
    query,
)
from payfeed.catalog.star_schema import PROPERTY_CODES, hr_tables
from payfeed.operators.batching import iso_records
from payfeed.plans import attendance, onboarding, overtime, payloads, salary, variable

CODES = list(PROPERTY_CODES)


@query("feed_attendance", "SELECT * FROM attendance_rows")
def feed_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attendance.attendance_feed(hr_tables(spark, sf_dir), ROSTER_MARK, ROSTER_AS_OF)


@query("feed_overtime", "SELECT * FROM overtime_rows")
def feed_overtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overtime.overtime_feed(hr_tables(spark, sf_dir), ROSTER_MARK, ROSTER_AS_OF)


@query(
    "feed_overtime_days",
    """
    WITH changed AS (
        SELECT DISTINCT d.ED_EMPID, r."Date", r.OT_UpdatedDate
        FROM rostering r JOIN employee_details d ON r.EmpCode = d.ED_EMPCode
        WHERE r.OT_Param_json IS NOT NULL AND r.OT_UpdatedDate > TIMESTAMP '2024-01-15 00:00:00')
    SELECT d.ED_EMPID AS EmployeeCode, p."Date", p.Code, round(CAST(p.Minutes AS DOUBLE) / 60.0, 2) AS ExtraHrs,
    CASE WHEN p.Conversion = 'Hours' THEN 'H' ELSE p.Conversion END AS Conversion, m.Rate AS ExtraTimePay,
    p.OT_UpdatedDate AS updateDate_timestamp
    FROM roster_params p JOIN employee_details d ON p.EmpCode = d.ED_EMPCode
    JOIN changed c ON c.ED_EMPID = d.ED_EMPID AND c."Date" = p."Date"
    JOIN ot_parameter_master m ON p.Code = m.Name
    """,
)
def feed_overtime_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overtime.overtime_days_feed(hr_tables(spark, sf_dir), ROSTER_MARK, ROSTER_AS_OF)


@query("feed_onboarding_in", "SELECT * FROM onboarding_india_rows")
def feed_onboarding_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onboarding.onboarding_india_feed(hr_tables(spark, sf_dir), SALARY_MARK)


@query("feed_onboarding_in_full", "SELECT * FROM onboarding_india_all")
def feed_onboarding_in_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onboarding.onboarding_india_feed(hr_tables(spark, sf_dir), None)


@query("feed_onboarding_ph", "SELECT * FROM onboarding_philippines_rows")
def feed_onboarding_ph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onboarding.onboarding_philippines_feed(hr_tables(spark, sf_dir), SALARY_MARK, codes=CODES)


@query("feed_salary_in", "SELECT * FROM salary_india_rows")
def feed_salary_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salary.salary_india_feed(hr_tables(spark, sf_dir), SALARY_MARK, SALARY_AS_OF)


@query("feed_salary_ph", "SELECT * FROM salary_philippines_rows")
def feed_salary_ph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salary.salary_philippines_feed(hr_tables(spark, sf_dir), SALARY_MARK, SALARY_AS_OF, COUNTRY, CODES)


@query("feed_salary_th", "SELECT * FROM salary_thailand_rows")
def feed_salary_th(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salary.salary_thailand_feed(hr_tables(spark, sf_dir), SALARY_MARK, SALARY_AS_OF, COUNTRY, CODES)


@query("feed_variable_in", "SELECT * FROM variable_india_rows")
def feed_variable_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variable.variable_india_feed(hr_tables(spark, sf_dir), VARIABLE_MARK, VARIABLE_AS_OF)


@query("feed_variable_ph", "SELECT * FROM variable_philippines_rows")
def feed_variable_ph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variable.variable_philippines_feed(hr_tables(spark, sf_dir), country_id=COUNTRY, codes=CODES)


# ---- payloads: the literal field lookups, without corrections ------------------

@query(
    "payload_attendance",
    """SELECT EmployeeID, EmployeeCode, CAST(AttendanceDate AS VARCHAR) AS AttendanceDate,
    CAST(ApprovedDate AS VARCHAR) AS ApprovedDate, Attendance, EarlyMinutes, LateMinutes FROM attendance_rows""",
)
def payload_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = payloads.drop_bookkeeping(feed_attendance(spark, sf_dir))
    return iso_records(sent, sent.columns)


@query(
    "payload_overtime",
    """SELECT EmployeeCode, CAST("Date" AS VARCHAR) AS "Date", Code, ExtraHrs, Conversion,
    CAST(ExtraTimePay AS DOUBLE) AS ExtraTimePay FROM overtime_rows""",
)
def payload_overtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = payloads.drop_bookkeeping(feed_overtime(spark, sf_dir))
    return iso_records(sent, sent.columns)


def _ints(pairs: str) -> str:
    """``out<-in`` pairs as whole numbers, null as 0."""
    items = [pair.split("<-") for pair in pairs.split()]
    return ", ".join(f"CAST(coalesce({source}, 0) AS BIGINT) AS {out}" for out, source in items)


def _constants(names: str, value: int) -> str:
    return ", ".join(f"CAST({value} AS BIGINT) AS {name}" for name in names.split())


@query(
    "payload_onboarding_in",
    f"""SELECT CAST(DOJ AS VARCHAR)[:10] AS "DOJ", CAST(FromDate AS VARCHAR)[:10] AS from_date, EmployeeCode AS employee_code,
    lower(PayHead) AS payhead_code,
    {_ints('''employee_id<-EmployeeID country_id<-CountryId payhead_id<-PayHeadID payhead_category_id<-PayHeadCategoryID
    ot_applicable<-IsOTApplicable income_tax_applicable<-IsTaxApplicable pf_employee<-IsPFApplicable pt_employee<-IsPTApplicable
    lwf_employee<-IsLWFApplicable esic_employee<-IsESICApplicable vpf_employee<-IsVPFApplicable vpf_employer<-IsVPFApplicable
    esic_employer<-IsESICApplicable pf_employer<-IsPFApplicable pt_employer<-IsPTApplicable lwf_employer<-IsLWFApplicable
    gratuity_applicable<-gratuity_applicable esic_employee_applicable<-IsESICApplicableForEmployee
    pf_employee_applicable<-IsPFApplicableForEmployee pt_employee_applicable<-IsPTApplicableForEmployee
    lwf_employee_applicable<-IsLWFApplicableForEmployee vpf_employee_applicable<-IsVPFApplicableForEmployee
    gross_net_applicable<-GrossNetApp''')},
    coalesce(MonthlyAmount, 0.0) AS monthly_rate, coalesce(YearlyAmount, 0.0) AS yearly_rate,
    {_constants('gender absent_deduction_applicable exemption', 0)}, {_constants('leave_encash_applicable is_prorata', 1)}
    FROM onboarding_india_rows""",
)
def payload_onboarding_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.project(feed_onboarding_in(spark, sf_dir), "onboarding", "INDIA", corrected=False)


@query(
    "payload_onboarding_ph",
    f"""SELECT '2026-01-01' AS "DOJ", '2026-01-01' AS from_date, EmployeeCode AS employee_code, lower(PayheadCode) AS payhead_code,
    {_ints('''country_id<-CountryId employee_id<-EmployeeID gender<-Gender leave_encash_applicable<-LeenPayApp
    ot_applicable<-Otapplicable payhead_category_id<-PayHeadCategoryID payhead_id<-PayheadId''')},
    coalesce(MonthlyRate, 0.0) AS monthly_rate, coalesce(YearlyRate, 0.0) AS yearly_rate,
    {_constants('''absent_deduction_applicable exemption income_tax_applicable pag_ibig_hdmf_employee pag_ibig_hdmf_employer
    philhealth_employee philhealth_employer sss_ecr_contri sss_employee sss_employer voluntary_employee_contribution_app
    workers_investment_and_savings_program_app w_tax''', 0)}
    FROM onboarding_philippines_rows""",
)
def payload_onboarding_ph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.project(feed_onboarding_ph(spark, sf_dir), "onboarding", "PHILIPPINES", corrected=False)


@query(
    "payload_salary_ph",
    f"""SELECT EmployeeCode AS employee_code, CAST(EffDate AS VARCHAR)[:10] AS eff_date, '' AS from_date,
    lower(PayheadCode) AS payhead_code, '2026-2026' AS fin_year, MonthlyRate AS monthly_rate, YearlyRate AS yearly_rate,
    {_ints('''country_id<-CountryId employee_id<-EmployeeID gender<-Gender ot_applicable<-Otapplicable
    payhead_category_id<-PayHeadCategoryID payhead_id<-PayheadId philhealth_employee<-Philhealthemployee
    sss_employee<-Sssemployee''')},
    {_constants('''absent_deduction_applicable exemption income_tax_applicable pag_ibig_hdmf_employee pag_ibig_hdmf_employer
    philhealth_employer sss_ecr_contri sss_employer voluntary_employee_contribution_app w_tax
    workers_investment_and_savings_program_app''', 0)},
    {_constants('leave_encash_applicable ot_arrear_applicable', 1)}
    FROM salary_philippines_rows""",
)
def payload_salary_ph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.project(feed_salary_ph(spark, sf_dir), "salary", "PHILIPPINES", as_of=SALARY_AS_OF, corrected=False)


_SALARY_COMMON = f"""EmployeeCode AS employee_code, '2001-11-05' AS from_date,
    {_ints('''country_id<-CountryId employee_id<-EmployeeID gender<-Gender leave_encash_applicable<-LeenPayApp
    payhead_category_id<-PayHeadCategoryID''')},
    {_constants('workers_investment_and_savings_program_app voluntary_employee_contribution_app ot_arrear_applicable', 0)},
    {_constants('''absent_deduction_applicable exemption pf_employee pf_employer ssc_employer vpf_employee vpf_employer
    w_tax''', 1)}"""


@query(
    "payload_salary_in",
    f"""SELECT {_SALARY_COMMON}, CAST(EffDate AS VARCHAR)[:10] AS eff_date, '2026-2027' AS fin_year, '' AS payhead_code,
    CAST(0.0 AS DOUBLE) AS monthly_rate, CAST(0.0 AS DOUBLE) AS yearly_rate,
    {_constants('payhead_id income_tax_applicable ot_applicable ssc_employee', 1)} FROM salary_india_rows""",
)
def payload_salary_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.project(feed_salary_in(spark, sf_dir), "salary", "INDIA", as_of=SALARY_AS_OF, corrected=False)


@query(
    "payload_salary_th",
    f"""SELECT {_SALARY_COMMON}, coalesce(CAST(EffDate AS VARCHAR)[:10], 'None') AS eff_date, '2026-2026' AS fin_year,
    lower(PayheadCode) AS payhead_code, CAST(format('{{:.2f}}', MonthlyRate) AS DOUBLE) AS monthly_rate, YearlyRate AS yearly_rate,
    {_ints('payhead_id<-PayheadId income_tax_applicable<-TaxApp ot_applicable<-Otapplicable ssc_employee<-Sssemployee')}
    FROM salary_thailand_rows""",
)
def payload_salary_th(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.project(feed_salary_th(spark, sf_dir), "salary", "THAILAND", as_of=SALARY_AS_OF, corrected=False)


@query(
    "payload_variable_in",
    f"""SELECT Amount, strftime(ApprovedDate, '%Y-%m-%d') AS "ApprovedDate", EmployeeCode, PayHeadCode AS "PayheadCode",
    {_ints('''ESICApplicable<-ESICApplicable EmployeeID<-EmployeeID LWFApplicable<-LWFApplicable PFApplicable<-PFApplicable
    PTApplicable<-PTApplicable PayHeadID<-PayHeadID SpotTaxApplicable<-SpotTaxApplicable TaxApplicable<-TaxApplicable
    Type<-Type VPFApplicable<-VPFApplicable''')}, {_constants('PayHeadCategoryID', 0)} FROM variable_india_rows""",
)
def payload_variable_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.project(feed_variable_in(spark, sf_dir), "variable", "INDIA", corrected=False)


_VARIABLE_PHILIPPINES = f"""SELECT EmployeeCode, PayheadCode, strftime(ApprovedDate, '%Y-%m-%d') AS "ApprovedDate",
    CAST(CAST(Amount AS DOUBLE) AS VARCHAR) AS "Amount",
    {_ints('''EmployeeID<-EmployeeID PayHeadID<-PayHeadID PayHeadCategoryID<-PayHeadCategoryID Type<-Type
    PFApplicable<-PFApplicable SSCApplicable<-SSCApplicable VPFApplicable<-VPFApplicable
    SpotTaxApplicable<-SpotTaxApplicable''')}, CAST(coalesce(TaxApplicable, 1) AS BIGINT) AS "TaxApplicable"
    FROM variable_philippines_rows"""


@query("payload_variable_ph", _VARIABLE_PHILIPPINES)
def payload_variable_ph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.project(feed_variable_ph(spark, sf_dir), "variable", "PHILIPPINES", corrected=False)


@query("payload_variable_th", _VARIABLE_PHILIPPINES)
def payload_variable_th(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.project(feed_variable_ph(spark, sf_dir), "variable", "THAILAND", corrected=False)


# ---- the same payloads in the form that is sent: corrected field names -------------

@query(
    "payload_onboarding_ph_corrected",
    f"""SELECT '2026-01-01' AS "DOJ", '2026-01-01' AS from_date, EmployeeCode AS employee_code, lower(PayheadCode) AS payhead_code,
    {_ints('''country_id<-CountryId employee_id<-EmployeeID gender<-Gender leave_encash_applicable<-LeenPayApp
    ot_applicable<-Otapplicable payhead_category_id<-PayHeadCategoryID payhead_id<-PayheadId
    philhealth_employee<-Philhealthemployee sss_employee<-Sssemployee''')},
    coalesce(MonthlyRate, 0.0) AS monthly_rate, coalesce(YearlyRate, 0.0) AS yearly_rate,
    {_constants('''absent_deduction_applicable exemption income_tax_applicable pag_ibig_hdmf_employee pag_ibig_hdmf_employer
    philhealth_employer sss_ecr_contri sss_employer voluntary_employee_contribution_app
    workers_investment_and_savings_program_app w_tax''', 0)}
    FROM onboarding_philippines_rows""",
)
def payload_onboarding_ph_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.project(feed_onboarding_ph(spark, sf_dir), "onboarding", "PHILIPPINES")


@query(
    "payload_salary_in_corrected",
    f"""SELECT {_SALARY_COMMON}, CAST(EffDate AS VARCHAR)[:10] AS eff_date, '2026-2027' AS fin_year, lower(PayHead) AS payhead_code,
    CAST(format('{{:.2f}}', MonthlyAmount) AS DOUBLE) AS monthly_rate, YearlyAmount AS yearly_rate,
    {_ints('payhead_id<-PayHeadID income_tax_applicable<-IsTaxApplicable ot_applicable<-IsOTApplicable')},
    {_constants('ssc_employee', 1)} FROM salary_india_rows""",
)
def payload_salary_in_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.project(feed_salary_in(spark, sf_dir), "salary", "INDIA", as_of=SALARY_AS_OF)


@query(
    "payload_salary_ph_corrected",
    f"""SELECT EmployeeCode AS employee_code, CAST(EffDate AS VARCHAR)[:10] AS eff_date, CAST(FromDate AS VARCHAR)[:10] AS from_date,
    lower(PayheadCode) AS payhead_code, '2026-2026' AS fin_year, MonthlyRate AS monthly_rate, YearlyRate AS yearly_rate,
    {_ints('''country_id<-CountryId employee_id<-EmployeeID gender<-Gender ot_applicable<-Otapplicable
    payhead_category_id<-PayHeadCategoryID payhead_id<-PayheadId philhealth_employee<-Philhealthemployee
    sss_employee<-Sssemployee''')},
    {_constants('''absent_deduction_applicable exemption income_tax_applicable pag_ibig_hdmf_employee pag_ibig_hdmf_employer
    philhealth_employer sss_ecr_contri sss_employer voluntary_employee_contribution_app w_tax
    workers_investment_and_savings_program_app''', 0)},
    {_constants('leave_encash_applicable ot_arrear_applicable', 1)}
    FROM salary_philippines_rows""",
)
def payload_salary_ph_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.project(feed_salary_ph(spark, sf_dir), "salary", "PHILIPPINES", as_of=SALARY_AS_OF)


@query(
    "payload_salary_th_corrected",
    f"""SELECT {_SALARY_COMMON}, coalesce(CAST(EffDate AS VARCHAR)[:10], 'None') AS eff_date, '2026-2026' AS fin_year,
    lower(PayheadCode) AS payhead_code, CAST(format('{{:.2f}}', MonthlyRate) AS DOUBLE) AS monthly_rate, YearlyRate AS yearly_rate,
    {_ints('payhead_id<-PayheadId income_tax_applicable<-TaxApp ot_applicable<-Otapplicable ssc_employee<-Sssemployee')}
    FROM salary_thailand_rows""",
)
def payload_salary_th_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.project(feed_salary_th(spark, sf_dir), "salary", "THAILAND", as_of=SALARY_AS_OF)
