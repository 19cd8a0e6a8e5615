"""Payloads: which feed column goes out under which name, per feed and country.

A specification is one line per output field, ``output<-input:kind``. Kinds:

    i   whole number, unreadable or null gives 0; a column the feed lacks gives 0
    i1  the same, but a column the feed lacks gives 1
    f   number, unreadable or null gives 0.0
    f!  number; a null or unreadable value is an error of the row
    r!  as f!, rounded to two decimals
    s   text; a column the feed lacks gives ''
    l   text in lower case
    d   first ten characters of the text
    n0  whole number, null or lacking gives 0; unreadable is an error (n1: gives 1)
    nf  number, null or lacking gives 0.0; unreadable is an error
    t   amount as text, null gives 0.0
    y   calendar day, null stays null
    =v  the constant v; =today is the day of the run

Input names are matched exactly, letter case included.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payfeed.functions.fields import plain_text, round_money, to_float, to_int, ymd, ymd10

# The payload fields of each feed and country, in sending order.
ONBOARDING_PHILIPPINES = """
DOJ<-DOJ:d
from_date<-FromDate:d
absent_deduction_applicable<-absentdeductionapplicable:i
country_id<-CountryId:i
employee_code<-EmployeeCode:s
employee_id<-EmployeeID:i
exemption<-exemption:i
gender<-Gender:i
income_tax_applicable<-incometaxapplicable:i
leave_encash_applicable<-LeenPayApp:i
ot_applicable<-Otapplicable:i1
monthly_rate<-MonthlyRate:f
yearly_rate<-YearlyRate:f
payhead_category_id<-PayHeadCategoryID:i
payhead_code<-PayheadCode:l
payhead_id<-PayheadId:i
pag_ibig_hdmf_employee<-pagibighdmfemployee:i
pag_ibig_hdmf_employer<-pagibighdmfemployer:i
philhealth_employee<-philhealthemployee:i
philhealth_employer<-philhealthemployer:i
sss_ecr_contri<-sssecercontri:i
sss_employee<-sssemployee:i
sss_employer<-sssemployer:i
voluntary_employee_contribution_app<-voluntaryemployeecontributionapp:i
workers_investment_and_savings_program_app<-workersinvestmentandsavingsprogramapp:i
w_tax<-wtax:i
"""

ONBOARDING_INDIA = """
DOJ<-DOJ:d
from_date<-FromDate:d
employee_code<-EmployeeCode:s
payhead_code<-PayHead:l
employee_id<-EmployeeID:i
country_id<-CountryId:i
gender<-Gender:i1
payhead_id<-PayHeadID:i
payhead_category_id<-PayHeadCategoryID:i
monthly_rate<-MonthlyAmount:f
yearly_rate<-YearlyAmount:f
ot_applicable<-IsOTApplicable:i1
income_tax_applicable<-IsTaxApplicable:i1
pf_employee<-IsPFApplicable:i
pt_employee<-IsPTApplicable:i
lwf_employee<-IsLWFApplicable:i
esic_employee<-IsESICApplicable:i
absent_deduction_applicable<-absent_deduction_applicable:i
leave_encash_applicable<-leave_encash_applicable:i1
exemption<-exemption:i
vpf_employee<-IsVPFApplicable:i
vpf_employer<-IsVPFApplicable:i
is_prorata<-:=1
esic_employer<-IsESICApplicable:i
pf_employer<-IsPFApplicable:i
pt_employer<-IsPTApplicable:i
lwf_employer<-IsLWFApplicable:i
gratuity_applicable<-gratuity_applicable:i
esic_employee_applicable<-IsESICApplicableForEmployee:i
pf_employee_applicable<-IsPFApplicableForEmployee:i
pt_employee_applicable<-IsPTApplicableForEmployee:i
lwf_employee_applicable<-IsLWFApplicableForEmployee:i
vpf_employee_applicable<-IsVPFApplicableForEmployee:i
gross_net_applicable<-GrossNetApp:i
"""

SALARY_PHILIPPINES = """
absent_deduction_applicable<-Absentdeductionapplicable:i
country_id<-CountryId:i
employee_code<-EmployeeCode:s
employee_id<-EmployeeID:i
exemption<-Exemption:i
eff_date<-EffDate:d
from_date<-from_date:d
gender<-Gender:i
income_tax_applicable<-Incometaxapplicable:i
leave_encash_applicable<-Leaveencashapplicable:i1
ot_applicable<-Otapplicable:i1
monthly_rate<-MonthlyRate:f!
pag_ibig_hdmf_employee<-Pagibighdmfemployee:i
pag_ibig_hdmf_employer<-Pagibighdmfemployer:i
payhead_category_id<-PayHeadCategoryID:i
payhead_code<-PayheadCode:l
payhead_id<-PayheadId:i
ot_arrear_applicable<-:=1
fin_year<-:=2026-2026
philhealth_employee<-Philhealthemployee:i
philhealth_employer<-Philhealthemployer:i
sss_ecr_contri<-Sssecercontri:i
sss_employee<-Sssemployee:i
sss_employer<-Sssemployer:i
voluntary_employee_contribution_app<-Voluntaryemployeecontributionapp:i
w_tax<-Wtax:i
workers_investment_and_savings_program_app<-Workersinvestmentandsavingsprogramapp:i
yearly_rate<-YearlyRate:f!
"""

SALARY_INDIA = """
absent_deduction_applicable<-Absentdeductionapplicable:i1
country_id<-CountryId:i
employee_code<-EmployeeCode:s
employee_id<-EmployeeID:i
eff_date<-EffDate:d
exemption<-Exemption:i1
from_date<-:=today
gender<-Gender:i1
income_tax_applicable<-TaxApp:i1
leave_encash_applicable<-LeenPayApp:i1
ot_applicable<-Otapplicable:i1
monthly_rate<-MonthlyRate:r!
payhead_category_id<-PayHeadCategoryID:i1
payhead_code<-PayheadCode:l
workers_investment_and_savings_program_app<-Workersinvestmentandsavingsprogramapp:i
voluntary_employee_contribution_app<-Voluntaryemployeecontributionapp:i
ot_arrear_applicable<-OtArrearApplicable:i
fin_year<-:=2026-2027
payhead_id<-PayheadId:i1
pf_employee<-Pagibighdmfemployee:i1
pf_employer<-Pagibighdmfemployer:i1
ssc_employee<-Sssemployee:i1
ssc_employer<-Sssemployer:i1
vpf_employee<-Vpfemployeeapplicable:i1
vpf_employer<-Vpfemployerapplicable:i1
w_tax<-Wtax:i1
yearly_rate<-YearlyRate:f!
"""

# Thailand differs from India in the fiscal year only.
SALARY_THAILAND = SALARY_INDIA.replace("2026-2027", "2026-2026")

VARIABLE_INDIA = """
Amount<-Amount:nf
ApprovedDate<-ApprovedDate:y
ESICApplicable<-ESICApplicable:n0
EmployeeCode<-EmployeeCode:s
EmployeeID<-EmployeeID:n0
LWFApplicable<-LWFApplicable:n0
PFApplicable<-PFApplicable:n0
PTApplicable<-PTApplicable:n0
PayHeadCategoryID<-PayHeadCategoryID:n0
PayHeadID<-PayHeadID:n0
PayheadCode<-PayHeadCode:s
SpotTaxApplicable<-SpotTaxApplicable:n1
TaxApplicable<-TaxApplicable:n1
Type<-Type:n1
VPFApplicable<-VPFApplicable:n0
"""

VARIABLE_PHILIPPINES = """
EmployeeID<-EmployeeID:n0
EmployeeCode<-EmployeeCode:s
PayHeadID<-PayHeadID:n0
PayheadCode<-PayheadCode:s
PayHeadCategoryID<-PayHeadCategoryID:n0
ApprovedDate<-ApprovedDate:y
Amount<-Amount:t
Type<-Type:n1
PFApplicable<-PFApplicable:n0
SSCApplicable<-SSCApplicable:n0
VPFApplicable<-VPFApplicable:n0
TaxApplicable<-TaxApplicable:n1
SpotTaxApplicable<-SpotTaxApplicable:n1
"""

SPECS = {
    ("onboarding", "INDIA"): ONBOARDING_INDIA,
    ("onboarding", "PHILIPPINES"): ONBOARDING_PHILIPPINES,
    ("salary", "INDIA"): SALARY_INDIA,
    ("salary", "PHILIPPINES"): SALARY_PHILIPPINES,
    ("salary", "THAILAND"): SALARY_THAILAND,
    ("variable", "INDIA"): VARIABLE_INDIA,
    ("variable", "PHILIPPINES"): VARIABLE_PHILIPPINES,
    ("variable", "THAILAND"): VARIABLE_PHILIPPINES,
}

# Feed columns meant by inputs that the feeds spell differently.
CORRECTIONS = {
    ("salary", "INDIA"): {
        "PayheadCode": "PayHead",
        "MonthlyRate": "MonthlyAmount",
        "YearlyRate": "YearlyAmount",
        "PayheadId": "PayHeadID",
        "TaxApp": "IsTaxApplicable",
        "Otapplicable": "IsOTApplicable",
    },
    ("salary", "PHILIPPINES"): {"from_date": "FromDate"},
    ("onboarding", "PHILIPPINES"): {
        name: name.capitalize()
        for name in (
            "absentdeductionapplicable",
            "exemption",
            "incometaxapplicable",
            "pagibighdmfemployee",
            "pagibighdmfemployer",
            "philhealthemployee",
            "philhealthemployer",
            "sssecercontri",
            "sssemployee",
            "sssemployer",
            "voluntaryemployeecontributionapp",
            "workersinvestmentandsavingsprogramapp",
            "wtax",
        )
    },
}

# The name of the record list in what is sent.
RECORD_KEYS = {
    "attendance": "records",
    "overtime": "overtime_data",
    "onboarding": "emp_data",
    "salary": "records",
    "variable": "records",
}
# Columns that attendance and overtime records lose before sending.
BOOKKEEPING = ("updateDate_timestamp", "source_db")

ERROR = "payload_error"


class UnsupportedCountry(ValueError):
    """No payload is defined for this feed and country."""


@dataclass(frozen=True)
class Field:
    output: str
    source: str
    kind: str


def fields(feed: str, country: str) -> list[Field]:
    try:
        spec = SPECS[(feed, country)]
    except KeyError:
        raise UnsupportedCountry(f"unsupported country: {country}") from None
    parsed = []
    for line in spec.split():
        output, rest = line.split("<-")
        source, kind = rest.split(":")
        parsed.append(Field(output, source, kind))
    return parsed


def _value(
    field: Field, dtype: str | None, as_of: dt.datetime | None, null_text: str | None, at: Callable[[str], Column]
) -> tuple[Column, Column | None]:
    """Output value and, for strict kinds, the condition under which the row is in error."""
    kind, column = field.kind, at(field.source) if field.source else None
    text = dtype == "string"
    if kind == "=today":
        if as_of is None:
            raise ValueError(f"{field.output} is the day of the run: give as_of")
        return F.lit(as_of.strftime("%Y-%m-%d")), None
    if kind.startswith("="):
        constant = kind[1:]
        return (F.lit(int(constant)).cast("bigint") if constant.isdigit() else F.lit(constant)), None
    if dtype is None:
        lacking = {
            "i": F.lit(0).cast("bigint"), "n0": F.lit(0).cast("bigint"),
            "i1": F.lit(1).cast("bigint"), "n1": F.lit(1).cast("bigint"),
            "f": F.lit(0.0), "f!": F.lit(0.0), "r!": F.lit(0.0), "nf": F.lit(0.0),
            "y": F.lit(None).cast("string"), "t": F.lit("0"),
        }
        return lacking.get(kind, F.lit("")), None
    if kind in ("i", "i1"):
        return to_int(column, 0, text=text), None
    if kind == "f":
        return to_float(column, 0.0, text=text), None
    if kind in ("f!", "r!"):
        number = to_float(column, None, text=text)
        return (round_money(number) if kind == "r!" else number), number.isNull()
    if kind in ("n0", "n1", "nf"):
        default = 1 if kind == "n1" else 0
        missing = column.isNull() | F.isnan(column) if dtype in ("double", "float") else column.isNull()
        if kind == "nf":
            number = to_float(column, None, text=text)
            return F.when(missing, F.lit(0.0)).otherwise(number), ~missing & number.isNull()
        number = F.nullif(to_int(column, -(2**63), text=text), F.lit(-(2**63)))
        return F.when(missing, F.lit(default).cast("bigint")).otherwise(number), ~missing & number.isNull()
    if kind == "s":
        return plain_text(column, dtype, null_text), None
    if kind == "l":
        return F.lower(plain_text(column, dtype, null_text)), None
    if kind == "d":
        return ymd10(column, dtype, null_text), None
    if kind == "y":
        return ymd(column), column.isNotNull() & ymd(column).isNull()
    if kind == "t":
        return plain_text(column, dtype, "0.0"), None
    raise ValueError(f"unknown kind {kind!r} for {field.output}")


def _named(name: str) -> Column:
    return F.col(f"`{name}`")


def payload_columns(
    types: dict[str, str],
    feed: str,
    country: str,
    *,
    as_of: dt.datetime | None = None,
    corrected: bool = True,
    null_text: str | None = "None",
    at: Callable[[str], Column] = _named,
) -> tuple[list[Column], Column]:
    """Payload columns of rows with fields of ``types``, and the name of the first field in error.

    ``at`` says where a field stands, by default in the column of its name.
    """
    renames = CORRECTIONS.get((feed, country), {}) if corrected else {}
    columns, errors = [], []
    for field in fields(feed, country):
        source = field.source
        if source not in types and renames.get(source) in types:
            source = renames[source]
        value, error = _value(Field(field.output, source, field.kind), types.get(source), as_of, null_text, at)
        columns.append(value.alias(field.output))
        if error is not None:
            errors.append(F.when(error, F.lit(field.output)))
    return columns, F.coalesce(*errors) if errors else F.lit(None).cast("string")


def project(
    df: DataFrame,
    feed: str,
    country: str,
    *,
    as_of: dt.datetime | None = None,
    corrected: bool = True,
    null_text: str | None = "None",
    keep: tuple[str, ...] = (),
    with_errors: bool = False,
) -> DataFrame:
    """Payload columns of a feed.

    ``corrected`` reads the feed column that is meant where the specification spells
    another; without it such fields take their defaults. ``keep`` carries bookkeeping
    columns through. ``with_errors`` adds the name of the first field in error.
    """
    columns, reason = payload_columns(
        dict(df.dtypes), feed, country, as_of=as_of, corrected=corrected, null_text=null_text
    )
    if with_errors:
        columns.append(reason.alias(ERROR))
    return df.select(*[f"`{k}`" for k in keep], *columns)


def drop_bookkeeping(df: DataFrame) -> DataFrame:
    return df.drop(*BOOKKEEPING)
