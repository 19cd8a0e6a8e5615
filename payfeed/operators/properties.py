"""Country properties of pay heads: rows into flag columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Property codes that stand for the three flags of a variable-pay row.
PF_CODES = ("SSSEMPLOYEE", "PFAPPLICABLE", "PF", "PFEMPLOYEE", "PF_EMPLOYEE", "PF_APPLICABLE")
SSC_CODES = ("PHILHEALTHEMPLOYEE", "SSCAPPLICABLE", "SSC", "SSCEMPLOYEE", "SSC_EMPLOYEE", "SSC_APPLICABLE")
VPF_CODES = (
    "PAGIBIGHDMFEMPLOYEE",
    "VPFAPPLICABLE",
    "VPF",
    "VPFEMPLOYEEAPPLICABLE",
    "VPF_EMPLOYEE",
    "VPF_APPLICABLE",
    "VOLUNTARYPF",
)


def distinct_codes(df: DataFrame, column: str = "GPP_PropertyCode") -> list[str]:
    """Property codes present, sorted; read on the driver to name the pivot columns."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(row[0] for row in rows)


def property_codes(df: DataFrame, column: str = "GPP_PropertyCode") -> DataFrame:
    """Property codes present, as one comma-separated value."""
    codes = df.select(column).distinct()
    return codes.agg(F.array_join(F.array_sort(F.collect_list(column)), ",").alias("property_codes"))


def property_matrix(
    df: DataFrame,
    codes: list[str] | None = None,
    *,
    rename=None,
    code_col: str = "GPP_PropertyCode",
    flag_col: str = "PropertyChecked",
) -> DataFrame:
    """One row per combination of all other columns, one flag column per property code.

    A flag is 1, 0 (also where the flag itself is null), or null where the combination
    has no row for the code. ``rename`` turns a code into its column name.
    """
    codes = distinct_codes(df, code_col) if codes is None else codes
    rest = [c for c in df.columns if c not in (code_col, flag_col)]
    flag = F.coalesce(F.col(flag_col).cast("int"), F.lit(0))
    flags = [
        F.max(F.when(F.col(code_col) == code, flag)).alias(rename(code) if rename else code) for code in codes
    ]
    return df.groupBy(*rest).agg(*flags)


def resolve_property(codes: list[str], aliases: tuple[str, ...]) -> str | None:
    """The property among ``codes`` that one of the aliases names; the last in order wins."""
    found = [code for code in sorted(codes) if code.upper() in aliases]
    return found[-1] if found else None


def resolved_flag(codes: list[str], aliases: tuple[str, ...]) -> Column:
    """Flag column of the resolved property, or 0 where no such property exists."""
    code = resolve_property(codes, aliases)
    return F.lit(0) if code is None else F.coalesce(F.col(f"`{code}`"), F.lit(0))
