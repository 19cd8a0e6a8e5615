"""Pay-head stars: who is paid what, under which rules.

The configuration side (groups, heads, rules, properties) is joined into one lookup
keyed by pay group and head code first, so that salaries are shuffled on the employee
only; adaptive execution turns the lookup into a broadcast where its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payfeed.functions.fields import gender_code
from payfeed.operators.attributes import MODULE, employee_pay_groups
from payfeed.operators.properties import distinct_codes, property_matrix
from payfeed.session import materialize

# Rule flags that follow a pay head whatever the pay group.
HEAD_FLAGS = ("LeenPayApp", "TaxApp", "SpotTaxApp")


def active_heads(tables: dict[str, DataFrame]) -> DataFrame:
    return (
        tables["payhead_master"]
        .where(F.col("Applicable") == 1)
        .select("PayHeadID", F.col("PayHeadCode").alias("HeadCode"), "PayHeadCategoryID")
    )


def head_rules(tables: dict[str, DataFrame]) -> DataFrame:
    """Rules of every pay group and active pay head."""
    return tables["pay_group_payhead_details"].join(active_heads(tables), "PayHeadID")


def people(tables: dict[str, DataFrame]) -> DataFrame:
    return tables["employee_details"].withColumn("EmpCode", F.col("ED_EMPCode"))


def people_with_finance(tables: dict[str, DataFrame]) -> DataFrame:
    finance = tables["employee_fin_details"]
    return people(tables).join(finance, F.col("ED_EMPID") == F.col("EFD_ED_EMPID"))


def names(include_gender_code: bool = True) -> list:
    """Employee columns that every onboarding and salary feed starts with."""
    return [
        F.coalesce(F.col("ED_Salutation"), F.lit("")).alias("Salutation"),
        F.coalesce(F.col("ED_FirstName"), F.lit("")).alias("FirstName"),
        F.coalesce(F.col("ED_MiddleName"), F.lit("")).alias("MiddleName"),
        F.coalesce(F.col("ED_LastName"), F.lit("")).alias("LastName"),
        F.col("ED_DOB").alias("DOB"),
        (gender_code(F.col("ED_Sex")) if include_gender_code else F.col("ED_Sex")).alias("Gender"),
    ]


def employee_roll(
    tables: dict[str, DataFrame],
    staff: DataFrame,
    module: str = MODULE,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Persons with each of their pay groups; ``keys`` limits it to some employees.

    Everything that depends on the employee alone, in one table to be staged: rows are
    then shuffled on the employee once, and the hot ones can be split.
    """
    if keys is not None:
        staff = staff.join(keys.select("EmpCode"), "EmpCode", "left_semi")
    roll = employee_pay_groups(tables, module, keys).join(staff, "EmpCode")
    return materialize(roll, "roll")


def rule_star(rows: DataFrame, roll: DataFrame, rules: DataFrame) -> DataFrame:
    """Employee-keyed rows with pay group, person and the rules of group and head."""
    return rows.join(roll, "EmpCode").join(rules, ["PayGroupID", "HeadCode"])


def stage_changes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changed rows written once, and the employees in them (with repeats).

    The large table is read once; all further work is of the size of the change.
    """
    staged = materialize(rows, "changed")
    return staged, staged.select("EmpCode")


def property_lookup(
    tables: dict[str, DataFrame],
    country_id: int,
    codes: list[str] | None,
    rename=None,
    with_rules: bool = True,
) -> tuple[DataFrame, list[str]]:
    """Properties per pay group and head as flag columns, and the property codes.

    Flags are the maximum over rows, and so is the pivot of the joined feed; pivoting
    the configuration first gives the same flags with one row instead of one per code.
    Rules are joined on the head alone and only by the flags that are used, which
    keeps one row per different set of flags.
    """
    scoped = tables["payhead_properties"].where(F.col("GPP_CountryID") == country_id)
    codes = distinct_codes(scoped) if codes is None else codes
    flags = property_matrix(
        scoped.select("APGD_PaygroupID", "PM_PayheadID", "GPP_CountryID", "GPP_PropertyCode", "PropertyChecked"),
        codes,
        rename=rename,
    )
    lookup = flags.select(
        F.col("APGD_PaygroupID").alias("PayGroupID"),
        F.col("PM_PayheadID").alias("PayHeadID"),
        F.col("GPP_CountryID").alias("CountryId"),
        *[f"`{rename(c) if rename else c}`" for c in codes],
    ).join(active_heads(tables), "PayHeadID")
    if with_rules:
        rules = tables["pay_group_payhead_details"].select("PayHeadID", *HEAD_FLAGS).distinct()
        lookup = lookup.join(rules, "PayHeadID")
    return lookup, codes


def merge_flags(rows: DataFrame, flags: list[str], newest: str | None = None) -> DataFrame:
    """One row per combination of the other columns, flags at their maximum.

    ``newest`` names a time column that is carried along instead of separating rows.
    """
    special = set(flags) | ({newest} if newest else set())
    keys = [c for c in rows.columns if c not in special]
    merged = [F.max(f"`{c}`").alias(c) for c in flags]
    if newest:
        merged.append(F.max(newest).alias(newest))
    return rows.groupBy(*[f"`{k}`" for k in keys]).agg(*merged)


def drop_absent(feed: DataFrame, flags: list[str]) -> DataFrame:
    """Leave out flag columns that no row fills; the feed is staged to find out."""
    staged = materialize(feed, "flags")
    used = set(filled(staged, flags))
    return staged.drop(*[c for c in flags if c not in used])


def filled(rows: DataFrame, flags: list[str]) -> list[str]:
    """Those of ``flags`` that some row has."""
    if not flags:
        return []
    found = rows.agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(c) for c in flags]).first()
    return [c for c in flags if found[c]]
