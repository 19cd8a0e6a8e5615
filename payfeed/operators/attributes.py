"""Configured employee attributes and the pay groups they lead to.

Which attributes count is configuration: a module's configuration row lists attribute
types as a delimited string. The list is read on the driver (it holds a handful of
names) and decides the columns of the two pivots and the keys of the join between them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payfeed.functions.fields import is_open, split_list

# The configuration scope that pay groups live in.
MODULE = "CompensationAndBenefits"

SUFFIX = "_Description"


class PayGroupNotConfigured(ValueError):
    """The module has no attributes, so no employee can be assigned to a pay group."""


def scoped_config(config: DataFrame, module: str = MODULE, sub_module: str | None = None) -> DataFrame:
    """Applicable configuration rows of one module."""
    return config.where(
        (F.col("Applicable") == 1)
        & (F.col("ModuleCode") == module)
        & (F.col("SubModuleCode") == (sub_module or module))
    )


def configured_dimensions(
    config: DataFrame, module: str = MODULE, sub_module: str | None = None
) -> list[str]:
    """Distinct attribute descriptions configured for a module, sorted; they become columns."""
    items = scoped_config(config, module, sub_module).select(
        F.explode(split_list(F.col("AttributeBasedOnDesc"))).alias("item")
    )
    names = sorted(row["item"] for row in items.distinct().collect())
    if not names:
        raise PayGroupNotConfigured(f"no attributes configured for module {module}")
    return names


def config_dimensions(
    config: DataFrame,
    types: DataFrame,
    module: str = MODULE,
    sub_module: str | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Configured attribute ids, one per row, with code and description of the type."""
    items = scoped_config(config, module, sub_module).select(
        *carry, F.explode(split_list(F.col("AttributeBasedOn"))).alias("Items")
    )
    active = types.where(F.col("Applicable") == 1).select(
        F.col("AttributeTypeID").cast("string").alias("Items"),
        "AttributeTypeCode",
        "AttributeTypeDescription",
    )
    return items.join(active, "Items")


def pay_group_units(
    unit_config: DataFrame,
    groups: DataFrame,
    units: DataFrame,
    module: str = MODULE,
    sub_module: str | None = None,
) -> DataFrame:
    """Attribute units of every applicable pay group, one per row."""
    combos = scoped_config(unit_config, module, sub_module).select("CombinationID", "AttributeUnitConfig")
    applicable = groups.where(F.col("Applicable") == 1).select(
        F.col("ComboID").alias("CombinationID"), "PayGroupID"
    )
    items = combos.join(applicable, "CombinationID").select(
        "CombinationID", "PayGroupID", F.explode(split_list(F.col("AttributeUnitConfig"))).alias("Items")
    )
    active = units.where(F.col("Applicable") == 1).select(
        F.col("AttributeTypeUnitID").cast("string").alias("Items"),
        "AttributeTypeID",
        "AttributeTypeUnitCode",
        "AttributeTypeUnitDescription",
    )
    return items.join(active, "Items")


def attribute_rows(details: DataFrame, types: DataFrame, units: DataFrame) -> DataFrame:
    """Open attribute rows of employees with the names of type and unit."""
    active_types = types.where(F.col("Applicable") == 1).select("AttributeTypeID", "AttributeTypeDescription")
    active_units = units.where(F.col("Applicable") == 1).select(
        "AttributeTypeID", "AttributeTypeUnitID", "AttributeTypeUnitDescription"
    )
    names = active_units.join(active_types, "AttributeTypeID")
    opened = details.where(is_open(F.col("ToDate"))).select(
        "EmployeeCode", "AttributeTypeID", "AttributeTypeUnitID"
    )
    return opened.join(names, ["AttributeTypeID", "AttributeTypeUnitID"]).select(
        "EmployeeCode", "AttributeTypeDescription", "AttributeTypeUnitDescription"
    )


def dimension_column(name: str) -> str:
    return name.replace(" ", "") + SUFFIX


def employee_matrix(rows: DataFrame, dims: list[str]) -> DataFrame:
    """One row per employee, one column per configured attribute."""
    labels = [dimension_column(d) for d in dims]
    column = F.concat(F.replace(F.col("AttributeTypeDescription"), F.lit(" "), F.lit("")), F.lit(SUFFIX))
    return (
        rows.select("EmployeeCode", column.alias("_column"), "AttributeTypeUnitDescription")
        .groupBy("EmployeeCode")
        .pivot("_column", labels)
        .agg(F.max("AttributeTypeUnitDescription"))
    )


def pay_group_matrix(dimensions: DataFrame, group_units: DataFrame, dims: list[str]) -> DataFrame:
    """One row per pay group, one column per configured attribute."""
    typed = dimensions.select(
        F.col("Items").try_cast("int").alias("AttributeTypeID"), "AttributeTypeDescription"
    )
    return (
        group_units.drop("Items").join(typed, "AttributeTypeID")
        .groupBy("CombinationID", "PayGroupID")
        .pivot("AttributeTypeDescription", dims)
        .agg(F.max("AttributeTypeUnitDescription"))
    )


def assign_pay_groups(employees: DataFrame, groups: DataFrame, dims: list[str]) -> DataFrame:
    """Employees with every pay group that agrees on all configured attributes.

    A missing attribute agrees with nothing.
    """
    if not dims:
        raise PayGroupNotConfigured("pay groups cannot be assigned without attributes")
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"`{dimension_column(d)}`") == F.col(f"`{d}`") for d in dims],
    )
    return employees.join(groups, same).select(
        F.col("EmployeeCode").alias("EmpCode"), "CombinationID", "PayGroupID", *[f"`{d}`" for d in dims]
    )


def employee_pay_groups(tables: dict[str, DataFrame], module: str = MODULE, keys: DataFrame | None = None) -> DataFrame:
    """From the HR tables to (employee, pay group); ``keys`` limits it to some employees."""
    dims = configured_dimensions(tables["type_configuration"], module)
    details = tables["employee_attribute_details"]
    if keys is not None:
        details = details.join(
            keys.select(F.col("EmpCode").alias("EmployeeCode")), "EmployeeCode", "left_semi"
        )
    rows = attribute_rows(details, tables["attribute_type_master"], tables["attribute_unit_master"])
    groups = pay_group_matrix(
        config_dimensions(tables["type_configuration"], tables["attribute_type_master"], module),
        pay_group_units(
            tables["unit_type_configuration"],
            tables["pay_group_master"],
            tables["attribute_unit_master"],
            module,
        ),
        dims,
    )
    return assign_pay_groups(employee_matrix(rows, dims), groups, dims).select("EmpCode", "PayGroupID")
