"""Configured attributes, pay groups, properties."""

import datetime as dt

import pytest

from payfeed.operators import attributes, properties
from payfeed.operators.attributes import MODULE

OPEN = dt.datetime(1900, 1, 1)


def config(spark, *lists, module=MODULE, applicable=1):
    return spark.createDataFrame(
        [(module, module, ids, names, applicable) for ids, names in lists],
        "ModuleCode string, SubModuleCode string, AttributeBasedOn string, AttributeBasedOnDesc string, Applicable int",
    )


def test_configured_dimensions(spark):
    rows = config(spark, ("1|2", " Cost Center |Region|"), ("2", "Region"))
    assert attributes.configured_dimensions(rows) == ["Cost Center", "Region"]


@pytest.mark.parametrize("bad", ["none", "off", "other"])
def test_unconfigured_module_raises(spark, bad):
    rows = {
        "none": config(spark, ("", "")),
        "off": config(spark, ("1", "Region"), applicable=0),
        "other": config(spark, ("1", "Region"), module="Other"),
    }[bad]
    with pytest.raises(attributes.PayGroupNotConfigured):
        attributes.configured_dimensions(rows)


def test_no_dimensions_never_become_a_cross_join(spark):
    df = spark.createDataFrame([("E1",)], "EmployeeCode string")
    with pytest.raises(attributes.PayGroupNotConfigured):
        attributes.assign_pay_groups(df, df, [])


def test_attribute_rows_and_matrix(spark):
    details = spark.createDataFrame(
        [
            ("E1", 1, 10, None),
            ("E1", 1, 11, OPEN),
            ("E1", 2, 20, dt.datetime(2020, 1, 1)),
            ("E2", 2, 20, OPEN),
            ("E2", 3, 30, None),
            ("E3", 2, 10, None),
        ],
        "EmployeeCode string, AttributeTypeID int, AttributeTypeUnitID int, ToDate timestamp_ntz",
    )
    types = spark.createDataFrame(
        [(1, "Cost Center", 1), (2, "Region", 1), (3, "Old", 0)],
        "AttributeTypeID int, AttributeTypeDescription string, Applicable int",
    )
    units = spark.createDataFrame(
        [(10, 1, "A", 1), (11, 1, "B", 1), (20, 2, "North", 1), (30, 3, "X", 1)],
        "AttributeTypeUnitID int, AttributeTypeID int, AttributeTypeUnitDescription string, Applicable int",
    )
    rows = attributes.attribute_rows(details, types, units)
    assert sorted((r[0], r[1], r[2]) for r in rows.collect()) == [
        ("E1", "Cost Center", "A"), ("E1", "Cost Center", "B"), ("E2", "Region", "North"),
    ]
    matrix = attributes.employee_matrix(rows, ["Cost Center", "Region"])
    assert matrix.columns == ["EmployeeCode", "CostCenter_Description", "Region_Description"]
    assert sorted(map(tuple, matrix.collect())) == [("E1", "B", None), ("E2", None, "North")]


def test_missing_attribute_matches_no_group(spark):
    staff = spark.createDataFrame(
        [("E1", "A", "N"), ("E2", None, "N"), ("E3", "A", "S")],
        "EmployeeCode string, CostCenter_Description string, Region_Description string",
    )
    groups = spark.createDataFrame(
        [(1, 7, "A", "N"), (2, 8, "A", "N"), (3, 9, None, "N")],
        "CombinationID int, PayGroupID int, `Cost Center` string, Region string",
    )
    got = attributes.assign_pay_groups(staff, groups, ["Cost Center", "Region"])
    assert sorted((r.EmpCode, r.PayGroupID) for r in got.collect()) == [("E1", 7), ("E1", 8)]


def test_pay_group_units_need_everything_applicable(spark):
    unit_config = spark.createDataFrame(
        [(1, "10| 20", MODULE, MODULE, 1), (2, "10", MODULE, MODULE, 0), (3, "10", "Other", MODULE, 1)],
        "CombinationID int, AttributeUnitConfig string, ModuleCode string, SubModuleCode string, Applicable int",
    )
    groups = spark.createDataFrame([(5, 1, 1), (6, 1, 0), (7, 2, 1), (8, 3, 1)], "PayGroupID int, ComboID int, Applicable int")
    units = spark.createDataFrame(
        [(10, 1, "a", "A", 1), (20, 2, "n", "N", 0)],
        "AttributeTypeUnitID int, AttributeTypeID int, AttributeTypeUnitCode string,"
        " AttributeTypeUnitDescription string, Applicable int",
    )
    got = attributes.pay_group_units(unit_config, groups, units)
    assert [(r.CombinationID, r.PayGroupID, r.Items) for r in got.collect()] == [(1, 5, "10")]


def test_property_matrix_cells(spark):
    rows = spark.createDataFrame(
        [("E1", "A", True), ("E1", "A", False), ("E1", "B", None), ("E2", "A", False)],
        "EmpCode string, GPP_PropertyCode string, PropertyChecked boolean",
    )
    got = properties.property_matrix(rows)
    assert got.columns == ["EmpCode", "A", "B"]
    assert sorted(map(tuple, got.collect())) == [("E1", 1, 0), ("E2", 0, None)]
    assert properties.property_codes(rows).first()[0] == "A,B"


def test_resolve_property_last_match_wins():
    codes = ["PF", "SSSEMPLOYEE", "Other"]
    assert properties.resolve_property(codes, properties.PF_CODES) == "SSSEMPLOYEE"
    assert properties.resolve_property(["pf_employee"], properties.PF_CODES) == "pf_employee"
    assert properties.resolve_property(codes, properties.VPF_CODES) is None
