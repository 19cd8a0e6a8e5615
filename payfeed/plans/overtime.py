"""Overtime feeds: the roster's JSON parameter lists joined to pay rates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payfeed.functions.fields import minutes_value, overtime_hours, unit_code
from payfeed.operators.changes import changed_days, changed_since, repeat_rows
from payfeed.plans.attendance import join_employees

ORDER = ("EmployeeCode", "Date")

PARAMETERS = "array<struct<ParameterCode:string,ParameterValue:string,Conversion:string>>"


def _scalar(value: Column) -> Column:
    """Text of a JSON scalar; nested objects and lists have none."""
    nested = F.substring(value, 1, 1).isin("[", "{")
    return F.when(~nested, value)


def _parameters(text: Column) -> Column:
    """The parameter list, or null where the text is not one JSON list of objects."""
    body = F.btrim(text, F.lit(" \t\r\n"))
    is_list = F.startswith(body, F.lit("[")) & F.endswith(body, F.lit("]"))
    return F.when(is_list, F.from_json(text, PARAMETERS))


def _problem(items: Column) -> Column:
    """Why parsed parameters cannot be sent; null where they can."""
    bad_minutes = F.exists(
        items,
        lambda p: F.coalesce(
            _scalar(p["ParameterValue"]).isNotNull()
            & minutes_value(_scalar(p["ParameterValue"])).isNull(),
            F.lit(False),
        ),
    )
    return F.when(items.isNull(), "not a JSON list of parameters").when(bad_minutes, "minutes are not a number")


def _parsed_once(use) -> Column:
    """``use`` of the parsed parameters of a row, which are bound to a name so that the text is parsed once."""
    return F.transform(F.array(_parameters(F.col("OT_Param_json"))), use)[0]


def explode_params(roster: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """One row per overtime parameter of a roster row; rows that cannot be read in full give none.

    The rows without parameters are dropped behind the generator: a filter before it would parse the text again.
    """
    readable = _parsed_once(lambda items: F.when(_problem(items).isNull(), items))
    return (
        roster.where(F.col("OT_Param_json").isNotNull())
        .select(*keep, F.posexplode_outer(readable).alias("place", "p"))
        .where(F.col("place").isNotNull())
        .select(
            *keep,
            _scalar(F.col("p.ParameterCode")).alias("Code"),
            _scalar(F.col("p.ParameterValue")).alias("Minutes"),
            _scalar(F.col("p.Conversion")).alias("Conversion"),
        )
    )


def unreadable() -> Column:
    """Why the parameters of a roster row cannot be read; null where they can."""
    return _parsed_once(_problem)


def overtime_rejects(roster: DataFrame) -> DataFrame:
    """Roster rows whose parameters cannot be read, with the reason; feeds leave them out."""
    return (
        roster.where(F.col("OT_Param_json").isNotNull())
        .withColumn("reason", unreadable())
        .where(F.col("reason").isNotNull())
    )


def rejected_changes(tables: dict[str, DataFrame], mark: dt.datetime | None, as_of: dt.datetime) -> DataFrame:
    """Changed roster rows that an increment cannot send: EmpCode, Date, update time and reason."""
    changed = changed_since(tables["rostering"], "OT_UpdatedDate", mark, backfill_col="Date", as_of=as_of)
    return overtime_rejects(changed).select(
        "EmpCode", "Date", F.col("OT_UpdatedDate").alias("updateDate_timestamp"), "reason"
    )


def overtime_rates(params: DataFrame, rates: DataFrame) -> DataFrame:
    """Parameters with a known rate; unknown codes are dropped."""
    known = rates.select(F.col("Name").alias("Code"), F.col("Rate").alias("ExtraTimePay"))
    return params.join(known, "Code")


def _shape(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("ED_EMPID").alias("EmployeeCode"),
        "Date",
        "Code",
        overtime_hours(minutes_value(F.col("Minutes"))).alias("ExtraHrs"),
        unit_code(F.col("Conversion")).alias("Conversion"),
        "ExtraTimePay",
        F.col("OT_UpdatedDate").alias("updateDate_timestamp"),
    )


def overtime_feed(
    tables: dict[str, DataFrame], mark: dt.datetime | None, as_of: dt.datetime
) -> DataFrame:
    changed = changed_since(
        tables["rostering"], "OT_UpdatedDate", mark, backfill_col="Date", as_of=as_of
    )
    params = explode_params(changed, ("EmpCode", "Date", "OT_UpdatedDate"))
    rated = overtime_rates(params, tables["ot_parameter_master"])
    return _shape(join_employees(rated, tables["employee_details"]))


def overtime_days_feed(
    tables: dict[str, DataFrame],
    mark: dt.datetime | None,
    as_of: dt.datetime,
    parity: bool = True,
) -> DataFrame:
    """The older feed: every row of an employee's day once anything on that day changed.

    With ``parity`` a row comes back once per distinct update time of its day.
    """
    roster = tables["rostering"].where(F.col("OT_Param_json").isNotNull()).select(
        "EmpCode", "Date", "OT_Param_json", "OT_UpdatedDate"
    )
    employees = tables["employee_details"]
    new = changed_since(roster, "OT_UpdatedDate", mark, backfill_col="Date", as_of=as_of)
    changed = join_employees(new, employees).select("ED_EMPID", "Date", "OT_UpdatedDate").distinct()
    # Back to the codes of each employee, so that the roster itself is shuffled once.
    codes = employees.select("ED_EMPID", F.col("ED_EMPCode").alias("EmpCode"))
    days = changed.join(codes, "ED_EMPID")
    rows = changed_days(roster, days, ["EmpCode", "Date"], carry=("ED_EMPID",))
    params = explode_params(rows, ("ED_EMPID", "Date", "OT_UpdatedDate", "changed_times"))
    rated = overtime_rates(params, tables["ot_parameter_master"])
    # Copies are made last: they are copies of what is read from the JSON text, too.
    return _shape(repeat_rows(rated, "changed_times") if parity else rated)
