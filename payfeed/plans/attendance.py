"""Attendance feed: changed roster rows with the employee's id."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payfeed.functions.fields import attendance_value
from payfeed.operators.changes import changed_since

ORDER = ("EmployeeID", "AttendanceDate", "updateDate_timestamp")


def join_employees(rows: DataFrame, employees: DataFrame) -> DataFrame:
    """Rows of known employees, with the employee's id."""
    ids = employees.select(F.col("ED_EMPCode").alias("EmpCode"), "ED_EMPID")
    return rows.join(ids, "EmpCode")


def attendance_feed(
    tables: dict[str, DataFrame], mark: dt.datetime | None, as_of: dt.datetime
) -> DataFrame:
    changed = changed_since(
        tables["rostering"], "UpdatedDate", mark, backfill_col="Date", as_of=as_of
    ).select("EmpCode", "Date", "AttValue1", "UpdatedDate")
    return join_employees(changed, tables["employee_details"]).select(
        F.col("ED_EMPID").alias("EmployeeID"),
        F.col("EmpCode").alias("EmployeeCode"),
        F.col("Date").alias("AttendanceDate"),
        F.col("Date").alias("ApprovedDate"),
        attendance_value(F.col("AttValue1")).alias("Attendance"),
        F.lit(0).alias("EarlyMinutes"),
        F.lit(0).alias("LateMinutes"),
        F.col("UpdatedDate").alias("updateDate_timestamp"),
    )
