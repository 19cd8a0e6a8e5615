"""Row filters that several feeds share."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payfeed.functions.fields import has_status

# Employment status codes each feed sends.
STATUS_ONBOARDING_INDIA = (1, 10, 5, 6)
STATUS_ACTIVE_AND_NOTICE = (1, 10)
STATUS_ACTIVE = (1,)


def current_salary(salary: DataFrame) -> DataFrame:
    """Salary rows without an end date and with a non-zero monthly rate."""
    return salary.where(F.col("ToDate").isNull() & (F.col("MonthlyRate") != 0))


def with_status(employees: DataFrame, codes: tuple[int, ...]) -> DataFrame:
    return employees.where(has_status(F.col("ED_Status"), codes))


def country_of(signups: DataFrame, organisation: str) -> int | None:
    """Country of one organisation; more than one row is an error, none gives None."""
    rows = signups.where(F.col("organizationName") == organisation).select("CountryID").limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"organisation {organisation!r} is signed up more than once")
    return rows[0][0] if rows else None


def organisation_of(database: str, prefix: str) -> str:
    """Organisation name held in a database name, behind a fixed prefix."""
    return database.replace(prefix, "")


def split_dated(batches: DataFrame, time_col: str = "max_timestamp") -> tuple[DataFrame, DataFrame]:
    """Batches with a newest update time, and those without one (never sent)."""
    return batches.where(F.col(time_col).isNotNull()), batches.where(F.col(time_col).isNull())


def batch_max_time(
    rows: DataFrame, by: list[str], time_col: str, now: dt.datetime | None = None
) -> DataFrame:
    """Newest readable update time of every batch; ``now`` where there is none.

    One unreadable value makes the whole batch undated.
    """
    moment = F.col(time_col).try_cast("timestamp_ntz")
    unreadable = F.max(
        F.col(time_col).isNotNull() & (F.col(time_col).cast("string") != "") & moment.isNull()
    )
    newest = F.when(~unreadable, F.max(moment))
    if now is not None:
        newest = F.coalesce(newest, F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz"))
    return rows.groupBy(*by).agg(newest.alias("max_timestamp"), F.count(F.lit(1)).alias("batch_size"))
