"""Change capture: which rows, keys and days changed since a mark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payfeed.functions.fields import ntz
from payfeed.session import staged_join

# How far a first run looks back.
BACKFILL_DAYS = 90


def _not_before(df: DataFrame, column: str, moment: dt.datetime) -> Column:
    """``column`` at or after ``moment``, comparing dates as midnights.

    The bound is turned into the column's own type here, on the driver, so that the
    comparison reaches the file scan.
    """
    if df.schema[column].dataType.typeName() != "date":
        return F.col(column) >= ntz(moment)
    day = moment.date()
    if moment.time() != dt.time():
        day += dt.timedelta(days=1)
    return F.col(column) >= F.lit(day)


def changed_since(
    df: DataFrame,
    update_col: str,
    mark: dt.datetime | None,
    *,
    inclusive: bool = False,
    backfill_col: str | None = None,
    days: int | None = BACKFILL_DAYS,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """Rows changed since ``mark``; without a mark, the rows of the first run.

    ``inclusive`` also takes rows at the mark. A first run takes rows whose
    ``backfill_col`` (the update time by default) lies within ``days`` before
    ``as_of``, or everything where ``days`` is None.
    """
    if mark is not None:
        bound = ntz(mark)
        return df.where(F.col(update_col) >= bound if inclusive else F.col(update_col) > bound)
    if days is None:
        return df
    if as_of is None:
        raise ValueError("a first run with a look-back needs as_of")
    start = as_of - dt.timedelta(days=days)
    if inclusive:
        start = start.replace(microsecond=0)
    return df.where(_not_before(df, backfill_col or update_col, start))


def changed_keys(df: DataFrame, key: str, update_col: str, mark: dt.datetime | None) -> DataFrame:
    """Distinct (key, update time) pairs changed since the mark; everything on a first run."""
    return changed_since(df, update_col, mark, days=None).select(key, update_col).distinct()


def only_changed(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """All rows of ``df`` whose key changed, changed rows or not."""
    columns = [on] if isinstance(on, str) else on
    return staged_join(df, keys.select(*columns).distinct(), columns, "left_semi", "keys")


def changed_days(df: DataFrame, changed: DataFrame, on: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """All rows of every key and day that has a changed row.

    ``changed`` has the key columns, the update time, and ``carry``, columns added to the
    result. ``changed_times`` in the result is the number of distinct update times.
    """
    days = changed.distinct().groupBy(*on, *carry).agg(F.count(F.lit(1)).cast("int").alias("changed_times"))
    return staged_join(df, days, on, label="days")


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Every row as often as its column ``times`` says; the column is dropped."""
    copies = F.explode(F.sequence(F.lit(1), F.col(times))).alias("_copy")
    return df.select("*", copies).drop("_copy", times)
