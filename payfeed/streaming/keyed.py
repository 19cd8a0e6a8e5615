"""A feed as a stream over several tables that change: arriving files say who changed, the feed is read anew for them.

Attendance or pay rows are sent as they arrive (``stream.arriving``). Onboarding is different: a row of one table makes all
pay of its employee due, and so may a row of another table, such as a new attribute. Each watched table is a file
stream of its own, reduced to keys at once; the streams are one query with one checkpoint, so a micro-batch is
repeated with the same keys after a failure. Per micro-batch, the tables that are keyed by employee are read
once, for the changed employees only, and the feed is built on them.

No state is kept between micro-batches, so nothing grows with the time that the stream runs. A hot employee is
one key, however many rows arrive for it. Rows without an employee code name nobody and are passed over.
"""

from __future__ import annotations

import datetime as dt
from collections import ChainMap
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from payfeed.operators.changes import only_changed
from payfeed.plans.increment import Feed, batches_of
from payfeed.session import materialize
from payfeed.streaming.stream import Shape, run_stream

# The tables whose rows belong to an employee, and the column that says to whom.
KEYED_TABLES = {
    "salary_master": "EmpCode",
    "emp_variable": "EmpCode",
    "employee_details": "ED_EMPCode",
    "employee_attribute_details": "EmployeeCode",
}


@dataclass(frozen=True)
class Watch:
    """A folder of arriving files and the employees that its rows name.

    ``employee`` is the employee code of an arrived row. Where ``time`` is given, only the rows of ``table`` with that
    update time are due, as a salary revision is; without it, all rows of the employee. ``prepare`` may
    filter and join the arrived rows with tables at hand.
    """

    table: str
    path: str
    schema: StructType
    employee: Column
    time: Column | None = None
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows
    fmt: str = "parquet"
    glob: str | None = None
    files_per_batch: int | None = None


def changes(spark: SparkSession, watches: list[Watch]) -> DataFrame:
    """One stream of all watched folders: table, EmpCode, changed_at (null: everything of the employee)."""

    def keys(watch: Watch) -> DataFrame:
        reader = spark.readStream.format(watch.fmt).schema(watch.schema)
        if watch.glob:
            reader = reader.option("pathGlobFilter", watch.glob)
        if watch.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", watch.files_per_batch)
        time = F.lit(None) if watch.time is None else watch.time
        rows = watch.prepare(reader.load(watch.path))
        return rows.select(
            F.lit(watch.table).alias("table"), watch.employee.alias("EmpCode"), time.cast("timestamp_ntz").alias("changed_at")
        ).where(F.col("EmpCode").isNotNull())

    if not watches:
        raise ValueError("no tables to watch")
    return reduce(DataFrame.unionByName, map(keys, watches))


def _due(rows: DataFrame, table: str, keys: DataFrame, time: str) -> DataFrame:
    """Rows of changed employees: all of them, or those of the arrived update times."""
    staged = materialize(only_changed(rows, keys, "EmpCode"), table)
    timed = F.coalesce((F.col("table") == table) & F.col("changed_at").isNotNull(), F.lit(False))
    whole = keys.where(~timed).select("EmpCode").distinct()
    single = keys.where(timed).select("EmpCode", F.col("changed_at").alias("_at")).distinct()
    single = single.join(whole, "EmpCode", "left_anti")
    at = staged.withColumn("_at", F.col(time).cast("timestamp_ntz"))
    revised = only_changed(at, single, ["EmpCode", "_at"]).drop("_at")
    return only_changed(staged, whole, "EmpCode").unionByName(revised)


def keyed(
    feed: Feed,
    snapshot: Callable[[], Mapping[str, DataFrame]],
    source: str,
    subscription: str,
    *,
    revised: Mapping[str, str] | None = None,
    mark: dt.datetime | None = None,
    now: Callable[[], dt.datetime] = dt.datetime.now,
    **options,
) -> Shape:
    """Batches, records and rejects of the employees named in a micro-batch of ``changes``.

    ``snapshot`` binds the tables as they are now, arrived files included. ``revised`` names tables of which
    only the arrived revisions are due, with their update column; such feeds take ``mark`` as "from the
    beginning", since what arrives has changed.
    """

    def shape(keys: DataFrame, epoch: int) -> dict[str, DataFrame]:
        keys, tables, as_of = materialize(keys.distinct(), "keys"), snapshot(), now()
        limited = {}
        for table, column in KEYED_TABLES.items():
            if table in tables:
                named = keys.select(F.col("EmpCode").alias(column)).distinct()
                limited[table] = only_changed(tables[table], named, column)
        for table, time in (revised or {}).items():
            limited[table] = _due(tables[table], table, keys, time)
        bound = ChainMap(limited, tables)
        built = feed.build(bound, mark=mark, as_of=as_of, **{**feed.options, **options})
        staged = materialize(built.withColumn("source_db", F.lit(source)), feed.name)
        batches, records = batches_of(staged, feed, {source: subscription}, as_of)
        return {"batches": batches, "records": records}

    return shape


def stream_changes(spark: SparkSession, watches: list[Watch], shape: Shape, outbox: str, checkpoint: str) -> None:
    """Process what has arrived in all watched folders, then stop; the next call goes on from there."""
    run_stream(changes(spark, watches), shape, outbox, checkpoint)
