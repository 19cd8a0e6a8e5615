"""One increment of a feed: changed rows, batches, outbox; later outcomes, log, marks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payfeed.functions.fields import ntz
from payfeed.operators.batching import (
    ATTENDANCE_ROWS,
    OTHER_EMPLOYEES,
    OVERTIME_EMPLOYEES,
    batch_keys,
    batch_rows,
    iso_records,
    manifest,
)
from payfeed.plans import attendance, onboarding, overtime, payloads, salary, variable
from payfeed.session import materialize, staging
from payfeed.sources.delivery import apply_outcomes, batch_log
from payfeed.sources.marks import commit_mark, next_mark, read_mark
from payfeed.sources.outbox import JSON_OPTIONS, batch_id, new_batches, write_outbox
from payfeed.sources.tables import fan_in

UPDATE_TIME = "updateDate_timestamp"


@dataclass(frozen=True)
class Feed:
    """How a feed is built, cut and sent.

    ``build(tables, mark, as_of, **options)`` gives the changed rows, and
    ``rejects(tables, mark, as_of)`` those that cannot be read. Batches hold ``batch_size``
    rows, or keys where ``batch_key`` is set.
    """

    name: str
    country: str | None
    build: Callable[..., DataFrame]
    order: tuple[str, ...]
    batch_size: int
    batch_key: str | None = None
    per_source_mark: bool = False
    options: dict = field(default_factory=dict)
    rejects: Callable[..., DataFrame] | None = None

    @property
    def record_key(self) -> str:
        return payloads.RECORD_KEYS[self.name]


FEEDS = {
    "attendance": Feed(
        "attendance", None, attendance.attendance_feed, attendance.ORDER, ATTENDANCE_ROWS, per_source_mark=True
    ),
    "overtime": Feed(
        "overtime", None, overtime.overtime_feed, overtime.ORDER, OVERTIME_EMPLOYEES, "EmployeeCode", True,
        rejects=overtime.rejected_changes,
    ),
    "onboarding_india": Feed(
        "onboarding", "INDIA", onboarding.onboarding_india_feed, onboarding.ORDER, OTHER_EMPLOYEES,
        "EmployeeCode", options={"with_update_time": True},
    ),
    "onboarding_philippines": Feed(
        "onboarding", "PHILIPPINES", onboarding.onboarding_philippines_feed, onboarding.ORDER,
        OTHER_EMPLOYEES, "EmployeeCode",
    ),
    "salary_india": Feed(
        "salary", "INDIA", salary.salary_india_feed, salary.ORDER, OTHER_EMPLOYEES, "EmployeeCode"
    ),
    "salary_philippines": Feed(
        "salary", "PHILIPPINES", salary.salary_philippines_feed, salary.ORDER, OTHER_EMPLOYEES,
        "EmployeeCode", options={"with_update_time": True},
    ),
    "salary_thailand": Feed(
        "salary", "THAILAND", salary.salary_thailand_feed, salary.ORDER, OTHER_EMPLOYEES,
        "EmployeeCode", options={"with_update_time": True},
    ),
    "variable_india": Feed(
        "variable", "INDIA", variable.variable_india_feed, variable.ORDER, OTHER_EMPLOYEES,
        "EmployeeCode", options={"with_update_time": True},
    ),
    "variable_philippines": Feed(
        "variable", "PHILIPPINES", variable.variable_philippines_feed, variable.ORDER, OTHER_EMPLOYEES,
        "EmployeeCode",
    ),
    "variable_thailand": Feed(
        "variable", "THAILAND", variable.variable_philippines_feed, variable.ORDER, OTHER_EMPLOYEES,
        "EmployeeCode",
    ),
}


def cut(rows: DataFrame, feed: Feed, batch_size: int | None = None, staged: bool = False) -> DataFrame:
    """Batch numbers for the rows of a feed, per source."""
    size = batch_size or feed.batch_size
    if feed.batch_key is None:
        return batch_rows(rows, size, list(feed.order), within=("source_db",), staged=staged)
    return batch_keys(rows, feed.batch_key, size, within=("source_db",), staged=staged)


def shape_records(batched: DataFrame, feed: Feed, as_of: dt.datetime) -> DataFrame:
    """Records of a cut feed as JSON text: source_db, batch_no, place, record, time and error.

    ``place`` orders the records of a batch: their row number, or what the feed is ordered by.
    """
    data = [c for c in batched.columns if c not in ("batch_no", "row_index")]
    numbered = "row_index" in batched.columns
    order = [F.col("row_index")] if numbered else [F.col(f"`{c}`") for c in feed.order]
    timed = UPDATE_TIME in data
    carried = batched.select(
        "source_db",
        "batch_no",
        F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("place"),
        (F.col(UPDATE_TIME) if timed else F.lit(None).cast("timestamp_ntz")).alias("time"),
        *[F.col(f"`{c}`") for c in data if c != "source_db"],
    )
    bookkeeping = ["source_db", "batch_no", "place", "time"]
    records = [c for c in data if c not in payloads.BOOKKEEPING]
    if feed.country is None:
        shaped = iso_records(carried.select(*bookkeeping, *records), records).withColumn(
            payloads.ERROR, F.lit(None).cast("string")
        )
    else:
        shaped = payloads.project(
            carried, feed.name, feed.country, as_of=as_of, keep=tuple(bookkeeping), with_errors=True
        )
        records = [c for c in shaped.columns if c not in (*bookkeeping, payloads.ERROR)]
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in records]), JSON_OPTIONS)
    return shaped.select(*bookkeeping, body.alias("record"), F.col(payloads.ERROR).alias("error"))


def pack(records: DataFrame, feed: Feed, subscriptions: dict[str, str], as_of: dt.datetime) -> DataFrame:
    """Batches of shaped records, one row each whatever their size: id, bookkeeping, first error.

    A batch without any update time counts as of now where the feed has one mark for
    all; attendance and overtime never send such a batch.
    """
    counted = manifest(records, ["source_db", "batch_no"], "record", "time", "error")
    names = F.create_map(*[F.lit(x) for pair in subscriptions.items() for x in pair])
    newest = F.col("max_timestamp")
    if not feed.per_source_mark:
        newest = F.coalesce(newest, ntz(as_of))
    undated = F.when(newest.isNull(), "no readable update time") if feed.per_source_mark else F.lit(None)
    unreadable = F.when(F.col("error").isNotNull(), F.concat(F.lit("unreadable "), F.col("error")))
    return (
        counted.withColumn("subscription_name", F.try_element_at(names, F.col("source_db")))
        .withColumn("error", F.coalesce(unreadable, undated))
        .withColumn("max_timestamp", newest)
        .withColumn("batch_id", batch_id(f"{feed.name}-{feed.country or ''}", F.col("digest")))
        .withColumn("feed", F.lit(feed.name))
        .drop("digest")
    )


def batches_of(
    rows: DataFrame, feed: Feed, subscriptions: dict[str, str], as_of: dt.datetime, batch_size: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Batches of staged rows, and their records with batch_id, place and JSON text.

    The batches are written as well, so records are summed up once, and what joins their ids is of known size.
    """
    shaped = materialize(shape_records(cut(rows, feed, batch_size, staged=True), feed, as_of), "records")
    packed = materialize(pack(shaped, feed, subscriptions, as_of), "packed")
    ids = packed.select("source_db", "batch_no", "batch_id")
    return packed, shaped.join(ids, ["source_db", "batch_no"]).select("batch_id", "place", "record")


def write_batches(
    rows: DataFrame,
    feed: Feed,
    subscriptions: dict[str, str],
    as_of: dt.datetime,
    path: str,
    batch_size: int | None = None,
    log: DataFrame | None = None,
    since: dt.datetime | None = None,
) -> None:
    """Cut staged rows and write the outbox of one run: ``batches`` and their ``records``.

    A batch's ``payload`` says where its records are.
    """
    packed, records = batches_of(rows, feed, subscriptions, as_of, batch_size)
    if log is not None:
        packed = new_batches(packed, log, since)
    content = F.concat(F.lit(f"{path}/records#"), F.col("batch_id"))
    write_outbox(packed.withColumn("payload", content), f"{path}/batches", mode="overwrite")
    sent = rows.sparkSession.read.parquet(f"{path}/batches").select("batch_id")
    write_outbox(records.join(sent, "batch_id", "left_semi"), f"{path}/records", mode="overwrite")


def run_increment(
    feed: Feed,
    sources: dict[str, dict[str, DataFrame]],
    subscriptions: dict[str, str],
    marks: DataFrame,
    as_of: dt.datetime,
    outbox: str,
    log: DataFrame | None = None,
    batch_size: int | None = None,
    **options,
) -> DataFrame:
    """Write the batches of everything that changed to the outbox, and return them.

    The changed rows are written once before they are cut, so batches, times and
    payloads all come from the same rows however the sources move on. Every run has a
    folder of its own under ``outbox``, named by feed and ``as_of``; a run that is
    repeated replaces it. The folder holds ``batches`` (returned), their ``records``, and
    ``rejects``: changed rows that could not be read. Rejects are returned as batches
    with an error, number -1, which no delivery takes and no safe mark passes.
    """
    spark = marks.sparkSession
    label = f"{feed.name}-{feed.country.lower()}" if feed.country else feed.name
    path = f"{outbox.rstrip('/')}/{label}/{as_of:%Y%m%dT%H%M%S%f}"
    with staging(spark):
        changed, refused, oldest = {}, {}, []
        for name, tables in sources.items():
            mark = read_mark(marks, name if feed.per_source_mark else None)
            oldest.append(mark)
            changed[name] = feed.build(tables, mark=mark, as_of=as_of, **{**feed.options, **options})
            if feed.rejects is not None:
                refused[name] = feed.rejects(tables, mark, as_of)
        rows = materialize(fan_in(changed), feed.name)
        since = None if None in oldest else min(oldest, default=None)
        write_batches(rows, feed, subscriptions, as_of, path, batch_size, log, since)
        if refused:
            write_outbox(fan_in(refused), f"{path}/rejects", mode="overwrite")
    sent = spark.read.parquet(f"{path}/batches")
    return sent.unionByName(rejected_batches(spark.read.parquet(f"{path}/rejects"), feed), allowMissingColumns=True) if refused else sent


def rejected_batches(rejects: DataFrame, feed: Feed) -> DataFrame:
    """Rejects of each source as one batch with an error."""
    error = F.concat(F.lit("unreadable rows: "), F.min("reason"))
    counted = rejects.groupBy("source_db").agg(
        F.lit(-1).cast("bigint").alias("batch_no"),
        F.count(F.lit(1)).alias("batch_size"),
        F.min(UPDATE_TIME).alias("min_timestamp"),
        F.max(UPDATE_TIME).alias("max_timestamp"),
        error.alias("error"),
    )
    moment = F.concat_ws("|", F.lit(f"{feed.name}-rejects"), "source_db", "min_timestamp", "max_timestamp", "batch_size")
    return counted.withColumn("batch_id", F.sha2(moment, 256)).withColumn("feed", F.lit(feed.name))


def record_outcomes(
    feed: Feed,
    sent: DataFrame,
    results: DataFrame,
    marks: DataFrame,
    at: dt.datetime,
    policy: str = "safe",
    bump: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Log rows of delivered batches, and mark rows to append (see ``next_mark``).

    Feeds with one mark for all sources advance every source to the same mark.
    """
    outcomes = apply_outcomes(sent, results, feed.name)
    if feed.per_source_mark:
        new = next_mark(outcomes, marks, policy, bump)
    else:
        latest = read_mark(marks)
        shared = marks.limit(0).unionByName(
            marks.sparkSession.range(1).select(
                F.lit(1).alias("ID"),
                (ntz(latest) if latest else F.lit(None).cast("timestamp_ntz")).alias("last_timestamp"),
                F.lit("").alias("source_db"),
            )
        )
        new = next_mark(outcomes.withColumn("source_db", F.lit("")), shared, policy, bump).withColumn(
            "source_db", F.lit(None).cast("string")
        )
    return batch_log(outcomes, at, feed.name), commit_mark(marks, new)
