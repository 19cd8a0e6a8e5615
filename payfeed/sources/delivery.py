"""What became of each batch, and the log of it."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payfeed.functions.fields import ntz
from payfeed.session import materialize

# The column by which a log is kept in folders.
DAY = "day"
# Characters of the response kept in the log.
DETAIL_CHARS = 1000

# The log flag of a delivered batch is 0 for these feeds and 1 for the
# others; a failed batch has the opposite flag.
INVERTED_FLAG_FEEDS = ("attendance", "overtime")


def apply_outcomes(envelopes: DataFrame, results: DataFrame, feed: str) -> DataFrame:
    """Envelopes with the outcome of their delivery.

    ``results`` has batch_id, status_code and response, at most one row per batch.
    200 is SUCCESS and any other code FAILED (0 stands for a failed connection). A batch
    with an ``error`` of its own is ERROR whatever was reported; one without a result
    is PENDING.

    Files of repetitive responses are far smaller than what they hold, so the planner would broadcast results that
    no driver can hold: both sides are sorted and merged. Responses that nothing shows stay behind.
    """
    inverted = feed in INVERTED_FLAG_FEEDS
    delivered = F.coalesce(F.col("status_code") == 200, F.lit(False))
    shown = F.col("response") if inverted else F.when(~delivered, F.col("response"))
    reported = results.select("batch_id", "status_code", shown.alias("response"))
    joined = envelopes.join(reported.hint("merge"), "batch_id", "left")
    own_error = F.col("error") if "error" in envelopes.columns else F.lit(None).cast("string")
    status = (
        F.when(own_error.isNotNull(), "ERROR")
        .when(F.col("status_code").isNull(), "PENDING")
        .when(F.col("status_code") == 200, "SUCCESS")
        .otherwise("FAILED")
    )
    quiet = F.lit("") if not inverted else F.col("response")
    details = (
        F.when(status == "ERROR", own_error).when(status == "SUCCESS", quiet).otherwise(F.col("response"))
    )
    complete = F.when(status == "SUCCESS", not inverted).when(status == "FAILED", inverted).otherwise(False)
    return (
        joined.withColumn("status", status)
        .withColumn("details", details)
        .withColumn("is_complete", complete)
        .drop("status_code", "response")
    )


def batch_log(outcomes: DataFrame, at: dt.datetime, feed: str) -> DataFrame:
    """Log rows of all batches that have an outcome.

    Attendance and overtime keep the payload of failed batches only.
    """
    payload = F.col("payload")
    if feed in INVERTED_FLAG_FEEDS:
        payload = F.when(F.col("status") == "FAILED", payload).otherwise("0")
    return outcomes.where(F.col("status") != "PENDING").select(
        "batch_id",
        ntz(at).alias("Timestamp"),
        F.col("batch_size").cast("int").alias("BatchSize"),
        F.col("status").alias("Status"),
        F.substring(F.coalesce(F.col("details"), F.lit("")), 1, DETAIL_CHARS).alias("Details"),
        F.col("is_complete").alias("IsBatchComplete"),
        payload.alias("Payload"),
    )


def append_log(log: DataFrame, path: str) -> None:
    """Append log rows that the log at ``path`` does not have; a call that is repeated adds nothing.

    The log is kept by ``day``, and only the days of the new rows are compared, however long the log is. A log
    that was begun without days stays as it is. One program writes a log at a time. The comparison is a merge: a
    log's file size says little of its rows, and a broadcast would bring them to the driver.
    """
    log = materialize(log, "log")
    first, last = log.agg(F.min("Timestamp"), F.max("Timestamp")).first()
    if first is None:
        return
    known = stored(log.sparkSession, path)
    by_day = known is None or DAY in known.columns
    if known is not None:
        if by_day:
            known = known.where(F.col(DAY).between(F.lit(first.date()), F.lit(last.date())))
        log = log.join(known.select("batch_id", "Status", "Timestamp").hint("merge"), ["batch_id", "Status", "Timestamp"], "left_anti").select(*log.columns)
    if by_day:
        log.withColumn(DAY, F.to_date("Timestamp")).write.mode("append").partitionBy(DAY).parquet(path)
    else:
        log.write.mode("append").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
