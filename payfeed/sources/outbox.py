"""Messages handed to the delivery program, and messages read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from payfeed.functions.fields import iso_text, ntz

JSON_OPTIONS = {"ignoreNullFields": "false"}

# What a message must carry besides records, by family of feeds.
REQUIRED_BY_SOURCE = ("source_db", "max_timestamp", "subscription_name")
REQUIRED_BY_SUBSCRIPTION = ("subscription_name",)


def envelope_message(required: tuple[str, ...] = REQUIRED_BY_SOURCE) -> Column:
    """The JSON message of an envelope row: its records and bookkeeping fields."""
    parts = [F.col("records")]
    for name in ("source_db", "subscription_name", "max_timestamp"):
        if name in required:
            column = F.col(name)
            parts.append(iso_text(column, "timestamp_ntz").alias(name) if name == "max_timestamp" else column)
    return F.to_json(F.struct(*parts), JSON_OPTIONS)


def api_payload(record_key: str, records: str = "records") -> Column:
    """The JSON body that goes to the payroll service."""
    return F.to_json(F.struct(F.col(records).alias(record_key), F.col("subscription_name")), JSON_OPTIONS)


def batch_id(feed: str, digest: Column) -> Column:
    """The same batch of the same increment always gets the same id."""
    return F.sha2(
        F.concat_ws(
            "|",
            F.lit(feed),
            F.coalesce(F.col("source_db"), F.lit("")),
            F.col("batch_no").cast("string"),
            F.coalesce(F.col("min_timestamp").cast("string"), F.lit("")),
            F.coalesce(F.col("max_timestamp").cast("string"), F.lit("")),
            digest,
        ),
        256,
    )


def write_outbox(envelopes: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    envelopes.write.mode(mode).format(fmt).save(path)


def new_batches(envelopes: DataFrame, log: DataFrame, since: dt.datetime | None = None) -> DataFrame:
    """Envelopes not yet delivered according to the log.

    ``since`` limits the log to rows written from then on: a batch of rows newer than a mark
    cannot have been logged before that mark was reached. Of a log kept by day, only the days from then on are read.
    Delivered batches are merged, not broadcast: they are as many as the log is long.
    """
    if since is not None:
        log = log.where(F.col("Timestamp") >= ntz(since))
        if "day" in log.columns:
            log = log.where(F.col("day") >= F.lit(since.date()))
    done = log.where(F.col("Status") == "SUCCESS").select("batch_id")
    return envelopes.join(done.hint("merge"), "batch_id", "left_anti")


def message_bodies(sent: DataFrame, records: DataFrame, record_key: str) -> DataFrame:
    """Batches with their JSON ``body``, for deliveries that take a batch in one message.

    ``records`` are the rows of these batches; what a body holds must fit a row.
    """
    ordered = F.sort_array(F.collect_list(F.struct("place", "record")))
    texts = records.groupBy("batch_id").agg(F.transform(ordered, lambda x: x["record"]).alias("_texts"))
    head = F.to_json(F.struct(F.col("subscription_name")), JSON_OPTIONS)
    body = F.concat(
        F.lit('{"' + record_key + '":['), F.array_join("_texts", ","), F.lit("],"), F.substring(head, F.lit(2), F.length(head))
    )
    return sent.join(texts, "batch_id").withColumn("body", body).drop("_texts")


def parse_messages(
    messages: DataFrame, required: tuple[str, ...] = REQUIRED_BY_SOURCE, column: str = "message"
) -> DataFrame:
    """Messages with their bookkeeping fields and their records, each as JSON text; ``error`` says what is wrong.

    For receivers that learn only from the message what its records are.
    """
    return _parsed(messages, StringType(), required, column)


def parse_envelopes(
    messages: DataFrame,
    record_schema: StructType,
    required: tuple[str, ...] = REQUIRED_BY_SOURCE,
    column: str = "message",
) -> DataFrame:
    """Messages with their parsed parts, and what is wrong with them in ``error``."""
    return _parsed(messages, record_schema, required, column)


def _parsed(messages: DataFrame, record: DataType, required: tuple[str, ...], column: str) -> DataFrame:
    schema = StructType(
        [
            StructField("records", ArrayType(record)),
            StructField("source_db", StringType()),
            StructField("subscription_name", StringType()),
            StructField("max_timestamp", StringType()),
        ]
    )
    whole = F.col(column).rlike(r"(?s)^\s*\{.*\}\s*$")
    parsed = messages.withColumn("_m", F.when(whole, F.from_json(column, schema)))
    error = F.when(F.col("_m").isNull(), "invalid JSON").when(
        F.coalesce(F.size("_m.records"), F.lit(0)) <= 0, "no records"
    )
    for name in required:
        value = F.col(f"_m.{name}")
        error = error.when(value.isNull() | (value == ""), f"missing {name}")
    if "max_timestamp" in required:
        error = error.when(F.col("_m.max_timestamp").try_cast("timestamp_ntz").isNull(), "unreadable max_timestamp")
    return parsed.withColumn("error", error).select(
        *[c for c in messages.columns],
        "error",
        F.col("_m.records").alias("records"),
        F.col("_m.source_db").alias("source_db"),
        F.col("_m.subscription_name").alias("subscription_name"),
        F.col("_m.max_timestamp").try_cast("timestamp_ntz").alias("max_timestamp"),
    )


def decode_envelopes(
    messages: DataFrame,
    record_schema: StructType,
    required: tuple[str, ...] = REQUIRED_BY_SOURCE,
    column: str = "message",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Records of all valid messages, one per row, with their position in the message."""
    valid = parse_envelopes(messages, record_schema, required, column).where(F.col("error").isNull())
    names = [f.name for f in record_schema.fields]
    # A record may carry its own source; the message's settings come first.
    extra = [c for c in ("subscription_name", "max_timestamp") if c not in names and c not in keep]
    return valid.select(*keep, *extra, F.posexplode("records").alias("position", "_r")).select(
        *keep, *extra, "position", *[F.col(f"_r.`{n}`").alias(n) for n in names]
    )
