"""What a consumer does with arrived messages: find the source, decode, shape for its country.

One pass: a message is parsed once, its records stay text until their country is known, and each is then
parsed once by that country's schema. No branch per country, so no table is read twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from payfeed.plans import payloads
from payfeed.sources.outbox import JSON_OPTIONS, REQUIRED_BY_SUBSCRIPTION, parse_messages
from payfeed.sources.tables import route


def _by_country(values: dict[str, Column]) -> Column:
    """The value for the country of the row."""
    (first, value), *rest = values.items()
    chosen = F.when(F.col("country") == first, value)
    for country, value in rest:
        chosen = chosen.when(F.col("country") == country, value)
    return chosen


def consume(
    messages: DataFrame,
    feed: str,
    sources: DataFrame,
    schemas: dict[str, StructType],
    as_of: dt.datetime,
    column: str = "message",
) -> DataFrame:
    """Records of messages, shaped for the country of the source that each came from.

    ``sources`` has name, subscription_name and country; ``schemas`` gives the records of each
    country, so sources of several countries go through one call. Returns message_id, subscription_name,
    country, position, record (JSON) and error. A message that cannot be read, has no source, or
    whose country has no payload or is not known is one row with an error and no record.
    """
    if not schemas:
        raise ValueError("no countries given")
    parsed = parse_messages(messages.select("message_id", column), REQUIRED_BY_SUBSCRIPTION, column)
    parsed = parsed.select("message_id", "subscription_name", "records", F.col("error").alias("_unread"))
    routed = route(parsed, sources).withColumnRenamed("source_country", "country")
    known = F.coalesce(F.col("country").isin(list(schemas)), F.lit(False))
    unknown = F.when(~known, F.concat(F.lit("unsupported country: "), F.coalesce("country", F.lit("null"))))
    unreadable = F.when(F.col("_unread") == "invalid JSON", F.col("_unread"))
    lost = F.coalesce(unreadable, "route_error", unknown, "_unread")
    named = routed.select("message_id", "subscription_name", "country", lost.alias("_lost"), F.when(lost.isNull(), F.col("records")).alias("_records"))
    rows = named.select(
        "message_id", "subscription_name", "country", "_lost", F.posexplode_outer("_records").alias("position", "_record")
    )
    struct = lambda country: f"_of_{list(schemas).index(country)}"
    decoded = rows.select(
        "*",
        *[F.when(F.col("country") == c, F.coalesce(F.from_json("_record", s), F.from_json(F.lit("{}"), s))).alias(struct(c)) for c, s in schemas.items()],
    )
    bodies, reasons = {}, {}
    for country, schema in schemas.items():
        types = {f.name: f.dataType.simpleString() for f in schema.fields}
        columns, reason = payloads.payload_columns(
            types, feed, country, as_of=as_of, at=lambda name, c=country: F.col(struct(c))[name]
        )
        bodies[country] = F.to_json(F.struct(*columns), JSON_OPTIONS)
        reasons[country] = reason
    shaped = F.col("_lost").isNull()
    wrong = F.when(~F.coalesce(F.col("_record").rlike(r"^\s*\{"), F.lit(False)), "record is no object").otherwise(
        F.concat(F.lit("unreadable "), _by_country(reasons))
    )
    return decoded.select(
        "message_id",
        "subscription_name",
        "country",
        "position",
        F.when(shaped, _by_country(bodies)).alias("record"),
        F.coalesce("_lost", wrong).alias("error"),
    )
