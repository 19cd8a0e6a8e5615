"""The increment as a stream over arriving files."""

from __future__ import annotations

import datetime as dt
from collections import ChainMap
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from payfeed.plans.increment import Feed, batches_of
from payfeed.session import materialize, staging

Shape = Callable[[DataFrame, int], dict[str, DataFrame]]


def arriving(
    feed: Feed,
    tables: Mapping[str, DataFrame],
    table: str,
    source: str,
    subscription: str,
    *,
    adapt: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    now: Callable[[], dt.datetime] = dt.datetime.now,
    **options,
) -> Shape:
    """Batches, records and rejects of arrived rows of ``table``, the other tables as they are.

    For feeds whose rows come from one table of changes (attendance, overtime, salary,
    variable pay of India). Whatever arrives has changed, so no mark is needed.
    """

    def shape(rows: DataFrame, epoch: int) -> dict[str, DataFrame]:
        as_of = now()
        bound = ChainMap({table: adapt(rows)}, tables)
        built = feed.build(bound, mark=dt.datetime.min, as_of=as_of, **{**feed.options, **options})
        staged = materialize(built.withColumn("source_db", F.lit(source)), feed.name)
        batches, records = batches_of(staged, feed, {source: subscription}, as_of)
        out = {"batches": batches, "records": records}
        if feed.rejects is not None:
            out["rejects"] = feed.rejects(bound, dt.datetime.min, as_of).withColumn("source_db", F.lit(source))
        return out

    return shape


def stream_increment(
    spark: SparkSession,
    shape: Shape,
    in_path: str,
    schema: StructType,
    outbox: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Process all files that have arrived, then stop; the next call goes on from there.

    ``shape(rows, epoch)`` turns the arrived rows into tables by name (``arriving``
    makes one for a feed), each written under its name in ``outbox``. Every micro-batch overwrites its
    own folders, so one that is repeated after a failure replaces what it left behind.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    run_stream(reader.load(in_path), shape, outbox, checkpoint)


def run_stream(rows: DataFrame, shape: Shape, outbox: str, checkpoint: str) -> None:
    """Write the tables that ``shape`` makes of each micro-batch of ``rows``; stop when all that has arrived is done."""

    def deliver(arrived: DataFrame, epoch: int) -> None:
        with staging(arrived.sparkSession):
            for name, table in shape(arrived, epoch).items():
                table.write.mode("overwrite").parquet(f"{outbox}/{name}/epoch={epoch}")

    query = (
        rows.writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
