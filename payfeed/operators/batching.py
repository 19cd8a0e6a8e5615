"""Cutting a feed into ordered batches, and folding batches into envelopes.

A global order is needed for batch numbers, but never in one task: rows are
range-partitioned and sorted, each row takes its position inside its partition, and
the partitions' starting numbers come from one count per partition.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payfeed.functions.fields import iso_text
from payfeed.session import materialize

# Rows per attendance batch, employees per overtime and other batches.
ATTENDANCE_ROWS = 250
OVERTIME_EMPLOYEES = 100
OTHER_EMPLOYEES = 1

_PLACE = "_place"
_PARTITION_BITS = 33
# Range partitions this much above the average hold copies that the order cannot split.
_LOPSIDED = 4
_LOPSIDED_ROWS = 100_000


def _place(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows sorted across partitions, each with partition number and position.

    Written out, because a second run of a range exchange may draw other boundaries.
    """
    quoted = [F.col(f"`{k}`") for k in keys]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *quoted).sortWithinPartitions(*quoted)
    return materialize(ordered.withColumn(_PLACE, F.monotonically_increasing_id()), "order")


def _partition_sizes(placed: DataFrame) -> dict[int, int]:
    """Rows per range partition: at most one entry per shuffle partition."""
    part = F.shiftright(F.col(_PLACE), _PARTITION_BITS).alias("part")
    return {row["part"]: row["n"] for row in placed.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}


def _is_lopsided(sizes: dict[int, int]) -> bool:
    if not sizes:
        return False
    mean = sum(sizes.values()) / max(len(sizes), 1)
    return max(sizes.values()) > max(_LOPSIDED * mean, _LOPSIDED_ROWS)


def number_rows(df: DataFrame, order: list[str], name: str = "row_index") -> DataFrame:
    """Number all rows from 0 in the given order (nulls first).

    Ties are broken by a hash of the remaining columns, so these are not sorted. Rows that
    agree on everything are interchangeable; where there are so many that a partition
    overflows, the placed rows are ordered once more with their position as last key,
    which splits them.
    """
    rest = sorted(c for c in df.columns if c not in order)
    keys = [*order, "_tie"] if rest else list(order)
    tied = df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in rest])) if rest else df
    placed = _place(tied, keys)
    sizes = _partition_sizes(placed)
    if _is_lopsided(sizes):
        placed = _place(placed.withColumnRenamed(_PLACE, "_copy"), [*keys, "_copy"]).drop("_copy")
        sizes = _partition_sizes(placed)
    parts = sorted(sizes)
    starts = df.sparkSession.createDataFrame(
        list(zip(parts, accumulate([0, *(sizes[p] for p in parts)]))), "_part long, _first long"
    )
    position = F.col(_PLACE).bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    numbered = placed.withColumn("_part", F.shiftright(F.col(_PLACE), _PARTITION_BITS)).join(F.broadcast(starts), "_part")
    return numbered.withColumn(name, F.col("_first") + position).drop(_PLACE, "_part", "_first", "_tie")


def _join_back(df: DataFrame, extra: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null."""
    renamed = extra.select(
        *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], *[c for c in extra.columns if c not in by]
    )
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by_{i}")) for i, c in enumerate(by)])
    return df.join(renamed, on, how).drop(*[f"_by_{i}" for i in range(len(by))])


def _from_start(numbered: DataFrame, within: list[str]) -> DataFrame:
    """Turn global row numbers into numbers inside each source."""
    if not within:
        return numbered
    starts = numbered.groupBy(*within).agg(F.min("row_index").alias("_start"))
    return (
        _join_back(numbered, starts, within)
        .withColumn("row_index", F.col("row_index") - F.col("_start"))
        .drop("_start")
    )


def batch_rows(
    df: DataFrame, n: int, order: list[str], within: tuple[str, ...] = (), staged: bool = False
) -> DataFrame:
    """Batches of ``n`` consecutive rows, numbered inside each source.

    A range exchange reads its rows twice, so they are written out first unless they are
    ``staged`` already.
    """
    if not staged:
        df = materialize(df, "rows")
    numbered = _from_start(number_rows(df, [*within, *order]), list(within))
    return numbered.withColumn("batch_no", F.floor(F.col("row_index") / n))


def batch_keys(
    df: DataFrame, key: str, n: int, within: tuple[str, ...] = (), staged: bool = False
) -> DataFrame:
    """Batches of ``n`` consecutive keys; all rows of a key are in one batch.

    The rows are read twice, for their keys and to be numbered, so they are written out
    first unless they are ``staged`` already. The numbers are written too: a join has no known
    size, and the planner would broadcast the rows to it and leave the work to a task or two.
    """
    by = [*within, key]
    if not staged:
        df = materialize(df, "rows")
    keys = _from_start(number_rows(df.select(*by).distinct(), by), list(within))
    numbers = keys.select(*by, F.floor(F.col("row_index") / n).alias("batch_no"))
    return _join_back(df, materialize(numbers, "numbers"), by)


def envelopes(batched: DataFrame, record_cols: list[str], by: list[str], order: list[str], time_col: str | None = None) -> DataFrame:
    """One row per batch with its records in order, their number and times.

    For batches that fit a message, as those of a fixed number of rows do; batches of
    whole employees have no bound and travel as rows, see ``manifest``. ``sort_array`` compares
    structs by an ordering made once; ``array_sort`` makes one anew for every comparison.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in record_cols])
    places = [F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)]
    ordered = F.sort_array(F.collect_list(F.struct(*places, record.alias("r"))))
    moment = F.col(time_col) if time_col else F.lit(None).cast("timestamp_ntz")
    return batched.groupBy(*by).agg(
        F.transform(ordered, lambda x: x["r"]).alias("records"),
        F.count(F.lit(1)).alias("batch_size"),
        F.min(moment).alias("min_timestamp"),
        F.max(moment).alias("max_timestamp"),
    )


def manifest(records: DataFrame, by: list[str], content: str, time_col: str, error_col: str) -> DataFrame:
    """One row per batch of any size: number of records, times, first error, and a digest.

    Only sums, so a batch that holds most rows is counted where they lie. ``digest``
    is the same for the same records in whatever order they are met. The least of several
    texts can only be found in sorted rows, so errors are counted as keys first: what is
    sorted is a row per batch and error, never the records.
    """
    marks = [F.xxhash64(content, F.lit(seed)).cast("decimal(38,0)").alias(f"_mark{seed}") for seed in (1, 2)]
    hashed = records.select(*by, F.col(time_col).alias("_time"), F.col(error_col).alias("_error"), *marks)
    counted = hashed.groupBy(*by, "_error").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_time").alias("_first"),
        F.max("_time").alias("_last"),
        *[F.sum(f"_mark{seed}").alias(f"_mark{seed}") for seed in (1, 2)],
    )
    return counted.groupBy(*by).agg(
        F.sum("_n").alias("batch_size"),
        F.min("_first").alias("min_timestamp"),
        F.max("_last").alias("max_timestamp"),
        F.min("_error").alias("error"),
        F.concat_ws("-", *[F.sum(f"_mark{seed}").cast("string") for seed in (1, 2)]).alias("digest"),
    )


def iso_records(df: DataFrame, columns: list[str]) -> DataFrame:
    """Dates and times as ISO text and decimals as doubles, as they go into an envelope."""
    types = dict(df.dtypes)

    def shaped(name: str) -> Column:
        column, dtype = F.col(f"`{name}`"), types[name]
        if dtype == "date" or dtype.startswith("timestamp"):
            return iso_text(column, dtype).alias(name)
        if dtype.startswith("decimal"):
            return column.cast("double").alias(name)
        return column

    return df.select(*[c for c in df.columns if c not in columns], *[shaped(c) for c in columns])
