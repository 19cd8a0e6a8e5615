"""Binding HR tables, joining several sources into one feed, routing by source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The tables the feeds read.
HR_TABLES = (
    "employee_details",
    "employee_fin_details",
    "attribute_type_master",
    "attribute_unit_master",
    "employee_attribute_details",
    "type_configuration",
    "unit_type_configuration",
    "pay_group_master",
    "payhead_master",
    "pay_group_payhead_details",
    "payhead_properties",
    "salary_master",
    "emp_variable",
    "rostering",
    "ot_parameter_master",
)


def bind_tables(
    spark: SparkSession,
    root: str | None = None,
    *,
    catalog: str | None = None,
    jdbc: dict[str, str] | None = None,
    jdbc_tables: dict[str, dict[str, str]] | None = None,
    names: dict[str, str] | None = None,
    tables: tuple[str, ...] = HR_TABLES,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """HR tables of one source: files under ``root``, a catalog schema, or a JDBC database.

    ``names`` maps a table to its name in the source. A JDBC source is given by its
    reader options (url, driver and so on), and ``jdbc_tables`` adds or replaces options of single
    tables, such as the column and bounds by which each is read in parallel.
    """
    if sum(x is not None for x in (root, catalog, jdbc)) != 1:
        raise ValueError("give exactly one of root, catalog and jdbc")
    names = names or {}

    def load(table: str) -> DataFrame:
        name = names.get(table, table)
        if root is not None:
            return spark.read.format(fmt).load(f"{root.rstrip('/')}/{name}")
        if catalog is not None:
            return spark.table(f"{catalog}.{name}")
        own = (jdbc_tables or {}).get(table, {})
        return spark.read.format("jdbc").options(**{**jdbc, "dbtable": name, **own}).load()

    return {table: load(table) for table in tables}


def fan_in(feeds: dict[str, DataFrame], column: str = "source_db") -> DataFrame:
    """Rows of all sources together, each stamped with its source."""
    if not feeds:
        raise ValueError("no sources given")
    stamped = [df.withColumn(column, F.lit(name)) for name, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stamped)


def route(envelopes: DataFrame, sources: DataFrame, by: str = "subscription_name") -> DataFrame:
    """Envelopes with the settings of their source; ``route_error`` where there are none.

    ``sources`` has name, subscription_name and country. Attendance and overtime are
    found by source name, the others by subscription. Of several entries for one key
    the first in order counts.
    """
    key = "name" if by == "source_db" else by
    rest = [c for c in sources.columns if c != key]
    known = (
        sources.groupBy(F.col(key).alias("_route"))
        .agg(F.min(F.struct(*rest)).alias("_s"))
        .select("_route", *[F.col(f"_s.{c}").alias(f"source_{c}") for c in rest])
        .withColumn("_known", F.lit(True))
    )
    joined = envelopes.join(known, F.col(by) == F.col("_route"), "left")
    missing = F.concat(F.lit("no source configured for "), F.coalesce(F.col(by), F.lit("null")))
    return joined.withColumn("route_error", F.when(F.col("_known").isNull(), missing)).drop("_route", "_known")
