"""Session settings, shared storage, and staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_STAGING: ContextVar[str | None] = ContextVar("staging", default=None)

# Runtime settings the feeds rely on; all may be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot employee even where that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "payfeed", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the feeds expect; keyword values override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``; in local mode, if it is unset, one in the warehouse.

    On a cluster it must be set, unless the warehouse is named in a shared store: otherwise that may be a folder of the driver's
    own machine. A path without a scheme is in the default file system, for Spark and for whatever else opens files below it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if "://" in warehouse and not warehouse.startswith("file:"):
            return f"{warehouse}/staged"
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    folder = (configured or f"{warehouse}/staged").rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return folder if files.getUri().getScheme() == "file" else files.makeQualified(path).toString()


def run_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, under the application or the current ``staging``."""
    folder = _STAGING.get() or f"{shared_dir(spark)}/payfeed/{spark.sparkContext.applicationId}"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """Stage tables in a folder of their own, removed at the end.

    For work that writes its result inside: staged tables must outlive what reads them.
    """
    folder = f"{shared_dir(spark)}/payfeed/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    token = _STAGING.set(folder)
    try:
        yield folder
    finally:
        _STAGING.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Spark deletes the shuffle files of a query when it ends, instead of when the driver has collected its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files; for results that are written, so that none of it is read again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage in a way that survives executor loss, and pins values that a
    re-run could assign differently (row positions after a range exchange).
    What was shuffled for it is deleted once it is written.
    """
    path = run_path(df.sparkSession, label)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_join(facts: DataFrame, side: DataFrame, on, how: str = "inner", label: str = "side") -> DataFrame:
    """Join facts to a side that is computed first and written out.

    The adaptive skew join splits a hot key only where both sides come straight from
    an exchange; a side that is still an aggregate or a join on the same key does not,
    and would leave all rows of a hot key to one task. A written side does, and its
    known size lets the planner broadcast it where it is small.
    """
    return facts.join(materialize(side, label), on, how)
