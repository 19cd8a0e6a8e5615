"""High-water marks: how far each source has been delivered.

Marks are append-only rows (ID, last_timestamp, source_db); the newest row counts.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MARKS = "ID int, last_timestamp timestamp_ntz, source_db string"
_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def latest_mark(marks: DataFrame, per_source: bool = True) -> DataFrame:
    """Newest mark per source, or the newest mark of all."""
    newest = F.max_by("last_timestamp", "ID").alias("last_timestamp")
    return marks.groupBy("source_db").agg(newest) if per_source else marks.agg(newest)


def read_mark(marks: DataFrame, source: str | None = None) -> dt.datetime | None:
    """The newest mark as a value; of one source, or of all."""
    rows = marks if source is None else marks.where(F.col("source_db") == source)
    return latest_mark(rows, per_source=False).first()["last_timestamp"]


def next_mark(
    outcomes: DataFrame,
    marks: DataFrame,
    policy: str = "safe",
    bump: bool = False,
) -> DataFrame:
    """Mark of every source after a delivery.

    ``outcomes`` has source_db, batch_no, status, min_timestamp and max_timestamp.

    * ``last_success``: newest time of the last batch that was delivered, even where an
      earlier batch failed or the mark moves back.
    * ``safe``: newest delivered time, but before the oldest row of any batch that was
      not delivered, and never before the old mark.

    ``bump`` adds one microsecond to a delivered time.
    """
    old = latest_mark(marks).select("source_db", F.col("last_timestamp").alias("_old"))
    ok = F.col("status") == "SUCCESS"
    step = F.expr("INTERVAL 1 MICROSECOND")
    reached = F.col("max_timestamp") + step if bump else F.col("max_timestamp")
    open_batch = F.coalesce(~ok, F.lit(True))
    summary = outcomes.groupBy("source_db").agg(
        F.max_by(F.when(ok, reached), F.when(ok, F.col("batch_no"))).alias("_last"),
        F.max(F.when(ok, reached)).alias("_newest"),
        F.min(F.when(open_batch, F.col("min_timestamp"))).alias("_open"),
        F.max(open_batch & F.col("min_timestamp").isNull()).alias("_undated"),
    )
    joined = summary.join(old, "source_db", "left")
    if policy == "last_success":
        mark = F.coalesce(F.col("_last"), F.col("_old"))
    elif policy == "safe":
        # least and greatest skip nulls: no open batch, or no old mark yet.
        reachable = F.least(F.col("_newest"), F.col("_open") - step)
        mark = F.when(
            F.col("_newest").isNull() | F.col("_undated"), F.col("_old")
        ).otherwise(F.greatest(F.col("_old"), reachable))
    else:
        raise ValueError(f"unknown mark policy {policy!r}")
    return joined.select("source_db", mark.alias("last_timestamp"))


def commit_mark(marks: DataFrame, new: DataFrame) -> DataFrame:
    """Rows to append so that ``new`` becomes the newest mark of its sources."""
    top = marks.agg(F.coalesce(F.max("ID"), F.lit(0)).alias("m")).first()["m"]
    place = F.row_number().over(Window.orderBy("source_db"))  # one row a source
    return new.select((F.lit(top) + place).cast("int").alias("ID"), "last_timestamp", "source_db")


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _newest_commit(spark: SparkSession, path: str) -> int:
    """Number of the last commit in a folder of marks; 0 where there is none."""
    at, files = _file_system(spark, path)
    if not files.exists(at):
        return 0
    names = [status.getPath().getName() for status in files.listStatus(at)]
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)


def _commit_file(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{number:020d}.json"


def _create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file with all its content at once, unless there is one of that name; whether it was written.

    The content goes to a file of its own first, which takes the name by a step that fails if the name is taken: a link in
    a local folder, a rename without overwriting elsewhere. A store must make that step atomic, as HDFS does.
    """
    at, files = _file_system(spark, path)
    hidden = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
    if files.getUri().getScheme() == "file":
        own, name = (spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath() for p in (hidden, path))
        os.makedirs(os.path.dirname(name), exist_ok=True)
        with open(own, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(own, name)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(hidden)
    out = files.create(temporary, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
        context.rename(temporary, at, none)
        return True
    except Py4JJavaError as problem:
        files.delete(temporary, False)
        if "FileAlreadyExists" in problem.java_exception.getClass().getName():
            return False
        raise


def stored_marks(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The marks in a folder, as of its last commit or an earlier one: the newest row of every source."""
    number = _newest_commit(spark, path) if number is None else number
    if not number:
        return spark.createDataFrame([], MARKS)
    return spark.read.schema(MARKS).option("timestampNTZFormat", _TIME).json(_commit_file(path, number))


def commit_marks(new: DataFrame, path: str, forward: bool = True, attempts: int = 100) -> list[int]:
    """Make ``new`` (source_db, last_timestamp) the newest marks in the folder ``path``; returns the new IDs.

    Any number of programs may do so at once. A commit is a numbered file with the marks of all sources (one row
    each). It is computed from the file before it and created only if no other program has created that number;
    then it is computed again from what that one has written. So no ID is given twice and no mark of another program
    is lost. Repeating a commit adds nothing. ``forward`` leaves out marks that would move a source back, such as those of a
    run that was overtaken.
    """
    spark = new.sparkSession
    wanted = [(r["source_db"], r["last_timestamp"]) for r in new.select("source_db", "last_timestamp").collect()]
    for _ in range(attempts):
        number = _newest_commit(spark, path)
        known = {r["source_db"]: (r["ID"], r["last_timestamp"]) for r in stored_marks(spark, path, number).collect()}
        old = lambda source: known.get(source, (0, None))[1]  # noqa: E731, B023
        moved = [(s, t) for s, t in wanted if (s not in known or t != old(s)) and not (forward and old(s) is not None and (t is None or t < old(s)))]
        if not moved:
            return []
        top = max((i for i, _ in known.values()), default=0)
        added = {s: (top + k, t) for k, (s, t) in enumerate(sorted(moved, key=lambda m: (m[0] is not None, m[0] or "")), 1)}
        rows = [{"ID": i, "last_timestamp": t and t.isoformat(timespec="microseconds"), "source_db": s} for s, (i, t) in {**known, **added}.items()]
        if _create_new(spark, _commit_file(path, number + 1), "".join(json.dumps(r) + "\n" for r in rows)):
            return sorted(i for i, _ in added.values())
    raise RuntimeError(f"marks in {path} were changed by others {attempts} times in a row")
