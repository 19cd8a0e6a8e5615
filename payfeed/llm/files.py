"""Files in storage that the driver and all executors share."""

from __future__ import annotations

import os
import re
import uuid

from pyarrow import fs


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``uri`` (plain paths and ``file:`` count as local) and the path in it."""
    local = re.match(r"^(?:file:)?(/.*)$", uri)
    if local:
        return fs.LocalFileSystem(), re.sub(r"^/+", "/", local[1])
    return fs.FileSystem.from_uri(uri)


def fresh_file(folder: str, stem: str, suffix: str) -> str:
    """A name in ``folder`` that no other attempt of the same task can take.

    Files are found through a manifest that Spark commits, so what a lost or repeated
    attempt has left behind is never read.
    """
    files, path = open_fs(folder)
    files.create_dir(path, recursive=True)
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


# Rows that go to a Python worker at once where the session has Spark's default: whole texts are long.
BATCH_ROWS = 1500


def reach_workers(spark) -> None:
    """Let Python workers import this package from where the driver has it, and send them small batches.

    Enough where all machines see the same installation; else pass the package with ``--py-files``.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
