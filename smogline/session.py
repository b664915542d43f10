"""Session helpers shared by jobs, checks and the benchmark."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "smogline", **conf) -> SparkSession:
    """A session with UTC time and adaptive execution; on a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back on a folder of its own: on a cluster a
    machine-local path would be invisible to the other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_OPEN = threading.local()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder where it lies, if it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what ``cut`` writes inside as soon as the block is left.

    For runs whose result is stored elsewhere by then; a frame that still reads from a
    table cut inside must not be used after it.
    """
    scopes = _OPEN.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            remove(spark, path)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    What follows starts from these files: nothing before is computed again, a lost executor
    costs a re-read only, and readers still take just the columns they need. Inside a
    ``scratch_scope`` the files go when the scope ends.
    """
    path = scratch_path(df.sparkSession, "cut")
    for scope in _OPEN.__dict__.get("scopes", [])[-1:]:
        scope.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
