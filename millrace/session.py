"""Session settings, the shared folder, and staging of narrow intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# What the operators count on. All are runtime settings, so they can be applied to a running session.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Where the innermost `staging` block notes what was staged in it.
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def build_session(master: str | None = None, app: str = "millrace", **conf: str) -> SparkSession:
    """A session with SETTINGS; on a cluster leave `master` and the sizing to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or the context's checkpoint folder.

    Only a local master may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder once and read it back.

    Used for narrow results (keys, page stops) that later plans join to wide rows. Reading a file
    gives Spark the real size, so it broadcasts the staged side only below
    spark.sql.autoBroadcastJoinThreshold and otherwise sorts and merges, with AQE splitting hot
    partitions. The files survive lost executors. They are deleted at the end of the `staging` block
    they are written in; outside of one they lie under one folder per application, which
    `clear_stage` deletes.
    """
    spark = df.sparkSession
    path = staged_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_alone(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """`stage(build())`, after which nothing else is left of what `build` staged on its way."""
    path = staged_path(spark)
    with staging(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete at the end, also on failure, what is staged inside by this thread.

    For jobs that write or collect their result inside: frames on what was staged cannot be read later.
    """
    outer = _staged.set([])
    try:
        yield
    finally:
        paths = _staged.get()
        _staged.reset(outer)
        for path in paths:
            _delete(spark, path)


def clear_stage(spark: SparkSession) -> None:
    """Delete what this application has staged. Frames that were built on it cannot be read again."""
    _delete(spark, _stage_dir(spark))


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def staged_path(spark: SparkSession) -> str:
    """A new path in the shared folder, which goes when what is staged goes."""
    path = f"{_stage_dir(spark)}/{uuid.uuid4().hex}"
    if (noted := _staged.get()) is not None:
        noted.append(path)
    return path


def _stage_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/millrace-stage/{spark.sparkContext.applicationId}"


@contextmanager
def scratch_schema(spark: SparkSession) -> Iterator[str]:
    """A schema of its own in the shared folder, dropped with its tables at the end."""
    name = f"millrace_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{shared_dir(spark)}/millrace-schemas/{name}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
