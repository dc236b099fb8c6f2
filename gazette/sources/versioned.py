"""Versioned keyed tables on plain Parquet.

A merge result is written to a fresh version directory; then a new
pointer record (publish time, version path) is added under ``_pointers``.
Nothing is ever overwritten: a job that dies before its pointer commits
leaves the previous version current, and readers see either the old or the
new version, never a half-written one.  The pointer history also allows
reading an earlier state.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER_SCHEMA = "published_at timestamp_ntz, path string"


def _pointers(root: str) -> str:
    return f"{root.rstrip('/')}/_pointers"


def publish(df: DataFrame, root: str) -> str:
    """Write ``df`` as a new version under ``root`` and make it current."""
    stamp = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    path = new_version(root, stamp)
    df.write.mode("errorifexists").parquet(path)
    point(df.sparkSession, root, path, stamp)
    return path


def new_version(root: str, stamp: dt.datetime | None = None) -> str:
    """A version path of its own for each run."""
    stamp = stamp or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    return f"{root.rstrip('/')}/v-{stamp:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def point(spark: SparkSession, root: str, path: str, stamp: dt.datetime | None = None) -> None:
    """Make ``path`` current: one appended record, so readers see the old or
    the new version of everything below it."""
    stamp = stamp or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    (spark.createDataFrame([(stamp, path)], POINTER_SCHEMA).coalesce(1)
     .write.mode("append").json(_pointers(root)))


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def current_path(spark: SparkSession, root: str, as_of: dt.datetime | None = None) -> str | None:
    """Path of the newest committed version (or the newest at ``as_of``)."""
    try:
        ptr = spark.read.schema(POINTER_SCHEMA).json(_pointers(root))
    except AnalysisException as error:
        if not is_missing(error):    # unreadable is not the same as never published
            raise
        return None
    if as_of is not None:
        ptr = ptr.filter(F.col("published_at") <= F.lit(as_of).cast("timestamp_ntz"))
    row = ptr.agg(F.max_by("path", F.struct("published_at", "path")).alias("p")).first()
    return row["p"] if row else None


def read_current(spark: SparkSession, root: str, schema=None, as_of: dt.datetime | None = None) -> DataFrame | None:
    path = current_path(spark, root, as_of)
    if path is None:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
