"""Tables bucketed by their key, so that joins on the key need no exchange.

For tables with one row a key (the ids of a snapshot, the delete log, a
latest-per-key model): a bucket then grows with the number of keys.  Of a table
with many rows a key, such as the raw versions, one task would read all rows of
a hot key; those stay with joins that AQE can split.

A table is a version folder whose name ends in its number of buckets; a reader
declares it in the session's catalog, resolves it and takes the declaration
back, so any session can read what another one wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gazette.sources import versioned

#: Rows that a bucket should hold; a table is dealt anew beyond GROWTH times as many.
ROWS_PER_BUCKET, GROWTH = 2_000_000, 4
LEAST_BUCKETS, MOST_BUCKETS = 8, 65_536


def buckets_for(rows: int, former: int | None = None) -> int:
    """A power of two for so many rows; the former number while its buckets are
    not too large, as only tables with the same number join without an exchange."""
    if former and (rows <= former * ROWS_PER_BUCKET * GROWTH or former >= MOST_BUCKETS):
        return former
    n = LEAST_BUCKETS
    while n * ROWS_PER_BUCKET < rows and n < MOST_BUCKETS:
        n *= 2
    return n


def buckets_of(path: str) -> int:
    return int(path.rsplit("-b", 1)[1])


def write_bucketed(df: DataFrame, root: str, key: str, buckets: int, dealt: bool = False) -> str:
    """Write a new version below ``root`` and return its path; it counts once
    ``versioned.point`` names it.  ``dealt``: each partition of df holds keys of
    one bucket (joins and unions of tables with this number of buckets), so
    nothing is exchanged; else one task writes each bucket."""
    spark = df.sparkSession
    path, name = f"{versioned.new_version(root)}-b{buckets}", f"bucketed_{uuid.uuid4().hex}"
    rows = df if dealt else df.repartition(buckets, key)
    try:
        rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).mode("errorifexists").saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")    # the declaration: files of a given path stay
    return path


def open_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """The rows of a version, known to Spark as bucketed by ``key``."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    try:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets_of(path)} BUCKETS LOCATION '{path}'")
        df = spark.table(name)
        df.schema    # resolved while the declaration stands
        return df
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_bucketed(spark: SparkSession, root: str, schema: T.StructType, key: str) -> DataFrame | None:
    """The published version, or None."""
    path = versioned.current_path(spark, root)
    return None if path is None else open_bucketed(spark, path, schema, key)
