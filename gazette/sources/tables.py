"""Parquet scans and sinks, lake layout, table set-up."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Codec of stored rows with text: its window is wide enough to meet a text's copies that stand next to it.
CODEC = "zstd"


@functools.lru_cache(maxsize=256)
def _scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver test table ``name`` under ``sf_dir`` (one parquet each).

    The input tables are read-only, so one scan DataFrame per path and
    session is reused (file listing and footer reads happen once)."""
    return _scan(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


@functools.lru_cache(maxsize=256)
def _count(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).count()


def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Row count of a read-only input table (one number, computed once)."""
    return _count(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan with an explicit schema, so no footer decides the table's types.
    Files must declare these types; ``read_loose`` takes others."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_loose(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan files from other writers, conformed to ``schema``.

    A writer that saw only NULLs in a column may declare another type for it
    (Arrow's null type reads as INT32), which the explicit schema rejects.
    Files are grouped by what their footers declare; each group is read with
    its own types, then cast.  Where a declared integer can't become the
    wanted type, the column must hold only NULLs.  Meant for one landed run:
    the driver reads one footer for each of its files."""
    layouts: dict[str, list[str]] = {}
    for file in spark.read.schema(schema).parquet(path).inputFiles():
        layouts.setdefault(spark.read.parquet(file).schema.json(), []).append(file)
    out = None
    for files in layouts.values():
        part = spark.read.parquet(*files)
        types = dict(part.dtypes)
        for f in schema.fields:
            if types.get(f.name) in ("int", "void") and not isinstance(f.dataType, T.NumericType):
                only_null = F.when(F.col(f.name).isNotNull(), F.raise_error(F.lit(f"{f.name} holds integers")).cast(f.dataType))
                part = part.withColumn(f.name, only_null)
        part = conform(part, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def read_jdbc_window(spark: SparkSession, url: str, table: str, columns: list[str],
                     since: dt.datetime, until: dt.datetime, properties: dict[str, str],
                     col: str = "updated_at", partitions: int = 1) -> DataFrame:
    """OLTP extract of one window with projection and predicate pushed into
    the database query; ``partitions`` > 1 splits the window into
    ``partitions`` parallel range reads on ``col``."""
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    reader = reader.option("dbtable", table)
    if partitions > 1:
        reader = (reader.option("partitionColumn", col).option("lowerBound", since.isoformat(sep=" "))
                  .option("upperBound", until.isoformat(sep=" ")).option("numPartitions", partitions))
    df = reader.load().select(*columns)
    c = F.col(col)
    return df.filter((c >= F.lit(since).cast("timestamp_ntz")) & (c < F.lit(until).cast("timestamp_ntz")))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to ``schema`` (missing columns become typed NULLs)."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode).option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def with_run_partition(df: DataFrame, run_ts: dt.datetime | Column) -> DataFrame:
    """Add the lake layout columns: ``run_ts``, its day ``dt`` and ``run``
    (time of day, HHmmss).  The run replaces the per-run object name, so
    one run's files can be found, replayed or replaced by value."""
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp_ntz")
    return df.withColumns({"run_ts": ts, "dt": F.date_format(ts, "yyyy-MM-dd"),
                           "run": F.date_format(ts, "HHmmss")})


def write_landing(df: DataFrame, root: str, run_ts: dt.datetime | Column, within: Sequence[str] = ()) -> None:
    """Land one or more runs under ``root/dt=YYYY-MM-DD/run=HHmmss``, a task's
    rows of a run in the order of ``within``.

    Overwrite with dynamic partition overwrite replaces exactly the runs
    being written: a retried run replaces its own files instead of
    duplicating them, and other runs are untouched.
    """
    rows = with_run_partition(df, run_ts)
    if within:
        rows = rows.sortWithinPartitions("dt", "run", *within)
    (rows.write.mode("overwrite").option("compression", CODEC)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt", "run").parquet(root))


def read_lake(spark: SparkSession, root: str, schema: T.StructType,
              days: list[str] | None = None) -> DataFrame:
    """Scan a lake zone; ``days`` prunes ``dt`` partitions at planning time."""
    full = T.StructType(schema.fields + [T.StructField("run_ts", T.TimestampNTZType()),
                                         T.StructField("dt", T.StringType()),
                                         T.StructField("run", T.StringType())])
    df = spark.read.schema(full).option("basePath", root).parquet(root)
    if days:
        df = df.filter(F.col("dt").isin(days))
    return df


def runs_of(spark: SparkSession, root: str) -> DataFrame:
    """(dt, run) of every run in a lake zone, from partition values; no rows
    where nothing was written yet."""
    try:
        df = spark.read.option("basePath", root).schema("dt string, run string").parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "dt string, run string")
    return df.select("dt", "run").distinct()


def partition_values(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Values of the partition folders right below a path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))


def recent_runs(spark: SparkSession, root: str, since_day: str = "") -> list[str]:
    """``dt/run`` of the runs in a lake zone from ``since_day`` on, oldest first.
    Lists the zone's days and the folders of those days alone; no file is opened."""
    days = [d for d in partition_values(spark, root, "dt=") if d >= since_day]
    return [f"{day}/{run}" for day in days for run in partition_values(spark, f"{root}/dt={day}", "run=")]


def read_runs(spark: SparkSession, root: str, schema: T.StructType, runs: list[str]) -> DataFrame:
    """Rows of the named runs, read by path: other runs are not even listed."""
    paths = [f"{root}/dt={day}/run={run}" for day, _, run in (r.partition("/") for r in runs)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def list_runs(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """One row per landed object: day, run timestamp, file and row count.

    Built from partition values and the hidden ``_metadata`` column, so it
    is a distributed aggregate, not a driver-side directory walk.
    """
    df = read_lake(spark, root, schema)
    return (df.select("dt", "run_ts", F.col("_metadata.file_path").alias("file_path"))
            .groupBy("dt", "run_ts", "file_path").agg(F.count(F.lit(1)).alias("rows")))


def write_json(df: DataFrame, path: str) -> None:
    """JSON sink (the scorecard hand-off format)."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def ensure_tables(spark: SparkSession, root: str, tables: dict[str, T.StructType],
                  database: str = "gazette") -> None:
    """Idempotent set-up: create the database and each table when missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in tables.items():
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) "
                  f"USING parquet LOCATION '{root.rstrip('/')}/{name}'")


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """Staging models are views; intermediate and mart models are tables.

    A table is written to ``path`` and read back, which also cuts the
    lineage of everything downstream.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if path is None:
        raise ValueError("a table needs a path")
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out
