"""Keyed tables that are replaced file by file.

A table's files lie in hash buckets of the key.  A manifest names the current
files, each with its bucket, rows, smallest and greatest key and a Bloom filter
of its keys, so a change of some keys reads and rewrites only the files that
may hold them; new keys are appended as files of their own.  All of it is
DataFrame work: the filters are built by an aggregate over the written files
and asked by a join on (file, block), the driver sees paths only.

A commit creates the next numbered record below ``_log``; creating a record that
exists fails, so of two jobs that read the same version one commits and the
other starts again on what the first left (``update``).  Files are never
overwritten: a job that dies before its record leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.sources.positions import bit_of
from gazette.sources.tables import CODEC

FILES = "path string, part string, bucket int, rows long, low string, high string, blocks int, index string"
INDEX = "path string, block int, bits binary"
#: Rows that a bucket should hold when a table is laid out anew.
ROWS_PER_BUCKET = 1_000_000
LEAST_BUCKETS, MOST_BUCKETS = 8, 200_000
#: Bits of one block of a Bloom filter (what bitmap_construct_agg fills), probes a key, keys a block.
BLOCK_BITS, PROBES, BLOCK_KEYS = 32768, 3, 4096


class Moved(RuntimeError):
    """Another job committed since this one read the table."""


def _fs(spark: SparkSession, path: str):
    """(file system, path) in Hadoop's terms."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place whole; False if one is there.  The last step
    is a rename that doesn't replace, which HDFS decides at once; a store
    without such a rename needs a lock of its own."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    draft = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = kinds.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf()).rename(draft, p, how)
    except Exception as error:  # noqa: BLE001 - the JVM's exception, told apart by what is there
        fs.delete(draft, False)
        if fs.exists(p):
            return False
        raise error
    return True


def _key_text(key: str) -> Column:
    """The key as text; a null key is a key like any other."""
    return F.coalesce(F.concat(F.lit(":"), F.col(key).cast("string")), F.lit("-"))


def _hash(text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), text)


def _probes(text: Column, blocks: Column) -> tuple[Column, Column]:
    """(block, bit positions) of a key in a file's filter of ``blocks`` blocks."""
    return F.pmod(_hash(text, 0), blocks).cast("int"), F.array(*[F.pmod(_hash(text, s), F.lit(BLOCK_BITS)) for s in range(1, PROBES + 1)])


@dataclass(frozen=True)
class Version:
    """What one committed record says: its number, the manifest and the notes."""
    number: int = 0
    manifest: str | None = None
    notes: dict = field(default_factory=dict)


@dataclass(frozen=True)
class KeyedTable:
    """Rows of ``schema`` by ``key``.  A table may have several parts that are replaced
    or appended to apart but commit together.  The number of buckets is a note
    of the version: ``replace`` chooses it by the rows."""
    root: str
    key: str
    schema: T.StructType
    rows_per_bucket: int = ROWS_PER_BUCKET

    def version(self, spark: SparkSession) -> Version:
        """The newest record: one listing of the log folder, one small read."""
        fs, p = _fs(spark, f"{self.root}/_log")
        if not fs.exists(p):
            return Version()
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        numbers = [int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith(".")]
        return self.at(spark, max(numbers)) if numbers else Version()

    def at(self, spark: SparkSession, number: int) -> Version:
        said = json.loads(spark.read.text(f"{self.root}/_log/{number:020d}.json").first()["value"])    # one line
        return Version(number, said["manifest"], said["notes"])

    def files(self, spark: SparkSession, at: Version | None = None) -> DataFrame:
        at = at or self.version(spark)
        return spark.createDataFrame([], FILES) if at.manifest is None else spark.read.schema(FILES).parquet(at.manifest)

    def read(self, spark: SparkSession, part: str | None = None, at: Version | None = None) -> DataFrame:
        """All rows (of one part); the files come from the manifest, not from a listing."""
        named = self.files(spark, at)
        return self.read_files(spark, _paths(named if part is None else named.filter(F.col("part") == part)))

    def read_files(self, spark: SparkSession, paths: Sequence[str], path_col: str | None = None) -> DataFrame:
        """Rows of these files; ``path_col`` names a column for each row's file."""
        rows = spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)
        return rows if path_col is None else rows.withColumn(path_col, F.col("_metadata.file_path") if paths else F.lit(None).cast("string"))

    def holding(self, keys: DataFrame, part: str, at: Version) -> list[str]:
        """Paths of the part's files that may hold one of ``keys`` (column ``key``).

        Keys meet files by bucket, key range and Bloom filter; a file without
        any of them is named with a small chance (about 2 in 100 a key in its
        bucket and range)."""
        spark = keys.sparkSession
        files = self.files(spark, at).filter(F.col("part") == part)
        asked = keys.select(_key_text(self.key).alias("text")).distinct().withColumn("bucket", self._bucket(F.col("text"), at))
        near = (asked.join(files, "bucket").filter((F.col("text") >= F.col("low")) & (F.col("text") <= F.col("high")))
                .select("text", "path", "index", *[c.alias(n) for c, n in zip(_probes(F.col("text"), F.col("blocks")), ("block", "probes"))]))
        folders = [r["index"] for r in near.select("index").distinct().collect()]      # one a commit that still has files here
        if not folders:
            return []
        index = spark.read.schema(INDEX).parquet(*folders)
        met = near.join(index, ["path", "block"])
        hit = F.lit(True)
        for k in range(PROBES):
            hit = hit & bit_of(F.col("bits"), F.col("probes")[k])
        return _paths(met.filter(hit))

    def _bucket(self, text: Column, at: Version) -> Column:
        return F.pmod(_hash(text, -1), F.lit(at.notes.get("buckets", LEAST_BUCKETS))).cast("int")

    def _write(self, rows: DataFrame, part: str, at: Version) -> DataFrame:
        """Write rows as new files and describe them (``FILES``)."""
        spark = rows.sparkSession
        path = f"{self.root}/files/{part}-{uuid.uuid4().hex}"
        text = _key_text(self.key)
        cut = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields], self._bucket(text, at).alias("_bucket"))
        # whole buckets to a task where they are small; Spark splits large ones
        cut.hint("rebalance", F.col("_bucket")).write.option("compression", CODEC).partitionBy("_bucket").parquet(path)
        back = (spark.read.schema(T.StructType([*self.schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(path)
                .select(F.col("_metadata.file_path").alias("path"), F.col("_bucket").alias("bucket"), text.alias("text")))
        sized = back.groupBy("path", "bucket").agg(F.count(F.lit(1)).alias("rows"), F.min("text").alias("low"), F.max("text").alias("high"))
        sized = sized.withColumn("blocks", F.ceil(F.col("rows") / BLOCK_KEYS).cast("int"))
        index = f"{self.root}/index/{uuid.uuid4().hex}"
        block, probes = _probes(F.col("text"), F.col("blocks"))
        (back.join(sized.select("path", "blocks"), "path").select("path", block.alias("block"), F.explode(probes).alias("at"))
         .groupBy("path", "block").agg(F.call_function("bitmap_construct_agg", F.col("at")).alias("bits"))
         .write.parquet(index))
        return sized.select("path", F.lit(part).alias("part"), "bucket", "rows", "low", "high", "blocks", F.lit(index).alias("index"))

    def commit(self, spark: SparkSession, base: Version, add: dict[str, DataFrame], remove: Sequence[str] = (), notes: dict | None = None) -> Version:
        """Publish ``base`` without ``remove`` and with new files for ``add``.
        Raises ``Moved`` if another record was committed after ``base``; where it
        is there already, before any file is written."""
        if self.version(spark).number != base.number:
            raise Moved(f"{self.root} has moved past version {base.number}")
        said = {"buckets": LEAST_BUCKETS, **base.notes, **(notes or {})}
        files = self.files(spark, base)
        if remove:
            gone = spark.createDataFrame([(p,) for p in remove], "path string")
            files = files.join(gone, "path", "left_anti")
        for part, rows in add.items():
            files = files.unionByName(self._write(rows, part, Version(base.number, base.manifest, said)))
        manifest = f"{self.root}/manifest/{base.number + 1:020d}-{uuid.uuid4().hex[:8]}"
        files.write.parquet(manifest)
        if not create_new(spark, f"{self.root}/_log/{base.number + 1:020d}.json", json.dumps({"manifest": manifest, "notes": said}) + "\n"):
            raise Moved(f"{self.root} has moved past version {base.number}")
        return Version(base.number + 1, manifest, said)

    def update(self, spark: SparkSession, change: Callable[[Version], tuple[dict[str, DataFrame], Sequence[str], dict] | None],
               tries: int = 10) -> Version:
        """Apply ``change`` (rows to add by part, paths to remove, notes) to the
        newest version, again from its start if another job commits meanwhile."""
        for _ in range(tries):
            base = self.version(spark)
            made = change(base)
            if made is None:
                return base
            try:
                return self.commit(spark, base, *made)
            except Moved:
                continue
        raise Moved(f"{self.root}: {tries} commits of other jobs came first")


    def replace(self, spark: SparkSession, rows: DataFrame, part: str = "rows") -> Version:
        """All rows of the table anew (they may be read from it), in buckets for
        their number; appended small files end up in one file a bucket."""
        n = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-rows.count() // self.rows_per_bucket)))
        return self.update(spark, lambda base: ({part: rows}, _paths(self.files(spark, base)), {"buckets": n}))


def _paths(files: DataFrame) -> list[str]:
    return sorted(r["path"] for r in files.select("path").distinct().collect())
