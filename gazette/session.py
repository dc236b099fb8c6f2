"""SparkSession construction and session-level settings."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: zone-less wall-clock time, ANSI errors, and
# AQE so shuffle partition counts, join strategies and skewed partitions are
# re-planned from runtime sizes instead of fixed guesses.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "gazette",
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the base settings applied.

    ``master`` is only set when given, so spark-submit on a cluster keeps
    its own master and resource settings.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in BASE_CONF.items():
        if not key.startswith("spark.ui."):
            spark.conf.set(key, value)
    return spark


def cluster_conf(total_cores: int, advisory_mb: int = 256) -> dict[str, str]:
    """Settings for a large cluster (e.g. 1000 executors over ~100 TB).

    Start with many shuffle partitions (about three per core, at least
    2000) and let AQE coalesce them to ``advisory_mb`` each, so the
    partition count follows the data instead of a fixed guess; split
    skewed partitions; keep scan splits large enough that the per-file
    overhead stays small; broadcast only what AQE measures below the
    threshold at runtime.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(2000, 3 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{advisory_mb * 2}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.files.openCostInBytes": "8m",
        "spark.sql.parquet.columnarReaderBatchSize": "4096",
        "spark.shuffle.service.enabled": "true",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
    }


#: Spark removes an execution's shuffle files at its end (4.1; other versions ignore it).
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written in here leaves no shuffle files behind: those of a
    finished write serve nothing, but stay until the driver collects its
    garbage.  (A DataFrame executed again makes its exchanges anew, so only
    writes belong in here.)"""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no context
        return None


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for lineage cuts and written intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system).  Only when it is unset in a local-mode session (tests,
    laptops) is ``fallback`` used and registered, so no job ever writes to
    a machine-local temp folder behind the cluster's back.
    """
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if fallback is None or sc is None or not sc.master.startswith("local"):
            # on a cluster a machine-local folder would lose data with its executor
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        root = fallback
        sc.setCheckpointDir(root)
    elif sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, fallback: str | None = None) -> str:
    """A path under the shared checkpoint folder, e.g. for a staged table."""
    return "/".join([checkpoint_root(spark, fallback), *[p.strip("/") for p in parts]])


def local_test_session(cores: int | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """Local-mode session used by tests and the bench."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return get_session(
        master=f"local[{cores}]",
        app="gazette-local",
        conf={
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": "16g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
            "spark.ui.showConsoleProgress": "false",
        },
    )
