"""Scheduled jobs as Spark functions over storage paths.

* ``hourly_run``: watermark -> window extract -> landing -> advance the
  watermark -> every landed run of the last days not yet in raw: clean + scorecard -> raw
  table -> drift alerts.
* ``snapshot_run``: the deduplicated model into the stored Type 2 history.
* ``report_run``: a run's rows per category next to the totals.
* ``scrape_run``: feed payload pages -> flatten (first seen, take-while on
  the scraper watermark) -> upsert into the files of the source table that
  may hold the ids (``gazette.sources.keyed``) -> watermark.
* ``delete_articles`` / ``delete_sync``: hard deletes in the source become
  a delete log by snapshot diff; tombstones are applied when models build.
  ``delete_sync_bucketed`` / ``tombstones_bucketed``: the same over tables in
  buckets of the id, which join without an exchange.
* ``build_models`` + ``gazette.plans.publish.write_audit_publish``: marts.

Every write replaces exactly what the run produces (per-run partitions with
dynamic overwrite, or a new version plus pointer), so a retried run or a
re-executed task replaces its own output instead of duplicating it.  Only
one-row results (a watermark, an emptiness check) reach the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette import schemas as S
from gazette.operators.clean import clean
from gazette.operators.dedupe import latest_per_key
from gazette.operators.drift import drift_alerts
from gazette.operators.incremental import incremental_extract, read_watermark
from gazette.operators.merge import advance_watermark, apply_tombstones, delete_log_of, merge_upsert
from gazette.operators.scd2 import scd2_moves
from gazette.operators.scorecard import scorecard
from gazette.plans.models import Models, stamp_load
from gazette.plans.serving import scrape_report
from gazette.sources import bucketed as BK
from gazette.sources import payload as P
from gazette.sources import positions as PS
from gazette.sources import tables as TB
from gazette.sources import versioned
from gazette.sources.keyed import KeyedTable

RAW_SCHEMA = T.StructType(S.ARTICLES_RAW.fields + [T.StructField("content_length", T.LongType())])
IDS = T.StructType([T.StructField("id", T.LongType())])
UPDATE_COLUMNS = ["title", "content", "author_id", "author_name", "category", "updated_at", "deleted_at"]


@dataclass(frozen=True)
class Lake:
    """Storage layout under one root in the shared file system."""
    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def landing(self) -> str:
        return self._p("landing", "articles")

    @property
    def cleaned(self) -> str:
        return self._p("cleaned", "articles")

    @property
    def raw(self) -> str:
        return self._p("dwh", "articles_raw")

    @property
    def scorecards(self) -> str:
        return self._p("dwh", "dq_scorecard")

    @property
    def watermark(self) -> str:
        return self._p("dwh", "etl_watermark")

    @property
    def source(self) -> str:
        return self._p("source", "articles")

    @property
    def delete_log(self) -> str:
        return self._p("source", "article_deleted")

    @property
    def snapshots(self) -> str:
        return self._p("dwh", "snap_articles")

    @property
    def marts(self) -> str:
        return self._p("marts")


def _row_hash(cols: Sequence[str]) -> Column:
    """Deterministic tie-break over the article columns."""
    return F.xxhash64(*[F.col(c) for c in cols])


def survivor_order() -> list[Column]:
    """Latest update first (NULL first), then a content hash for ties."""
    return [F.col("updated_at").desc_nulls_first(), _row_hash(S.ARTICLE_COLUMNS).desc()]


def _state(spark: SparkSession, lake: Lake, pipeline: str) -> DataFrame:
    """State of one pipeline.  Every pipeline has a pointer of its own, so
    two jobs that run at once can't undo each other's watermark."""
    cur = versioned.read_current(spark, f"{lake.watermark}/{pipeline}", S.WATERMARK)
    return cur if cur is not None else spark.createDataFrame([], S.WATERMARK)


def _save_state(state: DataFrame, lake: Lake, pipeline: str) -> None:
    versioned.publish(state.filter(F.col("pipeline_name") == pipeline), f"{lake.watermark}/{pipeline}")


def _run_filter(df: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Rows of one run; literal partition values prune the scan to it."""
    return df.filter((F.col("dt") == run_ts.strftime("%Y-%m-%d")) & (F.col("run") == run_ts.strftime("%H%M%S")))


def run_clean(spark: SparkSession, landed: DataFrame, cleaned_root: str, run_ts: dt.datetime,
              allow: Sequence[str] = S.VALID_CATEGORIES,
              table_name: str = S.TABLE_NAME) -> tuple[DataFrame, DataFrame]:
    """Clean one run and score it.  Writes the cleaned copy under
    ``cleaned_root/dt=/run=`` and returns (cleaned rows read back, the
    one-row scorecard)."""
    rows = TB.conform(landed, S.ARTICLE)
    cleaned = clean(rows, allow=allow, keys=["id"], order=survivor_order())
    cleaned = cleaned.withColumn("content_length", F.length("content").cast("long"))
    TB.write_landing(cleaned, cleaned_root, run_ts)
    sc = scorecard(rows, allow=allow, tie=_row_hash(S.ARTICLE_COLUMNS), table_name=table_name,
                   run_at=F.lit(run_ts).cast("timestamp_ntz"))
    back = _run_filter(TB.read_lake(spark, cleaned_root, T.StructType(
        S.ARTICLE.fields + [T.StructField("is_hard_deleted", T.BooleanType()),
                            T.StructField("content_length", T.LongType())])), run_ts)
    return back, sc


@dataclass
class RunResult:
    landed: bool
    since: dt.datetime | None = None
    alerts: DataFrame | None = None
    loaded: tuple[dt.datetime, ...] = ()


#: Runs that landed longer ago than this are known to be loaded.
LOAD_HORIZON = dt.timedelta(days=7)


def pending_runs(spark: SparkSession, lake: Lake, since: dt.datetime | None = None) -> list[dt.datetime]:
    """Landed runs that the raw table lacks, oldest first.  With ``since`` only
    the days from then on are listed, whatever else the zones hold; folder
    names decide, no file is opened."""
    day = f"{since:%Y-%m-%d}" if since else ""
    loaded = set(TB.recent_runs(spark, lake.raw, day))
    return [dt.datetime.strptime(r, "%Y-%m-%d/%H%M%S") for r in TB.recent_runs(spark, lake.landing, day) if r not in loaded]


def load_run(spark: SparkSession, lake: Lake, run_ts: dt.datetime, allow: Sequence[str] = S.VALID_CATEGORIES) -> None:
    """Clean a landed run, score it and append it to the raw table.  The raw
    partition is written last: until it stands, the run counts as pending and
    every write here replaces its own earlier output."""
    landed = _run_filter(TB.read_lake(spark, lake.landing, S.ARTICLE), run_ts)
    cleaned, sc = run_clean(spark, landed, lake.cleaned, run_ts, allow)
    (TB.with_run_partition(sc, run_ts).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("dt", "run").json(lake.scorecards))
    TB.write_landing(TB.conform(stamp_load(cleaned, F.lit(run_ts)), RAW_SCHEMA), lake.raw, run_ts)


def hourly_run(spark: SparkSession, lake: Lake, source: DataFrame, extraction_ts: dt.datetime,
               allow: Sequence[str] = S.VALID_CATEGORIES, pipeline: str = "articles_etl_hourly",
               lookback: dt.timedelta | None = None) -> RunResult:
    """One ingestion run.

    An empty window lands nothing and leaves the watermark in place; the
    watermark moves only after the landing write.  A window is written down
    before it lands, under its end as the run's name.  If the job dies before
    the watermark moved, the next run lands that window again under the same
    name, which replaces what the dead one left, and goes on from its end; so no
    row loads twice.  Then every landed run of the last days that the raw table
    lacks is loaded, whatever the watermark says, so a run that died after any
    write is completed by the next one.  Run times are whole seconds (the
    lake's partition values hold no more).
    """
    extraction_ts = extraction_ts.replace(microsecond=0)
    planned = _state(spark, lake, f"{pipeline}-planned")
    state = _state(spark, lake, pipeline)
    left = read_watermark(planned, f"{pipeline}-planned")      # the end of the last window that began to land
    first, landed = None, False
    for until in ([left] if read_watermark(state, pipeline) < left < extraction_ts else []) + [extraction_ts]:
        rows, new_state, since = incremental_extract(source, state, pipeline, until, lookback)
        first = since if first is None else first
        rows = TB.conform(rows, S.ARTICLE)
        if rows.isEmpty() and until == extraction_ts:
            continue
        _save_state(spark.createDataFrame([(f"{pipeline}-planned", until, until)], S.WATERMARK), lake, f"{pipeline}-planned")
        TB.write_landing(rows, lake.landing, until)
        _save_state(new_state, lake, pipeline)
        state, landed = _state(spark, lake, pipeline), landed or until == extraction_ts
    loaded = pending_runs(spark, lake, first - LOAD_HORIZON)
    for run_ts in loaded:
        load_run(spark, lake, run_ts, allow)
    alerts = drift_alerts(read_scorecards(spark, lake)) if loaded else None
    return RunResult(landed=landed, since=first, alerts=alerts, loaded=tuple(loaded))


def read_scorecards(spark: SparkSession, lake: Lake) -> DataFrame:
    full = T.StructType(S.SCORECARD.fields + [T.StructField("dt", T.StringType()),
                                              T.StructField("run", T.StringType())])
    return spark.read.schema(full).json(lake.scorecards).drop("dt", "run")


def build_models(spark: SparkSession, lake: Lake, respect_time: bool = False) -> Models:
    """Models over the stored raw table, delete log and scorecards."""
    raw = TB.read_lake(spark, lake.raw, RAW_SCHEMA).drop("run_ts", "dt", "run")
    return Models(raw, read_delete_log(spark, lake), read_scorecards(spark, lake), respect_time=respect_time)


SNAPSHOT_CHECK = ("title", "category")
SNAPSHOT_COLUMNS = ("article_id", "title", "category", "author_id", "updated_at")


HISTORY = T.StructType([
    T.StructField("article_id", T.LongType()), T.StructField("title", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("author_id", T.LongType()), T.StructField("updated_at", S.TS), T.StructField("valid_from", S.TS),
    T.StructField("valid_to", S.TS), T.StructField("is_current", T.BooleanType())])


def history_table(lake: Lake) -> KeyedTable:
    """The stored Type 2 history: open rows lie in files that are replaced,
    closed rows in files that are only ever added."""
    return KeyedTable(lake.snapshots, "article_id", HISTORY)


def snapshot_run(spark: SparkSession, lake: Lake, deduped: DataFrame, at: dt.datetime) -> DataFrame:
    """One Type 2 snapshot into the stored history (strategy check on title
    and category).  Returns the stored history.

    ``deduped`` holds the latest version of each article, or only of those that
    changed since the last run: keys that a run doesn't bring stay open.  The
    run reads the open files that may hold its keys, replaces those that hold a
    changed one and appends the closed rows, in one commit; a NULL key is a key.
    A run that repeats finds its own rows unchanged and commits nothing."""
    table, moment = history_table(lake), F.lit(at).cast("timestamp_ntz")
    snapshot = staged_rows(deduped.select(*SNAPSHOT_COLUMNS), table)

    def change(base):
        stood = table.read_files(spark, table.holding(snapshot, "open", base), "path")
        moves = staged_rows(scd2_moves(stood, snapshot, "article_id", SNAPSHOT_CHECK, moment), table)
        if moves.isEmpty():
            return None
        touched = [r["path"] for r in moves.select("was.path").distinct().collect() if r["path"]]
        left = without(table.read_files(spark, touched), moves.select("opened.article_id"), "article_id")
        return {"open": left.unionByName(moves.select("opened.*")), "closed": moves.filter("closed IS NOT NULL").select("closed.*")}, touched, {}

    table.update(spark, change)
    return table.read(spark)


def staged_rows(df: DataFrame, table: KeyedTable, path: str | None = None) -> DataFrame:
    """``df`` written once below the table's folder."""
    path = path or versioned.new_version(f"{table.root}/staged")
    df.write.option("compression", TB.CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key (NULL too) isn't among ``keys``."""
    gone = keys.select(F.col(key).alias("__gone"))
    return rows.join(gone, F.col(key).eqNullSafe(F.col("__gone")), "left_anti")


def report_run(spark: SparkSession, lake: Lake, run_ts: dt.datetime) -> DataFrame:
    """The run's rows per category next to the all-time totals."""
    batch = _run_filter(TB.read_lake(spark, lake.raw, RAW_SCHEMA), run_ts)
    return scrape_report(batch, build_models(spark, lake).fct)


# --- source side: scrape + upsert, hard deletes ----------------------------------

def source_table(lake: Lake) -> KeyedTable:
    return KeyedTable(lake.source, "id", S.ARTICLE)


def _source(spark: SparkSession, lake: Lake) -> DataFrame:
    return source_table(lake).read(spark)


def save_source(rows: DataFrame, lake: Lake) -> None:
    """The whole source table anew, laid out for its number of rows."""
    source_table(lake).replace(rows.sparkSession, TB.conform(rows, S.ARTICLE))


def upsert_change(table: KeyedTable, base, updates: DataFrame, order: Sequence[Column] | None = None):
    """The change that upserts ``updates`` (one an id, where ``order`` names no
    first) into a version of the source table.

    Of a stored row that an update meets only what the update leaves is read;
    the files' other rows go to their buckets as they stand, without the join."""
    spark = updates.sparkSession
    touched = table.holding(updates, "rows", base)
    stored = PS.placed(table.read_files(spark, touched), bool(touched))
    met = stored.join(updates.select("id"), "id", "left_semi")
    replaced = [c for c in UPDATE_COLUMNS if c in updates.columns]
    kept = met.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in replaced else F.col(f.name) for f in table.schema.fields])
    merged = merge_upsert(kept, updates, "id", UPDATE_COLUMNS, order=order)
    rest = PS.unpicked(stored, PS.marks(met.select(*PS.PLACE), versioned.new_version(f"{table.root}/staged")))
    return {"rows": merged.unionByName(rest)}, touched, {}


def scrape_run(spark: SparkSession, lake: Lake, pages: DataFrame,
               pipeline: str = "feed_scraper") -> int:
    """Upsert one scrape's feed pages into the source table.

    Returns 1 when something was upserted, 0 for an empty feed.  Only the
    files that may hold scraped ids are read and replaced, new ids get files of
    their own; another job's commit in between makes this one start again on
    what it left.  The parsed rows are written once; those of ``P.flatten_feed``
    are chosen among them by narrow rows, and of each id the last in feed is read
    where it stands.  The watermark becomes the newest publish time among the
    chosen, and stays if none is known.
    """
    table = source_table(lake)
    state = _state(spark, lake, pipeline)
    since = read_watermark(state, pipeline)
    parsed = PS.placed(staged_rows(P.flatten_pages(pages).withColumnRenamed("pos", "slot"), table))
    narrow = P.before_end(parsed.drop("title", "content"), P.payload_rejects(pages))
    rows = P.take_while_recent(P.first_seen(narrow, order=("page", "slot")), F.lit(since).cast("timestamp_ntz"), order=("page", "slot"))
    rows = staged_rows(rows.select("id", "feed_id", "page", "slot", "published_at", *PS.PLACE), table)
    if rows.isEmpty():
        return 0
    last = latest_per_key(rows, ["id"], [F.col("feed_id").desc(), F.col("page").desc(), F.col("slot").desc()])   # last in feed wins
    updates = PS.picked(parsed, PS.marks(last.select(*PS.PLACE), versioned.new_version(f"{table.root}/staged"))).select(*S.ARTICLE_COLUMNS)

    table.update(spark, lambda base: upsert_change(table, base, updates))
    newest = rows.agg(F.max("published_at")).first()[0]
    if newest is not None:
        upd = spark.createDataFrame([(pipeline, newest, newest)], S.WATERMARK)
        _save_state(advance_watermark(state, upd), lake, pipeline)
    return 1


def delete_table(lake: Lake) -> KeyedTable:
    return KeyedTable(lake.delete_log, "article_id", S.ARTICLE_DELETED)


def read_delete_log(spark: SparkSession, lake: Lake) -> DataFrame | None:
    table = delete_table(lake)
    at = table.version(spark)
    return None if at.manifest is None else table.read(spark, at=at)


def delete_articles(spark: SparkSession, lake: Lake, ids: DataFrame, at: dt.datetime) -> None:
    """Hard-delete ids from the source and record them in the delete log
    (first delete wins).  The log is published first: if the job dies between
    the two, the deletes are known and a repeat removes the rows."""
    table = source_table(lake)
    keys = staged_rows(ids.select(F.col("id").cast("long").alias("id")).distinct(), table)
    base = table.version(spark)
    held = table.read_files(spark, table.holding(keys, "rows", base)).select("id")
    log_deletes(spark, lake, keys.join(held, "id", "left_semi"), at)

    def change(base):
        touched = table.holding(keys, "rows", base)
        rows = PS.placed(table.read_files(spark, touched), bool(touched))
        if rows.join(keys, "id", "left_semi").isEmpty():
            return None
        gone = keys.select(F.col("id").alias("__gone"))
        found = rows.join(gone, F.col("id").eqNullSafe(F.col("__gone")), "left_semi")
        return {"rows": PS.unpicked(rows, PS.marks(found.select(*PS.PLACE), versioned.new_version(f"{table.root}/staged")))}, touched, {}

    table.update(spark, change)


def log_deletes(spark: SparkSession, lake: Lake, gone: DataFrame, at: dt.datetime) -> DataFrame:
    """Append ids to the delete log; an id that it has keeps its first time.
    Returns the log."""
    table = delete_table(lake)
    new = staged_rows(delete_log_of(gone.distinct(), F.lit(at).cast("timestamp_ntz")), table)

    def change(base):
        known = table.read_files(spark, table.holding(new, "rows", base))
        rows = without(new, known, "article_id")
        return None if base.manifest is not None and rows.isEmpty() else ({"rows": rows}, [], {})

    table.update(spark, change)
    return table.read(spark)


def delete_sync(spark: SparkSession, lake: Lake, previous: DataFrame, current: DataFrame,
                at: dt.datetime) -> DataFrame:
    """The delete log after a snapshot diff: ids of the previous snapshot that are gone now."""
    return log_deletes(spark, lake, previous.select("id").distinct().join(current.select("id"), "id", "left_anti"), at)


def _bucketed(lake: Lake, name: str) -> str:
    return lake._p("bucketed", name)


def delete_sync_bucketed(spark: SparkSession, lake: Lake, current: DataFrame, at: dt.datetime) -> DataFrame:
    """The delete log after a diff with the stored ids of the run before.

    Only the current ids are exchanged, once, when they are stored in buckets.
    The diff, the search in the log and the new log join bucket by bucket.  The
    log is published before the ids: a run that dies between the two is
    repeated with the same result.  An id keeps the time of its first delete;
    one that comes back and goes again keeps it too; a null id is never gone.
    """
    ids_root, log_root = _bucketed(lake, "ids"), _bucketed(lake, "delete_log")
    former, logged = versioned.current_path(spark, ids_root), versioned.current_path(spark, log_root)
    ids = current.select(F.col("id").cast("long").alias("id")).filter("id is not null").distinct()
    n = BK.buckets_for(ids.count(), BK.buckets_of(former) if former else None)
    path = BK.write_bucketed(ids, ids_root, "id", n)
    now = BK.open_bucketed(spark, path, IDS, "id")
    log = None if logged is None else BK.open_bucketed(spark, logged, S.ARTICLE_DELETED, "article_id")
    if former is not None:
        before = BK.open_bucketed(spark, former, IDS, "id")
        gone = before.join(now, "id", "left_anti")
        same = n == BK.buckets_of(former) and (logged is None or n == BK.buckets_of(logged))
        logged = BK.write_bucketed(delete_log_of(gone, F.lit(at).cast("timestamp_ntz"), log), log_root, "article_id", n, dealt=same)
        versioned.point(spark, log_root, logged)
        log = BK.open_bucketed(spark, logged, S.ARTICLE_DELETED, "article_id")
    versioned.point(spark, ids_root, path)
    return spark.createDataFrame([], S.ARTICLE_DELETED) if log is None else log


def tombstones_bucketed(spark: SparkSession, lake: Lake, latest: DataFrame) -> DataFrame:
    """The tombstone columns of a table with one row an id, from the bucketed
    log.  The table is stored in the log's buckets first; the join exchanges
    nothing."""
    log = versioned.current_path(spark, _bucketed(lake, "delete_log"))
    if log is None:
        return latest
    path = BK.write_bucketed(latest, _bucketed(lake, "latest"), "id", BK.buckets_of(log))
    rows = BK.open_bucketed(spark, path, latest.schema, "id")
    return apply_tombstones(rows, BK.open_bucketed(spark, log, S.ARTICLE_DELETED, "article_id"))
