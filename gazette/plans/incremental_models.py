"""Models kept up to date from new runs only.

``refresh_latest`` merges the raw runs that it hasn't seen into the stored latest
version of each article and writes what that changed as *moves*: each article's
stored row before and after, and the places (file, row) where their title and text
stand.  The other models follow the moves:

* ``refresh_author_days``: articles per (author, name, publish day) as counts that a
  move lowers for the row it takes away and raises for the one it brings; the
  author dimension is an aggregate of these few rows, so an extreme day that
  leaves needs no article;
* ``refresh_categories``: articles per category, in the same way.

Each model notes in its own commit how far it has followed, so a job that dies
between two of them is caught up by the next.  Old raw partitions are not read:
runs are found by listing the days inside a horizon, and a run is read by its path.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette import schemas as S
from gazette.functions.dates import published_date
from gazette.operators.dedupe import latest_per_key
from gazette.plans.jobs import RAW_SCHEMA, Lake, delete_table, staged_rows
from gazette.plans.models import stg_articles
from gazette.sources import positions as PS
from gazette.sources import tables as TB
from gazette.sources import versioned
from gazette.sources.keyed import KeyedTable, Version

MODEL = ["article_id", "title", "content", "author_id", "author_name", "category", "published_at", "created_at", "updated_at",
         "published_date", "content_length"]
LATEST = T.StructType([
    T.StructField("article_id", T.LongType()), T.StructField("title", T.StringType()), T.StructField("content", T.StringType()),
    T.StructField("author_id", T.LongType()), T.StructField("author_name", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("published_at", S.TS), T.StructField("created_at", S.TS), T.StructField("updated_at", S.TS),
    T.StructField("published_date", T.DateType()), T.StructField("content_length", T.LongType()),
    T.StructField("_loaded_at", S.TS), T.StructField("removed", T.BooleanType())])
AUTHOR_DAYS = T.StructType([T.StructField("author_id", T.LongType()), T.StructField("author_name", T.StringType()),
                            T.StructField("published_date", T.DateType()), T.StructField("n", T.LongType())])
#: The stored row without its title and text.
NARROW = T.StructType([f for f in LATEST.fields if f.name not in ("title", "content")])
MOVE = T.StructType([T.StructField("before", NARROW), T.StructField("after", NARROW), T.StructField("path", T.StringType()), T.StructField("pos", T.LongType()),
                     T.StructField("from_path", T.StringType()), T.StructField("from_pos", T.LongType())])
CATEGORIES = T.StructType([T.StructField("category", T.StringType()), T.StructField("n", T.LongType())])
#: Runs that land later than this behind the newest one are left to a full rebuild.
HORIZON = dt.timedelta(days=40)


def latest_table(lake: Lake) -> KeyedTable:
    return KeyedTable(f"{lake.root}/models/latest", "article_id", LATEST)


def author_days_table(lake: Lake) -> KeyedTable:
    return KeyedTable(f"{lake.root}/models/author_days", "author_id", AUTHOR_DAYS)


def categories_table(lake: Lake) -> KeyedTable:
    return KeyedTable(f"{lake.root}/models/categories", "category", CATEGORIES)


def _later(new: str, old: str) -> Column:
    """Whether version ``new`` stands before ``old`` in the dedupe order
    (updated_at descending, NULL first; then _loaded_at descending, NULL last)."""
    def of(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    nu, ou, nl, ol = of(new, "updated_at"), of(old, "updated_at"), of(new, "_loaded_at"), of(old, "_loaded_at")
    loads = F.when(ol.isNull(), nl.isNotNull()).otherwise(F.coalesce(nl > ol, F.lit(False)))
    return F.when(nu.eqNullSafe(ou), loads).when(nu.isNull(), True).when(ou.isNull(), False).otherwise(nu > ou)


def _new_deletes(spark: SparkSession, lake: Lake, base: Version) -> tuple[DataFrame, dict]:
    """Ids logged as deleted since the manifest of the log that ``base`` noted
    (the log is only appended to), and the note for the next run."""
    log = delete_table(lake)
    now = log.version(spark)
    seen = base.notes.get("deletes")
    if now.manifest is None or now.manifest == seen:
        return spark.createDataFrame([], "article_id long"), {}
    old = log.files(spark, Version(0, seen)).select("path")
    fresh = [r["path"] for r in log.files(spark, now).join(old, "path", "left_anti").select("path").collect()]
    return log.read_files(spark, fresh).select("article_id"), {"deletes": now.manifest}


def _days_before(run: str, horizon: dt.timedelta) -> str:
    return f"{dt.datetime.strptime(run[:10], '%Y-%m-%d') - horizon:%Y-%m-%d}"


def pending(spark: SparkSession, lake: Lake, base: Version, horizon: dt.timedelta = HORIZON) -> list[str]:
    """``day/run`` of the raw runs inside the horizon that the model lacks."""
    seen = set(base.notes.get("runs", []))
    since = _days_before(max(seen), horizon) if seen else ""
    return [r for r in TB.recent_runs(spark, lake.raw, since) if r not in seen]


def _staged(raw: DataFrame) -> DataFrame:
    """Raw rows (placed; with or without their text) as rows of the latest table."""
    stg = stg_articles(raw, keep=PS.PLACE)
    return stg.withColumns({"published_date": published_date("published_at"), "removed": F.lit(False)})


def refresh_latest(spark: SparkSession, lake: Lake, respect_time: bool = False, horizon: dt.timedelta = HORIZON) -> list[str]:
    """Merge the runs that the model lacks, late ones too; returns them.

    A run's rows compete with the stored rows of their keys alone: the files
    that may hold these keys are read and those that hold a changed one
    replaced.  A run that was merged before is known by its name; merging its
    rows again would change nothing.  Tombstones are a flag of the stored row, so
    ids that are new in the delete log are touched, the others are not.

    Versions compete as narrow rows that know their place in the files.  Title
    and text are read where the winner stands and written with it; the one
    exchange that carries them is the one to the table's buckets."""
    table, log, done = latest_table(lake), delete_table(lake), []

    def change(base: Version):
        done[:] = pending(spark, lake, base, horizon)
        deletes, noted = _new_deletes(spark, lake, base)
        if not done and not noted:
            return None
        raw = PS.placed(TB.read_runs(spark, lake.raw, RAW_SCHEMA, done), bool(done))
        narrow, names = _staged(raw.drop("title", "content")), NARROW.fieldNames()
        order = [F.col("updated_at").desc_nulls_first(), F.col("_loaded_at").desc_nulls_last()]
        new = staged_rows(latest_per_key(narrow, ["article_id"], order).select(*names, *PS.PLACE), table)
        keys = new.select("article_id").union(deletes).distinct()
        held = table.holding(keys, "rows", base)
        stood = PS.placed(table.read_files(spark, held), bool(held))
        flags = log.version(spark)
        hits = log.read_files(spark, log.holding(keys, "rows", flags)).select(F.col("article_id").alias("gone"), F.col("deleted_at").alias("gone_at"))

        n = new.select(F.col("article_id").alias("nk"), F.struct(*names).alias("n"), F.col("path").alias("n_path"), F.col("pos").alias("n_pos"))
        o = stood.select(F.col("article_id").alias("ok"), F.struct(*names).alias("o"), *PS.PLACE)
        o = o.join(keys.select(F.col("article_id").alias("ak")), F.col("ok").eqNullSafe(F.col("ak")), "left_semi")
        both = n.withColumn("hn", F.lit(True)).join(o.withColumn("ho", F.lit(True)), F.col("nk").eqNullSafe(F.col("ok")), "full_outer")
        wins = F.col("hn").isNotNull() & (F.col("ho").isNull() | _later("n", "o"))
        both = both.withColumn("win", F.when(wins, F.col("n")).otherwise(F.col("o"))).join(hits, F.col("win.article_id") == F.col("gone"), "left")
        dead = F.col("gone").isNotNull()
        if respect_time:
            dead = dead & F.coalesce(F.col("win.updated_at") <= F.col("gone_at"), F.lit(False))
        after = F.struct(*[dead.alias(c) if c == "removed" else F.col(f"win.{c}").alias(c) for c in names])
        moves = (both.filter(wins | (dead != F.col("o.removed")))
                 .select(F.when(F.col("ho").isNotNull(), F.col("o")).alias("before"), after.alias("after"), *PS.PLACE,
                         F.when(wins, F.col("n_path")).otherwise(F.col("path")).alias("from_path"), F.when(wins, F.col("n_pos")).otherwise(F.col("pos")).alias("from_pos")))
        written = versioned.new_version(f"{table.root}/moves")
        moves = staged_rows(moves, table, written)
        touched = [r["path"] for r in moves.select("path").distinct().collect() if r["path"]]
        files = PS.placed(table.read_files(spark, touched), bool(touched))
        left = PS.unpicked(files, PS.marks(moves.select(*PS.PLACE), versioned.new_version(f"{table.root}/staged")))
        source = moves.select(F.col("from_path").alias("path"), F.col("from_pos").alias("pos"), F.col("after.removed").alias("now_removed"))
        chosen = PS.marks(source, versioned.new_version(f"{table.root}/staged"), ["now_removed"])
        rows = left.select(LATEST.fieldNames())
        for found in (_staged(raw), files):
            rows = rows.unionByName(PS.picked(found, chosen).withColumn("removed", F.col("now_removed")).select(LATEST.fieldNames()))
        runs = sorted({*base.notes.get("runs", []), *done})
        since = _days_before(runs[-1], horizon) if runs else ""
        runs = [r for r in runs if r >= since]
        return {"rows": rows}, touched, {"runs": runs, "moves": written, **noted}

    table.update(spark, change)
    return list(done)


def latest_model(spark: SparkSession, lake: Lake) -> DataFrame:
    """The deduplicated model (``int_articles_deduped``)."""
    return latest_table(lake).read(spark).filter("NOT removed").select(*MODEL)


def moves_after(spark: SparkSession, lake: Lake, number: int) -> tuple[DataFrame, int]:
    """All moves of the latest table's versions after ``number``, and its newest version."""
    table = latest_table(lake)
    newest = table.version(spark).number
    paths = [table.at(spark, k).notes["moves"] for k in range(number + 1, newest + 1)]
    return (spark.read.schema(MOVE).parquet(*paths) if paths else spark.createDataFrame([], MOVE)), newest


def _signed(moves: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The groups that moves take from and bring to, as signed counts."""
    sides = []
    for side, sign in (("before", -1), ("after", 1)):
        sides.append(moves.filter(F.col(side).isNotNull() & ~F.col(f"{side}.removed")).select(*[F.col(f"{side}.{c}").alias(c) for c in columns], F.lit(sign).cast("long").alias("n")))
    return sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("n").alias("n")).filter("n <> 0")


def _follow(spark: SparkSession, lake: Lake, table: KeyedTable) -> None:
    """Bring a table of counts up to the latest table's moves: only the files
    that may hold a group's key are read and replaced."""
    columns = [c for c in table.schema.fieldNames() if c != "n"]

    def change(base: Version):
        moves, newest = moves_after(spark, lake, base.notes.get("followed", 0))
        if newest == base.notes.get("followed", 0):
            return None
        delta = staged_rows(_signed(moves, columns), table)
        touched = table.holding(delta, "rows", base)
        summed = table.read_files(spark, touched).unionByName(delta).groupBy(*columns).agg(F.sum("n").alias("n")).filter("n > 0")
        return {"rows": summed}, touched, {"followed": newest}

    table.update(spark, change)


def refresh_author_days(spark: SparkSession, lake: Lake) -> None:
    _follow(spark, lake, author_days_table(lake))


def refresh_categories(spark: SparkSession, lake: Lake) -> None:
    _follow(spark, lake, categories_table(lake))


def dim_author(spark: SparkSession, lake: Lake) -> DataFrame:
    """The author dimension from the counts: first per (author, name), so the
    names of an author that meet are few."""
    per_name = author_days_table(lake).read(spark).groupBy("author_id", "author_name").agg(
        F.sum("n").alias("n"), F.min("published_date").alias("lo"), F.max("published_date").alias("hi"))
    return per_name.groupBy("author_id").agg(
        F.array_max(F.collect_set("author_name")).alias("author_name"), F.sum("n").alias("total_articles"),
        F.min("lo").alias("first_published_date"), F.max("hi").alias("last_published_date"))


def category_totals(spark: SparkSession, lake: Lake) -> DataFrame:
    return categories_table(lake).read(spark).select("category", F.col("n").alias("n_articles"))


def refresh(spark: SparkSession, lake: Lake, respect_time: bool = False) -> list[str]:
    """All incremental models, in the order that each follows the one before."""
    done = refresh_latest(spark, lake, respect_time)
    refresh_author_days(spark, lake)
    refresh_categories(spark, lake)
    return done
