"""Keyed merges on immutable files: upsert, tombstones, delete log, state
(C1, C2, C3, C8, I1, I2, I4, I5).

Each function returns the new table as a DataFrame; the caller writes it
to a new version directory (``gazette.sources.versioned``) so a plan never
overwrites a path it is reading.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import schemas as S
from gazette.operators.dedupe import latest_per_key


def merge_upsert(target: DataFrame, updates: DataFrame, key: str,
                 update_cols: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO UPDATE SET update_cols.

    Matched keys take ``update_cols`` from the update and keep every other
    column (e.g. published_at, created_at, columns that updates lack) from
    the target; new keys are
    inserted whole; untouched keys pass through.  Several updates for one
    key apply in ``order`` and the last one wins, which equals keeping the
    first row under the reversed order.  One full-outer equi-join on the
    key: both sides shuffle once (or the small side is broadcast by AQE).
    """
    if order is not None:
        updates = latest_per_key(updates, [key], order)
    t, u = target.alias("t"), updates.alias("u")
    matched = F.col(f"u.{key}").isNotNull()
    cols = []
    for c in target.columns:
        if c == key:
            cols.append(F.coalesce(F.col(f"u.{key}"), F.col(f"t.{key}")).alias(key))
        elif c not in updates.columns:
            cols.append(F.col(f"t.{c}").alias(c))    # target-only: kept, NULL on insert
        elif c in update_cols:
            cols.append(F.when(matched, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            # kept on update, taken from the update on insert
            cols.append(F.when(F.col(f"t.{key}").isNotNull(), F.col(f"t.{c}"))
                        .otherwise(F.col(f"u.{c}")).alias(c))
    return t.join(u, F.col(f"t.{key}") == F.col(f"u.{key}"), "full_outer").select(*cols)


def apply_tombstones(raw: DataFrame, log: DataFrame, key: str = "id",
                     respect_time: bool = False) -> DataFrame:
    """Flag every version whose id is in the delete log and stamp its time.

    ``respect_time`` only flags versions updated at or before the delete,
    so a re-published article is not flagged again.  The log only grows,
    so no broadcast is forced; AQE broadcasts it while it is small.
    """
    lg = log.select(F.col("article_id").alias("__del_id"), F.col("deleted_at").alias("__del_at"))
    hit = F.col("__del_id").isNotNull()
    if respect_time:
        hit = hit & (F.col("updated_at") <= F.col("__del_at"))
    joined = raw.join(lg, F.col(key) == F.col("__del_id"), "left")
    out = [
        F.when(hit, F.lit(True)).otherwise(F.col("is_hard_deleted")).alias("is_hard_deleted")
        if c == "is_hard_deleted" else
        F.when(hit, F.col("__del_at")).otherwise(F.col("deleted_at")).alias("deleted_at")
        if c == "deleted_at" else F.col(c)
        for c in raw.columns
    ]
    return joined.select(*out)


def delete_log_diff(previous_ids: DataFrame, current_ids: DataFrame, at: Column,
                    existing: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Ids present in the previous snapshot and gone now, stamped ``at``.

    Merged into ``existing`` so that the first delete of an id wins.
    """
    gone = previous_ids.select(key).distinct().join(current_ids.select(key), key, "left_anti")
    return delete_log_of(gone, at, existing, key)


def delete_log_of(gone: DataFrame, at: Column, existing: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Delete-log rows of distinct removed ids (for sources that flag them),
    merged into ``existing``."""
    gone = gone.select(F.col(key).cast("long").alias("article_id"), at.cast("timestamp_ntz").alias("deleted_at"))
    if existing is None:
        return gone
    new = gone.join(existing.select("article_id"), "article_id", "left_anti")
    return existing.select("article_id", "deleted_at").unionByName(new)


# --- watermark state ------------------------------------------------------

def state_log(rows: DataFrame) -> DataFrame:
    """Conform (pipeline_name, last_updated_at[, written_at]) to the state
    schema; ``written_at`` defaults to the value itself."""
    if "written_at" not in rows.columns:
        rows = rows.withColumn("written_at", F.col("last_updated_at"))
    return rows.select(F.col("pipeline_name").cast("string"),
                       F.col("last_updated_at").cast("timestamp_ntz"),
                       F.col("written_at").cast("timestamp_ntz"))


def watermark(state: DataFrame, pipelines: DataFrame,
              seed: dt.datetime = S.DEFAULT_WATERMARK) -> DataFrame:
    """Current value per requested pipeline: the last write wins (it may
    move backwards); a pipeline never written gets ``seed``."""
    current = state.groupBy("pipeline_name").agg(
        F.max_by("last_updated_at", "written_at").alias("last_updated_at"))
    return (pipelines.select("pipeline_name").distinct()
            .join(current, "pipeline_name", "left")
            .select("pipeline_name",
                    F.coalesce(F.col("last_updated_at"),
                               F.lit(seed).cast("timestamp_ntz")).alias("last_updated_at")))


def advance_watermark(state: DataFrame, updates: DataFrame) -> DataFrame:
    """MERGE of keyed state: replace matched pipelines, insert new ones.

    State is one row per pipeline, so this is a left-anti join plus union.
    """
    upd = state_log(updates)
    kept = state.join(upd.select("pipeline_name"), "pipeline_name", "left_anti")
    return kept.unionByName(upd)
