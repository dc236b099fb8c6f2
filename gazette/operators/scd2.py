"""Type 2 history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _changed(cols: Sequence[str], prev_prefix: str) -> Column:
    diff = F.lit(False)
    for c in cols:
        diff = diff | ~F.col(c).eqNullSafe(F.col(f"{prev_prefix}{c}"))
    return diff


def scd2_rebuild(versions: DataFrame, key: str, check: Sequence[str],
                 order: Sequence[str], valid_from: str = "updated_at",
                 bucket: Column | None = None) -> DataFrame:
    """Set-based history from all versions of every key.

    A version opens a new history row when it is the key's first or any
    ``check`` column differs (NULL-safe) from the previous version; the row
    is valid until the next history row opens.  Payload-only edits keep
    the open row; a return to an old value opens a new row.

    ``order`` names the ascending order columns (NULL first).  A row ends at
    the next known opening time, and is current if no row follows (a
    superseded row may lack an end when no later time is known).  With ``bucket`` (a value that never
    decreases along ``order``, e.g. the day of ``valid_from``), the lag and
    lead windows run per (key, bucket) and the bucket edges are stitched
    from a one-row-per-(key, bucket) summary, so a key holding a third of
    all versions is spread over its buckets instead of landing in one task.
    Without ``bucket`` the windows are per key.
    """
    if bucket is None:
        return _rebuild_per_key(versions, key, check, order, valid_from)
    return _rebuild_bucketed(versions, key, check, order, valid_from, bucket)


def _rebuild_per_key(versions, key, check, order, valid_from):
    w = Window.partitionBy(key).orderBy(*order)
    lagged = versions.withColumns({**{f"__prev_{c}": F.lag(c).over(w) for c in check},
                                   "__first": F.row_number().over(w) == 1})
    opened = (lagged.filter(F.col("__first") | _changed(check, "__prev_"))
              .drop(*[f"__prev_{c}" for c in check], "__first"))
    later = w.rowsBetween(1, Window.unboundedFollowing)
    return opened.withColumns({"valid_from": F.col(valid_from), "valid_to": F.first(valid_from, ignorenulls=True).over(later),
                               "is_current": F.lead(F.lit(1)).over(w).isNull()})


def _order_struct(order: Sequence[str]) -> Column:
    """The ascending order as one comparable struct (for max_by / min_by);
    NULL sorts first, as in the ascending windows."""
    return F.struct(*[F.col(c) for c in order])


def _rebuild_bucketed(versions, key, check, order, valid_from, bucket):
    """One large shuffle (rows by key and bucket) plus a small one for the
    per-(key, bucket) summary, which carries what crosses bucket edges:
    the previous bucket's last values and the next bucket's first opening."""
    v = versions.withColumns({"__b": bucket, "__ord": _order_struct(order), "__vf": F.col(valid_from)})
    wb = Window.partitionBy(key, "__b").orderBy(*order)
    v = v.withColumns({"__rn": F.row_number().over(wb), **{f"__prev_{c}": F.lag(c).over(wb) for c in check}})
    v = v.withColumn("__chg", (F.col("__rn") > 1) & _changed(check, "__prev_"))

    # per (key, bucket): first / last values, first time, first in-bucket change
    summ = v.groupBy(key, "__b").agg(
        *[F.max_by(c, "__ord").alias(f"__last_{c}") for c in check],
        *[F.min_by(c, "__ord").alias(f"__first_{c}") for c in check],
        F.min_by("__vf", "__ord").alias("__first_vf"),
        F.min_by("__vf", F.when(F.col("__chg"), F.col("__ord"))).alias("__first_chg_vf"),
        F.max("__chg").alias("__any_chg"),
    )
    wk = Window.partitionBy(key).orderBy("__b")          # one row per (key, bucket)
    summ = summ.withColumns({"__has_prev": F.row_number().over(wk) > 1,
                             **{f"__bprev_{c}": F.lag(f"__last_{c}").over(wk) for c in check}})
    opens_first = ~F.col("__has_prev")
    for c in check:
        opens_first = opens_first | ~F.col(f"__first_{c}").eqNullSafe(F.col(f"__bprev_{c}"))
    first_open = F.when(opens_first, F.col("__first_vf")).otherwise(F.col("__first_chg_vf"))
    summ = summ.withColumns({"__open_first": opens_first, "__first_open_vf": first_open})
    later = wk.rowsBetween(1, Window.unboundedFollowing)
    summ = summ.withColumns({
        "__next_open_vf": F.first("__first_open_vf", ignorenulls=True).over(later),
        "__opens_later": F.coalesce(F.max(F.col("__open_first") | F.col("__any_chg")).over(later), F.lit(False))})

    # NULL keys and NULL buckets (unknown times) are groups like any other
    edges = summ.select(F.col(key).alias("__k"), F.col("__b").alias("__bb"), "__open_first", "__next_open_vf", "__opens_later")
    j = v.join(edges, F.col(key).eqNullSafe(F.col("__k")) & F.col("__b").eqNullSafe(F.col("__bb")), "inner")
    opened = j.filter(F.when(F.col("__rn") == 1, F.col("__open_first")).otherwise(F.col("__chg")))
    wo = Window.partitionBy(key, "__b").orderBy(*order)
    nxt = F.first(valid_from, ignorenulls=True).over(wo.rowsBetween(1, Window.unboundedFollowing))
    out = opened.withColumns({"valid_from": F.col(valid_from), "valid_to": F.coalesce(nxt, F.col("__next_open_vf")),
                              "is_current": F.lead(F.lit(1)).over(wo).isNull() & ~F.col("__opens_later")})
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def scd2_current(history: DataFrame) -> DataFrame:
    return history.filter("is_current")


def scd2_as_of(history: DataFrame, at: Column) -> DataFrame:
    """Rows valid at ``at``: valid_from <= at < valid_to (open = infinite)."""
    return history.filter((F.col("valid_from") <= at) &
                          (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def scd2_merge(history: DataFrame, snapshot: DataFrame, key: str,
               check: Sequence[str], at: Column) -> DataFrame:
    """One snapshot run (strategy ``check``) against existing history.

    Unchanged keys keep their open row; changed keys close it at ``at`` and
    open a new row; new keys open a row; keys missing from the snapshot stay
    open (no hard-delete invalidation).  Closed rows pass through.
    """
    at = at.cast("timestamp_ntz")
    closed_rows = history.filter(F.col("valid_to").isNotNull())
    open_rows = history.filter(F.col("valid_to").isNull()).withColumn("__h", F.lit(True))
    snap = snapshot.select(*[F.col(c).alias(f"__s_{c}") for c in snapshot.columns], F.lit(True).alias("__s"))
    # a NULL key is a key like any other: sides are told apart by flags of their own
    j = open_rows.join(snap, F.col(key).eqNullSafe(F.col(f"__s_{key}")), "full_outer")
    in_hist, in_snap = F.col("__h").isNotNull(), F.col("__s").isNotNull()
    changed = in_hist & in_snap & _changed(check, "__s_")
    hist_cols = [c for c in history.columns]
    # existing open rows: close the changed ones
    kept = (j.filter(in_hist)
            .select(*[F.when(changed, at).otherwise(F.col("valid_to")).alias("valid_to")
                      if c == "valid_to" else
                      F.when(changed, F.lit(False)).otherwise(F.col("is_current")).alias("is_current")
                      if c == "is_current" else F.col(c)
                      for c in hist_cols]))
    # new open rows for changed and new keys
    opened = (j.filter(in_snap & (changed | ~in_hist))
              .select(*[F.col(f"__s_{c}").alias(c) if c in snapshot.columns else
                        at.alias(c) if c == "valid_from" else
                        F.lit(None).cast("timestamp_ntz").alias(c) if c == "valid_to" else
                        F.lit(True).alias(c) if c == "is_current" else
                        F.lit(None).alias(c)
                        for c in hist_cols]))
    return closed_rows.unionByName(kept).unionByName(opened)


def scd2_moves(open_rows: DataFrame, snapshot: DataFrame, key: str, check: Sequence[str], at: Column) -> DataFrame:
    """What one snapshot run changes, given the open rows that its keys may have.

    One row per changed or new key: ``closed`` (the old row as it ends, NULL for
    a new key), ``opened`` (the new row) and the columns of ``open_rows`` that are
    no history columns under ``was``.  Unchanged keys give no row.  Snapshot keys are distinct."""
    at = at.cast("timestamp_ntz")
    columns = [*snapshot.columns, "valid_from", "valid_to", "is_current"]
    more = [c for c in open_rows.columns if c not in columns]
    old = open_rows.select(*[F.col(c).alias(f"__h_{c}") for c in [*columns, *more]], F.lit(True).alias("__h"))
    j = snapshot.join(old, F.col(key).eqNullSafe(F.col(f"__h_{key}")), "left")
    stood = F.col("__h").isNotNull()
    end = {"valid_to": at, "is_current": F.lit(False)}
    closed = F.struct(*[end.get(c, F.col(f"__h_{c}")).alias(c) for c in columns])
    begin = {"valid_from": at, "valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True)}
    opened = F.struct(*[begin.get(c, F.col(c) if c in snapshot.columns else F.lit(None)).alias(c) for c in columns])
    was = F.struct(*[F.col(f"__h_{c}").alias(c) for c in more]) if more else F.lit(None)
    return (j.filter(~stood | _changed(check, "__h_"))
            .select(F.when(stood, closed).alias("closed"), opened.alias("opened"), F.when(stood, was).alias("was")))


def scd2_init(snapshot: DataFrame, at: Column) -> DataFrame:
    """First snapshot run: every row opens at ``at``."""
    return snapshot.withColumns({"valid_from": at.cast("timestamp_ntz"),
                                 "valid_to": F.lit(None).cast("timestamp_ntz"),
                                 "is_current": F.lit(True)})
