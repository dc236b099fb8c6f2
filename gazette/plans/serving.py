"""Serving, report and BI queries."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import schemas as S

PAGE_COLUMNS = ["article_id", "title", "category", "author_id", "date_day", "content_length"]


def _bounded(value: int, lo: int, hi: int, name: str) -> int:
    if not lo <= value <= hi:
        raise ValueError(f"{name} must be in [{lo}, {hi}], got {value}")
    return value


def page_order() -> list[Column]:
    """Newest day first (NULL day first, as the source database sorts), then id."""
    return [F.col("date_day").desc_nulls_first(), F.col("article_id").asc_nulls_last()]


def articles_page(fct: DataFrame, limit: int = S.PAGE_DEFAULT, offset: int = 0,
                  category: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(page rows, one-row total) of the fact table, optional category filter.

    An empty or missing category means no filter.  The page is a top-k
    (``offset + limit`` rows per partition, one merge), fine for the
    shallow pages an API serves; ``articles_after`` is the keyset form for
    deep paging.
    """
    _bounded(limit, 1, S.PAGE_MAX, "limit")
    if offset < 0:
        raise ValueError("offset must be >= 0")
    src = fct.filter(F.col("category") == F.lit(category)) if category else fct
    total = src.agg(F.count(F.lit(1)).alias("total"))
    ordered = src.select(*PAGE_COLUMNS).orderBy(*page_order())
    page = (ordered.offset(offset) if offset else ordered).limit(limit)
    return page, total


def articles_after(fct: DataFrame, after_day: Any, after_id: int, limit: int = S.PAGE_DEFAULT) -> DataFrame:
    """Keyset page: the ``limit`` rows following (after_day, after_id) in
    page order; the filter prunes row groups instead of skipping rows.  A
    NULL day stands first, so after it come its larger ids and all days."""
    d, i = F.col("date_day"), F.col("article_id")
    if after_day is None:
        after = d.isNotNull() | (i > F.lit(after_id))
    else:
        after = (d < F.lit(after_day)) | ((d == F.lit(after_day)) & (i > F.lit(after_id)))
    return fct.filter(after).select(*PAGE_COLUMNS).orderBy(*page_order()).limit(limit)


def by_key(df: DataFrame, col: str, value: Any) -> DataFrame:
    """Point lookup (0 or 1 row on a unique key); a literal pushes to the scan."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.filter(F.col(col) == v)


def top_authors(dim_author: DataFrame, limit: int = 10, offset: int = 0) -> DataFrame:
    """Authors by article count, author id as the tie-break (top-k: each
    partition keeps its best ``offset + limit`` rows, then one merge)."""
    ordered = dim_author.orderBy(F.col("total_articles").desc(), F.col("author_id").asc_nulls_last())
    return (ordered.offset(offset) if offset else ordered).limit(limit)


# --- scorecard serving -----------------------------------------------------

def dq_history(scorecards: DataFrame, n: int = S.HISTORY_DEFAULT) -> DataFrame:
    """Newest ``n`` scorecards (n=1 is the latest); the API allows 1..100.
    Runs of one time are ordered by table and source."""
    _bounded(n, 1, S.HISTORY_MAX, "n")
    return scorecards.orderBy(F.col("run_at").desc(), "table_name", "data_source").limit(n)


def dq_trend(scorecards: DataFrame, goal: float = S.DQ_THRESHOLD) -> DataFrame:
    return (scorecards.select("run_at", "overall_score", F.lit(goal).alias("goal"))
            .orderBy("run_at"))


def dq_breakdown(scorecards: DataFrame) -> DataFrame:
    """Latest scorecard as (dimension, score) rows, NULL scores kept."""
    latest = dq_history(scorecards, 1)
    return latest.select(F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).alias("score")) for d in S.SCORE_DIMENSIONS
    ])).alias("kv")).select("kv.dimension", "kv.score")


# --- category reports ------------------------------------------------------

def category_label(col: str = "category") -> Column:
    """NULL or empty category -> the report's 'no category' label."""
    c = F.col(col)
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(S.NO_CATEGORY_LABEL)).otherwise(c)


def category_totals(fct: DataFrame) -> DataFrame:
    """All-time article count per category (NULL is a group)."""
    return fct.groupBy("category").agg(F.count(F.lit(1)).alias("n_articles"))


def batch_counts(loaded: DataFrame, run_keys: list[str]) -> DataFrame:
    """Rows per run and labelled category."""
    return (loaded.groupBy(*run_keys, category_label().alias("category"))
            .agg(F.count(F.lit(1)).alias("n_articles")))


def scrape_report(batch: DataFrame, fct: DataFrame) -> DataFrame:
    """One run's counts next to all-time totals, per labelled category,
    with both grand totals; no rows when both sides are empty."""
    b = batch.groupBy(category_label().alias("category")).agg(F.count(F.lit(1)).alias("batch_count"))
    t = fct.groupBy(category_label().alias("category")).agg(F.count(F.lit(1)).alias("total_count"))
    rows = b.join(t, "category", "full_outer").select(
        "category", F.coalesce("batch_count", F.lit(0)).alias("batch_count"),
        F.coalesce("total_count", F.lit(0)).alias("total_count"))
    # grand totals as scalar subqueries (one value each), no join needed
    return (rows.withColumns({"batch_total": rows.select(F.sum("batch_count")).scalar(),
                              "grand_total": rows.select(F.sum("total_count")).scalar()})
            .orderBy(F.col("total_count").desc(), F.col("batch_count").desc(), "category"))


def articles_over_time(fct: DataFrame) -> DataFrame:
    """Counts per day, ISO week and month: facts are counted per day, then
    each day's count fans out to its three buckets."""
    per_day = fct.groupBy("date_day").agg(F.count(F.lit(1)).alias("n"))
    d = F.col("date_day")
    buckets = F.array(
        F.struct(F.lit("day").alias("grain"), d.alias("bucket")),
        F.struct(F.lit("week").alias("grain"), F.trunc(d, "week").alias("bucket")),
        F.struct(F.lit("month").alias("grain"), F.trunc(d, "month").alias("bucket")),
    )
    return (per_day.select(F.explode(buckets).alias("b"), "n").select("b.grain", "b.bucket", "n")
            .groupBy("grain", "bucket").agg(F.sum("n").alias("n_articles")))


def star_join_rollup(fct: DataFrame, dim_author: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact joined to both dimensions, rolled up by year and month.

    dim_date has one row per calendar day of the publish span, so it is
    bounded by the date range, not by fact volume; AQE broadcasts it (and
    dim_author while small) from runtime sizes and keeps a shuffle join
    beyond the threshold.
    """
    dated = fct.join(dim_date, "date_day", "inner")
    names = dim_author.select(F.col("author_id").alias("__author"), "author_name")
    # facts without an author match nothing: they pass beside the join, not through one task of it
    known = dated.filter(F.col("author_id").isNotNull()).join(names, F.col("author_id") == F.col("__author"), "left").drop("__author")
    j = known.unionByName(dated.filter(F.col("author_id").isNull()).withColumn("author_name", F.lit(None).cast("string")))
    return (j.rollup("year", "month").agg(
        F.count(F.lit(1)).alias("n_articles"),
        F.sum("content_length").alias("total_length"),
        F.count_distinct("author_id").alias("n_authors"),
        F.count("author_name").alias("named_articles"),
        F.grouping_id().cast("int").alias("level"),
    ))
