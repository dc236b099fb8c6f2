"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their
reference SQL.  Every query reads the driver's test tables (through the
fixture mapping) over their whole extent."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette import functions as FN
from gazette import schemas as S
from gazette.operators import checks as CK
from gazette.operators import merge as MG
from gazette.operators import scd2 as H
from gazette.operators.dedupe import latest_per_key
from gazette.operators.drift import drift, drift_alerts
from gazette.operators.incremental import extract_window, incremental_extract
from gazette.operators.scorecard import scorecard
from gazette.plans import models as M
from gazette.plans import serving as V
from gazette.plans.oracle import CTES as _CTES
from gazette.plans.oracle import with_ctes
from gazette.session import freed_shuffles, scratch_path
from gazette.sources import fixtures as fx
from gazette.sources import payload as P
from gazette.sources import tables as TB
from gazette.sources.versioned import publish, read_current
from gazette.streaming.available_now import read_cleaned, run_available_now

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- minimum slice and marts ----------------------------------------------

@register("clean_articles", with_ctes("SELECT * FROM cleaned", "cleaned"))
def q_clean_articles(spark, sf):
    return M.Warehouse(spark, sf).cleaned


@register("stg_articles", with_ctes("""
    SELECT id AS article_id, trim(title) AS title, content, author_id, author_name,
           nullif(CASE WHEN category = 'error' THEN 'UNKNOWN' ELSE category END, 'UNKNOWN') AS category,
           published_at, created_at, updated_at, deleted_at, is_hard_deleted,
           updated_at + INTERVAL 5 MINUTE AS _loaded_at
    FROM articles WHERE is_hard_deleted IS NOT TRUE""", "articles"))
def q_stg_articles(spark, sf):
    return M.stg_articles(fx.staging_raw(fx.articles(spark, sf)))


@register("articles_deduped", with_ctes("SELECT * FROM deduped", "deduped"))
def q_articles_deduped(spark, sf):
    return M.Warehouse(spark, sf).deduped


@register("fct_articles", with_ctes("SELECT * FROM fct", "fct"))
def q_fct_articles(spark, sf):
    return M.Warehouse(spark, sf).fct


@register("dim_author", with_ctes("SELECT * FROM dim_author", "dim_author"))
def q_dim_author(spark, sf):
    return M.Warehouse(spark, sf).dim_author


@register("dim_date", with_ctes("SELECT * FROM dim_date", "dim_date"))
def q_dim_date(spark, sf):
    return M.Warehouse(spark, sf).dim_date


@register("dq_scorecard_by_day", with_ctes("SELECT * FROM scorecards", "scorecards"))
def q_dq_scorecard_by_day(spark, sf):
    return M.Warehouse(spark, sf).scorecards


@register("top_authors", with_ctes("""
    SELECT * FROM dim_author ORDER BY total_articles DESC, author_id ASC NULLS LAST LIMIT 10""",
                                   "dim_author"))
def q_top_authors(spark, sf):
    return V.top_authors(M.Warehouse(spark, sf).dim_author, limit=10)


# --- merges, tombstones, state ----------------------------------------------


_S1 = "id, title, content, author_id, author_name, category, published_at, created_at, updated_at, deleted_at"
S1_COLS = [c.strip() for c in _S1.split(",")]


@register("raw_append", with_ctes("SELECT * FROM raw", "raw"))
def q_raw_append(spark, sf):
    return M.Warehouse(spark, sf).raw


@register("tombstone_apply", with_ctes("SELECT * FROM raw_tomb", "raw_tomb"))
def q_tombstone_apply(spark, sf):
    return M.Warehouse(spark, sf).raw_tombstoned


@register("delete_log_diff", with_ctes("""
    SELECT article_id, deleted_at FROM old_log
    UNION ALL
    SELECT article_id, deleted_at FROM delete_log WHERE article_id NOT IN (SELECT article_id FROM old_log)""",
    "delete_log", "old_log", extra={"old_log": (["articles"], """
        SELECT DISTINCT id AS article_id, (SELECT max(ts) FROM events) AS deleted_at
        FROM articles WHERE id % 50 = 0""")}))
def q_delete_log_diff(spark, sf):
    """Snapshot diff merged into an older log (ids id%50=0 deleted a day
    earlier): the first delete of an id wins."""
    ids = fx.articles(spark, sf).select("id").distinct()
    at = fx.snapshot_time(spark, sf)
    old = (ids.filter(F.col("id") % 50 == 0).select(F.col("id").alias("article_id"))
           .withColumn("deleted_at", at - F.expr("INTERVAL 1 DAY")))
    return MG.delete_log_diff(ids, ids.filter(F.col("id") % 25 != 0), at=at, existing=old)


_CUT_UPSERT = "(SELECT max(updated_at) - INTERVAL 7 DAY FROM articles)"


@register("source_upsert", with_ctes(f"""
    SELECT coalesce(u.id, t.id) AS id,
           CASE WHEN u.id IS NOT NULL THEN u.title ELSE t.title END AS title,
           CASE WHEN u.id IS NOT NULL THEN u.content ELSE t.content END AS content,
           CASE WHEN u.id IS NOT NULL THEN u.author_id ELSE t.author_id END AS author_id,
           CASE WHEN u.id IS NOT NULL THEN u.author_name ELSE t.author_name END AS author_name,
           CASE WHEN u.id IS NOT NULL THEN u.category ELSE t.category END AS category,
           CASE WHEN t.id IS NOT NULL THEN t.published_at ELSE u.published_at END AS published_at,
           CASE WHEN t.id IS NOT NULL THEN t.created_at ELSE u.created_at END AS created_at,
           CASE WHEN u.id IS NOT NULL THEN u.updated_at ELSE t.updated_at END AS updated_at,
           CASE WHEN u.id IS NOT NULL THEN u.deleted_at ELSE t.deleted_at END AS deleted_at
    FROM (SELECT {_S1} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS FIRST, seq DESC) rn
                             FROM articles WHERE updated_at < {_CUT_UPSERT}) WHERE rn = 1) t
    FULL OUTER JOIN
         (SELECT {_S1} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS FIRST, seq DESC) rn
                             FROM articles WHERE updated_at >= {_CUT_UPSERT}) WHERE rn = 1) u
    ON t.id = u.id""", "articles"))
def q_source_upsert(spark, sf):
    """Source table (latest version per id before the cut) upserted with
    every scraped version after it; the last scraped version of an id wins
    and published_at / created_at stay as first stored."""
    art = fx.articles(spark, sf)
    cut = art.select(F.max("updated_at") - F.expr("INTERVAL 7 DAYS")).scalar()
    order = [F.col("updated_at").desc_nulls_first(), F.col("seq").desc()]
    target = latest_per_key(art.filter(F.col("updated_at") < cut), ["id"], order).select(*S1_COLS)
    updates = art.filter(F.col("updated_at") >= cut).select(*S1_COLS, "seq")
    merged = MG.merge_upsert(target, updates, "id",
                             ["title", "content", "author_id", "author_name", "category",
                              "updated_at", "deleted_at"], order=order)
    return merged.select(*S1_COLS)


_WM_PIPES = ["articles_etl_hourly", "feed_scraper", "news_hard_delete_sync"]


@register("watermark_get_set", with_ctes(f"""
    SELECT r.p AS pipeline_name, coalesce(cur.v, TIMESTAMP '2016-01-01 00:00:00') AS last_updated_at
    FROM (VALUES {", ".join(f"('{p}')" for p in _WM_PIPES)}) r(p)
    LEFT JOIN (SELECT pipeline_name, max_by(last_updated_at, written_at) AS v FROM state1 GROUP BY 1) cur
    ON cur.pipeline_name = r.p""", "state1", extra={
    "state0": (["batched"], """
        SELECT 'articles_etl_hourly' AS pipeline_name, CAST(batch AS TIMESTAMP) + INTERVAL 1 DAY AS last_updated_at,
               CAST(batch AS TIMESTAMP) + INTERVAL 1 DAY AS written_at
        FROM (SELECT DISTINCT batch FROM batched)"""),
    "wm_upd": (["articles"], """
        SELECT 'articles_etl_hourly' AS p, max(updated_at) AS v FROM articles
        UNION ALL SELECT 'feed_scraper', max(published_at) FROM articles"""),
    "state1": (["state0", "wm_upd"], """
        SELECT * FROM state0 WHERE pipeline_name NOT IN (SELECT p FROM wm_upd)
        UNION ALL SELECT p, v, v FROM wm_upd"""),
}))
def q_watermark_get_set(spark, sf):
    """State log with one write per daily run, then a MERGE that sets the
    ETL watermark to the last extraction and the scraper watermark to the
    newest publish time, then a get for three pipelines (one unseen ->
    seed)."""
    wh = M.Warehouse(spark, sf)
    state0 = MG.state_log(wh.batched.select("batch").distinct().select(
        F.lit("articles_etl_hourly").alias("pipeline_name"),
        (F.col("batch").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("last_updated_at")))
    upd = wh.articles.agg(F.max("updated_at").alias("etl"), F.max("published_at").alias("scr")).select(
        F.explode(F.array(
            F.struct(F.lit("articles_etl_hourly").alias("pipeline_name"), F.col("etl").alias("last_updated_at")),
            F.struct(F.lit("feed_scraper").alias("pipeline_name"), F.col("scr").alias("last_updated_at")),
        )).alias("u")).select("u.*")
    state1 = MG.advance_watermark(state0, upd)
    req = spark.createDataFrame([(p,) for p in _WM_PIPES], "pipeline_name string")
    return MG.watermark(state1, req)


_WIN_SINCE = "(SELECT CAST(CAST(min(updated_at) AS DATE) AS TIMESTAMP) + INTERVAL 7 DAY FROM articles)"
_WIN_UNTIL = "(SELECT CAST(CAST(min(updated_at) AS DATE) AS TIMESTAMP) + INTERVAL 10 DAY FROM articles)"


@register("incremental_window", with_ctes(f"""
    SELECT {_S1} FROM articles WHERE updated_at >= {_WIN_SINCE} AND updated_at < {_WIN_UNTIL}""", "articles"))
def q_incremental_window(spark, sf):
    """Window [watermark, extraction time) of one run.  The bounds reach the
    driver as one row and are applied as literals, as a run does with its
    watermark."""
    art = fx.articles(spark, sf)
    row = art.agg(F.to_date(F.min("updated_at")).cast("timestamp_ntz").alias("d")).first()
    since = row["d"] + dt.timedelta(days=7)
    until = row["d"] + dt.timedelta(days=10)
    return extract_window(art, since, until).select(*S1_COLS)


# --- scorecards, drift, scorecard serving -----------------------------------


_MART = "run_at, data_source, table_name, completeness, accuracy, consistency, timeliness, validity, uniqueness, overall_score"

_WHOLE = {
    "batched_all": (["articles"], "SELECT *, DATE '2000-01-01' AS batch, CAST(length(content) AS BIGINT) AS content_length FROM articles"),
    "cleaned_all": (["batched_all"], _CTES["cleaned"][1].replace("FROM batched)", "FROM batched_all)")),
    "sc_counts_all": (["batched_all", "cleaned_all"],
                      _CTES["sc_counts"][1].replace("FROM batched ", "FROM batched_all ")
                      .replace("FROM cleaned ", "FROM cleaned_all ")),
    "sc_int_all": (["sc_counts_all"], _CTES["sc_int"][1].replace("FROM sc_counts", "FROM sc_counts_all")),
}


@register("dq_scorecard", with_ctes(
    _CTES["scorecards"][1].replace("CAST(batch AS TIMESTAMP) + INTERVAL 1 DAY AS run_at",
                                   "(SELECT max(updated_at) FROM articles) AS run_at")
    .replace("FROM sc_int", "FROM sc_int_all"), "sc_int_all", extra=_WHOLE))
def q_dq_scorecard(spark, sf):
    """One scorecard over the whole table as a single run (run_at = newest
    update), including the NULL-aware distinct id count."""
    art = fx.articles(spark, sf)
    return scorecard(art, allow=fx.FIXTURE_CATEGORIES, tie=F.col("seq"),
                     run_at=art.select(F.max("updated_at")).scalar())


_ANOMALY_SQL = """
    SELECT run_at, data_source, table_name, row_count, completeness, accuracy, consistency, timeliness,
           validity, uniqueness, overall_score, history_points,
           round(CASE WHEN history_points < 5 OR lo = hi THEN 0.0 ELSE (overall_score - mu) / sd END, 6) AS z_score,
           CASE WHEN history_points < 5 THEN false WHEN lo = hi THEN overall_score <> hi
                ELSE abs((overall_score - mu) / sd) >= 2.0 END AS is_anomaly
    FROM (SELECT *, count(overall_score) OVER w AS history_points, avg(overall_score) OVER w AS mu,
                 stddev_samp(overall_score) OVER w AS sd, min(overall_score) OVER w AS lo,
                 max(overall_score) OVER w AS hi
          FROM scorecards WHERE overall_score IS NOT NULL
          WINDOW w AS (PARTITION BY table_name ORDER BY run_at ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))"""


@register("dq_anomaly_zscore", with_ctes(_ANOMALY_SQL, "scorecards"))
def q_dq_anomaly_zscore(spark, sf):
    return drift(M.Warehouse(spark, sf).scorecards)


@register("dq_latest", with_ctes(f"SELECT {_MART} FROM scorecards ORDER BY run_at DESC LIMIT 1", "scorecards"))
def q_dq_latest(spark, sf):
    return V.dq_history(M.Warehouse(spark, sf).mart_dq_scorecard, 1)


@register("dq_history", with_ctes(f"SELECT {_MART} FROM scorecards ORDER BY run_at DESC LIMIT 10", "scorecards"))
def q_dq_history(spark, sf):
    return V.dq_history(M.Warehouse(spark, sf).mart_dq_scorecard, 10)


@register("dq_trend", with_ctes("SELECT run_at, overall_score, CAST(0.85 AS DOUBLE) AS goal FROM scorecards ORDER BY run_at",
                                "scorecards"))
def q_dq_trend(spark, sf):
    return V.dq_trend(M.Warehouse(spark, sf).mart_dq_scorecard)


@register("dq_breakdown", with_ctes(" UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {d} AS score FROM latest" for d in
    ["completeness", "accuracy", "consistency", "timeliness", "validity", "uniqueness"]),
    "latest", extra={"latest": (["scorecards"], "SELECT * FROM scorecards ORDER BY run_at DESC LIMIT 1")}))
def q_dq_breakdown(spark, sf):
    return V.dq_breakdown(M.Warehouse(spark, sf).mart_dq_scorecard)


# --- serving and reports --------------------------------------------------------

_PAGE = "article_id, title, category, author_id, date_day, content_length"


@register("articles_page", with_ctes(f"""
    SELECT {_PAGE}, (SELECT count(*) FROM fct) AS total FROM fct
    ORDER BY date_day DESC NULLS FIRST, article_id LIMIT 20 OFFSET 40""", "fct"))
def q_articles_page(spark, sf):
    page, total = V.articles_page(M.Warehouse(spark, sf).fct, limit=20, offset=40)
    return page.withColumn("total", total.select("total").scalar())


@register("articles_page_category", with_ctes(f"""
    SELECT {_PAGE}, (SELECT count(*) FROM fct WHERE category = 'view') AS total FROM fct
    WHERE category = 'view' ORDER BY date_day DESC NULLS FIRST, article_id LIMIT 20 OFFSET 20""", "fct"))
def q_articles_page_category(spark, sf):
    page, total = V.articles_page(M.Warehouse(spark, sf).fct, limit=20, offset=20, category="view")
    return page.withColumn("total", total.select("total").scalar())


@register("article_by_id", with_ctes(
    f"SELECT {_PAGE} FROM fct WHERE article_id = (SELECT max(doc_id) FROM documents)", "fct"))
def q_article_by_id(spark, sf):
    """Point lookup by a literal key (here the highest document id, read
    from one column of one table), as the API passes it."""
    key = TB.load(spark, sf, "documents").agg(F.max("doc_id")).first()[0]
    return V.by_key(M.Warehouse(spark, sf).fct, "article_id", key).select(*V.PAGE_COLUMNS)


@register("author_by_id", with_ctes(
    "SELECT * FROM dim_author WHERE author_id = (SELECT max(user_id) FROM events)", "dim_author"))
def q_author_by_id(spark, sf):
    key = TB.load(spark, sf, "events").agg(F.max("user_id")).first()[0]
    return V.by_key(M.Warehouse(spark, sf).dim_author, "author_id", key)


@register("category_totals", with_ctes("SELECT category, count(*) AS n_articles FROM fct GROUP BY category", "fct"))
def q_category_totals(spark, sf):
    return V.category_totals(M.Warehouse(spark, sf).fct)


_LABEL = "CASE WHEN coalesce(category, '') = '' THEN '(tanpa kategori)' ELSE category END"


@register("batch_counts", with_ctes(f"""
    SELECT batch, {_LABEL} AS category, count(*) AS n_articles FROM raw GROUP BY batch, {_LABEL}""", "raw"))
def q_batch_counts(spark, sf):
    return V.batch_counts(M.Warehouse(spark, sf).raw, ["batch"])


@register("scrape_report", with_ctes(f"""
    SELECT r.*, s.batch_total, s.grand_total FROM rep r,
           (SELECT CAST(sum(batch_count) AS BIGINT) AS batch_total, CAST(sum(total_count) AS BIGINT) AS grand_total FROM rep) s""", "rep", extra={
    "rep": (["raw", "fct"], f"""
        SELECT coalesce(b.category, t.category) AS category, coalesce(b.batch_count, 0) AS batch_count,
               coalesce(t.total_count, 0) AS total_count
        FROM (SELECT {_LABEL} AS category, count(*) AS batch_count FROM raw
              WHERE batch = (SELECT max(batch) FROM raw) GROUP BY 1) b
        FULL OUTER JOIN (SELECT {_LABEL} AS category, count(*) AS total_count FROM fct GROUP BY 1) t
        ON b.category = t.category""")}))
def q_scrape_report(spark, sf):
    """Latest run's loaded rows per category next to the all-time totals."""
    wh = M.Warehouse(spark, sf)
    last = wh.raw.select(F.max("batch")).scalar()
    return V.scrape_report(wh.raw.filter(F.col("batch") == last), wh.fct)


@register("articles_over_time", with_ctes("""
    SELECT 'day' AS grain, date_day AS bucket, count(*) AS n_articles FROM fct GROUP BY date_day
    UNION ALL SELECT 'week', CAST(date_trunc('week', date_day) AS DATE), count(*) FROM fct GROUP BY 2
    UNION ALL SELECT 'month', CAST(date_trunc('month', date_day) AS DATE), count(*) FROM fct GROUP BY 2""", "fct"))
def q_articles_over_time(spark, sf):
    return V.articles_over_time(M.Warehouse(spark, sf).fct)


@register("star_join_rollup", with_ctes("""
    SELECT d.year, d.month, count(*) AS n_articles, CAST(sum(f.content_length) AS BIGINT) AS total_length,
           count(DISTINCT f.author_id) AS n_authors, count(a.author_name) AS named_articles,
           CAST(grouping(d.year, d.month) AS INTEGER) AS level
    FROM fct f JOIN dim_date d ON f.date_day = d.date_day
    LEFT JOIN dim_author a ON f.author_id = a.author_id
    GROUP BY ROLLUP (d.year, d.month)""", "fct", "dim_date", "dim_author"))
def q_star_join_rollup(spark, sf):
    wh = M.Warehouse(spark, sf)
    path = _scratch(spark, "star")
    wh.deduped.drop("content").write.parquet(path)      # read by the facts and both dimensions
    wh.deduped = spark.read.parquet(path)
    return V.star_join_rollup(wh.fct, wh.dim_author, wh.dim_date)


# --- data tests ---------------------------------------------------------------


_UNIQUE_TARGETS = [("stg_articles", "stg", "article_id"), ("fct_articles", "fct", "article_id"),
                   ("dim_author", "dim_author", "author_id"), ("dim_date", "dim_date", "date_day")]
_NOT_NULL_TARGETS = [("stg_articles", "stg", "article_id", "article_id"),
                     ("stg_articles", "stg", "title", "article_id"),
                     ("stg_articles", "stg", "published_at", "article_id"),
                     ("fct_articles", "fct", "article_id", "article_id"),
                     ("fct_articles", "fct", "author_id", "article_id"),
                     ("fct_articles", "fct", "date_day", "article_id"),
                     ("dim_author", "dim_author", "author_id", "author_id"),
                     ("dim_date", "dim_date", "date_day", "date_day")]
_REL_TARGETS = [("fct_articles", "fct", "author_id", "dim_author", "author_id"),
                ("fct_articles", "fct", "date_day", "dim_date", "date_day"),
                ("stg_articles", "stg", "author_id", "dim_author", "author_id")]
_VALID_SQL = ("'nasional', 'ekonomi', 'olahraga', 'teknologi', 'hiburan', 'woman', 'mom', 'otomotif', 'food-travel', 'bolanita'")


def _models(wh: M.Warehouse) -> dict[str, DataFrame]:
    return {"stg": wh.stg, "fct": wh.fct, "dim_author": wh.dim_author, "dim_date": wh.dim_date}


def _union(dfs):
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def _unique_sql(model, cte, col):
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, CAST({col} AS VARCHAR) AS unique_field, "
            f"count(*) AS n_records FROM {cte} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1")


def _not_null_sql(model, cte, col, key):
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, CAST({key} AS VARCHAR) AS failing_key "
            f"FROM {cte} WHERE {col} IS NULL")


def _rel_sql(model, cte, col, pcte, field):
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, CAST(c.{col} AS VARCHAR) AS from_field "
            f"FROM {cte} c WHERE c.{col} IS NOT NULL AND c.{col} NOT IN "
            f"(SELECT {field} FROM {pcte} WHERE {field} IS NOT NULL)")


_ALL_MODELS = ("stg", "fct", "dim_author", "dim_date")


@register("check_unique", with_ctes(" UNION ALL ".join(_unique_sql(*t) for t in _UNIQUE_TARGETS), *_ALL_MODELS))
def q_check_unique(spark, sf):
    m = _models(M.Warehouse(spark, sf))
    return _union([CK.check_unique(m[cte], col).select(
        F.lit(model).alias("model"), F.lit(col).alias("column_name"),
        F.col("unique_field").cast("string").alias("unique_field"), "n_records")
        for model, cte, col in _UNIQUE_TARGETS])


@register("check_not_null", with_ctes(" UNION ALL ".join(_not_null_sql(*t) for t in _NOT_NULL_TARGETS),
                                      *_ALL_MODELS))
def q_check_not_null(spark, sf):
    m = _models(M.Warehouse(spark, sf))
    return _union([CK.check_not_null(m[cte], col).select(
        F.lit(model).alias("model"), F.lit(col).alias("column_name"),
        F.col(key).cast("string").alias("failing_key"))
        for model, cte, col, key in _NOT_NULL_TARGETS])


@register("check_accepted_values", with_ctes(f"""
    SELECT category AS value_field, count(*) AS n_records FROM stg GROUP BY category
    HAVING category NOT IN ({_VALID_SQL})""", "stg"))
def q_check_accepted_values(spark, sf):
    return CK.check_accepted_values(M.Warehouse(spark, sf).stg, "category", S.VALID_CATEGORIES)


@register("check_relationships", with_ctes(" UNION ALL ".join(_rel_sql(*t) for t in _REL_TARGETS), *_ALL_MODELS))
def q_check_relationships(spark, sf):
    m = _models(M.Warehouse(spark, sf))
    return _union([CK.check_relationships(m[cte], col, m[pcte], field).select(
        F.lit(model).alias("model"), F.lit(col).alias("column_name"),
        F.col("from_field").cast("string").alias("from_field"))
        for model, cte, col, pcte, field in _REL_TARGETS])


_AS_OF_FUTURE = "(SELECT max(published_at) - INTERVAL 1 DAY FROM deduped)"


@register("check_no_future", with_ctes(
    f"SELECT article_id, published_at FROM deduped WHERE published_at > {_AS_OF_FUTURE}", "deduped"))
def q_check_no_future(spark, sf):
    d = M.Warehouse(spark, sf).deduped
    return CK.check_no_future(d, d.select(F.max("published_at") - F.expr("INTERVAL 1 DAY")).scalar())


@register("check_dq_threshold", with_ctes(f"""
    SELECT {_MART} FROM scorecards WHERE run_at = (SELECT max(run_at) FROM scorecards) AND overall_score < 0.85""",
                                          "scorecards"))
def q_check_dq_threshold(spark, sf):
    return CK.check_dq_threshold(M.Warehouse(spark, sf).mart_dq_scorecard)


_FRESH = """
    SELECT max_loaded_at, as_of, age_hours,
           CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN age_hours > 6 THEN 'error'
                WHEN age_hours > 2 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT max(_loaded_at) AS max_loaded_at, max(_loaded_at) + INTERVAL 3 HOUR AS as_of,
                 CAST(date_diff('microsecond', max(_loaded_at), max(_loaded_at) + INTERVAL 3 HOUR) AS DOUBLE)
                 / 3600000000.0 AS age_hours
          FROM raw)"""


@register("check_freshness", with_ctes(_FRESH, "raw"))
def q_check_freshness(spark, sf):
    raw = M.Warehouse(spark, sf).raw
    return CK.check_freshness(raw, raw.select(F.max("_loaded_at") + F.expr("INTERVAL 3 HOURS")).scalar())


def _summary_checks(wh: M.Warehouse) -> list:
    m = _models(wh)
    sev_unique = {"stg_articles": "warn"}
    out = []
    for model, cte, col in _UNIQUE_TARGETS:
        out.append(CK.Check("unique", model, col, sev_unique.get(model, "error"), CK.check_unique(m[cte], col)))
    for model, cte, col, _key in _NOT_NULL_TARGETS:
        out.append(CK.not_null(model, m[cte], col))
    out.append(CK.Check("accepted_values", "stg_articles", "category", "warn",
                        CK.check_accepted_values(m["stg"], "category", S.VALID_CATEGORIES)))
    for model, cte, col, pcte, field in _REL_TARGETS[:2]:
        out.append(CK.Check("relationships", model, col, "error",
                            CK.check_relationships(m[cte], col, m[pcte], field)))
    d = wh.deduped
    out.append(CK.Check("no_future_published", "int_articles_deduped", "published_at", "error",
                        CK.check_no_future(d, d.select(F.max("published_at") - F.expr("INTERVAL 1 DAY")).scalar())))
    out.append(CK.Check("dq_score_above_threshold", "mart_dq_scorecard", "overall_score", "error",
                        CK.check_dq_threshold(wh.mart_dq_scorecard)))
    raw = wh.raw
    out.append(CK.Check("freshness", "articles_raw", "_loaded_at", "error",
                        CK.check_freshness(raw, raw.select(F.max("_loaded_at") + F.expr("INTERVAL 3 HOURS")).scalar())))
    return out


def _summary_sql() -> str:
    def row(name, model, col, sev, count_sql):
        fail = "fail" if sev == "error" else "warn"
        return (f"SELECT '{name}' AS check_name, '{model}' AS model, '{col}' AS column_name, '{sev}' AS severity, "
                f"n AS failures, CASE WHEN n = 0 THEN 'pass' ELSE '{fail}' END AS status "
                f"FROM (SELECT count(*) AS n FROM ({count_sql}))")
    parts = []
    for model, cte, col in _UNIQUE_TARGETS:
        parts.append(row("unique", model, col, "warn" if model == "stg_articles" else "error",
                         _unique_sql(model, cte, col)))
    for model, cte, col, key in _NOT_NULL_TARGETS:
        parts.append(row("not_null", model, col, "error", _not_null_sql(model, cte, col, key)))
    parts.append(row("accepted_values", "stg_articles", "category", "warn",
                     f"SELECT category FROM stg GROUP BY category HAVING category NOT IN ({_VALID_SQL})"))
    for t in _REL_TARGETS[:2]:
        parts.append(row("relationships", t[0], t[2], "error", _rel_sql(*t)))
    parts.append(row("no_future_published", "int_articles_deduped", "published_at", "error",
                     f"SELECT article_id FROM deduped WHERE published_at > {_AS_OF_FUTURE}"))
    parts.append(row("dq_score_above_threshold", "mart_dq_scorecard", "overall_score", "error",
                     "SELECT * FROM scorecards WHERE run_at = (SELECT max(run_at) FROM scorecards) "
                     "AND overall_score < 0.85"))
    parts.append("SELECT 'freshness' AS check_name, 'articles_raw' AS model, '_loaded_at' AS column_name, "
                 "'error' AS severity, CAST(CASE WHEN status = 'pass' THEN 0 ELSE 1 END AS BIGINT) AS failures, "
                 "CASE WHEN status = 'error' THEN 'fail' ELSE status END AS status "
                 f"FROM ({_FRESH})")
    return " UNION ALL ".join(parts)


@register("check_summary", with_ctes(_summary_sql(), *_ALL_MODELS, "deduped", "scorecards", "raw"))
def q_check_summary(spark, sf):
    """All data tests as one table.  Staging (without the text, whose length
    it carries) and the deduplicated model are written once, the tests run on
    the written tables."""
    wh = M.Warehouse(spark, sf)
    root = _scratch(spark, "summary")

    def put(name, df):
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    wh.stg = put("stg", wh.stg.withColumn("content", F.lit(None).cast("string")))
    wh.deduped = put("deduped", wh.deduped)
    return CK.summarize(_summary_checks(wh))


# --- history (SCD2) ---------------------------------------------------------------


_SNAP = "article_id, title, category, author_id, updated_at"
_HIST = _SNAP + ", valid_from, valid_to, is_current"
_SCD2_CTES = {
    "versions": (["articles"], "SELECT id AS article_id, title, category, author_id, updated_at, seq FROM articles"),
    "scd2_open": (["versions"], """
        SELECT article_id, title, category, author_id, updated_at, seq FROM (
            SELECT *, lag(title) OVER w AS pt, lag(category) OVER w AS pc, row_number() OVER w AS rn
            FROM versions WINDOW w AS (PARTITION BY article_id ORDER BY updated_at ASC NULLS FIRST, seq))
        WHERE rn = 1 OR pt IS DISTINCT FROM title OR pc IS DISTINCT FROM category"""),
    "scd2": (["scd2_open"], """
        SELECT article_id, title, category, author_id, updated_at, updated_at AS valid_from,
               lead(updated_at) OVER w AS valid_to, lead(updated_at) OVER w IS NULL AS is_current
        FROM scd2_open WINDOW w AS (PARTITION BY article_id ORDER BY updated_at ASC NULLS FIRST, seq)"""),
}


def _scd2_history(spark, sf) -> DataFrame:
    art = fx.articles(spark, sf)
    versions = art.select(F.col("id").alias("article_id"), "title", "category", "author_id", "updated_at", "seq")
    # day buckets: lag/lead per (article, day), edges stitched per article
    hist = H.scd2_rebuild(versions, "article_id", ["title", "category"], ["updated_at", "seq"],
                          bucket=F.to_date("updated_at"))
    return hist.drop("seq")


@register("scd2_rebuild", with_ctes(f"SELECT {_HIST} FROM scd2", "scd2", extra=_SCD2_CTES))
def q_scd2_rebuild(spark, sf):
    """History on (title, category) rebuilt from every stored version."""
    return _scd2_history(spark, sf)


@register("scd2_current", with_ctes(f"SELECT {_HIST} FROM scd2 WHERE valid_to IS NULL", "scd2", extra=_SCD2_CTES))
def q_scd2_current(spark, sf):
    return H.scd2_current(_scd2_history(spark, sf))


_AS_OF_SCD2 = "(SELECT max(updated_at) - INTERVAL 10 DAY FROM articles)"


@register("scd2_as_of", with_ctes(f"""
    SELECT {_HIST} FROM scd2 WHERE valid_from <= {_AS_OF_SCD2}
       AND (valid_to IS NULL OR valid_to > {_AS_OF_SCD2})""", "scd2", extra=_SCD2_CTES))
def q_scd2_as_of(spark, sf):
    art = fx.articles(spark, sf)
    at = art.select(F.max("updated_at") - F.expr("INTERVAL 10 DAYS")).scalar()
    return H.scd2_as_of(_scd2_history(spark, sf), at)


def _snap_sql(cut: str) -> str:
    return f"""
        SELECT {_SNAP} FROM (
            SELECT id AS article_id, title || ' v' || CAST(seq % 2 AS VARCHAR) AS title, category, author_id,
                   updated_at, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS FIRST, seq DESC) AS rn
            FROM articles WHERE updated_at < {cut}) WHERE rn = 1"""


_CUT1 = "(SELECT max(updated_at) - INTERVAL 14 DAY FROM articles)"
_CUT2 = "(SELECT max(updated_at) - INTERVAL 7 DAY FROM articles)"


@register("scd2_incremental", with_ctes(f"""
    SELECT * FROM h1 WHERE valid_to IS NOT NULL
    UNION ALL
    SELECT h_id, h_title, h_category, h_author_id, h_updated_at, h_valid_from,
           CASE WHEN changed THEN {_CUT2} ELSE h_valid_to END, CASE WHEN changed THEN false ELSE h_is_current END
    FROM j WHERE h_id IS NOT NULL
    UNION ALL
    SELECT s_id, s_title, s_category, s_author_id, s_updated_at, {_CUT2}, CAST(NULL AS TIMESTAMP), true
    FROM j WHERE s_id IS NOT NULL AND (changed OR h_id IS NULL)""", "h1", "j", extra={
    "s1": (["articles"], _snap_sql(_CUT1)),
    "s2": (["articles"], _snap_sql(_CUT2)),
    "h1": (["s1"], f"SELECT {_SNAP}, {_CUT1} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, "
                   "true AS is_current FROM s1"),
    "j": (["h1", "s2"], """
        SELECT h.article_id AS h_id, h.title AS h_title, h.category AS h_category, h.author_id AS h_author_id,
               h.updated_at AS h_updated_at, h.valid_from AS h_valid_from, h.valid_to AS h_valid_to,
               h.is_current AS h_is_current, s.article_id AS s_id, s.title AS s_title, s.category AS s_category,
               s.author_id AS s_author_id, s.updated_at AS s_updated_at,
               (h.article_id IS NOT NULL AND s.article_id IS NOT NULL AND
                (h.title IS DISTINCT FROM s.title OR h.category IS DISTINCT FROM s.category)) AS changed
        FROM (SELECT * FROM h1 WHERE valid_to IS NULL) h FULL OUTER JOIN s2 s ON h.article_id = s.article_id"""),
}))
def q_scd2_incremental(spark, sf):
    """Two snapshot runs (strategy check on title, category): the first
    opens every row, the second closes changed rows and opens new ones."""
    art = fx.articles(spark, sf)
    vmax = art.select(F.max("updated_at")).scalar()
    cut1, cut2 = vmax - F.expr("INTERVAL 14 DAYS"), vmax - F.expr("INTERVAL 7 DAYS")
    order = [F.col("updated_at").desc_nulls_first(), F.col("seq").desc()]
    versions = art.select(F.col("id").alias("article_id"),
                          F.concat(F.col("title"), F.lit(" v"), (F.col("seq") % 2).cast("string")).alias("title"),
                          "category", "author_id", "updated_at", "seq")

    def snapshot(cut):
        return latest_per_key(versions.filter(F.col("updated_at") < cut), ["article_id"], order).drop("seq")

    h1 = H.scd2_init(snapshot(cut1), cut1)
    return H.scd2_merge(h1, snapshot(cut2), "article_id", ["title", "category"], cut2)


# --- feed payloads ---------------------------------------------------------------


_FEED_COLS = ("feed_id, page, pos, id, title, content, author_id, author_name, category, published_at, "
              "created_at, updated_at, deleted_at")
# The SQL states the fixed values itself, so a wrong one in the code shows.
_INGEST = ("WHEN '1' THEN 'nasional' WHEN '2' THEN 'hiburan' WHEN '3' THEN 'woman' WHEN '4' THEN 'mom' WHEN '5' THEN 'olahraga' "
           "WHEN '6' THEN 'teknologi' WHEN '7' THEN 'otomotif' WHEN '8' THEN 'food-travel' WHEN '9' THEN 'bolanita' "
           "WHEN '10' THEN 'ekonomi' ELSE 'UNKNOWN' END")
_ALT = ("WHEN '1' THEN 'news' WHEN '2' THEN 'entertainment' WHEN '3' THEN 'woman' WHEN '4' THEN 'mom' WHEN '5' THEN 'bola-sports' "
        "WHEN '6' THEN 'tekno-sains' WHEN '7' THEN 'otomotif' WHEN '8' THEN 'food-travel' WHEN '9' THEN 'bolanita' "
        "WHEN '10' THEN 'bisnis' ELSE 'other' END")
_AGE = ("CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 18 THEN '<18' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' "
        "WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' ELSE '55+' END")
_TIER = ("CASE WHEN followers IS NULL THEN 'nano' WHEN followers < 10000 THEN 'nano' WHEN followers < 100000 THEN 'micro' "
         "WHEN followers < 500000 THEN 'mid' WHEN followers < 1000000 THEN 'macro' ELSE 'mega' END")
_CHANNEL_CASE = f"CASE CAST(seq % 12 AS VARCHAR) {_INGEST}"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _safe(x: str, n: int) -> str:
    return f"nullif(left({_strip(x)}, {n}), '')"


_FEED_CTES = {
    "payload": (["articles"], f"""
        SELECT rnk // {fx.PAGE_SIZE} // {fx.PAGES_PER_FEED} AS feed_id, (rnk // {fx.PAGE_SIZE}) % {fx.PAGES_PER_FEED} AS page,
               CAST(rnk % {fx.PAGE_SIZE} AS INTEGER) AS pos, id,
               {_safe('title', 500)} AS title,
               nullif(concat_ws(chr(10) || chr(10), {_safe('content', 2000)}, {_safe('title', 1000)}), '') AS content,
               author_id, {_safe('author_name', 200)} AS author_name,
               CASE WHEN category <> 'error' THEN category ELSE {_CHANNEL_CASE} END AS category,
               published_at, coalesce(CASE WHEN seq % 11 <> 0 THEN created_at END, published_at) AS created_at,
               updated_at, deleted_at
        FROM (SELECT *, (SELECT max(seq) FROM articles) - seq AS rnk FROM articles) WHERE seq % 37 <> 0"""),
    "first_seen": (["payload"], f"""
        SELECT {_FEED_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY feed_id, id ORDER BY page, pos) AS rn
                                  FROM payload) WHERE rn = 1"""),
}


def _pages(spark, sf) -> DataFrame:
    return P.fixture_pages(fx.versions(spark, sf), fx.texts(spark, sf), fx.text_parts(spark, sf))


@register("payload_flatten", with_ctes(f"SELECT {_FEED_COLS} FROM payload", "payload", extra=_FEED_CTES))
def q_payload_flatten(spark, sf):
    """Feed pages built with to_json from the article versions, parsed back
    with from_json + posexplode and mapped to the flat article schema."""
    return P.flatten_pages(_pages(spark, sf))


@register("feed_first_seen", with_ctes(f"SELECT {_FEED_COLS} FROM first_seen", "first_seen", extra=_FEED_CTES))
def q_feed_first_seen(spark, sf):
    return P.first_seen(P.flatten_pages(_pages(spark, sf)))


@register("feed_take_while", with_ctes(f"""
    SELECT {_FEED_COLS} FROM (
        SELECT *, max(CASE WHEN published_at < since THEN 1 ELSE 0 END) OVER (
                      PARTITION BY feed_id ORDER BY page, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped
        FROM (SELECT *, min(published_at) OVER (PARTITION BY feed_id) + INTERVAL 1 DAY AS since FROM first_seen))
    WHERE stopped = 0""", "first_seen", extra=_FEED_CTES))
def q_feed_take_while(spark, sf):
    """Each scrape run stops at its first story published before the run's
    watermark (here: a day after the run's oldest story)."""
    rows = P.first_seen(P.flatten_pages(_pages(spark, sf)))
    since = F.min("published_at").over(Window.partitionBy("feed_id")) + F.expr("INTERVAL 1 DAY")
    return P.take_while_recent(rows.withColumn("__since", since), F.col("__since")).drop("__since")


# --- scalar helpers ---------------------------------------------------------------


_HELPER_CTES = {"helper_inputs": ([], fx.helper_inputs_sql())}


@register("channel_category_ingest", with_ctes(f"""
    SELECT event_id, channel_id, channel_slug,
           CASE WHEN coalesce(channel_slug, '') <> '' THEN channel_slug
                ELSE CASE coalesce(channel_id, '') {_INGEST} END AS category
    FROM helper_inputs""", "helper_inputs", extra=_HELPER_CTES))
def q_channel_category_ingest(spark, sf):
    h = fx.helper_inputs(spark, sf)
    return h.select("event_id", "channel_id", "channel_slug",
                    FN.channel_to_category("channel_id", "channel_slug").alias("category"))


@register("channel_category_alt", with_ctes(f"""
    SELECT event_id, channel_id, channel_slug,
           CASE WHEN coalesce(channel_slug, '') <> '' THEN channel_slug
                ELSE CASE coalesce(channel_id, '') {_ALT} END AS category
    FROM helper_inputs""", "helper_inputs", extra=_HELPER_CTES))
def q_channel_category_alt(spark, sf):
    h = fx.helper_inputs(spark, sf)
    return h.select("event_id", "channel_id", "channel_slug",
                    FN.channel_to_category("channel_id", "channel_slug", S.ALT_CHANNEL_MAP,
                                           S.ALT_CHANNEL_DEFAULT).alias("category"))


@register("age_group", with_ctes(
    f"SELECT event_id, age, {_AGE} AS age_group "
    "FROM helper_inputs", "helper_inputs", extra=_HELPER_CTES))
def q_age_group(spark, sf):
    return fx.helper_inputs(spark, sf).select("event_id", "age", FN.age_group("age").alias("age_group"))


@register("follower_tier", with_ctes(
    f"SELECT event_id, followers, {_TIER} "
    "AS follower_tier FROM helper_inputs", "helper_inputs", extra=_HELPER_CTES))
def q_follower_tier(spark, sf):
    return fx.helper_inputs(spark, sf).select("event_id", "followers",
                                              FN.follower_tier("followers").alias("follower_tier"))


@register("edu_level", with_ctes(
    "SELECT event_id, edu, CAST(CASE edu WHEN 'SMA' THEN 1 WHEN 'D3' THEN 2 WHEN 'S1' THEN 3 WHEN 'S2' THEN 4 WHEN 'S3' THEN 5 "
    "ELSE 0 END AS INTEGER) AS edu_level FROM helper_inputs", "helper_inputs", extra=_HELPER_CTES))
def q_edu_level(spark, sf):
    return fx.helper_inputs(spark, sf).select("event_id", "edu", FN.edu_level("edu").alias("edu_level"))


@register("device_class", with_ctes("""
    SELECT event_id, device,
           CASE WHEN coalesce(device, '') = '' THEN 'unknown' WHEN contains(lower(device), 'mobile') THEN 'mobile'
                WHEN contains(lower(device), 'tablet') THEN 'tablet' ELSE 'desktop' END AS device_class
    FROM helper_inputs""", "helper_inputs", extra=_HELPER_CTES))
def q_device_class(spark, sf):
    return fx.helper_inputs(spark, sf).select("event_id", "device", FN.device_class("device").alias("device_class"))


# --- storage round trips and the streaming hop ----------------------------------


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, "gazette", f"{name}-{uuid.uuid4().hex}", fallback="/tmp/gazette-checkpoints")


@register("parquet_roundtrip", with_ctes("SELECT * FROM cleaned", "cleaned"))
def q_parquet_roundtrip(spark, sf):
    """Cleaned rows written with overwrite and scanned back with the
    explicit schema."""
    cleaned = M.Warehouse(spark, sf).cleaned
    path = _scratch(spark, "cleaned")
    TB.write_parquet(cleaned.sortWithinPartitions("id"), path)      # copies of a text stand together
    return TB.read_parquet(spark, path, cleaned.schema)


@register("landing_partition_scan", with_ctes("""
    SELECT strftime(CAST(batch AS TIMESTAMP) + INTERVAL 1 DAY, '%Y-%m-%d') AS dt,
           CAST(batch AS TIMESTAMP) + INTERVAL 1 DAY AS run_ts, count(*) AS rows
    FROM batched GROUP BY batch""", "batched"))
def q_landing_partition_scan(spark, sf):
    """Every daily run landed under dt=YYYY-MM-DD with its run timestamp,
    then listed from partition values and file metadata."""
    wh = M.Warehouse(spark, sf)
    root = _scratch(spark, "landing")
    run_ts = F.col("batch").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    TB.write_landing(wh.batched.select(*S1_COLS, "batch"), root, run_ts, within=["id"])
    runs = TB.list_runs(spark, root, S.ARTICLE)
    return runs.groupBy("dt", "run_ts").agg(F.sum("rows").alias("rows"))


@register("raw_table_append", with_ctes("SELECT * FROM raw", "raw"))
def q_raw_table_append(spark, sf):
    """Raw rows appended to a table in two loads (earlier and later runs)
    and read back: the table holds the sum of the loads."""
    raw = M.Warehouse(spark, sf).raw
    path = _scratch(spark, "articles_raw")
    with freed_shuffles(spark):
        # the chain runs once for both loads and the cut; copies of a text stand together, in the loads too
        TB.write_parquet(raw.sortWithinPartitions("id"), f"{path}-given")
        raw = TB.read_parquet(spark, f"{path}-given", raw.schema)
        mid = raw.select(F.min("batch") + F.expr("INTERVAL 15 DAYS")).scalar()
        TB.write_parquet(raw.filter(F.col("batch") < mid), path, "append")
        TB.write_parquet(raw.filter(F.col("batch") >= mid), path, "append")
    return TB.read_parquet(spark, path, raw.schema)


@register("scorecard_append", with_ctes("SELECT * FROM scorecards", "scorecards"))
def q_scorecard_append(spark, sf):
    """Daily scorecards appended as JSON in two loads and read back with
    the scorecard schema (the hand-off format between jobs)."""
    sc = M.Warehouse(spark, sf).scorecards
    path = _scratch(spark, "dq_scorecard")
    mid = sc.select(F.min("run_at") + F.expr("INTERVAL 15 DAYS")).scalar()
    sc.filter(F.col("run_at") < mid).write.mode("append").json(path)
    sc.filter(F.col("run_at") >= mid).write.mode("append").json(path)
    return TB.read_json(spark, path, S.SCORECARD)


@register("stream_clean_available_now", with_ctes("SELECT * FROM cleaned", "cleaned"))
def q_stream_clean_available_now(spark, sf):
    """Landing files -> readStream -> availableNow trigger -> foreachBatch
    clean per (run, id) -> sink; the result equals the batch clean."""
    wh = M.Warehouse(spark, sf)
    root = _scratch(spark, "stream")
    landing = f"{root}/landing"
    src = wh.landed().select("seq", *S1_COLS, "batch", "content_length")
    schema = src.schema
    with freed_shuffles(spark):
        # a run lies in several files, a micro-batch takes some of them
        TB.write_parquet(src, landing, "append", ["batch"])
        run_available_now(spark, landing, schema, f"{root}/sink", f"{root}/_checkpoint", allow=fx.FIXTURE_CATEGORIES,
                          keys=["batch", "id"], order=wh.survivor_order, max_files=40, wide=["title", "content"])
        return read_cleaned(spark, f"{root}/sink", wh.cleaned.schema, ["batch", "id"], wh.survivor_order, wide=["title", "content"])


# --- one incremental run end to end, drift alerts ---------------------------------


@register("incremental_run", with_ctes(f"""
    SELECT {_S1} FROM articles WHERE updated_at >= {_WIN_SINCE} AND updated_at < {_WIN_UNTIL}""", "articles"))
def q_incremental_run(spark, sf):
    """I3 against a stored source table: read the watermark from state,
    extract [watermark, extraction time) with the bounds pushed to the
    Parquet scan, land the rows under dt=, then publish the advanced
    state.  Returns the landed rows read back from the lake."""
    art = fx.articles(spark, sf)
    root = _scratch(spark, "incremental")
    art.select(*S1_COLS).write.parquet(f"{root}/source")
    source = TB.read_parquet(spark, f"{root}/source", S.ARTICLE)
    day0 = art.agg(F.to_date(F.min("updated_at")).cast("timestamp_ntz").alias("d")).first()["d"]
    state = MG.state_log(spark.createDataFrame(
        [("articles_etl_hourly", day0 + dt.timedelta(days=7))],
        "pipeline_name string, last_updated_at timestamp_ntz"))
    until = day0 + dt.timedelta(days=10)
    rows, new_state, _since = incremental_extract(source, state, "articles_etl_hourly", until)
    TB.write_landing(rows, f"{root}/landing", run_ts=until)
    publish(new_state, f"{root}/state")          # only after the landing write
    assert read_current(spark, f"{root}/state") is not None
    return TB.read_lake(spark, f"{root}/landing", S.ARTICLE).select(*S1_COLS)


@register("dq_drift_alerts", with_ctes(
    f"SELECT run_at, table_name, overall_score, z_score, history_points FROM ({_ANOMALY_SQL}) WHERE is_anomaly",
    "scorecards"))
def q_dq_drift_alerts(spark, sf):
    return drift_alerts(M.Warehouse(spark, sf).scorecards)


@register("mart_dq_scorecard", with_ctes(f"SELECT {_MART} FROM scorecards", "scorecards"))
def q_mart_dq_scorecard(spark, sf):
    return M.Warehouse(spark, sf).mart_dq_scorecard


_KEYSET_AFTER = """(SELECT date_day, article_id FROM fct
                    ORDER BY date_day DESC NULLS FIRST, article_id LIMIT 1 OFFSET 19)"""


@register("articles_page_keyset", with_ctes(f"""
    SELECT {_PAGE} FROM fct
    WHERE date_day < (SELECT date_day FROM k)
       OR (date_day = (SELECT date_day FROM k) AND article_id > (SELECT article_id FROM k))
    ORDER BY date_day DESC NULLS FIRST, article_id LIMIT 20""", "fct", "k",
    extra={"k": (["fct"], _KEYSET_AFTER)}))
def q_articles_page_keyset(spark, sf):
    """Second page by keyset: the rows after the first page's last row."""
    fct = M.Warehouse(spark, sf).fct
    first, _total = V.articles_page(fct, limit=20, offset=0)
    last = first.orderBy(*[c for c in reversed_page_order()]).limit(1).first()
    return V.articles_after(fct, last["date_day"], last["article_id"], limit=20)


def reversed_page_order():
    return [F.col("date_day").asc_nulls_last(), F.col("article_id").desc_nulls_first()]


from gazette.plans import catalog_edge  # noqa: E402,F401 - registers more queries
