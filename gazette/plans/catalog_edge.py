"""Registered queries on NULLs, bad input and storage jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette import functions as FN
from gazette import schemas as S
from gazette.operators import checks as CK
from gazette.operators import merge as MG
from gazette.operators import scd2 as H
from gazette.operators.dedupe import latest_per_key
from gazette.operators.drift import drift_alerts
from gazette.plans import incremental_models as IM
from gazette.plans import jobs as J
from gazette.plans import models as M
from gazette.plans import publish as PB
from gazette.plans import serving as V
from gazette.plans.catalog import (_ALL_MODELS, _ANOMALY_SQL, _AS_OF_FUTURE, _CUT1, _CUT2, _CUT_UPSERT, _FEED_CTES, _HIST, _MART, _PAGE, _S1, _SNAP, _WIN_SINCE, _WIN_UNTIL, ORACLE, S1_COLS,
                                   _pages, _scratch, _summary_sql, register, reversed_page_order)
from gazette.plans.oracle import with_ctes
from gazette.session import freed_shuffles
from gazette.sources import fixtures as fx
from gazette.sources import payload as P
from gazette.sources import tables as TB
from gazette.streaming import available_now as AN

# --- paging, history and upsert with NULLs ---------------------------------------

_NULL_DAYS = ("SELECT article_id, author_id, CASE WHEN article_id % 5 = 1 THEN NULL ELSE date_day END AS date_day, "
              "category, content_length, title FROM fct")


@register("articles_page_keyset_null_days", with_ctes(f"""
    SELECT {_PAGE} FROM f, k
    WHERE CASE WHEN k.d IS NULL THEN f.date_day IS NOT NULL OR f.article_id > k.i
               ELSE f.date_day < k.d OR (f.date_day = k.d AND f.article_id > k.i) END
    ORDER BY date_day DESC NULLS FIRST, article_id LIMIT 200""", "f", "k", extra={
    "f": (["fct"], _NULL_DAYS),
    "k": (["f"], "SELECT date_day AS d, article_id AS i FROM f ORDER BY date_day DESC NULLS FIRST, article_id LIMIT 1 OFFSET 9")}))
def q_keyset_null_days(spark, sf):
    """Keyset page after a row whose day is unknown (every fifth id has none)."""
    fct = M.Warehouse(spark, sf).fct
    fct = fct.withColumn("date_day", F.when(F.col("article_id") % 5 != 1, F.col("date_day")))
    first, _total = V.articles_page(fct, limit=10, offset=0)
    last = first.orderBy(*reversed_page_order()).limit(1).first()
    return V.articles_after(fct, last["date_day"], last["article_id"], limit=200)


_NULL_TIMES = """SELECT CASE WHEN id % 40 = 7 THEN NULL ELSE id END AS article_id, title || ' v' || CAST(seq % 3 AS VARCHAR) AS title,
                        category, author_id, CASE WHEN seq % 6 = 1 THEN NULL ELSE updated_at END AS updated_at, seq FROM articles"""


@register("scd2_rebuild_null_times", with_ctes(f"""
    SELECT {_SNAP}, updated_at AS valid_from,
           first_value(updated_at IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS valid_to,
           row_number() OVER w = count(*) OVER (PARTITION BY article_id) AS is_current
    FROM (SELECT * FROM (SELECT *, lag(title) OVER w AS pt, lag(category) OVER w AS pc, row_number() OVER w AS rn
                         FROM v WINDOW w AS (PARTITION BY article_id ORDER BY updated_at ASC NULLS FIRST, seq))
          WHERE rn = 1 OR pt IS DISTINCT FROM title OR pc IS DISTINCT FROM category)
    WINDOW w AS (PARTITION BY article_id ORDER BY updated_at ASC NULLS FIRST, seq)""", "v", extra={"v": (["articles"], _NULL_TIMES)}))
def q_scd2_null_times(spark, sf):
    """Bucketed history where ids and times may be unknown."""
    art = fx.articles(spark, sf)
    versions = art.select(F.when(F.col("id") % 40 != 7, F.col("id")).alias("article_id"),
                          F.concat("title", F.lit(" v"), (F.col("seq") % 3).cast("string")).alias("title"), "category", "author_id",
                          F.when(F.col("seq") % 6 != 1, F.col("updated_at")).alias("updated_at"), "seq")
    hist = H.scd2_rebuild(versions, "article_id", ["title", "category"], ["updated_at", "seq"], bucket=F.to_date("updated_at"))
    return hist.drop("seq")


@register("source_upsert_extra_column", ORACLE["source_upsert"].replace(
    "SELECT coalesce(u.id, t.id) AS id,", "SELECT coalesce(u.id, t.id) AS id, t.id * 10 AS extra,", 1))
def q_upsert_extra(spark, sf):
    """The upsert into a source with a column that the feed does not have."""
    art = fx.articles(spark, sf)
    cut = art.select(F.max("updated_at") - F.expr("INTERVAL 7 DAYS")).scalar()
    order = [F.col("updated_at").desc_nulls_first(), F.col("seq").desc()]
    target = latest_per_key(art.filter(F.col("updated_at") < cut), ["id"], order).select(*S1_COLS, (F.col("id") * 10).alias("extra"))
    return MG.merge_upsert(target, art.filter(F.col("updated_at") >= cut).select(*S1_COLS, "seq"), "id", J.UPDATE_COLUMNS, order=order)


@register("top_authors_offset", with_ctes("""
    SELECT * FROM dim_author ORDER BY total_articles DESC, author_id ASC NULLS LAST LIMIT 10 OFFSET 20""", "dim_author"))
def q_top_authors_offset(spark, sf):
    return V.top_authors(M.Warehouse(spark, sf).dim_author, limit=10, offset=20)


# --- gates and alerts that fire ---------------------------------------------------

@register("check_dq_threshold_strict", with_ctes(f"""
    SELECT {_MART} FROM scorecards WHERE run_at = (SELECT max(run_at) FROM scorecards) AND overall_score < 0.999""", "scorecards"))
def q_threshold_strict(spark, sf):
    """The gate at 0.999, which the fixture's last run fails."""
    return CK.check_dq_threshold(M.Warehouse(spark, sf).mart_dq_scorecard, threshold=0.999)


_DROPPED = ("SELECT * REPLACE (CASE WHEN run_at = (SELECT max(run_at) FROM scorecards) THEN overall_score - 0.3 ELSE overall_score END "
            "AS overall_score) FROM scorecards")


@register("dq_drift_alerts_after_drop", with_ctes(
    f"SELECT run_at, table_name, overall_score, z_score, history_points FROM ({_ANOMALY_SQL.replace('FROM scorecards WHERE', 'FROM dropped WHERE')}) "
    "WHERE is_anomaly", "dropped", extra={"dropped": (["scorecards"], _DROPPED)}))
def q_alerts_after_drop(spark, sf):
    """Drift alerts when the last run scores 0.3 lower."""
    sc = M.Warehouse(spark, sf).scorecards
    last = sc.select(F.max("run_at")).scalar()
    return drift_alerts(sc.withColumn("overall_score", F.when(F.col("run_at") == last, F.col("overall_score") - 0.3).otherwise(F.col("overall_score"))))


# --- bad input ---------------------------------------------------------------------

INT_INPUTS = ["7", " 42 ", "4.7", "", "seven", "-3", "9223372036854775808", None, "1e3", "+5"]
DATE_INPUTS = ["2024-02-29T12:30:00Z", "2023-02-29T12:30:00", "2024-03-01 08:15", "2024-03-01T08:15:30.25+0700", "soon", "", None, "2024-13-01",
               "20240301", "2024-03-01T25:00:00"]
TEXT_INPUTS = ["  two  words ", "\n", "line\nbreak", " edge ", None, "", "a longer piece of text"]
_INTS = ["7", "42", None, None, None, "-3", None, None, None, "5"]
_DATES = ["2024-02-29 12:30:00", None, "2024-03-01 08:15:00", "2024-03-01 08:15:30.25", None, None, None, None, None, None]
_TEXTS = ["two  words", None, "line\nbreak", "edge", None, None, "a longer p"]


def _pick_sql(values: list, kind: str) -> str:
    """The expected values, literal by literal."""
    lit = lambda v: "NULL" if v is None else f"CAST('{v}' AS {kind})"
    return f"CAST(CASE event_id % {len(values)} " + " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values)) + f" END AS {kind})"


@register("parse_helpers_bad_input", f"""
    SELECT event_id, {_pick_sql(_INTS, 'BIGINT')} AS as_int, {_pick_sql(_DATES, 'TIMESTAMP')} AS as_time,
           {_pick_sql(_TEXTS, 'VARCHAR')} AS as_text FROM events""")
def q_parse_bad_input(spark, sf):
    """Integers, dates with offsets and texts, good and bad, one a row."""
    eid = F.col("event_id")
    return TB.load(spark, sf, "events").select(
        "event_id", FN.safe_int(fx._pick(eid, INT_INPUTS)).alias("as_int"), FN.parse_dt(fx._pick(eid, DATE_INPUTS)).alias("as_time"),
        FN.safe_str(fx._pick(eid, TEXT_INPUTS), 10).alias("as_text"))


@register("payload_rejects", with_ctes(f"""
    SELECT feed_id, n_pages, CASE WHEN feed_id % 3 = 2 THEN 0 WHEN n_pages > 3 THEN 1 ELSE 0 END AS n_rejected,
           CASE WHEN n_pages > 3 THEN 3 END AS end_page
    FROM (SELECT feed_id, count(*) AS n_pages FROM pages_ GROUP BY feed_id)""", "pages_", extra={"pages_": (["articles"], f"""
        SELECT DISTINCT rnk // {fx.PAGE_SIZE} // {fx.PAGES_PER_FEED} AS feed_id, (rnk // {fx.PAGE_SIZE}) % {fx.PAGES_PER_FEED} AS page
        FROM (SELECT (SELECT max(seq) FROM articles) - seq AS rnk FROM articles)""")}))
def q_payload_rejects(spark, sf):
    """Page 3 of every feed is cut off, an error page, or empty in turn."""
    return P.payload_rejects(spoiled_pages(spark, sf))


def spoiled_pages(spark, sf) -> DataFrame:
    pages = _pages(spark, sf)
    kind = F.col("feed_id") % 3
    bad = (F.when(kind == 0, F.substring("payload", 1, 40)).when(kind == 1, F.lit('{"error": "unavailable"}'))
           .otherwise(F.lit('{"data": {"FindAllActiveHeadlines": {"edges": []}}}')))
    return pages.withColumn("payload", F.when(F.col("page") == 3, bad).otherwise(F.col("payload")))


@register("null_typed_files", with_ctes(f"""
    SELECT {_S1.replace('deleted_at', "CASE WHEN seq % 2 = 0 THEN deleted_at END AS deleted_at")} FROM articles""", "articles"))
def q_null_typed_files(spark, sf):
    """A landing folder where half the files declare the all-NULL column as an integer."""
    art = fx.articles(spark, sf).select("seq", *S1_COLS)
    art = art.coalesce(fx.text_parts(spark, sf, 8 * fx.ROWS_PER_TASK)).sortWithinPartitions("id")    # copies of a text stand together
    root = _scratch(spark, "loose")
    with freed_shuffles(spark):
        TB.write_parquet(art.filter("seq % 2 = 0").drop("seq"), root)
        TB.write_parquet(art.filter("seq % 2 <> 0").drop("seq").withColumn("deleted_at", F.lit(None).cast("int")), root, "append")
    return TB.read_loose(spark, root, S.ARTICLE).select(*S1_COLS)


# --- jobs over storage ---------------------------------------------------------------

def _stored_source(spark, sf, root: str) -> DataFrame:
    fx.articles(spark, sf).select(*S1_COLS).write.parquet(f"{root}/given")
    return TB.read_parquet(spark, f"{root}/given", S.ARTICLE)


_REPLAY = f"""
    SELECT {_S1.replace("title,", "trim(regexp_replace(title, '\\\\s+', ' ', 'g')) AS title,").replace("category,", "CASE WHEN category <> 'error' THEN category END AS category,")}
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS FIRST, seq DESC) AS rn FROM articles
          WHERE updated_at >= {_WIN_SINCE} AND updated_at < {_WIN_UNTIL}) WHERE rn = 1"""


def _replayed_lake(spark, sf) -> J.Lake:
    """A landed run whose load died, completed by a later, empty run."""
    root = _scratch(spark, "replay")
    art = fx.articles(spark, sf)
    newest = [F.col("updated_at").desc_nulls_first(), F.col("seq").desc()]
    day0 = art.agg(F.to_date(F.min("updated_at")).cast("timestamp_ntz").alias("d")).first()["d"]
    since, until = day0 + dt.timedelta(days=7), day0 + dt.timedelta(days=10)
    window = art.filter((F.col("updated_at") >= F.lit(since)) & (F.col("updated_at") < F.lit(until)))
    latest_per_key(window, ["id"], newest).select(*S1_COLS).write.parquet(f"{root}/given")
    source = TB.read_parquet(spark, f"{root}/given", S.ARTICLE)
    lake = J.Lake(f"{root}/lake")
    # what a run leaves that dies right after it moved the watermark
    TB.write_landing(source, lake.landing, until)
    state = spark.createDataFrame([("articles_etl_hourly", until, until)], S.WATERMARK)
    J._save_state(state, lake, "articles_etl_hourly")
    res = J.hourly_run(spark, lake, source, until + dt.timedelta(hours=1), allow=fx.FIXTURE_CATEGORIES)
    assert not res.landed and res.loaded == (until,)
    return lake


@register("hourly_replay", with_ctes(_REPLAY, "articles"))
def q_hourly_replay(spark, sf):
    """Raw rows of a landed run that an hourly run with an empty window found unloaded."""
    return TB.read_lake(spark, _replayed_lake(spark, sf).raw, J.RAW_SCHEMA).select(*S1_COLS)


@register("cleaned_copy", with_ctes(_REPLAY, "articles"))
def q_cleaned_copy(spark, sf):
    """The run's cleaned copy in the lake."""
    return TB.read_lake(spark, _replayed_lake(spark, sf).cleaned, S.ARTICLE).select(*S1_COLS)


@register("scd2_snapshot_job", ORACLE["scd2_incremental"])
def q_scd2_snapshot_job(spark, sf):
    """Two snapshot runs through the stored history."""
    art = fx.articles(spark, sf)
    lake = J.Lake(_scratch(spark, "snapshots"))
    top = art.agg(F.max("updated_at")).first()[0]
    order = [F.col("updated_at").desc_nulls_first(), F.col("seq").desc()]
    versions = art.select(F.col("id").alias("article_id"), F.concat(F.col("title"), F.lit(" v"), (F.col("seq") % 2).cast("string")).alias("title"),
                          "category", "author_id", "updated_at", "seq")
    for days in (14, 7):
        at = top - dt.timedelta(days=days)
        history = J.snapshot_run(spark, lake, latest_per_key(versions.filter(F.col("updated_at") < F.lit(at)), ["article_id"], order), at)
    return history


@register("tables_set_up", with_ctes("SELECT article_id, date_day, category FROM fct", "fct"))
def q_tables_set_up(spark, sf):
    """Facts appended to a table that the idempotent set-up created twice,
    then read through a view model and a table model."""
    root = _scratch(spark, "tables")
    name = "setup_" + root.rsplit("-", 1)[-1]
    fct = M.Warehouse(spark, sf).fct.select("article_id", "date_day", "category")
    for _ in range(2):
        TB.ensure_tables(spark, root, {name: fct.schema}, database="gazette_setup")
    fct.write.mode("append").insertInto(f"gazette_setup.{name}")
    staged = TB.materialize(spark.table(f"gazette_setup.{name}"), f"{name}_view")
    out = TB.materialize(staged, f"{name}_table", kind="table", path=f"{root}/model")
    spark.sql(f"DROP TABLE gazette_setup.{name}")
    return out


def _upserted_sql(target: str, updates: str) -> str:
    """Rows ``updates`` upserted into ``target``: published_at and created_at stay as first stored."""
    kept = ("published_at", "created_at")
    cols = ", ".join(f"CASE WHEN t.id IS NOT NULL THEN t.{c} ELSE u.{c} END AS {c}" if c in kept else
                     f"CASE WHEN u.id IS NOT NULL THEN u.{c} ELSE t.{c} END AS {c}" for c in S1_COLS if c != "id")
    return f"SELECT coalesce(u.id, t.id) AS id, {cols} FROM ({target}) t FULL OUTER JOIN ({updates}) u ON t.id = u.id"


def _last_in_feed(parity: int) -> str:
    return f"""SELECT {_S1} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY feed_id DESC, page DESC, pos DESC) AS last
                                  FROM first_seen WHERE feed_id % 2 = {parity}) WHERE last = 1"""


@register("scrape_upsert_job", with_ctes(_upserted_sql(_last_in_feed(0), _last_in_feed(1)), "first_seen", extra=_FEED_CTES))
def q_scrape_upsert_job(spark, sf):
    """The even feeds' pages, then the odd ones', upserted into the source
    table: the last story of an id wins, published_at and created_at stay as
    the first scrape stored them."""
    root = _scratch(spark, "scrape")
    lake = J.Lake(f"{root}/lake")
    with freed_shuffles(spark):
        TB.write_parquet(_pages(spark, sf), f"{root}/pages")
        pages = spark.read.parquet(f"{root}/pages")
        for parity, pipeline in enumerate(("even", "odd")):
            J.scrape_run(spark, lake, pages.filter(F.col("feed_id") % 2 == parity), pipeline=pipeline)
    return J._source(spark, lake).select(*S1_COLS)


_LATEST_WHERE = """SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS FIRST, seq DESC) AS rn
                                       FROM articles WHERE {cond}) WHERE rn = 1"""


@register("source_upsert_concurrent", with_ctes(_upserted_sql(
    _LATEST_WHERE.format(cols=_S1, cond=f"updated_at < {_CUT_UPSERT} AND id % 10 <> 3"),
    _LATEST_WHERE.format(cols=_S1, cond=f"updated_at >= {_CUT_UPSERT}")), "articles"))
def q_source_upsert_concurrent(spark, sf):
    """An upsert that has read the source table when a delete commits: it
    starts again on what the delete left, so neither is lost."""
    art = fx.articles(spark, sf)
    lake = J.Lake(_scratch(spark, "concurrent"))
    cut = art.agg(F.max("updated_at")).first()[0] - dt.timedelta(days=7)
    order = [F.col("updated_at").desc_nulls_first(), F.col("seq").desc()]
    table = J.source_table(lake)
    J.save_source(latest_per_key(art.filter(F.col("updated_at") < F.lit(cut)), ["id"], order).select(*S1_COLS), lake)
    updates = J.staged_rows(art.filter(F.col("updated_at") >= F.lit(cut)).select(*S1_COLS, "seq").sortWithinPartitions("id"), table)
    tries = []

    def change(base):
        made = J.upsert_change(table, base, updates, order)
        if not tries:       # the other job, after this one read
            J.delete_articles(spark, lake, J._source(spark, lake).filter("id % 10 = 3").select("id"), cut)
        tries.append(base.number)
        return made

    table.update(spark, change)
    assert len(tries) == 2
    return J._source(spark, lake).select(*S1_COLS)


def _history_sql(key: str, cuts: list[str]) -> tuple[str, dict]:
    """History after a full snapshot at each cut: (name of the last step, CTEs)."""
    snap = f"""SELECT {_SNAP} FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY updated_at DESC NULLS FIRST, seq DESC) AS rn
        FROM (SELECT {key} AS article_id, title || ' v' || CAST(seq % 2 AS VARCHAR) AS title, category, author_id, updated_at, seq
              FROM articles WHERE updated_at < {{cut}})) WHERE rn = 1"""
    ctes = {"hist0": (["articles"], f"SELECT {_SNAP}, {cuts[0]} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current FROM ({snap.format(cut=cuts[0])})")}
    for k, cut in enumerate(cuts[1:], 1):
        ctes[f"step{k}"] = ([f"hist{k - 1}", "articles"], f"""
            SELECT h.*, s.article_id AS s_id, s.title AS s_title, s.category AS s_category, s.author_id AS s_author, s.updated_at AS s_updated,
                   h.valid_from IS NOT NULL AS stood, s.updated_at IS NOT NULL AS came, h.title IS DISTINCT FROM s.title OR h.category IS DISTINCT FROM s.category AS differs
            FROM (SELECT * FROM hist{k - 1} WHERE valid_to IS NULL) h FULL OUTER JOIN ({snap.format(cut=cut)}) s ON h.article_id IS NOT DISTINCT FROM s.article_id""")
        ctes[f"hist{k}"] = ([f"step{k}"], f"""
            SELECT {_HIST} FROM hist{k - 1} WHERE valid_to IS NOT NULL
            UNION ALL SELECT {_SNAP}, valid_from, CASE WHEN came AND differs THEN {cut} END, NOT (came AND differs) FROM step{k} WHERE stood
            UNION ALL SELECT s_id, s_title, s_category, s_author, s_updated, {cut}, CAST(NULL AS TIMESTAMP), true FROM step{k} WHERE came AND (differs OR NOT stood)""")
    return f"hist{len(cuts) - 1}", ctes


def _snapshot_runs(spark, sf, key):
    """Three snapshot runs; the second and third bring only what changed since the one before."""
    art = fx.articles(spark, sf)
    lake = J.Lake(_scratch(spark, "snapshots"))
    top = art.agg(F.max("updated_at")).first()[0]
    order = [F.col("updated_at").desc_nulls_first(), F.col("seq").desc()]
    versions = art.select(key.alias("article_id"), F.concat(F.col("title"), F.lit(" v"), (F.col("seq") % 2).cast("string")).alias("title"),
                          "category", "author_id", "updated_at", "seq")
    since = None
    for days in (14, 7, 2):
        at = top - dt.timedelta(days=days)
        now = versions.filter(F.col("updated_at") < F.lit(at))
        now = now if since is None else now.filter(F.col("updated_at") >= F.lit(since))
        history = J.snapshot_run(spark, lake, latest_per_key(now, ["article_id"], order), at)
        since = at
    return history


_CUT3 = "(SELECT max(updated_at) - INTERVAL 2 DAY FROM articles)"
_LAST, _STEPS = _history_sql("id", [_CUT1, _CUT2, _CUT3])
_NULL_KEY = "CASE WHEN id % 40 = 7 THEN NULL ELSE id END"
_LAST_NULL, _STEPS_NULL = _history_sql(_NULL_KEY, [_CUT1, _CUT2, _CUT3])


@register("scd2_snapshot_job_partial", with_ctes(f"SELECT * FROM {_LAST}", _LAST, extra=_STEPS))
def q_scd2_snapshot_job_partial(spark, sf):
    """Three snapshots through the stored history, two of them with changed
    articles alone; the SQL takes full snapshots."""
    return _snapshot_runs(spark, sf, F.col("id"))


@register("scd2_snapshot_null_keys", with_ctes(f"SELECT * FROM {_LAST_NULL}", _LAST_NULL, extra=_STEPS_NULL))
def q_scd2_snapshot_null_keys(spark, sf):
    """The same with articles whose id is unknown: NULL is one key, and its history stays."""
    return _snapshot_runs(spark, sf, F.when(F.col("id") % 40 != 7, F.col("id")))


_TWO_WINDOWS = f"""
    SELECT {_S1.replace("title,", "trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title,").replace("category,", "CASE WHEN category <> 'error' THEN category END AS category,")}
    FROM (SELECT *, row_number() OVER (PARTITION BY id, updated_at < {_WIN_UNTIL} - INTERVAL 1 DAY ORDER BY updated_at DESC NULLS FIRST, seq DESC) AS rn
          FROM articles WHERE updated_at >= {_WIN_SINCE} AND updated_at < {_WIN_UNTIL}) WHERE rn = 1"""


@register("hourly_crash_before_watermark", with_ctes(_TWO_WINDOWS, "articles"))
def q_hourly_crash_before_watermark(spark, sf):
    """Raw rows after a run that died between landing and watermark, and the
    next run: the dead run's window is landed again under its own name, so no
    row is loaded twice."""
    root = _scratch(spark, "crash")
    lake = J.Lake(f"{root}/lake")
    art = fx.articles(spark, sf)
    day0 = art.agg(F.to_date(F.min("updated_at")).cast("timestamp_ntz").alias("d")).first()["d"]
    since, dead, until = (day0 + dt.timedelta(days=d) for d in (7, 9, 10))
    window = art.filter((F.col("updated_at") >= F.lit(since)) & (F.col("updated_at") < F.lit(until))).withColumn("early", F.col("updated_at") < F.lit(dead))
    latest_per_key(window, ["id", "early"], [F.col("updated_at").desc_nulls_first(), F.col("seq").desc()]).select(*S1_COLS).write.parquet(f"{root}/given")
    source = TB.read_parquet(spark, f"{root}/given", S.ARTICLE)
    pipeline = "articles_etl_hourly"
    for name, ts in ((pipeline, since), (f"{pipeline}-planned", dead)):
        J._save_state(spark.createDataFrame([(name, ts, ts)], S.WATERMARK), lake, name)
    TB.write_landing(source.filter(F.col("updated_at") < F.lit(dead)), lake.landing, dead)
    res = J.hourly_run(spark, lake, source, until, allow=fx.FIXTURE_CATEGORIES)
    assert res.loaded == (dead, until)
    return TB.read_lake(spark, lake.raw, J.RAW_SCHEMA).select(*S1_COLS)


# --- models kept up to date from new runs ---------------------------------------------

def _incremental_lake(spark, sf) -> J.Lake:
    """The daily runs in three slices, each followed by a refresh; one early
    day lands late, half of the deletes are logged between refreshes."""
    root = _scratch(spark, "models")
    lake = J.Lake(f"{root}/lake")
    wh = M.Warehouse(spark, sf)
    # copies of a text stand together
    TB.write_parquet(TB.conform(wh.raw, J.RAW_SCHEMA).withColumn("batch", F.to_date("updated_at")).sortWithinPartitions("id"), f"{root}/given")
    given = spark.read.parquet(f"{root}/given")
    day0 = given.agg(F.min("batch")).first()[0]
    day = lambda k: F.lit(day0 + dt.timedelta(days=k))
    late = F.col("batch") == day(3)
    slices = [(F.col("batch") < day(12)) & ~late, (F.col("batch") >= day(12)) & (F.col("batch") < day(20)), (F.col("batch") >= day(20)) | late]
    at = wh.delete_log.first()["deleted_at"]
    for k, part in enumerate(slices):
        closes = F.to_date("updated_at").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")      # a run fires when its day closes
        TB.write_landing(given.filter(part).drop("batch"), lake.raw, closes)
        if k:
            J.log_deletes(spark, lake, given.filter((F.col("id") % 25 == 0) & (F.col("id") % 2 == k - 1)).select("id"), at)
        IM.refresh(spark, lake)
    assert IM.refresh(spark, lake) == []
    return lake


@register("articles_deduped_incremental", with_ctes("SELECT * FROM deduped", "deduped"))
def q_articles_deduped_incremental(spark, sf):
    """The deduplicated model after three incremental refreshes equals the full rebuild."""
    return IM.latest_model(spark, _incremental_lake(spark, sf))


@register("dim_author_incremental", with_ctes("SELECT * FROM dim_author", "dim_author"))
def q_dim_author_incremental(spark, sf):
    """The author dimension from counts with retraction."""
    return IM.dim_author(spark, _incremental_lake(spark, sf))


@register("category_totals_incremental", with_ctes("SELECT category, count(*) AS n_articles FROM fct GROUP BY category", "fct"))
def q_category_totals_incremental(spark, sf):
    return IM.category_totals(spark, _incremental_lake(spark, sf))


# --- stream scorecards, published lookups and pages -------------------------------------

@register("stream_scorecard_append", with_ctes("SELECT * FROM scorecards", "scorecards"))
def q_stream_scorecard_append(spark, sf):
    """Daily scorecards from a stream whose micro-batches hold parts of the
    runs; the epochs' counts are compacted between two starts of the stream."""
    wh = M.Warehouse(spark, sf)
    root = _scratch(spark, "stream-scores")
    columns = ["seq", *S1_COLS, "batch", "content_length"]
    schema = wh.batched.select(*columns).schema
    runs = [f for f in schema.fields if f.name == "batch"]
    state = AN.state_schema(runs, next(f for f in schema.fields if f.name == "id"))
    with freed_shuffles(spark):
        for half in (0, 1):     # every run comes in both halves
            TB.write_parquet(wh.landed(F.col("seq") % 2 == half).select(*columns), f"{root}/landing", "append", ["batch"])
            AN.run_available_now(spark, f"{root}/landing", schema, f"{root}/sink", f"{root}/_checkpoint", allow=fx.FIXTURE_CATEGORIES, keys=["batch", "id"],
                                 order=wh.survivor_order, max_files=30, state=f"{root}/state", run_keys=["batch"], tie=F.col("seq"), wide=["title", "content"])
            AN.compact(spark, f"{root}/state", state, AN.state_merge(["batch"]))
    scored = AN.read_scorecards(spark, f"{root}/state", state, ["batch"], F.col("batch").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))
    return scored.drop("batch")


def _published(spark, sf) -> str:
    """The fixture's marts, staged and published without the audit."""
    root = _scratch(spark, "published")
    path = PB.versioned.new_version(root)
    PB.stage_lookups(spark, path, PB.stage_models(M.Warehouse(spark, sf), path))
    PB.versioned.point(spark, root, path)
    return root


@register("author_by_id_stored", with_ctes(
    "SELECT * FROM dim_author WHERE author_id = (SELECT max(author_id) FROM dim_author)", "dim_author"))
def q_author_by_id_stored(spark, sf):
    """Point lookup in the published copy that is ordered by id."""
    root = _published(spark, sf)
    last = PB.read_mart(spark, root, "author_lookup").agg(F.max("author_id")).first()[0]
    return PB.lookup(spark, root, "author_lookup", last)


_STORED_AFTER = "SELECT date_day, article_id FROM fct ORDER BY date_day DESC NULLS FIRST, article_id LIMIT 1 OFFSET (SELECT count(*) // 2 FROM fct)"


@register("articles_page_keyset_stored", with_ctes(f"""
    SELECT {_PAGE} FROM fct, k WHERE fct.date_day < k.date_day OR (fct.date_day = k.date_day AND fct.article_id > k.article_id)
    ORDER BY fct.date_day DESC NULLS FIRST, fct.article_id LIMIT 50""".replace("date_day,", "fct.date_day,", 1).replace("article_id,", "fct.article_id,", 1),
    "fct", "k", extra={"k": (["fct"], _STORED_AFTER)}))
def q_articles_page_keyset_stored(spark, sf):
    """The page after the middle of the published facts, month by month."""
    root = _published(spark, sf)
    fct = PB.read_mart(spark, root, "fct_articles")
    half = fct.count() // 2
    last = fct.select("date_day", "article_id").orderBy(*V.page_order()).offset(half).limit(1).first()
    return PB.page_after_stored(spark, root, last["date_day"], last["article_id"], 50)


# --- checks counted by the publishing write, tables in buckets ----------------------------

#: The summary at a day before the newest load.
_PUBLISH_SQL = (_summary_sql().replace(_AS_OF_FUTURE, "(SELECT max(_loaded_at) - INTERVAL 1 DAY FROM raw)")
                .replace("max(_loaded_at) + INTERVAL 3 HOUR", "max(_loaded_at) - INTERVAL 24 HOUR"))


@register("publish_audit_counted", with_ctes(_PUBLISH_SQL, *_ALL_MODELS, "deduped", "scorecards", "raw"))
def q_publish_audit_counted(spark, sf):
    """Write-audit-publish: the summary of a publish whose row tests were
    counted by the writes (a day before the newest load)."""
    wh = M.Warehouse(spark, sf)
    newest = wh.raw.agg(F.max("_loaded_at") - F.expr("INTERVAL 1 DAY")).first()[0]
    return PB.write_audit_publish(wh, _scratch(spark, "audited"), F.lit(str(newest)).cast("timestamp_ntz")).summary


def _bucketed_lake(spark, sf) -> J.Lake:
    """Three syncs: all ids; without every fiftieth; without every 25th, and
    two ids that went before are back."""
    lake = J.Lake(_scratch(spark, "bucketed"))
    art = fx.articles(spark, sf).select("id")
    at = fx.snapshot_time(spark, sf)
    day = spark.range(1).select(at.cast("timestamp_ntz").alias("t")).first()["t"]
    J.delete_sync_bucketed(spark, lake, art, day - dt.timedelta(days=2))
    J.delete_sync_bucketed(spark, lake, art.filter(F.col("id") % 50 != 0), day - dt.timedelta(days=1))
    J.delete_sync_bucketed(spark, lake, art.filter((F.col("id") % 25 != 0) | F.col("id").isin(50, 100)), day)
    return lake


_BUCKETED_LOG = {"bucketed_log": (["articles"], """
    SELECT DISTINCT id AS article_id, (SELECT max(ts) FROM events) + CASE WHEN id % 50 = 0 THEN INTERVAL 0 DAY ELSE INTERVAL 1 DAY END AS deleted_at
    FROM articles WHERE id % 25 = 0""")}


@register("delete_sync_bucketed", with_ctes("SELECT * FROM bucketed_log", "bucketed_log", extra=_BUCKETED_LOG))
def q_delete_sync_bucketed(spark, sf):
    """The delete log after three snapshot diffs over bucketed ids: the first
    delete of an id wins, an id that comes back keeps it."""
    lake = _bucketed_lake(spark, sf)
    return J.BK.read_bucketed(spark, J._bucketed(lake, "delete_log"), S.ARTICLE_DELETED, "article_id")


_LATEST = "id, title, category, author_id, updated_at"


@register("tombstones_bucketed", with_ctes(f"""
    SELECT {_LATEST}, CASE WHEN l.article_id IS NOT NULL THEN l.deleted_at ELSE r.deleted_at END AS deleted_at,
           CASE WHEN l.article_id IS NOT NULL THEN true ELSE r.is_hard_deleted END AS is_hard_deleted
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, seq DESC) AS rn FROM raw) r
    LEFT JOIN bucketed_log l ON r.id = l.article_id WHERE rn = 1""", "raw", "bucketed_log", extra=_BUCKETED_LOG))
def q_tombstones_bucketed(spark, sf):
    """The newest version of every article with the bucketed log's tombstones."""
    raw = M.Warehouse(spark, sf).raw
    latest = latest_per_key(raw, ["id"], [F.col("updated_at").desc_nulls_last(), F.col("seq").desc()])
    return J.tombstones_bucketed(spark, _bucketed_lake(spark, sf), latest.select(*_LATEST.split(", "), "deleted_at", "is_hard_deleted"))
