"""The scheduled jobs over a lake in a temp folder: two hourly runs, hard
deletes, a scrape upsert; marts equal a one-shot computation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gazette import schemas as S
from gazette.operators.dedupe import latest_per_key
from gazette.operators.incremental import read_watermark
from gazette.plans import jobs
from gazette.plans.jobs import Lake, _source, _state, build_models, delete_articles, hourly_run, save_source, scrape_run, snapshot_run
from gazette.sources import fixtures as fx
from gazette.sources import payload as P
from gazette.sources import versioned


def test_hourly_runs_deletes_and_scrape(spark, sf, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    art = fx.articles(spark, sf)
    b = art.agg(F.min("updated_at").alias("lo"), F.max("updated_at").alias("hi")).first()
    t1 = dt.datetime.combine(b.lo.date(), dt.time()) + dt.timedelta(days=10)
    t2 = (b.hi + dt.timedelta(hours=1)).replace(microsecond=0)
    newest = [F.col("updated_at").desc_nulls_first()]

    def source_at(t):
        """The source table (one row per id) as it stood at time t."""
        snap = latest_per_key(art.filter(F.col("updated_at") < t), ["id"], newest)
        save_source(snap.select(*S.ARTICLE_COLUMNS), lake)
        return _source(spark, lake)

    r1 = hourly_run(spark, lake, source_at(t1), t1, allow=fx.FIXTURE_CATEGORIES)
    source = source_at(t2)
    r2 = hourly_run(spark, lake, source, t2, allow=fx.FIXTURE_CATEGORIES)
    assert r1.landed and r2.landed and r2.since == t1
    assert not hourly_run(spark, lake, source, t2, allow=fx.FIXTURE_CATEGORIES).landed   # empty window

    m = build_models(spark, lake)
    # raw holds one row per (run, id); the fact table is the latest version of every id
    latest = latest_per_key(art, ["id"], newest)
    assert m.raw.count() == (art.filter(F.col("updated_at") < t1).select("id").distinct().count()
                             + latest.filter(F.col("updated_at") >= t1).count())
    assert m.fct.count() == latest.count()
    assert m.fct.select("article_id").exceptAll(latest.select("id")).count() == 0
    assert m.scorecards.count() == 2

    # hard deletes: gone from the source, logged once, excluded from the marts
    gone = art.select("id").distinct().filter(F.col("id") % 25 == 0)
    delete_articles(spark, lake, gone, t2)
    delete_articles(spark, lake, gone, t2 + dt.timedelta(days=1))      # first delete wins
    log = jobs.read_delete_log(spark, lake)
    assert log.count() == gone.count() and log.filter(F.col("deleted_at") != F.lit(t2)).count() == 0
    m = build_models(spark, lake)
    assert m.fct.count() == latest.count() - gone.count()

    # scrape: feed pages upserted into the source; the scraper watermark moves
    pages = P.fixture_pages(art)
    assert scrape_run(spark, lake, pages) == 1
    src = _source(spark, lake)
    assert src.count() == art.select("id").distinct().count()
    assert read_watermark(_state(spark, lake, "feed_scraper"), "feed_scraper") > dt.datetime(2016, 1, 1)
    assert read_watermark(_state(spark, lake, "articles_etl_hourly"), "articles_etl_hourly") == t2

    # marts from the stored tables go through write-audit-publish
    from gazette.plans.publish import read_mart, write_audit_publish
    res = write_audit_publish(m, lake.marts, as_of=F.lit(t2).cast("timestamp_ntz"),
                              blocking={"unique", "relationships"})
    assert res.published
    assert read_mart(spark, lake.marts, "fct_articles").exceptAll(m.fct).count() == 0


def small_source(spark, n, day, extra=0):
    t = dt.datetime(2024, 1, day)
    rows = [(i, f"t{i} v{day}", "text", 1, "a", "click", t, t, t + dt.timedelta(minutes=i + extra), None) for i in range(n)]
    return spark.createDataFrame(rows, S.ARTICLE)


@pytest.mark.parametrize("broken", ["run_clean", "write_landing:1", "write_landing:2", "_save_state", "_save_state:1", "write_landing:0"])
def test_a_run_that_died_is_completed_by_the_next(spark, tmp_path, monkeypatch, broken):
    """A failure after any write loses nothing and doubles nothing."""
    lake, source = Lake(str(tmp_path / "lake")), small_source(spark, 40, 3)
    t1, t2 = dt.datetime(2024, 1, 4), dt.datetime(2024, 1, 5)
    name, _, at = broken.partition(":")
    owner = jobs.TB if name == "write_landing" else jobs
    real, calls = getattr(owner, name), []

    def dies(*a, **k):
        calls.append(1)
        if not at or len(calls) == int(at) + 1:
            raise RuntimeError("executor lost")
        return real(*a, **k)

    monkeypatch.setattr(owner, name, dies)
    with pytest.raises(RuntimeError, match="executor lost"):
        hourly_run(spark, lake, source, t1, allow=fx.FIXTURE_CATEGORIES)
    monkeypatch.setattr(owner, name, real)
    later = source.unionByName(small_source(spark, 5, 4))
    res = hourly_run(spark, lake, later, t2, allow=fx.FIXTURE_CATEGORIES)
    assert res.landed and jobs.pending_runs(spark, lake) == []
    m = build_models(spark, lake)
    assert m.fct.count() == 40 and m.scorecards.count() == len(res.loaded)
    # no row loads twice; a run that died before its landing leaves one window for both
    assert m.raw.count() == (40 if broken == "_save_state" else 45)
    assert m.stg.filter("title like '%v4'").count() == 5
    assert not hourly_run(spark, lake, later, t2, allow=fx.FIXTURE_CATEGORIES).loaded


def test_snapshot_history_persists(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    cols = "article_id long, title string, category string, author_id long, updated_at timestamp_ntz"
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    snapshot_run(spark, lake, spark.createDataFrame([(1, "a", "x", 7, t[0]), (2, "b", None, 7, t[0])], cols), t[0])
    second = spark.createDataFrame([(1, "a2", "x", 7, t[1]), (2, "b", None, 8, t[1]), (3, "c", "x", 9, t[1])], cols)
    for _ in range(2):      # a repeated run adds nothing
        h = snapshot_run(spark, lake, second, t[1])
        got = sorted((r.article_id, r.title, r.valid_from, r.valid_to, r.is_current) for r in h.collect())
        assert got == [(1, "a", t[0], t[1], False), (1, "a2", t[1], None, True), (2, "b", t[0], None, True), (3, "c", t[1], None, True)]


def test_unreadable_state_is_not_missing_state(spark, tmp_path):
    assert versioned.read_current(spark, str(tmp_path / "nothing")) is None
    with pytest.raises(Exception) as e:
        versioned.read_current(spark, "nosuchfs://host/table")
    assert "PATH_NOT_FOUND" not in str(e.value)


def test_scrape_without_publish_times_keeps_the_watermark(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    page = '{"data":{"FindAllActiveHeadlines":{"edges":[{"story":{"id":"%d","title":"x","publishedAt":%s}}]}}}'
    pages = lambda i, at: spark.createDataFrame([(1, 0, page % (i, at))], "feed_id long, page long, payload string")
    assert scrape_run(spark, lake, pages(1, '"2024-02-01T00:00:00"')) == 1
    assert scrape_run(spark, lake, pages(2, "null")) == 1
    assert read_watermark(_state(spark, lake, "feed_scraper"), "feed_scraper") == dt.datetime(2024, 2, 1)
    assert sorted(r.id for r in _source(spark, lake).collect()) == [1, 2]
    assert scrape_run(spark, lake, spark.createDataFrame([(1, 0, "{")], "feed_id long, page long, payload string")) == 0
