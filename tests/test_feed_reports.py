"""Payload flattening, feed cut-off and the scrape report."""

import datetime as dt
import json

from pyspark.sql import functions as F

from gazette.plans import serving as V
from gazette.sources import payload as P


def page(edges):
    return json.dumps({"data": {"FindAllActiveHeadlines": {"edges": edges}}})


def story(i, published, **kw):
    s = {"id": str(i), "title": f"  t{i}  ", "leadText": "lead", "metaDescription": "meta",
         "author": {"id": "7", "name": "Ann"}, "channel": {"id": "5", "slug": None},
         "publishedAt": published, "createdAt": None, "updatedAt": None, "deletedAt": None}
    s.update(kw)
    return {"story": s}


def test_flatten_and_cut(spark):
    edges = [story(1, "2026-01-15T10:00:00Z"), {"story": None}, story(1, "2026-01-15T09:00:00Z"),
             story(2, "2026-01-14T10:00:00Z"), story(3, "2026-01-15T11:00:00Z")]
    pages = spark.createDataFrame([(0, 0, page(edges))], "feed_id long, page long, payload string")
    rows = P.flatten_pages(pages)
    first = rows.orderBy("pos").first()
    assert (first.id, first.title, first.content, first.category) == (1, "t1", "lead\n\nmeta", "olahraga")
    assert first.created_at == first.published_at == dt.datetime(2026, 1, 15, 10)
    assert rows.count() == 4                                    # the empty edge is dropped
    seen = P.first_seen(rows)
    assert seen.count() == 3                                    # repeated id kept once
    since = F.lit(dt.datetime(2026, 1, 15)).cast("timestamp_ntz")
    kept = P.take_while_recent(seen, since)
    assert [r.id for r in kept.orderBy("pos").collect()] == [1]  # stops at id 2, never reaches id 3


def test_scrape_report(spark):
    batch = spark.createDataFrame([("news",)] * 3 + [("sport",)] + [(None,)], "category string")
    fct = spark.createDataFrame([("news",)] * 100 + [("sport",)] * 50, "category string")
    rows = V.scrape_report(batch, fct).collect()
    by = {r.category: (r.batch_count, r.total_count) for r in rows}
    assert by == {"news": (3, 100), "sport": (1, 50), "(tanpa kategori)": (1, 0)}
    assert (rows[0].batch_total, rows[0].grand_total) == (5, 150)
    empty = spark.createDataFrame([], "category string")
    assert V.scrape_report(empty, empty).count() == 0


def test_feed_ends_at_unreadable_or_empty_page(spark):
    """A cut-off page, an error page and an empty page end their feed and are
    told apart; pages behind them are not read."""
    good = lambda i: page([story(i, "2026-01-15T10:00:00Z")])
    rows = [(0, 0, good(1)), (0, 1, good(2)[:50]), (0, 2, good(3)),
            (1, 0, good(4)), (1, 1, '{"error": "unavailable"}'), (1, 2, good(5)),
            (2, 0, good(6)), (2, 1, page([])), (2, 2, good(7)),
            (3, 0, good(8)), (3, 1, good(9)), (4, 0, None), (4, 1, good(10))]
    pages = spark.createDataFrame(rows, "feed_id long, page long, payload string")
    assert sorted(r.id for r in P.flatten_feed(pages).collect()) == [1, 4, 6, 8, 9]
    got = {r.feed_id: (r.n_pages, r.n_rejected, r.end_page) for r in P.payload_rejects(pages).collect()}
    assert got == {0: (3, 1, 1), 1: (3, 1, 1), 2: (3, 0, 1), 3: (2, 0, None), 4: (2, 1, 0)}
