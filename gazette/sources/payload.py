"""Nested feed payloads -> flat article rows.

A payload is one JSON page: data.FindAllActiveHeadlines.edges[].story.
Parsing is ``from_json`` with an explicit schema and ``posexplode`` of the
edges, so pages are processed in parallel with no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette import schemas as S
from gazette.functions.buckets import channel_to_category
from gazette.functions.parse import parse_dt, safe_int
from gazette.functions.text import join_nonempty, safe_str
from gazette.sources import fixtures as fx

EDGES = "data.FindAllActiveHeadlines.edges"


def flatten_pages(pages: DataFrame, payload: str = "payload",
                  keep: tuple[str, ...] = ("feed_id", "page")) -> DataFrame:
    """Parse each page and emit one row per edge with its position.

    Edges without a story are dropped; ids that do not parse are dropped;
    pages that do not parse have no edges (``page_status`` tells them).
    """
    parsed = pages.select(*keep, F.from_json(F.col(payload), S.FEED_PAGE).alias("p"))
    edges = parsed.select(*keep, F.posexplode_outer(F.col(f"p.{EDGES}")).alias("pos", "edge"))
    st = F.col("edge.story")
    lead = safe_str(st["leadText"], S.LEAD_MAX)
    meta = safe_str(st["metaDescription"], S.META_MAX)
    published = parse_dt(st["publishedAt"])
    rows = edges.filter(st.isNotNull()).select(
        *keep, "pos",
        safe_int(st["id"]).alias("id"),
        safe_str(st["title"], S.TITLE_MAX).alias("title"),
        join_nonempty(lead, meta).alias("content"),
        safe_int(st["author"]["id"]).alias("author_id"),
        safe_str(st["author"]["name"], S.AUTHOR_MAX).alias("author_name"),
        channel_to_category(st["channel"]["id"], st["channel"]["slug"]).alias("category"),
        published.alias("published_at"),
        F.coalesce(parse_dt(st["createdAt"]), published).alias("created_at"),
        F.coalesce(parse_dt(st["updatedAt"]), published).alias("updated_at"),
        parse_dt(st["deletedAt"]).alias("deleted_at"),
    )
    return rows.filter(F.col("id").isNotNull())


def page_status(pages: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ("feed_id", "page")) -> DataFrame:
    """One row per page: n_edges (NULL when the page does not hold the
    expected JSON) and whether it ends its feed (no edges)."""
    n = F.size(F.from_json(F.col(payload), S.FEED_PAGE)["data"]["FindAllActiveHeadlines"]["edges"])
    n_edges = F.when(n >= 0, n)
    return pages.select(*keep, n_edges.alias("n_edges"), (F.coalesce(n_edges, F.lit(0)) == 0).alias("ends_feed"))


def payload_rejects(pages: DataFrame, payload: str = "payload", feed: str = "feed_id", order: str = "page") -> DataFrame:
    """Per feed: its pages, those that do not parse, and the pages read before
    the first that does not parse or is empty."""
    st = page_status(pages, payload, (feed, order))
    return st.groupBy(feed).agg(F.count(F.lit(1)).alias("n_pages"), F.count_if(F.col("n_edges").isNull()).alias("n_rejected"),
                                F.min(F.when(F.col("ends_feed"), F.col(order))).alias("end_page"))


def readable_pages(pages: DataFrame, payload: str = "payload", feed: str = "feed_id", order: str = "page") -> DataFrame:
    """Pages before their feed's first page without edges (a truncated page,
    an error page, an empty one): a scrape ends there."""
    return before_end(pages, payload_rejects(pages, payload, feed, order), feed, order)


def before_end(rows: DataFrame, rejects: DataFrame, feed: str = "feed_id", order: str = "page") -> DataFrame:
    """Rows (pages, or what they hold) before their feed's ``end_page``."""
    ends = rejects.filter("end_page is not null").select(F.col(feed).alias("__f"), "end_page")
    return (rows.join(ends, rows[feed] == F.col("__f"), "left")
            .filter(F.col("end_page").isNull() | (F.col(order) < F.col("end_page"))).drop("__f", "end_page"))


def first_seen(rows: DataFrame, feed: str = "feed_id", order: tuple[str, ...] = ("page", "pos")) -> DataFrame:
    """First occurrence of every id within its feed, in feed order."""
    w = Window.partitionBy(feed, "id").orderBy(*order)
    return rows.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def take_while_recent(rows: DataFrame, since: Column, feed: str = "feed_id",
                      order: tuple[str, ...] = ("page", "pos")) -> DataFrame:
    """Keep each feed's rows up to (not including) the first one published
    before ``since``; a NULL publish time never stops the feed.

    A running max of the stop flag per feed; the window is partitioned by
    feed, and one feed (one scrape run) is bounded by its page limit.
    """
    stop = F.when(F.col("published_at") < since, F.lit(1)).otherwise(F.lit(0))
    w = Window.partitionBy(feed).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("__stopped", F.max(stop).over(w))
            .filter(F.col("__stopped") == 0).drop("__stopped"))


def flatten_feed(pages: DataFrame, since: Column | None = None) -> DataFrame:
    """Payload pages -> first-seen articles of each feed, up to its first
    unreadable or empty page, cut at ``since``."""
    rows = first_seen(flatten_pages(readable_pages(pages)))
    return take_while_recent(rows, since) if since is not None else rows


# --- fixture feed built from the article versions ------------------------------

def _iso(c: Column, zulu: Column) -> Column:
    s = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(zulu, F.concat(s, F.lit("Z"))).otherwise(s)


def fixture_pages(art: DataFrame, texts: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Feed pages of the fixture: newest first, ``PAGE_SIZE`` edges a page,
    ``PAGES_PER_FEED`` pages a scrape run.  Every 37th edge has no story.

    ``art`` holds whole articles, or their narrow columns with title and content
    by id in ``texts``: then a text goes to a page once, whatever the number of
    its versions there.  A feed's pages lie in one partition, so the exchange
    that brings the text to them (to ``tasks`` of them) serves the feed's
    windows too.  Page groups are bounded by the page size, so collecting one
    page's edges is a fixed-size aggregate."""
    known = art if texts is None else art.join(texts.select("id"), "id", "left_semi")
    rank = known.select(F.max("seq")).scalar() - F.col("seq")            # 0 = newest
    page_no = F.call_function("div", rank, F.lit(fx.PAGE_SIZE))
    place = [F.call_function("div", page_no, F.lit(fx.PAGES_PER_FEED)).alias("feed_id"), (page_no % fx.PAGES_PER_FEED).alias("page")]
    v = F.struct((rank % fx.PAGE_SIZE).alias("slot"), *[c for c in art.columns if c not in ("id", *fx.TEXT_COLUMNS)])
    if texts is None:
        parts = art.select(*place, "id", "title", "content", F.array(v).alias("vs"))
    else:
        vs = art.select(*place, "id", v.alias("v")).groupBy("feed_id", "page", "id").agg(F.collect_list("v").alias("vs"))
        parts = vs.join(texts.select("id", "title", "content"), "id")
    parts = parts.repartition(tasks, "feed_id") if tasks else parts.repartition("feed_id")
    pages = parts.groupBy("feed_id", "page").agg(F.collect_list(F.struct("id", "title", "content", "vs")).alias("parts"))

    def edge(v: Column, part: Column) -> Column:
        story = F.struct(
            part["id"].cast("string").alias("id"),
            part["title"].alias("title"),
            part["content"].alias("leadText"),
            part["title"].alias("metaDescription"),
            F.struct(v["author_id"].cast("string").alias("id"), v["author_name"].alias("name")).alias("author"),
            F.struct((v["seq"] % 12).cast("string").alias("id"),
                     F.when(v["category"] != "error", v["category"]).alias("slug")).alias("channel"),
            _iso(v["published_at"], v["seq"] % 3 == 0).alias("publishedAt"),
            F.when(v["seq"] % 11 != 0, _iso(v["created_at"], v["seq"] % 3 == 1)).alias("createdAt"),
            _iso(v["updated_at"], F.lit(False)).alias("updatedAt"),
            _iso(v["deleted_at"], F.lit(False)).alias("deletedAt"),
        )
        return F.struct(v["slot"].alias("slot"), F.when(v["seq"] % 37 != 0, story).alias("story"))

    edges = F.array_sort(F.flatten(F.transform("parts", lambda p: F.transform(p["vs"], lambda v: edge(v, p)))))
    payload = F.to_json(F.struct(F.struct(F.struct(
        F.transform(edges, lambda e: F.struct(e["story"].alias("story"))).alias("edges")
    ).alias("FindAllActiveHeadlines")).alias("data")))
    return pages.select("feed_id", "page", payload.alias("payload"))
