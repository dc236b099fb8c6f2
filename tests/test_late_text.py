"""The articles' text is joined to the rows that remain: no exchange carries a text per version."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gazette.plans.models import Warehouse
from gazette.sources import fixtures as fx
from gazette.sources import payload as P
from tests.test_plans import plan


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Events of eight documents; two documents share an id, one id has no document."""
    root = tmp_path_factory.mktemp("late")
    t = dt.datetime(2024, 1, 1)
    events = [(i, t + dt.timedelta(hours=5 * i), i % 4, ["view", "error", "click"][i % 3]) for i in range(120)]
    docs = [(i, f" title  {i}\nbody {i}") for i in range(7)] + [(3, "other title\nother body")]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string").write.parquet(f"{root}/events.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "c_custkey long, c_name string").write.parquet(f"{root}/customer.parquet")
    return str(root)


def exchanged(df, column):
    """Keys of the exchanges whose input has the column."""
    p = df._jdf.queryExecution().executedPlan()
    out = []

    def walk(node):
        if node.nodeName() in ("Exchange", "ShuffleExchange") and column in [node.output().apply(k).name() for k in range(node.output().size())]:
            out.append(node.outputPartitioning().toString())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.inputPlan())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(p)
    return out


def test_clean_and_dedupe_exchange_documents_only(spark, tables):
    wh = Warehouse(spark, tables)
    for df in (wh.articles, wh.cleaned, wh.raw, wh.raw_tombstoned, wh.deduped, wh.landed()):
        met = exchanged(df, "content")
        assert len(met) == 1 and "batch" not in met[0], met


def test_late_text_gives_one_row_a_key(spark, tables):
    wh = Warehouse(spark, tables)
    rows = wh.cleaned.collect()
    assert len({(r.batch, r.id) for r in rows}) == len(rows) and {r.id for r in rows} == set(range(7))
    assert all(r.title == ("other title" if r.content.startswith("other") else f"title {r.id}") and r.content_length == len(r.content) for r in rows)
    whole = {(r.batch, r.id): r.seq for r in wh.batched.orderBy("updated_at", "seq").collect()}
    assert {(r.batch, r.id): r.seq for r in rows} == whole
    assert sorted(r.article_id for r in wh.deduped.collect()) == [1, 2, 3, 4, 5, 6]      # 0 is deleted


def test_pages_from_narrow_rows_equal_pages_from_articles(spark, tables):
    known = fx.texts(spark, tables).withColumn("r", F.xxhash64("content")).dropDuplicates(["id"]).drop("r").localCheckpoint()
    versions = fx.versions(spark, tables)
    whole = versions.join(known, "id")
    late = P.fixture_pages(versions, known, 3)
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, P.fixture_pages(whole).collect()))
    assert len(exchanged(P.first_seen(P.flatten_pages(late)), "content")) == len(exchanged(late, "content"))    # the feed's window needs no exchange


def test_landing_has_no_exchange_of_the_text(spark, tables):
    assert "RoundRobin" not in plan(Warehouse(spark, tables).landed())
