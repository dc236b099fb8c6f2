"""Landing, stream, raw table and scrape keep text once where they can, and leave no shuffle files."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from gazette.plans import catalog
from gazette.plans import catalog_edge
from gazette.plans import jobs as J
from gazette.plans.catalog import QUERIES
from gazette.plans.models import Warehouse
from gazette.session import FREED, freed_shuffles
from gazette.sources import fixtures as fx
from gazette.sources import payload as P
from gazette.streaming import available_now as AN
from tests.test_late_text import exchanged, tables  # noqa: F401 - the fixture

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """200 documents with texts of their own, 40 versions of each in five runs."""
    root = tmp_path_factory.mktemp("copies")
    events = spark.range(8000).select(F.col("id").alias("event_id"), (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval((F.col("id") / 2000).cast("int"))).alias("ts"),
                                      (F.col("id") % 4).alias("user_id"), F.lit("view").alias("event_type"))
    events.write.parquet(f"{root}/events.parquet")
    spark.createDataFrame([(k, f"t{k}\n" + "".join(f"{hash((k, j)) & 0xffffffff:08x}" for j in range(300))) for k in range(200)], "doc_id long, text string").coalesce(1).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(0, "a")], "c_custkey long, c_name string").write.parquet(f"{root}/customer.parquet")
    return str(root)


def _size(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


@pytest.mark.parametrize("name, folder, texts", [
    ("raw_table_append", "articles_raw-x", 200), ("raw_table_append", "articles_raw-x-given", 200), ("null_typed_files", "loose-x", 2 * 200),
    ("stream_clean_available_now", "stream-x/landing", 5 * 200), ("stream_clean_available_now", "stream-x/sink", 5 * 200),
    ("stream_scorecard_append", "stream-scores-x/landing", 2 * 5 * 200), ("stream_scorecard_append", "stream-scores-x/sink", 2 * 5 * 200)])
def test_written_text_costs_little(spark, copies, tmp_path, monkeypatch, name, folder, texts):
    for module in (catalog, catalog_edge):
        monkeypatch.setattr(module, "_scratch", lambda _spark, n: f"{tmp_path}/{n}-x")
    assert QUERIES[name](spark, copies).count()
    assert 0 < _size(tmp_path / folder) < 0.8 * texts * 2_400


def test_stream_exchanges_no_text(spark, tables, tmp_path, monkeypatch):  # noqa: F811
    """Runs in several epochs; some rows without a run; the survivors' text is read in place."""
    wh, keys = Warehouse(spark, tables), ["batch", "id"]
    src = wh.batched.filter("id <> 3").withColumn("batch", F.when(F.col("seq") % 7 != 0, F.col("batch"))).drop("is_hard_deleted")      # two texts of id 3 tie
    landing, rest = f"{tmp_path}/with space/landing", {"allow": fx.FIXTURE_CATEGORIES, "keys": keys, "order": wh.survivor_order, "max_files": 3}
    src.repartition(3).write.partitionBy("batch").parquet(landing)
    batches, clean, got = [], AN.clean, []
    monkeypatch.setattr(AN, "clean", lambda df, **k: batches.append("content" in df.columns) or clean(df, **k))
    for wide in ([], ["title", "content"]):
        sink = f"{tmp_path}/sink-{len(wide)}"
        AN.run_available_now(spark, landing, src.schema, sink, f"{sink}-ckpt", wide=wide, **rest)
        got.append(AN.read_cleaned(spark, sink, wh.cleaned.schema, keys, wh.survivor_order, wide=wide))
        assert len(batches) > 3 and set(batches) == {not wide}
        batches.clear()
    assert got[0].count() == got[1].count() > 20 and got[0].exceptAll(got[1]).count() == 0
    assert not exchanged(got[1], "content")
    assert AN.read_cleaned(spark, f"{tmp_path}/none", wh.cleaned.schema, keys, wh.survivor_order, wide=["content"]).count() == 0


def test_scrape_chooses_by_narrow_rows(spark, tables, tmp_path, monkeypatch):  # noqa: F811
    """The parsed rows are staged without an exchange of their text; the upsert equals the last rows of the whole feed."""
    pages = P.fixture_pages(fx.versions(spark, tables), fx.texts(spark, tables))
    pages = pages.withColumn("payload", F.when(F.col("page") == 4, F.lit('{"data":')).otherwise(F.col("payload")))     # the feed ends there
    pages.write.parquet(f"{tmp_path}/pages")
    pages, lake, staged, seen = spark.read.parquet(f"{tmp_path}/pages"), J.Lake(f"{tmp_path}/lake"), J.staged_rows, []
    monkeypatch.setattr(J, "staged_rows", lambda df, *a: seen.append(exchanged(df, "content")) or staged(df, *a))
    since = T0 + dt.timedelta(days=10)
    J._save_state(spark.createDataFrame([("scrape", since, since)], J.S.WATERMARK), lake, "scrape")
    assert J.scrape_run(spark, lake, pages, "scrape") == 1
    assert seen and not any(seen)
    want = {}
    for r in sorted(P.flatten_feed(pages, F.lit(since).cast("timestamp_ntz")).collect(), key=lambda r: (r.feed_id, r.page, r.pos)):
        want[r.id] = tuple(r[c] for c in J.S.ARTICLE_COLUMNS)
    got = {r.id: tuple(r[c] for c in J.S.ARTICLE_COLUMNS) for r in J._source(spark, lake).collect()}
    assert got == want and len(got) > 2
    assert J.scrape_run(spark, lake, pages.filter("page < 0"), "scrape") == 0


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))


def test_freed_writes_leave_no_shuffle_files(spark, tmp_path):
    had, before = _shuffle_files(spark), spark.conf.get(FREED, None)
    df = spark.range(10_000).repartition(7, "id")
    with freed_shuffles(spark):
        df.write.parquet(f"{tmp_path}/a")
    until = time.time() + 10
    while _shuffle_files(spark) > had and time.time() < until:
        time.sleep(0.1)
    assert _shuffle_files(spark) <= had and spark.conf.get(FREED, None) == before
    df.write.parquet(f"{tmp_path}/b")       # the same rows once more
    assert spark.read.parquet(f"{tmp_path}/b").count() == spark.read.parquet(f"{tmp_path}/a").count() == 10_000
