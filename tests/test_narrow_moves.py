"""Jobs choose by narrow rows: the text of stored versions passes no join, and its copies stand together in files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gazette.plans import incremental_models as IM
from gazette.plans import jobs as J
from gazette.plans.catalog import QUERIES
from gazette.sources import positions as PS
from gazette.sources import tables as TB
from gazette.sources.keyed import KeyedTable, Moved
from tests.test_late_text import exchanged, tables  # noqa: F401 - the fixture

T0 = dt.datetime(2024, 1, 1)


def raw_rows(spark, rows):
    """(id, day, text) as raw rows."""
    df = spark.createDataFrame(rows, "id long, day int, content string")
    at = F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.col("day"))
    return TB.conform(df.withColumns({"title": F.concat(F.lit(" t"), F.col("content")), "published_at": at, "updated_at": at, "_loaded_at": at, "category": F.lit("view"),
                                      "author_id": F.col("id"), "is_hard_deleted": F.lit(False), "content_length": F.length("content").cast("long")}), J.RAW_SCHEMA)


def land(spark, lake, day, rows):
    TB.write_landing(raw_rows(spark, rows), lake.raw, T0 + dt.timedelta(days=day))


def latest(spark, lake):
    return sorted(((r.article_id, r.title, r.content) for r in IM.latest_model(spark, lake).collect()), key=str)


def test_picked_and_unpicked_rows_cover_the_files(spark, tmp_path):
    spark.range(0, 100_000, 1, 3).write.parquet(f"{tmp_path}/t")
    rows = PS.placed(spark.read.parquet(f"{tmp_path}/t"))
    marked = PS.marks(rows.filter("id % 7 = 3").select(*PS.PLACE), f"{tmp_path}/m")
    assert PS.picked(rows, marked).filter("id % 7 = 3").count() == PS.picked(rows, marked).count() == rows.filter("id % 7 = 3").count()
    assert PS.unpicked(rows, marked).filter("id % 7 <> 3").count() == PS.unpicked(rows, marked).count() == rows.filter("id % 7 <> 3").count()
    tagged = PS.marks(rows.select(*PS.PLACE, (F.col("id") % 2 == 0).alias("even")), f"{tmp_path}/e", ["even"])
    assert PS.picked(rows, tagged).filter(F.col("even") == (F.col("id") % 2 == 0)).count() == 100_000


def test_refresh_keeps_the_text_of_the_winner(spark, tmp_path):
    lake = J.Lake(str(tmp_path))
    land(spark, lake, 5, [(k, 4, f"a{k}") for k in range(20)] + [(None, 4, "null")])
    IM.refresh(spark, lake)
    land(spark, lake, 6, [(k, 5, f"b{k}") for k in range(0, 20, 2)])
    land(spark, lake, 4, [(k, 3, f"old{k}") for k in range(0, 20, 3)] + [(30, 3, "new30")])     # late: only the new id wins
    J.log_deletes(spark, lake, spark.createDataFrame([(3,), (4,)], "id long"), T0)
    IM.refresh(spark, lake)
    want = [(k, f"b{k}" if k % 2 == 0 else f"a{k}") for k in range(20) if k not in (3, 4)] + [(30, "new30"), (None, "null")]
    assert latest(spark, lake) == sorted([(k, f"t{c}", c) for k, c in want], key=str)
    assert IM.latest_table(lake).read(spark).filter("removed").count() == 2
    assert IM.refresh(spark, lake) == []


def test_moves_and_choice_carry_no_text(spark, tmp_path, monkeypatch):
    lake, seen = J.Lake(str(tmp_path)), []
    land(spark, lake, 5, [(k, 4, f"a{k}") for k in range(20)])
    staged = J.staged_rows
    monkeypatch.setattr(IM, "staged_rows", lambda df, *a: seen.append(df) or staged(df, *a))
    IM.refresh(spark, lake)
    assert seen and not any("content" in df.schema.simpleString().replace("content_length", "") for df in seen)
    assert not any(exchanged(df, c) for df in seen for c in ("content", "title"))


def test_upsert_exchanges_no_stored_text(spark, tmp_path):
    lake = J.Lake(str(tmp_path))
    J.save_source(raw_rows(spark, [(k, 1, f"a{k}") for k in range(20)] + [(None, 1, "null")]), lake)
    table = J.source_table(lake)
    updates = J.staged_rows(TB.conform(raw_rows(spark, [(3, 2, "b3"), (3, 3, "c3"), (40, 2, "n40")]), J.S.ARTICLE), table)
    base = table.version(spark)
    add, touched, _ = J.upsert_change(table, base, updates, [F.col("updated_at").desc()])
    kept = {r.id: r.content for r in add["rows"].collect()}
    assert kept[3] == "c3" and kept[40] == "n40" and "a3" not in kept.values()
    first = next(r for r in add["rows"].collect() if r.id == 3)
    assert first.published_at == T0 + dt.timedelta(days=1) and first.updated_at == T0 + dt.timedelta(days=3)
    texts = PS.placed(table.read_files(spark, touched))
    assert not exchanged(PS.unpicked(texts, PS.marks(texts.filter("id = 3").select(*PS.PLACE), f"{tmp_path}/m")), "content")
    table.commit(spark, base, add, touched)
    assert sorted((str(r.id), r.content) for r in table.read(spark).collect()) == sorted([(str(k), f"a{k}") for k in range(20) if k != 3] + [("3", "c3"), ("40", "n40"), ("None", "null")])


def test_a_job_that_is_late_writes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "id long, v string")
    table = KeyedTable(str(tmp_path / "t"), "id", rows.schema)
    base = table.version(spark)
    table.commit(spark, base, {"rows": rows})
    before = sorted(p.name for p in (tmp_path / "t" / "files").iterdir())
    with pytest.raises(Moved):
        table.commit(spark, base, {"rows": rows})
    assert sorted(p.name for p in (tmp_path / "t" / "files").iterdir()) == before


def _size(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


@pytest.mark.parametrize("name, folder", [("parquet_roundtrip", "cleaned-*"), ("landing_partition_scan", "landing-*")])
def test_copies_of_a_text_cost_little(spark, tmp_path, monkeypatch, name, folder):
    """200 documents with texts of their own, 40 versions of each in a few runs."""
    from gazette.plans import catalog
    events = spark.range(8000).select(F.col("id").alias("event_id"), (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval((F.col("id") / 2000).cast("int"))).alias("ts"),
                                      (F.col("id") % 4).alias("user_id"), F.lit("view").alias("event_type"))
    events.write.parquet(f"{tmp_path}/in/events.parquet")
    spark.createDataFrame([(k, f"t{k}\n" + "".join(f"{hash((k, j)) & 0xffffffff:08x}" for j in range(300))) for k in range(200)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/in/documents.parquet")
    spark.createDataFrame([(0, "a")], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/in/customer.parquet")
    monkeypatch.setattr(catalog, "_scratch", lambda _spark, n: f"{tmp_path}/{n}-x")
    QUERIES[name](spark, f"{tmp_path}/in").count()
    written = _size(next(p for p in tmp_path.glob(folder)))
    texts = {"parquet_roundtrip": 200, "landing_partition_scan": 5 * 200}[name]      # landing: a text once a run
    assert written < 0.8 * texts * 2_400


def test_versions_are_dealt_by_id_once(spark, tables):  # noqa: F811
    """Tombstones, dedupe and text share the tasks that are counted by the rows, also where nothing is
    broadcast (Spark deals anew what has fewer tasks than the session's partitions)."""
    from gazette.plans.models import Warehouse
    asked = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "2"}
    old = {k: spark.conf.get(k) for k in asked}
    for k, v in asked.items():
        spark.conf.set(k, v)
    try:
        met = []

        def walk(node):
            if "Exchange" in node.nodeName() and "author_id" in [node.output().apply(k).name() for k in range(node.output().size())]:
                met.append(node.outputPartitioning().toString())
            for k in range(node.children().size()):
                walk(node.children().apply(k))

        walk(Warehouse(spark, tables).deduped._jdf.queryExecution().executedPlan().initialPlan())
        met = [e for e in met if "batch" not in e]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(met) == 1, met
