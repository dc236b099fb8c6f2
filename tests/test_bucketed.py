"""Tables in buckets of their key: joins without an exchange, syncs that survive a crash."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gazette import schemas as S
from gazette.operators.merge import apply_tombstones
from gazette.plans import jobs as J
from gazette.sources import bucketed as BK
from gazette.sources import versioned

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def log(spark, lake):
    df = BK.read_bucketed(spark, J._bucketed(lake, "delete_log"), S.ARTICLE_DELETED, "article_id")
    return {r.article_id: r.deleted_at for r in df.collect()}


def test_diff_and_tombstones_exchange_nothing(spark, tmp_path, no_broadcast):
    root = str(tmp_path / "t")
    a = BK.open_bucketed(spark, BK.write_bucketed(spark.range(5000), f"{root}/a", "id", 8), J.IDS, "id")
    b = BK.open_bucketed(spark, BK.write_bucketed(spark.range(0, 5000, 2), f"{root}/b", "id", 8), J.IDS, "id")
    gone = a.join(b, "id", "left_anti")
    assert "Exchange" not in plan(gone) and gone.count() == 2500
    known = spark.range(1, 1000, 2).select(F.col("id").alias("article_id"), F.lit(T0).cast("timestamp_ntz").alias("deleted_at"))
    old = BK.open_bucketed(spark, BK.write_bucketed(known, f"{root}/log", "article_id", 8), S.ARTICLE_DELETED, "article_id")
    new = J.delete_log_of(gone, F.lit(T0 + dt.timedelta(days=1)).cast("timestamp_ntz"), old)
    assert "Exchange" not in plan(new)
    path = BK.write_bucketed(new, f"{root}/log", "article_id", 8, dealt=True)
    again = BK.open_bucketed(spark, path, S.ARTICLE_DELETED, "article_id")
    assert again.count() == 2500 and again.filter(F.col("deleted_at") == F.lit(T0).cast("timestamp_ntz")).count() == 500
    rows = a.select("id", F.lit(False).alias("is_hard_deleted"), F.lit(None).cast("timestamp_ntz").alias("deleted_at"))
    flagged = apply_tombstones(rows, again)
    assert "Exchange" not in plan(flagged) and flagged.filter("is_hard_deleted").count() == 2500


def test_a_version_is_read_in_another_session_and_leaves_no_table(spark, tmp_path):
    path = BK.write_bucketed(spark.range(100).withColumn("x", F.lit("v")), str(tmp_path / "t"), "id", 16)
    assert BK.buckets_of(path) == 16
    other = spark.newSession()
    df = BK.open_bucketed(other, path, spark.read.parquet(path).schema, "id")
    assert df.agg(F.sum("id")).first()[0] == 4950 and not [t for t in other.catalog.listTables() if t.name.startswith("bucketed_")]
    with pytest.raises(Exception):
        BK.open_bucketed(other, f"{path}/no-b", J.IDS, "id")


def test_bucket_numbers():
    step = BK.ROWS_PER_BUCKET
    assert BK.buckets_for(0) == BK.LEAST_BUCKETS and BK.buckets_for(step * 9) == 16 and BK.buckets_for(10**15) == BK.MOST_BUCKETS
    assert BK.buckets_for(step * 8 * BK.GROWTH, 8) == 8 and BK.buckets_for(step * 8 * BK.GROWTH + 1, 8) == 64 and BK.buckets_for(0, 64) == 64


def test_sync_null_ids_repeats_returns_and_growth(spark, tmp_path, monkeypatch):
    lake = J.Lake(str(tmp_path / "lake"))
    ids = lambda *v: spark.createDataFrame([(i,) for i in v], "id long")
    assert J.delete_sync_bucketed(spark, lake, ids(), T0).count() == 0
    assert J.delete_sync_bucketed(spark, lake, ids(1, 2, 3, 3, None), T0).count() == 0
    J.delete_sync_bucketed(spark, lake, ids(1, 1), T0 + dt.timedelta(days=1))
    assert log(spark, lake) == {2: T0 + dt.timedelta(days=1), 3: T0 + dt.timedelta(days=1)}
    J.delete_sync_bucketed(spark, lake, ids(1, 2, 4), T0 + dt.timedelta(days=2))
    monkeypatch.setattr(BK, "ROWS_PER_BUCKET", 1)      # the ids outgrow their buckets
    J.delete_sync_bucketed(spark, lake, ids(*range(4, 100)), T0 + dt.timedelta(days=3))
    assert BK.buckets_of(versioned.current_path(spark, J._bucketed(lake, "ids"))) == 128
    assert log(spark, lake) == {1: T0 + dt.timedelta(days=3), 2: T0 + dt.timedelta(days=1), 3: T0 + dt.timedelta(days=1)}


def test_a_sync_that_died_before_the_ids_were_published_is_repeated(spark, tmp_path, monkeypatch):
    lake = J.Lake(str(tmp_path / "lake"))
    J.delete_sync_bucketed(spark, lake, spark.range(10), T0)
    real = versioned.point

    def dies(spark, root, path, stamp=None):
        if root.endswith("/ids"):
            raise RuntimeError("lost")
        real(spark, root, path, stamp)

    monkeypatch.setattr(J.versioned, "point", dies)
    with pytest.raises(RuntimeError):
        J.delete_sync_bucketed(spark, lake, spark.range(5), T0 + dt.timedelta(days=1))
    monkeypatch.setattr(J.versioned, "point", real)
    J.delete_sync_bucketed(spark, lake, spark.range(4), T0 + dt.timedelta(days=2))
    want = {i: T0 + dt.timedelta(days=1) for i in range(5, 10)} | {4: T0 + dt.timedelta(days=2)}
    assert log(spark, lake) == want
