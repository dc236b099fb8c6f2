"""Upsert, tombstones, delete log, watermark and SCD2 behaviour on small frames."""

import datetime as dt

from pyspark.sql import functions as F

from gazette.operators import merge as MG
from gazette.operators import scd2 as H

T0 = dt.datetime(2024, 1, 1)
TGT = "id long, title string, published_at timestamp_ntz, updated_at timestamp_ntz"


def test_upsert_partial_update_and_insert(spark):
    target = spark.createDataFrame([(1, "a", T0, T0), (2, "b", T0, T0)], TGT)
    upd = spark.createDataFrame([
        (2, "b2", T0 + dt.timedelta(days=5), T0 + dt.timedelta(days=1)),
        (2, "b3", T0 + dt.timedelta(days=6), T0 + dt.timedelta(days=2)),
        (3, "c", T0 + dt.timedelta(days=3), T0 + dt.timedelta(days=3))], TGT)
    out = MG.merge_upsert(target, upd, "id", ["title", "updated_at"], order=[F.col("updated_at").desc()])
    rows = {r.id: r for r in out.collect()}
    assert rows[1].title == "a"
    assert rows[2].title == "b3" and rows[2].published_at == T0          # kept on update
    assert rows[3].published_at == T0 + dt.timedelta(days=3)              # inserted whole
    again = MG.merge_upsert(out, upd, "id", ["title", "updated_at"], order=[F.col("updated_at").desc()])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))   # idempotent


def test_delete_log_first_delete_wins(spark):
    prev = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    cur = spark.createDataFrame([(1,)], "id long")
    old = spark.createDataFrame([(2, T0)], "article_id long, deleted_at timestamp_ntz")
    at = F.lit(T0 + dt.timedelta(days=1)).cast("timestamp_ntz")
    log = {r.article_id: r.deleted_at for r in MG.delete_log_diff(prev, cur, at, old).collect()}
    assert log == {2: T0, 3: T0 + dt.timedelta(days=1)}


def test_tombstone_respect_time(spark):
    raw = spark.createDataFrame([(1, T0, None, False), (1, T0 + dt.timedelta(days=3), None, False)],
                                "id long, updated_at timestamp_ntz, deleted_at timestamp_ntz, is_hard_deleted boolean")
    log = spark.createDataFrame([(1, T0 + dt.timedelta(days=1))], "article_id long, deleted_at timestamp_ntz")
    assert MG.apply_tombstones(raw, log).filter("is_hard_deleted").count() == 2
    assert MG.apply_tombstones(raw, log, respect_time=True).filter("is_hard_deleted").count() == 1


def test_watermark_seed_and_last_write_wins(spark):
    state = MG.state_log(spark.createDataFrame(
        [("p", T0 + dt.timedelta(days=2), T0), ("p", T0 + dt.timedelta(days=1), T0 + dt.timedelta(hours=1))],
        "pipeline_name string, last_updated_at timestamp_ntz, written_at timestamp_ntz"))
    req = spark.createDataFrame([("p",), ("q",)], "pipeline_name string")
    got = {r.pipeline_name: r.last_updated_at for r in MG.watermark(state, req).collect()}
    assert got == {"p": T0 + dt.timedelta(days=1), "q": dt.datetime(2016, 1, 1)}


VERS = "article_id long, title string, category string, updated_at timestamp_ntz"


def test_scd2_rebuild_rules(spark):
    d = [T0 + dt.timedelta(days=i) for i in range(5)]
    v = spark.createDataFrame([(1, "a", "x", d[0]), (1, "a", "x", d[1]), (1, "a", None, d[2]),
                               (1, "a", "x", d[3]), (2, "b", "y", d[0])], VERS)
    h = H.scd2_rebuild(v, "article_id", ["title", "category"], ["updated_at"])
    rows = sorted((r.article_id, r.valid_from, r.valid_to) for r in h.collect())
    assert rows == [(1, d[0], d[2]), (1, d[2], d[3]), (1, d[3], None), (2, d[0], None)]
    # one open row per key, intervals do not overlap
    assert h.filter("valid_to IS NULL").groupBy("article_id").count().filter("count > 1").count() == 0


def test_scd2_merge(spark):
    at1, at2 = F.lit(T0).cast("timestamp_ntz"), F.lit(T0 + dt.timedelta(days=1)).cast("timestamp_ntz")
    s1 = spark.createDataFrame([(1, "a", "x", T0), (2, "b", "y", T0)], VERS)
    s2 = spark.createDataFrame([(1, "a", "z", T0), (3, "c", "y", T0)], VERS)
    h = H.scd2_merge(H.scd2_init(s1, at1), s2, "article_id", ["title", "category"], at2)
    rows = sorted((r.article_id, r.category, r.valid_to is None) for r in h.collect())
    assert rows == [(1, "x", False), (1, "z", True), (2, "y", True), (3, "y", True)]


def test_scd2_bucketed_equals_per_key(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for k in range(6):
        n = 200 if k == 0 else rnd.randint(1, 12)       # key 0 is a hot key spanning many days
        for i in range(n):
            ts = T0 + dt.timedelta(hours=rnd.randint(0, 24 * 20))
            rows.append((k, rnd.choice(["a", "b", None]), rnd.choice(["x", "y"]), ts))
    v = spark.createDataFrame(rows, VERS).dropDuplicates(["article_id", "updated_at"])
    plain = H.scd2_rebuild(v, "article_id", ["title", "category"], ["updated_at"])
    bucketed = H.scd2_rebuild(v, "article_id", ["title", "category"], ["updated_at"],
                              bucket=F.to_date("updated_at"))
    cols = ["article_id", "title", "category", "updated_at", "valid_from", "valid_to", "is_current"]
    def key(df):
        return sorted(tuple(str(x) for x in r) for r in df.select(cols).collect())
    assert key(plain) == key(bucketed)
    assert bucketed.filter("article_id = 0").count() > 10
