"""Keyed tables: file index, optimistic commits, partial replacement; models
kept up to date from new runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gazette.operators.scd2 import scd2_init, scd2_merge
from gazette.plans import incremental_models as IM
from gazette.plans import jobs
from gazette.plans.jobs import Lake
from gazette.plans.models import Models, dim_author
from gazette.plans.serving import category_totals
from gazette.sources import keyed
from gazette.sources import tables as TB
from gazette.sources.keyed import KeyedTable, Moved, Version

T0 = dt.datetime(2024, 1, 1)


def numbers(spark, ids, v="a"):
    return spark.createDataFrame([(i, v) for i in ids], "id long, v string")


@pytest.fixture
def table(spark, tmp_path):
    t = KeyedTable(str(tmp_path / "t"), "id", numbers(spark, []).schema, rows_per_bucket=100)
    t.replace(spark, numbers(spark, range(2000)))
    return t


def paths(spark, table, at=None):
    return {r.path: r for r in table.files(spark, at).collect()}


def test_a_change_reads_and_replaces_only_files_that_may_hold_its_keys(spark, table):
    before = paths(spark, table)
    assert len(before) == 20 and sum(r.rows for r in before.values()) == 2000      # as many buckets as the rows ask for
    ids = [3, 700, 1999]
    seen = []

    def change(base):
        touched = table.holding(numbers(spark, ids), "rows", base)
        seen.extend(touched)
        rows = table.read_files(spark, touched)
        return {"rows": rows.withColumn("v", F.when(F.col("id").isin(ids), "b").otherwise(F.col("v")))}, touched, {}

    table.update(spark, change)
    after = paths(spark, table)
    assert 1 <= len(seen) <= 3 and set(before) - set(after) == set(seen)
    assert {r.id for r in table.read(spark).filter("v = 'b'").collect()} == set(ids) and table.read(spark).count() == 2000


def test_the_index_misses_no_key_and_names_few_files_in_vain(spark, table):
    base = table.version(spark)
    every = table.holding(numbers(spark, range(0, 2000, 7)), "rows", base)
    held = {r.id for r in table.read_files(spark, every).collect()}
    assert set(range(0, 2000, 7)) <= held
    inside = spark.createDataFrame([(f":{k}x",) for k in range(400)], "id string")      # within the range of keys, never stored
    other = KeyedTable(table.root, "id", table.schema)
    assert len(other.holding(inside.withColumn("id", F.expr("substring(id, 2)")), "rows", base)) <= 4
    assert other.holding(numbers(spark, []), "rows", base) == []


def test_null_keys_are_keys(spark, table):
    base = table.version(spark)
    null = spark.createDataFrame([(None, "n")], "id long, v string")
    table.commit(spark, base, {"rows": null})
    found = table.holding(null, "rows", table.version(spark))
    assert [r.id for r in table.read_files(spark, found).filter("v = 'n'").collect()] == [None]


def test_of_two_jobs_one_starts_again(spark, table):
    base = table.version(spark)
    table.commit(spark, base, {"rows": numbers(spark, [5000])})
    with pytest.raises(Moved):
        table.commit(spark, base, {"rows": numbers(spark, [5001])})
    tries = []

    def change(base):
        if len(tries) < 2:
            table.commit(spark, base, {"rows": numbers(spark, [6000 + len(tries)])})
        tries.append(base.number)
        return {"rows": numbers(spark, [7000])}, [], {"by": "me"}

    done = table.update(spark, change)
    assert len(tries) == 3 and tries == sorted(set(tries)) and done.notes["by"] == "me"
    assert {r.id for r in table.read(spark).filter("id >= 5000").collect()} == {5000, 6000, 6001, 7000}


def test_a_job_that_dies_before_its_record_leaves_the_table(spark, table, monkeypatch):
    base, before = table.version(spark), table.read(spark).count()
    monkeypatch.setattr(keyed, "create_new", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.commit(spark, base, {"rows": numbers(spark, [9])}, remove=list(paths(spark, table)))
    assert table.version(spark) == base and table.read(spark).count() == before
    assert table.read(spark, at=Version()).count() == 0


# --- stored history -------------------------------------------------------------------

COLS = "article_id long, title string, category string, author_id long, updated_at timestamp_ntz"


def test_a_snapshot_replaces_only_open_files_of_changed_keys(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    table = jobs.history_table(lake)
    first = spark.createDataFrame([(i if i else None, f"t{i}", "x", 1, T0) for i in range(400)], COLS)
    jobs.snapshot_run(spark, lake, first, T0)
    before = paths(spark, table)
    day = [T0 + dt.timedelta(days=d) for d in range(4)]
    changed = spark.createDataFrame([(7, "t7b", "x", 1, day[1]), (None, "t0b", "x", 2, day[1]), (8, "t8", "x", 9, day[1]), (900, "new", None, 1, day[1])], COLS)
    history = jobs.snapshot_run(spark, lake, changed, day[1])
    after = paths(spark, table)
    assert len(set(before) - set(after)) <= 2 and all(p in after for p in before if before[p].part == "closed")
    rewritten = sum(r.rows for p, r in after.items() if p not in before and r.part == "open")
    assert rewritten <= sum(before[p].rows for p in set(before) - set(after)) + 1
    assert sum(r.rows for r in after.values() if r.part == "closed") == 2
    version = table.version(spark)
    history = jobs.snapshot_run(spark, lake, changed, day[2])       # nothing new: nothing is committed
    assert table.version(spark) == version
    got = {(r.article_id, r.title, r.valid_from, r.valid_to, r.is_current) for r in history.filter("article_id is null or article_id in (7, 8, 900)").collect()}
    assert got == {(7, "t7", T0, day[1], False), (7, "t7b", day[1], None, True), (None, "t0", T0, day[1], False), (None, "t0b", day[1], None, True),
                   (8, "t8", T0, None, True), (900, "new", day[1], None, True)}


def test_merge_keeps_the_history_of_a_null_key(spark):
    at = [F.lit(T0 + dt.timedelta(days=d)) for d in range(3)]
    snap = spark.createDataFrame([(None, "a", "x", 1, T0), (1, "b", "x", 1, T0)], COLS)
    history = scd2_merge(scd2_init(snap, at[0]), snap, "article_id", ["title", "category"], at[1])
    assert history.count() == 2 and history.filter("is_current").count() == 2
    other = spark.createDataFrame([(None, "c", "x", 1, T0)], COLS)
    history = scd2_merge(history, other, "article_id", ["title", "category"], at[2])
    assert sorted((r.article_id, r.title, r.is_current) for r in history.filter("article_id is null").collect()) == [(None, "a", False), (None, "c", True)]


# --- incremental models ------------------------------------------------------------------

def raw_run(spark, lake, day, rows):
    """rows: (id, author, name, category, publish day, minutes)"""
    at = T0 + dt.timedelta(days=day)
    made = [(i, f"t{i} {day}", "text", a, n, c, None if p is None else T0 + dt.timedelta(days=p), at, None if m is None else at + dt.timedelta(minutes=m), None,
             False, at, 4) for i, a, n, c, p, m in rows]
    TB.write_landing(spark.createDataFrame(made, jobs.RAW_SCHEMA), lake.raw, at)


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.select(a.columns).collect()))


def agree(spark, lake, respect_time=False):
    raw = TB.read_lake(spark, lake.raw, jobs.RAW_SCHEMA).drop("run_ts", "dt", "run")
    full = Models(raw, jobs.read_delete_log(spark, lake), respect_time=respect_time).deduped
    assert same(IM.latest_model(spark, lake), full)
    assert same(IM.dim_author(spark, lake), dim_author(full))
    assert same(IM.category_totals(spark, lake), category_totals(full.withColumnRenamed("published_date", "date_day")))


@pytest.mark.parametrize("respect_time", [False, True])
def test_models_follow_late_and_repeated_runs_and_deletes(spark, tmp_path, respect_time):
    lake = Lake(str(tmp_path / "lake"))
    raw_run(spark, lake, 5, [(1, 1, "a", "click", 9, 0), (2, 1, "b", "view", 1, 0), (3, None, None, None, None, None), (None, 2, "c", "view", 3, 1)])
    assert len(IM.refresh(spark, lake, respect_time)) == 1 and IM.refresh(spark, lake, respect_time) == []
    agree(spark, lake, respect_time)
    # the author's extreme days leave, an article changes its author and category
    raw_run(spark, lake, 6, [(1, 1, "a", "click", 4, 0), (2, 2, "b", "click", 1, 0), (4, 1, None, "view", 5, 0)])
    IM.refresh(spark, lake, respect_time)
    assert {r.author_id: (r.first_published_date.day, r.last_published_date.day) for r in IM.dim_author(spark, lake).filter("author_id = 1").collect()} == {1: (5, 6)}
    agree(spark, lake, respect_time)
    # a late run with older and newer versions, and the run of day 6 once more
    raw_run(spark, lake, 3, [(1, 9, "z", "view", 1, 0), (5, 9, "z", "view", 1, 0), (4, 8, "y", "view", 2, 9000)])
    assert len(IM.refresh(spark, lake, respect_time)) == 1
    agree(spark, lake, respect_time)
    jobs.log_deletes(spark, lake, spark.createDataFrame([(2,), (5,), (77,)], "id long"), T0 + dt.timedelta(days=6, hours=1))
    assert IM.refresh(spark, lake, respect_time) == []
    agree(spark, lake, respect_time)
    raw_run(spark, lake, 8, [(2, 2, "b", "view", 7, 0), (77, 1, "q", "click", 2, 0)])      # logged ids come back
    IM.refresh(spark, lake, respect_time)
    agree(spark, lake, respect_time)


def test_a_model_that_lags_is_caught_up_and_old_runs_are_not_read(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    raw_run(spark, lake, 1, [(i, i % 3, "a", "click", 1, 0) for i in range(30)])
    IM.refresh(spark, lake)
    read = []
    real = TB.read_runs
    monkeypatch.setattr(TB, "read_runs", lambda spark, root, schema, runs: read.extend(runs) or real(spark, root, schema, runs))
    for day in (2, 3):
        raw_run(spark, lake, day, [(i + day, i % 3, "b", "view", day, 0) for i in range(5)])
        IM.refresh_latest(spark, lake)          # the job dies before the other models
    IM.refresh(spark, lake)
    agree(spark, lake)
    assert read == ["2024-01-03/000000", "2024-01-04/000000"]
    assert IM.pending(spark, lake, IM.latest_table(lake).version(spark), dt.timedelta(days=0)) == []
