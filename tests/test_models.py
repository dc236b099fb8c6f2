"""Invariants of the warehouse chain (sf0.001)."""

from pyspark.sql import functions as F

from gazette.operators.scorecard import scorecard_from
from gazette.plans.models import Warehouse
from gazette.sources import fixtures as fx


def test_fact_unique_and_live(spark, sf):
    wh = Warehouse(spark, sf)
    fct = wh.fct
    assert fct.count() == fct.select("article_id").distinct().count() == 192
    assert fct.filter(F.col("article_id") % 25 == 0).count() == 0


def test_raw_rows_equal_sum_of_runs(spark, sf):
    wh = Warehouse(spark, sf)
    per_run = wh.raw.groupBy("batch").count().agg(F.sum("count")).first()[0]
    assert per_run == wh.raw.count() == wh.cleaned.count()


def test_clean_keeps_one_row_per_run_and_id(spark, sf):
    c = Warehouse(spark, sf).cleaned
    assert c.groupBy("batch", "id").count().filter("count > 1").count() == 0
    assert c.filter(~F.col("category").isin(*fx.FIXTURE_CATEGORIES)).count() == 0
    assert c.filter(F.col("title").rlike(r"\s\s|^\s|\s$")).count() == 0


def test_single_pass_scorecard_equals_definitional(spark, sf):
    wh = Warehouse(spark, sf)
    fast = wh.scorecards.drop("run_at")
    slow = scorecard_from(wh.batched, wh.cleaned, run_keys=["batch"],
                          run_at=F.col("batch").cast("timestamp_ntz")).drop("run_at", "batch")
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))


def test_scorecard_known_values(spark, sf):
    from gazette.operators.scorecard import scorecard
    art = fx.articles(spark, sf)
    row = scorecard(art, allow=fx.FIXTURE_CATEGORIES).first()
    assert (row.completeness, row.accuracy, row.timeliness, row.uniqueness) == (0.95, 0.923, 0.891, 1.0)


def test_scorecard_empty_input(spark, sf):
    from gazette.operators.scorecard import scorecard
    art = fx.articles(spark, sf).limit(0)
    row = scorecard(art).first()
    assert row.row_count == 0 and row.overall_score is None


def test_dim_date_spine(spark, sf):
    wh = Warehouse(spark, sf)
    b = wh.deduped.agg(F.min("published_date").alias("a"), F.max("published_date").alias("b")).first()
    d = wh.dim_date
    assert d.count() == (b.b - b.a).days + 1
    assert d.select("date_day").distinct().count() == d.count()


def test_tombstones_flag_all_versions(spark, sf):
    wh = Warehouse(spark, sf)
    t = wh.raw_tombstoned
    flagged = t.filter("is_hard_deleted").select("id").distinct()
    assert flagged.count() == wh.delete_log.count() == 8
    assert t.filter((F.col("id") % 25 == 0) & ~F.col("is_hard_deleted")).count() == 0


def test_clean_any_survivor_variant(spark, sf):
    from gazette.operators.clean import clean
    wh = Warehouse(spark, sf)
    c = clean(wh.batched, allow=fx.FIXTURE_CATEGORIES, keys=["batch", "id"])   # dropDuplicates form
    assert c.count() == wh.cleaned.count()
    assert c.groupBy("batch", "id").count().filter("count > 1").count() == 0


def test_whole_table_scorecard_forms_agree(spark, sf):
    from gazette.operators.clean import clean
    from gazette.operators.scorecard import scorecard
    art = fx.articles(spark, sf)
    fast = scorecard(art, allow=fx.FIXTURE_CATEGORIES, tie=F.col("seq")).drop("run_at").first()
    cleaned = clean(art, allow=fx.FIXTURE_CATEGORIES, keys=["id"],
                    order=[F.col("updated_at").desc_nulls_first(), F.col("seq").desc()])
    slow = scorecard_from(art, cleaned).drop("run_at").first()
    assert fast == slow
