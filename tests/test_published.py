"""Published lookups and pages: what a reader opens."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gazette.operators import checks as CK
from gazette.plans import publish as PB
from gazette.plans.models import Warehouse
from gazette.plans.serving import articles_after, page_order
from gazette.sources import versioned


@pytest.fixture
def root(spark, tmp_path):
    """Facts of even ids over eight months, one in seven without a day."""
    day = F.expr("date_add(date'2024-01-01', cast(article_id % 240 as int))")
    fct = (spark.range(0, 4000, 2).withColumnRenamed("id", "article_id").select("article_id", F.lit(1).cast("long").alias("author_id"),
           F.when(F.col("article_id") % 7 != 0, day).alias("date_day"), F.lit("click").alias("category"), F.lit(1).cast("long").alias("content_length"),
           F.lit("t").alias("title")))
    root = str(tmp_path / "marts")
    path = versioned.new_version(root)
    fct.withColumn("month", F.date_format("date_day", "yyyy-MM")).write.partitionBy("month").parquet(f"{path}/fct_articles")
    authors = fct.select("author_id").distinct()
    PB.stage_lookups(spark, path, {"fct_articles": fct, "dim_author": authors})
    versioned.point(spark, root, path)
    return root


def scanned(df) -> int:
    """Rows that left the scan of an executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()) if leaves.apply(i).metrics().contains("numOutputRows"))


def test_an_id_that_is_not_there_is_not_searched_for(spark, root):
    got = PB.lookup(spark, root, "article_lookup", 1234)
    assert [r.article_id for r in got.collect()] == [1234]
    absent = PB.lookup(spark, root, "article_lookup", 1235)     # inside the range of ids: only the Bloom filter knows
    assert scanned(absent) == 0 and absent.count() == 0
    assert PB.lookup(spark, f"{root}/none", "article_lookup", 1) is None


@pytest.mark.parametrize("cursor", [(None, 0), (None, 3990), (dt.date(2024, 7, 1), 5), (dt.date(2024, 3, 1), -1), (dt.date(2023, 1, 1), 0)])
@pytest.mark.parametrize("limit", [1, 40, 200])
def test_a_stored_page_reads_only_the_months_it_needs(spark, root, monkeypatch, cursor, limit):
    months = []
    real = PB.read_month
    monkeypatch.setattr(PB, "read_month", lambda spark, path, month: months.append(month) or real(spark, path, month))
    got = PB.page_after_stored(spark, root, *cursor, limit).collect()
    fct = PB.read_mart(spark, root, "fct_articles")
    want = articles_after(fct, *cursor, limit=limit).orderBy(*page_order()).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    if len(got) == limit and limit < 200:
        assert len(months) <= 2
    assert months == sorted(months, key=lambda m: (m == PB.NULL_MONTH, m), reverse=True)


def test_row_tests_are_counted_by_the_write(spark, tmp_path):
    df = spark.range(1000, numPartitions=7).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int))").alias("t"))
    tests = [CK.not_null_test("k"), CK.not_null_test("t"), CK.no_future_test(F.lit("2025-01-01").cast("timestamp_ntz"), "t")]
    got = CK.write_counted(df.repartitionByRange("k"), tests, lambda rows: rows.write.parquet(str(tmp_path / "a")), "m")
    assert [(c.name, c.column, c.failures) for c in got] == [("not_null", "k", 100), ("not_null", "t", 0), ("no_future_published", "t", 1000 - 367)]
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1000
    rows = {(r.column_name, r.check_name): (r.failures, r.status) for r in CK.summarize([*got, CK.not_null("m", df, "t")]).collect()}
    assert rows[("k", "not_null")] == (100, "fail") and rows[("t", "no_future_published")] == (633, "fail")
    empty = CK.write_counted(df.filter("false"), tests, lambda rows: rows.write.parquet(str(tmp_path / "b")), "m")
    assert [c.failures for c in empty] == [0, 0, 0]


def test_a_counted_audit_scans_less_and_says_the_same(spark, sf, tmp_path):
    wh = Warehouse(spark, sf)
    as_of = PB.moment(spark, wh.raw.select(F.max("_loaded_at") - F.expr("INTERVAL 1 DAY")).scalar())
    counted = []
    staged = PB.stage_models(wh, str(tmp_path / "m"), as_of, counted)
    stg = staged["int_articles_deduped"]      # stored stand-ins for staging and raw: the plans hold the models' scans only
    raw = stg.withColumn("_loaded_at", F.col("published_at"))
    with_scans, without = PB.audit(staged, raw, as_of, stg), PB.audit(staged, raw, as_of, stg, counted)
    a, b = CK.summarize(with_scans), CK.summarize(without)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())) and a.count() == 18
    scans = [d._jdf.queryExecution().optimizedPlan().toString().count("Relation [") for d in (a, b)]
    assert scans[1] <= scans[0] - 4, scans
    assert any(c.failures for c in counted)
