"""Plan checks: no Python UDFs, pushed filters, bounded windows, top-1 limits."""

import datetime as dt

import __spark_entry__ as E
from gazette.operators.incremental import extract_window
from gazette.plans.models import Warehouse


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs(spark, sf):
    for name in ["fct_articles", "dq_scorecard_by_day", "scd2_rebuild", "payload_flatten", "check_summary"]:
        p = plan(E.queries()[name](spark, sf))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_latest_per_key_uses_window_group_limit(spark, sf):
    df = Warehouse(spark, sf).deduped
    df._jdf.queryExecution().executedPlan()
    assert "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString()


def test_window_filter_pushed_to_parquet(spark, sf, tmp_path):
    src = Warehouse(spark, sf).articles.drop("content")
    path = str(tmp_path / "src")
    src.write.parquet(path)
    df = extract_window(spark.read.parquet(path), dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 11))
    p = plan(df)
    assert "PushedFilters: [IsNotNull(updated_at), GreaterThanOrEqual(updated_at" in p


def test_content_pruned_from_fact_shuffle(spark, sf):
    """The fact path needs only the text's length: no exchange carries the text."""
    lines = plan(Warehouse(spark, sf).fct).splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = next(x for x in lines[i + 1:] if "Project [" in x)
            assert "content#" not in below.split("AS content_length")[0].replace("length(content#", ""), below


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 10
    assert df.columns == ["author_id", "author_name", "total_articles", "first_published_date",
                          "last_published_date"]


def _unpartitioned_windows(p: str) -> list[str]:
    """Window expressions whose spec starts with an ordering or the frame,
    i.e. ``windowspecdefinition`` without partition expressions."""
    import re
    bad = []
    for line in p.splitlines():
        if "Window [" not in line or "WindowGroupLimit" in line:
            continue
        for spec in re.findall(r"windowspecdefinition\(([^,]*)", line):
            if spec.startswith("specifiedwindowframe") or re.search(r" (ASC|DESC) NULLS ", spec):
                bad.append(line)
    return bad


def test_window_detector_sees_global_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    assert _unpartitioned_windows(plan(df))


# Windows over the scorecard table run per table; the scorecards here all
# belong to one table (a literal), so Catalyst drops the partition spec.  The
# group is one row per pipeline run, independent of the article volume.
PER_TABLE_SCORECARD_WINDOWS = {"dq_anomaly_zscore", "dq_drift_alerts", "dq_drift_alerts_after_drop"}


def test_no_unpartitioned_window_in_any_query(spark, sf):
    for name, fn in E.queries().items():
        if name in E.LLM_QUERIES:
            continue
        if name in PER_TABLE_SCORECARD_WINDOWS:
            continue
        bad = _unpartitioned_windows(plan(fn(spark, sf)))
        assert not bad, (name, bad[0][:200])


def test_rollups_are_hash_aggregates(spark, sf):
    for name in ("dim_author", "dq_scorecard_by_day"):
        assert "SortAggregate" not in plan(E.queries()[name](spark, sf)), name


def test_fact_table_scans(spark, sf):
    assert plan(E.queries()["fct_articles"](spark, sf)).split("== Initial Plan ==")[0].count("FileScan") <= 5
