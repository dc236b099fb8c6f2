"""Hot keys: one key holds a third of all rows.  Shuffle metrics of the
executed plans show the hot key is collapsed before it is shuffled (partial
window limit, partial aggregation) and split by bucket in the SCD2 rebuild."""

import datetime as dt

from pyspark.sql import functions as F

from gazette.operators.dedupe import latest_per_key
from gazette.operators.scd2 import scd2_rebuild
from gazette.operators.scorecard import scorecard
from gazette.plans.models import int_author_activity

N, PARTS = 240_000, 8


def _walk(node, out):
    out.append(node)
    for getter in ("plan",):
        try:
            _walk(getattr(node, getter)(), out)
        except Exception:  # noqa: BLE001 - not a query stage
            pass
    ch = node.children()
    for i in range(ch.size()):
        _walk(ch.apply(i), out)
    return out


def shuffle_records(df) -> list[int]:
    """Records written by each executed exchange of ``df``'s final plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    out = []
    for n in _walk(plan, []):
        if n.nodeName() == "Exchange":
            m = n.metrics().get("shuffleRecordsWritten")
            if m.isDefined():
                out.append(int(m.get().value()))
    return out


def hot(spark):
    """k = 0 for every third row, else unique; spread over PARTS input partitions."""
    base = spark.range(0, N, 1, PARTS)
    return base.select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                       F.col("id").alias("v"))


def test_latest_per_key_ships_one_row_per_task_for_hot_key(spark):
    df = hot(spark)
    distinct = N - N // 3 + 1
    recs = shuffle_records(latest_per_key(df, ["k"], [F.col("v").desc()]))
    assert max(recs) <= distinct - 1 + PARTS          # hot key: at most one row per map task


def test_scorecard_collapses_hot_id_map_side(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = hot(spark).select(
        F.col("k").alias("id"), F.lit("x").alias("category"), F.lit(None).cast("string").alias("author_name"),
        F.lit(t0).cast("timestamp_ntz").alias("published_at"),
        F.lit(t0).cast("timestamp_ntz").alias("created_at"),
        (F.lit(t0).cast("timestamp_ntz") + F.make_interval(secs=F.col("v").cast("int"))).alias("updated_at"))
    recs = shuffle_records(scorecard(df, allow=["x"]))
    assert max(recs) <= N - N // 3 + PARTS


def test_author_rollup_partial_aggregation(spark):
    df = hot(spark).select(F.col("k").alias("author_id"), F.lit("a").alias("author_name"),
                           F.current_date().alias("published_date"))
    recs = shuffle_records(int_author_activity(df))
    assert max(recs) <= N - N // 3 + PARTS


def test_scd2_bucketed_spreads_hot_key(spark):
    t0 = dt.datetime(2024, 1, 1)
    v = hot(spark).select(F.col("k").alias("article_id"), (F.col("v") % 2).cast("string").alias("title"),
                          F.lit("c").alias("category"),
                          (F.lit(t0).cast("timestamp_ntz") + F.make_interval(mins=F.col("v").cast("int")))
                          .alias("updated_at"))
    hist = scd2_rebuild(v, "article_id", ["title", "category"], ["updated_at"], bucket=F.to_date("updated_at"))
    plan = hist._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(article_id" in plan and "__b" in plan.split("hashpartitioning(article_id")[1][:40]
    # the hot key's versions sit in many (key, day) windows, not one
    spread = (v.filter("article_id = 0").select(F.to_date("updated_at").alias("d")).distinct().count())
    assert spread > 50
    assert hist.filter("article_id = 0 AND valid_to IS NULL").count() == 1
