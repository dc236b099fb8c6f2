"""Six-dimension data-quality scorecard.

Dimensions, each over ``total`` = rows of the raw batch unless noted:
completeness = 1 - NULL author_name / total; validity = rows surviving the
clean step with an accepted category / total (so duplicates lower it);
uniqueness = distinct ids after clean / distinct ids before (NULL id counts
as one id); accuracy = published_at <= updated_at; timeliness =
updated_at >= created_at (NULL fails both); consistency = 1.0 placeholder;
overall = mean of the six rounded values.  Every value is rounded half-up
to four decimals with exact integer arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import schemas as S
from gazette.functions.rounding import half_up_4, mean_half_up_4, tenths_of_mille_to_double


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def _finish(counts: DataFrame, run_keys: Sequence[str], run_at: Column | None,
            table_name: str, data_source: str) -> DataFrame:
    total = F.col("total")
    parts = {
        "completeness": half_up_4(total - F.col("null_author"), total),
        "accuracy": half_up_4(F.col("accurate"), total),
        "consistency": F.when(total > 0, F.lit(10000).cast("long")),
        "timeliness": half_up_4(F.col("timely"), total),
        "validity": half_up_4(F.col("valid_clean"), total),
        "uniqueness": half_up_4(F.col("clean_ids"), F.col("raw_ids")),
    }
    scored = counts.select(*run_keys, "total",
                           *[p.alias(f"__{k}") for k, p in parts.items()])
    overall = mean_half_up_4([F.col(f"__{k}") for k in parts])
    return scored.select(
        *run_keys,
        (run_at if run_at is not None else F.localtimestamp()).cast("timestamp_ntz").alias("run_at"),
        F.lit(data_source).alias("data_source"),
        F.lit(table_name).alias("table_name"),
        F.col("total").cast("long").alias("row_count"),
        *[tenths_of_mille_to_double(F.col(f"__{k}")).alias(k) for k in S.SCORE_DIMENSIONS],
        tenths_of_mille_to_double(overall).alias("overall_score"),
    )


def survivor_code(time: Column, tie: Column | None, valid: Column) -> Column:
    """(time, tie, valid bit) as one number in the clean step's order: years 1
    to 9999 in microseconds, shifted to be positive, NULL above all; the tie
    (a long) fills 64 bits below, the valid bit is the last."""
    micros = F.coalesce(F.unix_micros(time.cast("timestamp")) + F.lit(63 * 10**15), F.lit(9 * 10**17))
    low = (tie if tie is not None else F.lit(0)).cast("long").cast("decimal(20,0)") + F.expr(f"{2**63}BD")
    return (micros.cast("decimal(18,0)") * F.expr(f"{2**65}BD") + low * 2 + valid).cast("decimal(38,0)")


def scorecard(raw: DataFrame, allow: Sequence[str] = S.VALID_CATEGORIES,
              run_keys: Sequence[str] = (), tie: Column | None = None,
              run_at: Column | None = None, table_name: str = S.TABLE_NAME,
              data_source: str = S.DATA_SOURCE, key: str = "id") -> DataFrame:
    """One scorecard row per run (``run_keys``), in a single pass over raw.

    Two partial-aggregated levels replace the seven separate counts: first
    per (run, id), which also decides the clean survivor (latest
    ``updated_at``, NULL as latest, then the largest ``tie``: the order the
    clean step uses), then per run.  Both levels combine map-side, so a hot
    id or a huge run shuffles one row per map task, never its rows.  Time,
    tie and valid bit are one DECIMAL(38,0), whose maximum stays a hash
    aggregate (a struct maximum would sort all rows).
    """
    return scorecard_of(scorecard_state(raw, allow, run_keys, tie, key), run_keys, run_at, table_name, data_source)


def scorecard_state(raw: DataFrame, allow: Sequence[str] = S.VALID_CATEGORIES, run_keys: Sequence[str] = (),
                    tie: Column | None = None, key: str = "id") -> DataFrame:
    """Counts and survivor per (run, id).  States of parts of the rows merge
    (``merge_states``), so a run may arrive in any number of pieces."""
    valid = _flag(F.col("category").isin(*allow))
    return raw.groupBy(*run_keys, key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_flag(F.col("author_name").isNull())).alias("null_author"),
        F.sum(_flag(F.col("published_at") <= F.col("updated_at"))).alias("accurate"),
        F.sum(_flag(F.col("updated_at") >= F.col("created_at"))).alias("timely"),
        F.max(survivor_code(F.col("updated_at"), tie, valid)).alias("survivor"),
    )


def merge_states(states: DataFrame, run_keys: Sequence[str] = (), key: str = "id") -> DataFrame:
    """One state per (run, id) from several: sums, and the greatest survivor."""
    return states.groupBy(*run_keys, key).agg(
        *[F.sum(c).alias(c) for c in ("n", "null_author", "accurate", "timely")], F.max("survivor").alias("survivor"))


def scorecard_of(state: DataFrame, run_keys: Sequence[str] = (), run_at: Column | None = None,
                 table_name: str = S.TABLE_NAME, data_source: str = S.DATA_SOURCE) -> DataFrame:
    """Scorecard rows from one state per (run, id)."""
    per_id = state.withColumn("valid_clean", (F.col("survivor") % 2).cast("int"))
    counts = per_id.groupBy(*run_keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.sum("null_author").alias("null_author"),
        F.sum("accurate").alias("accurate"),
        F.sum("timely").alias("timely"),
        F.sum("valid_clean").alias("valid_clean"),
        F.count(F.lit(1)).alias("raw_ids"),     # groups: NULL id counts once
        F.count(F.lit(1)).alias("clean_ids"),   # clean keeps one row per group
    )
    return _finish(counts, run_keys, run_at, table_name, data_source)


def distinct_with_null(col: str) -> Column:
    """``select(col).distinct().count()`` as an aggregate (NULL counts once)."""
    return F.count_distinct(F.col(col)) + F.max(_flag(F.col(col).isNull()))


def scorecard_from(raw: DataFrame, cleaned: DataFrame, run_keys: Sequence[str] = (),
                   run_at: Column | None = None, table_name: str = S.TABLE_NAME,
                   data_source: str = S.DATA_SOURCE, key: str = "id") -> DataFrame:
    """Definitional form over an already cleaned DataFrame: one aggregate per
    input, joined per run.  Used to check the single-pass form."""
    r = raw.groupBy(*run_keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(_flag(F.col("author_name").isNull())).alias("null_author"),
        F.sum(_flag(F.col("published_at") <= F.col("updated_at"))).alias("accurate"),
        F.sum(_flag(F.col("updated_at") >= F.col("created_at"))).alias("timely"),
        distinct_with_null(key).alias("raw_ids"),
    )
    c = cleaned.groupBy(*run_keys).agg(
        F.sum(_flag(F.col("category").isNotNull())).alias("valid_clean"),
        distinct_with_null(key).alias("clean_ids"),
    )
    if run_keys:
        counts = r.join(c, list(run_keys), "left")
    else:   # both sides are single rows: take the clean side as scalar subqueries
        counts = r.withColumns({"valid_clean": c.select("valid_clean").scalar(),
                                "clean_ids": c.select("clean_ids").scalar()})
    return _finish(counts, run_keys, run_at, table_name, data_source)
