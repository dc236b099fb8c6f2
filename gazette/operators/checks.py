"""Declarative data tests (J1-J9).  Each check returns its failing rows;
``summarize`` turns a set of checks into one result table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gazette import schemas as S


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Non-NULL values occurring more than once, with their count."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1)
            .select(F.col(col).alias("unique_field"), "n_records"))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def check_accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with counts; NULL is not a failure."""
    return (df.groupBy(F.col(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(~F.col("value_field").isin(*values)))


def check_relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (left anti join; NULL
    keys are filtered first so they neither fail nor skew the join)."""
    keys = parent.select(F.col(field).alias("__parent_key")).distinct()
    return (child.filter(F.col(col).isNotNull())
            .join(keys, F.col(col) == F.col("__parent_key"), "left_anti")
            .select(F.col(col).alias("from_field")))


def check_no_future(df: DataFrame, as_of: Column, col: str = "published_at",
                    key: str = "article_id") -> DataFrame:
    return df.filter(F.col(col) > as_of).select(key, col)


def check_dq_threshold(scorecards: DataFrame, threshold: float = S.DQ_THRESHOLD) -> DataFrame:
    """Latest run(s) (all ties on max run_at) scoring below the gate; a
    NULL score passes.  The max is a scalar subquery (one value)."""
    latest = scorecards.select(F.max("run_at")).scalar()
    return scorecards.filter((F.col("run_at") == latest) & (F.col("overall_score") < F.lit(threshold)))


def check_freshness(df: DataFrame, as_of: Column, col: str = "_loaded_at",
                    warn_hours: float = S.FRESHNESS_WARN_HOURS,
                    error_hours: float = S.FRESHNESS_ERROR_HOURS) -> DataFrame:
    """One row: newest load, its age in hours at ``as_of`` and the status."""
    agg = df.agg(F.max(col).alias("max_loaded_at"))
    age = (F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), as_of.cast("timestamp_ntz"))
           .cast("double") / F.lit(3_600_000_000.0))
    return agg.select("max_loaded_at", as_of.cast("timestamp_ntz").alias("as_of"),
                      age.alias("age_hours")).withColumn(
        "status",
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        .when(F.col("age_hours") > error_hours, F.lit("error"))
        .when(F.col("age_hours") > warn_hours, F.lit("warn"))
        .otherwise(F.lit("pass")))


@dataclass
class Check:
    name: str
    model: str
    column: str | None
    severity: str            # "error" or "warn"
    failing: DataFrame | None    # failing rows (or, for freshness, a status row)
    source: DataFrame | None = None   # not_null: the model, so checks on one model share a scan
    failures: int | None = None       # known without a query: counted while the model was written


def not_null(model: str, df: DataFrame, col: str, severity: str = "error") -> Check:
    return Check("not_null", model, col, severity, check_not_null(df, col), source=df)


@dataclass(frozen=True)
class RowTest:
    """A check that looks at single rows, so a write can count its failures."""
    name: str
    column: str
    fails: Column
    severity: str = "error"


def not_null_test(col: str) -> RowTest:
    return RowTest("not_null", col, F.col(col).isNull())


def no_future_test(as_of: Column, col: str = "published_at") -> RowTest:
    return RowTest("no_future_published", col, F.col(col) > as_of)


def write_counted(df: DataFrame, tests: Sequence[RowTest], write: Callable[[DataFrame], None], model: str) -> list[Check]:
    """Write df and count each test's failures in the same pass (``observe``).

    The counts are taken above df's last exchange, in the tasks that write, and
    Spark takes a task's counts once, whichever attempt ends first.  A table
    that the optimizer knows to be empty has no counts and no failures.
    """
    if not tests:
        write(df)
        return []
    seen = Observation()
    write(df.observe(seen, *[F.count_if(t.fails).alias(f"t{i}") for i, t in enumerate(tests)]))
    got = seen.get
    return [Check(t.name, model, t.column, t.severity, None, failures=int(got.get(f"t{i}") or 0)) for i, t in enumerate(tests)]


def _known(checks: Sequence[Check]) -> DataFrame:
    """One row per check whose failures are known."""
    rows = [(c.name, c.model, c.column, c.severity, c.failures, "pass" if not c.failures else "fail" if c.severity == "error" else "warn") for c in checks]
    return SparkSession.active().createDataFrame(rows, "check_name string, model string, column_name string, severity string, failures long, status string")


def _status(failures: Column, severity: str) -> Column:
    return (F.when(failures == 0, F.lit("pass"))
            .otherwise(F.lit("fail" if severity == "error" else "warn")))


def _not_null_group(checks: Sequence[Check]) -> DataFrame:
    """All not_null checks of one model as one aggregate (one scan)."""
    src = checks[0].source
    counts = src.agg(*[F.count_if(F.col(c.column).isNull()).cast("long").alias(f"__n{i}")
                       for i, c in enumerate(checks)])
    rows = F.explode(F.array(*[F.struct(
        F.lit(c.name).alias("check_name"), F.lit(c.model).alias("model"),
        F.lit(c.column).cast("string").alias("column_name"), F.lit(c.severity).alias("severity"),
        F.col(f"__n{i}").alias("failures"), _status(F.col(f"__n{i}"), c.severity).alias("status"))
        for i, c in enumerate(checks)]))
    return counts.select(rows.alias("r")).select("r.*")


def summarize(checks: Sequence[Check]) -> DataFrame:
    """One result row per check: failures and pass / warn / fail.

    Each check is reduced to a one-row count before the union, so the
    result is tiny whatever the model sizes.
    """
    parts = []
    known = [c for c in checks if c.failures is not None]
    if known:
        parts.append(_known(known))
        checks = [c for c in checks if c.failures is None]
    grouped: dict[int, list[Check]] = {}
    for c in checks:
        if c.name == "not_null" and c.source is not None:
            grouped.setdefault(id(c.source), []).append(c)
    for group in grouped.values():
        parts.append(_not_null_group(group))
    for c in checks:
        if c.name == "not_null" and c.source is not None:
            continue
        if c.name == "freshness":
            status_row = c.failing.select(
                F.when(F.col("status") == "pass", F.lit(0)).otherwise(F.lit(1)).cast("long").alias("failures"),
                F.when(F.col("status") == "error", F.lit("fail")).otherwise(F.col("status")).alias("status"))
        else:
            n = F.count(F.lit(1)).cast("long")   # failing rows, as the test query returns them
            status_row = c.failing.agg(n.alias("failures")).select(
                "failures", _status(F.col("failures"), c.severity).alias("status"))
        parts.append(status_row.select(
            F.lit(c.name).alias("check_name"), F.lit(c.model).alias("model"),
            F.lit(c.column).cast("string").alias("column_name"),
            F.lit(c.severity).alias("severity"), "failures", "status"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
