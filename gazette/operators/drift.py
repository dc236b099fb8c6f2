"""Trailing-window z-score drift detection on scorecards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette import schemas as S


def drift(scorecards: DataFrame, window: int = S.DRIFT_WINDOW,
          min_points: int = S.DRIFT_MIN_POINTS, z_threshold: float = S.DRIFT_Z,
          score: str = "overall_score", by: str = "table_name", order: str = "run_at",
          z_digits: int = 6) -> DataFrame:
    """Score every run against up to ``window`` earlier runs of its table.

    Fewer than ``min_points`` earlier runs -> (false, 0.0).  A flat history
    (min = max) -> z 0.0, flagged iff the score differs from it.  Otherwise
    z = (score - mean) / sample stdev and flagged when |z| >= threshold.
    Runs with a NULL score are dropped before the window.

    Scorecards hold one row per pipeline run (not per data row), so the
    per-table window stays small however large the article tables grow.
    """
    w = Window.partitionBy(by).orderBy(order).rowsBetween(-window, -1)
    s = F.col(score)
    hist = scorecards.filter(s.isNotNull()).withColumns({
        "history_points": F.count(s).over(w), "__mean": F.avg(s).over(w),
        "__sd": F.stddev_samp(s).over(w), "__lo": F.min(s).over(w), "__hi": F.max(s).over(w)})
    cold = F.col("history_points") < min_points
    flat = F.col("__lo") == F.col("__hi")
    z = (F.when(cold | flat, F.lit(0.0))
         .otherwise(F.try_divide(s - F.col("__mean"), F.col("__sd"))))
    flagged = (F.when(cold, F.lit(False))
               .when(flat, s != F.col("__hi"))
               .otherwise(F.abs(z) >= F.lit(z_threshold)))
    return (hist.withColumns({"z_score": F.round(z, z_digits), "is_anomaly": flagged})
            .drop("__mean", "__sd", "__lo", "__hi"))


def drift_alerts(scorecards: DataFrame, **kw) -> DataFrame:
    """Alert rows (score, z, table) for the flagged runs only."""
    return (drift(scorecards, **kw).filter("is_anomaly")
            .select("run_at", "table_name", "overall_score", "z_score", "history_points"))
