"""Drift detection with the literal histories of the source system's tests."""

import datetime as dt

import pytest

from gazette.operators.drift import drift

HIST = [0.97, 0.98, 0.97, 0.99, 0.98, 0.97]


def run(spark, history, latest, z=2.0):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=i), "articles", v) for i, v in enumerate(history + [latest])]
    df = spark.createDataFrame(rows, "run_at timestamp_ntz, table_name string, overall_score double")
    last = drift(df, z_threshold=z).orderBy("run_at").collect()[-1]
    return last.is_anomaly, last.z_score


def test_sharp_drop_flagged(spark):
    flagged, z = run(spark, HIST, 0.80)
    assert flagged and z < 0


def test_normal_value_not_flagged(spark):
    assert run(spark, HIST, 0.975)[0] is False


def test_threshold_matters(spark):
    assert run(spark, HIST, 0.968, 2.0)[0] is False
    assert run(spark, HIST, 0.968, 0.5)[0] is True


def test_cold_start(spark):
    assert run(spark, [0.9, 0.9, 0.9, 0.9], 0.1) == (False, 0.0)


@pytest.mark.parametrize("latest,expected", [(0.95, (False, 0.0)), (0.80, (True, 0.0))])
def test_flat_history(spark, latest, expected):
    assert run(spark, [0.95] * 6, latest) == expected


def test_window_is_twenty_runs(spark):
    # 25 runs: a huge outlier at run 0 falls out of the 20-run window of the last run
    hist = [0.1] + [0.95, 0.96] * 12
    flagged, z = run(spark, hist, 0.955)
    assert flagged is False
