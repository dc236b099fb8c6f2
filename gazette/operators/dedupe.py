"""Keep-one-row-per-key operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per ``keys`` under ``order`` (``row_number() = 1``).

    Catalyst turns this into a partial ``WindowGroupLimit`` before the
    shuffle and a final one after it, so each map task forwards at most one
    row per key: a key holding a third of all rows costs one row per map
    task in the exchange, not a third of the data in one reducer.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dropDuplicates``: one arbitrary row per key (partial aggregation)."""
    return df.dropDuplicates(list(keys))


def latest_version_order(ts: str = "updated_at", *tie_breaks: str) -> list[Column]:
    """Latest first, NULL timestamp counted as latest (Postgres DESC order),
    then descending tie-break columns."""
    return [F.col(ts).desc_nulls_first()] + [F.col(t).desc_nulls_last() for t in tie_breaks]
