"""Calendar expressions; all stay zone-less (DATE / TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def published_date(ts) -> Column:
    """Day of a zone-less timestamp (``date_trunc`` would return a zoned type)."""
    return F.to_date(_c(ts))


def day_of_week_sunday0(d) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(_c(d)) - 1).cast("int")


def day_name_padded(d) -> Column:
    """English day name blank-padded to nine characters, e.g. 'Monday   '."""
    return F.rpad(F.date_format(_c(d), "EEEE"), 9, " ")


def date_parts(d) -> list[Column]:
    c = _c(d)
    return [F.year(c).cast("int").alias("year"), F.month(c).cast("int").alias("month"),
            F.dayofmonth(c).cast("int").alias("day"),
            day_of_week_sunday0(c).alias("day_of_week"), day_name_padded(c).alias("day_name")]


def date_spine(bounds: DataFrame, lo: str = "min_date", hi: str = "max_date",
               out: str = "date_day") -> DataFrame:
    """One row per day between the bounds of a one-row DataFrame.

    NULL bounds give no rows.  The row count is the calendar span in days,
    independent of how many facts fall on each day.
    """
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY"))).alias(out))
