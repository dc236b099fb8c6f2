"""Tolerant parsers: bad input becomes NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 date or date-time, optional fraction, optional Z / +hh:mm offset.
ISO_8601 = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_int(c) -> Column:
    """Integer value or NULL (``try_cast`` never raises under ANSI)."""
    return _c(c).cast("string").try_cast("bigint")


def parse_dt(c) -> Column:
    """ISO-8601 text -> zone-less timestamp keeping the wall clock.

    A ``Z`` or ``+07:00`` suffix is dropped, not converted (the cast to
    TIMESTAMP_NTZ ignores the offset).  Anything that is not ISO-8601,
    including the partial dates Spark's cast would accept, is NULL.
    """
    s = _c(c).cast("string")
    return F.when(s.rlike(ISO_8601), s.try_cast("timestamp_ntz"))
