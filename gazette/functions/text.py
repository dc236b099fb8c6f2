"""String cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_ws(c) -> Column:
    """Collapse every whitespace run to one space, then trim the ends."""
    return F.trim(F.regexp_replace(_c(c), r"\s+", " "))


def py_strip(c) -> Column:
    """Strip leading/trailing whitespace of any kind (Unicode-aware).

    ``trim`` only removes U+0020; the ``(?U)`` flag makes ``\\s`` match the
    Unicode space classes as well.
    """
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def safe_str(c, max_len: int | None = None) -> Column:
    """Cast to string, strip, cut to ``max_len`` characters, empty -> NULL.

    The cut happens after the strip and is not re-stripped, so a cut that
    ends in a space keeps it.
    """
    s = py_strip(_c(c).cast("string"))
    if max_len:
        s = F.substring(s, 1, max_len)
    return F.nullif(s, F.lit(""))


def join_nonempty(*cols, sep: str = "\n\n") -> Column:
    """Join the non-NULL parts with ``sep``; nothing left -> NULL."""
    return F.nullif(F.concat_ws(sep, *[_c(c) for c in cols]), F.lit(""))
