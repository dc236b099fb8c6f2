"""Dimension bucketing expressions (CASE chains and literal maps)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette import schemas as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def channel_to_category(channel_id, channel_slug, mapping: dict | None = None,
                        default: str | None = None) -> Column:
    """Slug when non-empty, else the channel-id lookup, else ``default``."""
    mapping = S.INGEST_CHANNEL_MAP if mapping is None else mapping
    default = S.INGEST_CHANNEL_DEFAULT if default is None else default
    key = F.coalesce(_c(channel_id).cast("string"), F.lit(""))
    return F.coalesce(F.nullif(_c(channel_slug), F.lit("")),
                      F.try_element_at(_literal_map(mapping), key),
                      F.lit(default))


def age_group(age) -> Column:
    a = _c(age)
    out = F.when(a.isNull(), F.lit(S.AGE_UNKNOWN))
    for bound, label in S.AGE_BUCKETS:
        out = out.when(a < bound, F.lit(label))
    return out.otherwise(F.lit(S.AGE_TOP))


def follower_tier(n) -> Column:
    x = _c(n)
    out = F.when(x.isNull(), F.lit(S.FOLLOWER_NULL))
    for bound, label in S.FOLLOWER_TIERS:
        out = out.when(x < bound, F.lit(label))
    return out.otherwise(F.lit(S.FOLLOWER_TOP))


def edu_level(edu) -> Column:
    """Education code -> level; unknown, empty and NULL give 0."""
    level = F.try_element_at(_literal_map(S.EDU_LEVELS), F.coalesce(_c(edu), F.lit("")))
    return F.coalesce(level, F.lit(0)).cast("int")


def device_class(device) -> Column:
    d = F.lower(_c(device))
    return (F.when(F.coalesce(d, F.lit("")) == "", F.lit("unknown"))
            .when(d.contains("mobile"), F.lit("mobile"))
            .when(d.contains("tablet"), F.lit("tablet"))
            .otherwise(F.lit("desktop")))
