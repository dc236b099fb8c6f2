"""Column -> Column helpers.  All are native Spark expressions (no UDFs)."""

from gazette.functions.buckets import (
    age_group, channel_to_category, device_class, edu_level, follower_tier,
)
from gazette.functions.dates import (
    date_parts, date_spine, day_name_padded, day_of_week_sunday0, published_date,
)
from gazette.functions.parse import parse_dt, safe_int
from gazette.functions.rounding import half_up_4, mean_half_up_4, tenths_of_mille_to_double
from gazette.functions.text import collapse_ws, join_nonempty, py_strip, safe_str

__all__ = [
    "age_group", "channel_to_category", "device_class", "edu_level", "follower_tier",
    "date_parts", "date_spine", "day_name_padded", "day_of_week_sunday0", "published_date",
    "parse_dt", "safe_int", "half_up_4", "mean_half_up_4", "tenths_of_mille_to_double",
    "collapse_ws", "join_nonempty", "py_strip", "safe_str",
]
