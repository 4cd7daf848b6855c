"""Column functions; all of them are built-in Spark expressions."""

from reelstat.functions.casts import count_of, instant_of, or_default
from reelstat.functions.names import derived_table, object_key, safe_name
from reelstat.functions.times import (
    anchored, instant, iso_text, month_key, published_since, relative_range, time_grain,
)

__all__ = [
    "anchored", "count_of", "derived_table", "instant", "instant_of", "iso_text", "month_key",
    "object_key", "or_default", "published_since", "relative_range", "safe_name", "time_grain",
]
