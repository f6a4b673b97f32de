"""Column expressions: typed fields, hour of day, wide sums."""

from logmill.functions.fields import stamp_parts, to_bytes, to_datetime, to_status
from logmill.functions.sums import join_limbs, limbs, wide_sum
from logmill.functions.times import epoch_second, hour_of_day, micro_of_second

__all__ = [
    "epoch_second",
    "hour_of_day",
    "join_limbs",
    "limbs",
    "micro_of_second",
    "stamp_parts",
    "to_bytes",
    "to_datetime",
    "to_status",
    "wide_sum",
]
