"""Column functions: native Spark expressions, so Catalyst sees them and no Python worker runs."""

from boreal.functions.calendar import (
    before_within_days,
    circular_hour_distance,
    hour_of_time,
    is_leap_year,
    seasonal_day_distance,
    year_range,
)
from boreal.functions.geo import haversine_km
from boreal.functions.kernels import gaussian_kernel
from boreal.functions.text import normalized_equals, text_before

__all__ = [
    "before_within_days",
    "circular_hour_distance",
    "gaussian_kernel",
    "haversine_km",
    "hour_of_time",
    "is_leap_year",
    "normalized_equals",
    "seasonal_day_distance",
    "text_before",
    "year_range",
]
