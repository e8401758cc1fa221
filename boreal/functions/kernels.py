"""Gaussian kernel weight.

``exp(-(d^2 / h))``: ``h`` already holds the scale factor (it is not ``2 sigma^2``). With h = 300000
a 400 km distance weighs 58.7 %; with h = 1000 a 50-day distance weighs 8.2 %; with h = 31 a 12-hour
distance weighs 1.0 %.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gaussian_kernel(distance: Column, h: float) -> Column:
    return F.exp(-(distance * distance) / F.lit(float(h)))
