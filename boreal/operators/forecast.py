"""Kernel-weighted forecast of a value at a place, a date and hours of that day.

Each usable reading (strictly before the target date, at most ``lookback_days`` older) gets three
Gaussian kernel weights — distance from its station to the target place (kd), circular day-of-year
distance to the target date (ky), circular hour distance to the forecast hour (kt) — and the
forecast is the weighted mean of the values, once with the *sum* of the three weights and once with
their *product*.

Only kt depends on the forecast hour, and it depends on the reading only through its hour of day.
So for a forecast hour t::

    sum_r (kd + ky + kt(h_r, t)) v_r = sum_h [ A_h + kt(h, t) S_h ],  A_h = sum_{h_r = h} (kd + ky) v_r
    sum_r  kd * ky * kt(h_r, t)  v_r = sum_h   kt(h, t) P_h,          P_h = sum_{h_r = h} kd ky v_r

and likewise for the denominators. Plan (the readings are scanned once):

1. look-back filter, pushed to the scan as a date range;
2. join the per-station distance weights (one per station key), broadcast when Catalyst estimates the
   station table small enough; beyond, readings are first summed per (station, day distance, hour) — at most
   184 x 24 rows per station, combined map-side — and those sums are shuffle-joined instead;
3. ``groupBy(hour)``: six sums per hour of day — at most 24 groups whatever the input, combined
   map-side, so a station or hour holding a third of the readings is still one partial row per task;
4. the forecast hours (a parameter list) are exploded over the <= 24 hourly rows, together with
   one zero row per requested hour, and a last ``groupBy(forecast hour)`` forms the two weighted
   means — one row per requested hour, NULL when nothing was usable.

All weights are native Column expressions; no Python runs on the executors.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.functions.calendar import (
    before_within_days,
    circular_hour_distance,
    seasonal_day_distance,
)
from boreal.functions.geo import haversine_km
from boreal.functions.kernels import gaussian_kernel
from boreal.operators.joins import fits_broadcast
from boreal.operators.readings import sort_calendar_result

# The forecast hours (00:00, then 22:00 down to 04:00 in steps of two hours), the
# kernel widths for distance (km), days and hours, and the look-back in days.
FORECAST_HOURS = (0, 22, 20, 18, 16, 14, 12, 10, 8, 6, 4)
H_DISTANCE = 300000.0
H_DATE = 1000.0
H_TIME = 31.0
LOOKBACK_DAYS = 2190


def station_kernel_weights(stations: DataFrame, latitude: float, longitude: float,
                           h_distance: float = H_DISTANCE, *, station: str = "station",
                           lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Distance (km) of every station to the target place and its Gaussian weight."""
    dist = haversine_km(F.col(lat), F.col(lon), latitude, longitude)
    return (stations.select(F.col(station).alias("station"), dist.alias("distance_km"))
            .withColumn("distance_weight", gaussian_kernel(F.col("distance_km"), h_distance)))


def lookback_filter(readings: DataFrame, target_date: dt.date,
                    lookback_days: int = LOOKBACK_DAYS, *, date: str = "date") -> DataFrame:
    """Readings usable for a forecast on ``target_date``."""
    return readings.where(before_within_days(date, target_date, lookback_days))


def seasonal_distance(readings: DataFrame, target_date: dt.date, h_date: float = H_DATE,
                      lookback_days: int = LOOKBACK_DAYS, wrap_leap: bool = True,
                      exact_half: bool = True, *, date: str = "date",
                      value: str = "value") -> DataFrame:
    """Usable readings per circular day distance to the target date, with the day weight."""
    dd = seasonal_day_distance(F.col(date), target_date, wrap_leap, exact_half)
    return (lookback_filter(readings, target_date, lookback_days, date=date)
            .groupBy(dd.alias("day_distance"))
            .agg(F.count(value).alias("n_readings"))
            .withColumn("day_weight", gaussian_kernel(F.col("day_distance"), h_date))
            .transform(lambda df: sort_calendar_result(df, "day_distance")))


def hourly_distance(readings: DataFrame, target_date: dt.date, target_hour: int,
                    h_time: float = H_TIME, lookback_days: int = LOOKBACK_DAYS, *,
                    date: str = "date", hour: str = "hour", value: str = "value") -> DataFrame:
    """Usable readings per circular hour distance to ``target_hour``, with the hour weight."""
    hd = circular_hour_distance(F.col(hour), target_hour)
    return (lookback_filter(readings, target_date, lookback_days, date=date)
            .groupBy(hd.alias("hour_distance"))
            .agg(F.count(value).alias("n_readings"))
            .withColumn("hour_weight", gaussian_kernel(F.col("hour_distance"), h_time))
            .transform(lambda df: sort_calendar_result(df, "hour_distance")))


def kernel_regression(readings: DataFrame, stations: DataFrame, latitude: float,
                      longitude: float, target_date: dt.date, hours=FORECAST_HOURS,
                      h_distance: float = H_DISTANCE, h_date: float = H_DATE,
                      h_time: float = H_TIME, lookback_days: int = LOOKBACK_DAYS,
                      wrap_leap: bool = True, exact_half: bool = True, *,
                      station: str = "station", date: str = "date", hour: str = "hour",
                      value: str = "value", station_key: str = "station",
                      lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Forecast per hour: ``hour, forecast_sum, forecast_prod`` (NULL when all weights are 0).

    ``readings`` needs a station key, a date or timestamp, an hour of day (0-23) and a value;
    ``stations`` a key with latitude and longitude. Readings without a value, and readings of
    stations missing from ``stations``, are not used (report the latter with
    ``boreal.operators.integrity.fk_orphans``). Of several rows of one station the largest weight
    (the nearest place) counts, once.
    """
    usable = (lookback_filter(readings, target_date, lookback_days, date=date)
              .where(F.col(value).isNotNull())
              .select(F.col(station).alias("station"), F.col(date).alias("date"),
                      F.col(hour).alias("hour"), F.col(value).alias("value")))
    weights = station_kernel_weights(stations, latitude, longitude, h_distance,
                                     station=station_key, lat=lat, lon=lon) \
        .groupBy("station").agg(F.max("distance_weight").alias("distance_weight"))
    kd = F.col("distance_weight")
    dd = seasonal_day_distance(F.col("date"), target_date, wrap_leap, exact_half)
    if fits_broadcast(weights):
        # Stations fit a broadcast: weight each reading map-side, no shuffle of readings.
        ky = gaussian_kernel(dd, h_date)
        v = F.col("value")
        per_hour = (usable.join(F.broadcast(weights), "station")
                    .select("hour", v, (kd + ky).alias("k_add"), (kd * ky).alias("k_mul"))
                    .groupBy("hour")
                    .agg(F.sum(F.col("k_add") * v).alias("a"), F.sum("k_add").alias("b"),
                         F.sum(v).alias("s"), F.count(F.lit(1)).alias("n"),
                         F.sum(F.col("k_mul") * v).alias("p"), F.sum("k_mul").alias("q")))
    else:
        # Too many stations to broadcast: reduce readings to (station, day distance, hour) sums
        # first (at most 184 x 24 rows per station, combined map-side), then shuffle-join those.
        ky = gaussian_kernel(F.col("day_distance"), h_date)
        groups = (usable.groupBy("station", dd.alias("day_distance"), "hour")
                  .agg(F.sum("value").alias("vs"), F.count(F.lit(1)).alias("vn")))
        per_hour = (groups.join(weights, "station")
                    .select("hour", "vs", "vn", (kd + ky).alias("k_add"),
                            (kd * ky).alias("k_mul"))
                    .groupBy("hour")
                    .agg(F.sum(F.col("k_add") * F.col("vs")).alias("a"),
                         F.sum(F.col("k_add") * F.col("vn")).alias("b"),
                         F.sum("vs").alias("s"), F.sum("vn").alias("n"),
                         F.sum(F.col("k_mul") * F.col("vs")).alias("p"),
                         F.sum(F.col("k_mul") * F.col("vn")).alias("q")))
    hours = list(dict.fromkeys(int(t) for t in hours))  # each requested hour once, in order
    targets = F.explode(F.array(*[F.lit(t) for t in hours])).alias("target")
    kt = gaussian_kernel(circular_hour_distance(F.col("hour"), F.col("target")), h_time)
    terms = (per_hour.select("*", targets).withColumn("kt", kt)
             .select("target",
                     (F.col("a") + F.col("kt") * F.col("s")).alias("sum_num"),
                     (F.col("b") + F.col("kt") * F.col("n")).alias("sum_den"),
                     (F.col("kt") * F.col("p")).alias("prod_num"),
                     (F.col("kt") * F.col("q")).alias("prod_den")))
    # One zero row per requested hour: every hour gets a row, NULL when nothing was usable.
    zero = F.lit(0.0)
    requested = readings.sparkSession.range(1).select(
        targets, zero.alias("sum_num"), zero.alias("sum_den"), zero.alias("prod_num"),
        zero.alias("prod_den"))
    return (terms.unionByName(requested)
            .groupBy(F.col("target").alias("hour"))
            .agg(F.try_divide(F.sum("sum_num"), F.sum("sum_den")).alias("forecast_sum"),
                 F.try_divide(F.sum("prod_num"), F.sum("prod_den")).alias("forecast_prod")))


def kernel_peak_hour(forecast: DataFrame) -> DataFrame:
    """Hour of the highest forecast per kernel (``kernel, hour, forecast``); on equal forecasts the
    larger hour number wins (midnight is hour 0)."""
    long = forecast.select("hour", F.inline(F.array(
        F.struct(F.lit("sum").alias("kernel"), F.col("forecast_sum").alias("forecast")),
        F.struct(F.lit("prod").alias("kernel"), F.col("forecast_prod").alias("forecast")))))
    best = F.max(F.struct(F.col("forecast"), F.col("hour")))
    return (long.where(F.col("forecast").isNotNull()).groupBy("kernel").agg(best.alias("b"))
            .select("kernel", F.col("b.hour").alias("hour"), F.col("b.forecast").alias("forecast")))
