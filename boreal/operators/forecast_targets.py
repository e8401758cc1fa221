"""Kernel forecasts for a table of targets: places, dates and hours, in one scan of the readings.

The forecast of ``boreal.operators.forecast`` for every row of a target table. Of the three weights only the distance
weight depends on station and place together, and it fades: beyond ``radius_km`` it is below ``tail``. So

* readings are summed once per (station, target date, hour of day): a reading meets the target dates it is usable for by
  an equi-join on its day with a table of days, which also holds the season weight; 24 rows per station and date;
* the parts without the distance weight come from those sums over all stations, per (date, hour of day);
* the parts with it come from the stations near a place only. Both are put on a grid of cells as wide as the radius in
  three dimensions (the chord of the great circle, so neither poles nor the date line are special), and a place meets the
  stations of its own and the 26 neighbouring cells by an equi-join; no pair of a place and a far station is formed.
  A place without a station in the radius asks again with twice the radius, up to the distance where weights are zero;
* the hour weight joins last, on 24 rows per target.

What the cut leaves out is bounded, and the bound is part of the result. Where the nearest station with readings for the date is
at distance d, stations count up to sqrt(d² + radius²): farther ones weigh less than ``tail`` times the nearest, w. So they would
change the numerator by at most ``tail * w * sum |v|`` and the denominator by at most ``tail * w * count`` of their readings (weighted
by season and hour for the product), which are known as the difference of all and near sums. So ``bound_sum`` and ``bound_prod``
are proven bounds on the difference to the forecast over all stations (but for rounding). With ``tail=0`` nothing is cut.

The sums per (station, date, hour) and the near stations are written to the shared folder once (they are used several times);
the forecasts themselves are lazy.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boreal.functions.calendar import circular_hour_distance, seasonal_day_distance
from boreal.functions.geo import EARTH_RADIUS_KM, haversine_km
from boreal.functions.kernels import gaussian_kernel
from boreal.operators.forecast import H_DATE, H_DISTANCE, H_TIME, LOOKBACK_DAYS
from boreal.operators.joins import staged

#: Per station, date and hour: readings, sum and sum of sizes; the same weighted by season.
SUMS = ("n", "s", "a", "yn", "ys", "ya")
#: -ln of the smallest positive double, rounded up: beyond sqrt(ZERO * h) a weight is 0.
ZERO = 745.2


def radii_km(h_distance: float, tail: float) -> tuple[float, list[float]]:
    """The radius of the cut, and the radii in which a place looks for its nearest station."""
    most = min(math.pi * EARTH_RADIUS_KM, math.sqrt(ZERO * h_distance))
    radius = most if tail <= 0 else min(most, math.sqrt(h_distance * -math.log(tail)))
    steps = [radius]
    while steps[-1] < most:
        steps.append(min(most, 2 * steps[-1]))
    return radius, steps


def cells(lat: str, lon: str, radius_km: float) -> list[Column]:
    """Numbers of the grid cell of a place on the unit sphere; places within the radius lie in the same or
    neighbouring cells."""
    width = 2 * math.sin(min(radius_km / EARTH_RADIUS_KM, math.pi) / 2) * (1 + 1e-9)
    phi, lmb = F.radians(F.col(lat)), F.radians(F.col(lon))
    xyz = {"x": F.cos(phi) * F.cos(lmb), "y": F.cos(phi) * F.sin(lmb), "z": F.sin(phi)}
    return [F.floor(v / width).alias(c) for c, v in xyz.items()]


def met_on_grid(places: DataFrame, stations: DataFrame, radius_km: float) -> DataFrame:
    """(lat, lon, on, station, km) for every place (lat, lon, on) and every station (station, on, slat, slon) of the same
    date within the radius; of several rows of one station the nearest."""
    around = F.array(*[F.struct(*[F.lit(d).alias(c) for c, d in zip("xyz", (i, j, k))])
                       for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])
    asked = places.select("lat", "lon", "on", *cells("lat", "lon", radius_km)).withColumn("d", F.explode(around)).select(
        "lat", "lon", "on", *[(F.col(c) + F.col(f"d.{c}")).alias(c) for c in "xyz"])
    placed = stations.select("station", "on", "slat", "slon", *cells("slat", "slon", radius_km))
    km = haversine_km(F.col("slat"), F.col("slon"), F.col("lat"), F.col("lon"))
    met = asked.join(placed, ["on", *"xyz"]).withColumn("km", km).where(F.col("km") <= radius_km)
    return met.groupBy("lat", "lon", "on", "station").agg(F.min("km").alias("km"))


def near_stations(places: DataFrame, stations: DataFrame, h_distance: float, tail: float) -> DataFrame:
    """(lat, lon, on, station, km, nearest) of the stations that count for a place and date."""
    radius, steps = radii_km(h_distance, tail)
    nearest = F.min("km").over(Window.partitionBy("lat", "lon", "on"))
    found, left = [], places
    for step in steps:
        reach = min(math.sqrt(step ** 2 + radius ** 2), steps[-1])
        met = met_on_grid(left, stations, reach).withColumn("nearest", nearest)
        found.append(staged(met.where((F.col("nearest") <= step) & (
            F.col("km") * F.col("km") <= F.col("nearest") * F.col("nearest") + radius ** 2)), "near-stations"))
        left = left.join(found[-1], ["lat", "lon", "on"], "left_anti")
        if step == steps[-1] or left.isEmpty():
            return reduce(DataFrame.unionByName, found)
        left = staged(left, "places-left")


def kernel_regression_targets(readings: DataFrame, stations: DataFrame, targets: DataFrame, h_distance: float = H_DISTANCE,
                              h_date: float = H_DATE, h_time: float = H_TIME, lookback_days: int = LOOKBACK_DAYS,
                              wrap_leap: bool = True, exact_half: bool = True, tail: float = 1e-12, *, station: str = "station",
                              date: str = "date", hour: str = "hour", value: str = "value", station_key: str = "station",
                              lat: str = "latitude", lon: str = "longitude", target: str = "target", target_lat: str = "latitude",
                              target_lon: str = "longitude", target_date: str = "date", target_hour: str = "hour") -> DataFrame:
    """``target, date, hour, forecast_sum, forecast_prod, bound_sum, bound_prod`` for every row of ``targets``; NULL where
    nothing is usable (for the product: where all weights are 0) or where the target lacks a place, date or hour."""
    asked = targets.select(F.col(target).alias("target"), F.col(target_lat).cast("double").alias("lat"),
                           F.col(target_lon).cast("double").alias("lon"), F.to_date(target_date).alias("date"),
                           F.col(target_hour).cast("int").alias("hour"))
    whole = asked.dropna(subset=["lat", "lon", "date", "hour"])
    place_dates = whole.select("lat", "lon", "date").distinct()

    # days a target date looks back on, with the season weight; at most lookback_days rows per date
    dates = whole.select(F.col("date").alias("on")).distinct()
    past = F.sequence(F.date_sub("on", lookback_days), F.date_sub("on", 1))
    days = dates.select("on", F.explode(past).alias("day"))
    days = days.withColumn("ky", gaussian_kernel(seasonal_day_distance("day", F.col("on"), wrap_leap, exact_half), h_date))
    # the range of days as values of the date column's own type, so that the scan receives them
    kind = readings.schema[date].dataType
    begin = whole.select(F.date_sub(F.min("date"), lookback_days).cast(kind)).scalar()
    end = whole.select(F.max("date").cast(kind)).scalar()
    usable = readings.where(F.col(value).isNotNull() & (F.col(date) >= begin) & (F.col(date) < end)).select(
        F.col(station).alias("station"), F.to_date(date).alias("day"), F.col(hour).alias("h"), F.col(value).cast("double").alias("v"))
    v, ky = F.col("v"), F.col("ky")
    places = stations.select(F.col(station_key).alias("station"), F.col(lat).cast("double").alias("slat"),
                             F.col(lon).cast("double").alias("slon")).dropna().distinct()
    sums = (usable.join(days, "day").groupBy("station", "on", "h").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(v).alias("s"), F.sum(F.abs(v)).alias("a"),
        F.sum(ky).alias("yn"), F.sum(ky * v).alias("ys"), F.sum(ky * F.abs(v)).alias("ya")))
    sums = staged(sums.join(places.select("station").distinct(), "station", "left_semi"), "station-sums")

    everywhere = sums.groupBy("on", "h").agg(*[F.sum(c).alias(c) for c in SUMS])
    place_dates = place_dates.withColumnRenamed("date", "on")
    active = sums.select("station", "on").distinct().join(places, "station")
    near = near_stations(place_dates, active, h_distance, tail)
    kd = gaussian_kernel(F.col("km"), h_distance)
    local = (near.join(sums, ["station", "on"]).withColumn("kd", kd).groupBy("lat", "lon", "on", "h").agg(
        *[F.sum(F.col("kd") * F.col(c)).alias(f"d{c}") for c in ("n", "s", "yn", "ys")], *[F.sum(c).alias(f"near_{c}") for c in SUMS]))
    bounds = near.groupBy("lat", "lon", "on").agg(F.max(gaussian_kernel(F.col("nearest"), h_distance)).alias("most"))
    base = (place_dates.join(bounds, ["lat", "lon", "on"], "left").join(everywhere, "on")
            .join(local, ["lat", "lon", "on", "h"], "left"))
    base = base.na.fill(0.0, ["most", "dn", "ds", "dyn", "dys", *(f"near_{c}" for c in SUMS)])

    kt = gaussian_kernel(circular_hour_distance("h", F.col("hour")), h_time)

    def far(c: str) -> Column:
        return F.greatest(F.col(c) - F.col(f"near_{c}"), F.lit(0.0))

    terms = whole.distinct().join(base.withColumnRenamed("on", "date"), ["lat", "lon", "date"]).withColumn("kt", kt)
    kt = F.col("kt")
    per_target = terms.groupBy("target", "lat", "lon", "date", "hour").agg(
        F.sum(F.col("ds") + F.col("ys") + kt * F.col("s")).alias("sum_num"),
        F.sum(F.col("dn") + F.col("yn") + kt * F.col("n")).alias("sum_den"),
        F.sum(kt * F.col("dys")).alias("prod_num"), F.sum(kt * F.col("dyn")).alias("prod_den"), F.max("most").alias("most"),
        F.sum(far("a")).alias("far_a"), F.sum(far("n")).alias("far_n"),
        F.sum(kt * far("ya")).alias("far_ya"), F.sum(kt * far("yn")).alias("far_yn"))
    forecast_sum, forecast_prod = (F.try_divide(f"{k}_num", f"{k}_den") for k in ("sum", "prod"))
    weight = F.lit(float(max(tail, 0.0))) * F.col("most")

    def bound(forecast: Column, far_values: str, far_weights: str, den: str) -> Column:
        return F.try_divide(weight * (F.col(far_values) + F.abs(forecast) * F.col(far_weights)), F.col(den))

    found = per_target.select(
        "target", "lat", "lon", "date", "hour", forecast_sum.alias("forecast_sum"), forecast_prod.alias("forecast_prod"),
        bound(forecast_sum, "far_a", "far_n", "sum_den").alias("bound_sum"),
        bound(forecast_prod, "far_ya", "far_yn", "prod_den").alias("bound_prod"))
    keys = ["target", "lat", "lon", "date", "hour"]
    a, b = asked.alias("a"), found.alias("b")
    return a.join(b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "left").select(
        "a.target", "a.date", "a.hour", *[f"b.{c}" for c in ("forecast_sum", "forecast_prod", "bound_sum", "bound_prod")])
