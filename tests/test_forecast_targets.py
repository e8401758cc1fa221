"""Forecasts for a table of targets against the forecast of one place and date, over all stations."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from boreal.operators import forecast as K
from boreal.operators import forecast_targets as KT
from boreal.plans import bindings as B
from boreal.plans.inspect import plan_text, scans_of
from conftest import SF_SMALL

STATION = "station string, latitude double, longitude double"
READING = "station string, date date, hour int, value double"
TARGET = "target long, latitude double, longitude double, date date, hour int"


def places(spark):
    """Stations all over the globe: around a point, at the poles, on both sides of the date line; one listed twice."""
    rnd = random.Random(5)
    rows = [(f"s{k}", 58 + rnd.uniform(-3, 3), 15 + rnd.uniform(-4, 4)) for k in range(12)]
    rows += [("north", 89.9, 10.0), ("south", -89.5, 0.0), ("east", 1.0, 179.8), ("west", 1.0, -179.7), ("s1", 59.0, 15.5),
             ("silent", 58.4, 14.8), ("odd", None, 3.0)]
    return spark.createDataFrame(rows, STATION)


def measured(spark):
    rnd = random.Random(6)
    names = [f"s{k}" for k in range(12)] + ["north", "south", "east", "west", "unknown"]
    rows = [(rnd.choice(names), dt.date(1999, 1, 1) + dt.timedelta(days=rnd.randrange(800)), rnd.randrange(24),
             rnd.choice([rnd.uniform(-10, 30)] * 9 + [None])) for _ in range(2500)]
    return spark.createDataFrame(rows, READING)


ASKED = [(1, 58.4, 14.8, dt.date(2000, 7, 4), 12), (2, 58.4, 14.8, dt.date(2000, 7, 4), 0), (3, 58.4, 14.8, dt.date(2000, 2, 29), 5),
         (4, 89.5, -170.0, dt.date(2000, 12, 31), 23), (5, 0.5, 179.95, dt.date(2001, 1, 1), 6), (6, 0.5, -179.95, dt.date(2001, 1, 1), 6),
         (7, -60.0, 100.0, dt.date(2000, 7, 4), 12), (8, 30.0, 15.0, dt.date(2000, 7, 4), 12), (8, 30.0, 15.0, dt.date(2000, 7, 4), 13)]


@pytest.mark.parametrize("h_distance, tail, rules", [(300000.0, 1e-6, {}), (2000.0, 1e-3, {}), (500.0, 1e-9, {}), (2000.0, 0.0, {}),
                                                     (2000.0, 1e-6, {"wrap_leap": False, "exact_half": False})])
def test_targets_equal_single_forecasts_within_the_bound(spark, h_distance, tail, rules):
    readings, stations = measured(spark).cache(), places(spark)
    found = KT.kernel_regression_targets(readings, stations, spark.createDataFrame(ASKED, TARGET), h_distance=h_distance, tail=tail, **rules)
    found = {(r["target"], r["hour"]): r for r in found.collect()}
    assert len(found) == len(ASKED)
    for target, lat, lon, date, hour in ASKED:
        want = K.kernel_regression(readings, stations.dropna(), lat, lon, date, [hour], h_distance, **rules).first()
        got = found[target, hour]
        for kernel in ("sum", "prod"):
            exact, mine, bound = want[f"forecast_{kernel}"], got[f"forecast_{kernel}"], got[f"bound_{kernel}"]
            if exact is None:
                assert mine is None
            elif not (kernel == "prod" and abs(exact) < 1e-9):
                assert mine is not None and abs(mine - exact) <= bound + 1e-6 * abs(exact), (target, kernel, mine, exact, bound)
    if tail == 1e-6 and not rules:
        assert all(r["bound_sum"] < 1e-4 for r in found.values())


def test_targets_that_cannot_be_forecast(spark):
    odd = [(1, None, 14.8, dt.date(2000, 7, 4), 12), (2, 58.4, 14.8, None, 12), (3, 58.4, 14.8, dt.date(2000, 7, 4), None),
           (4, 58.4, 14.8, dt.date(1980, 1, 1), 12), (5, 58.4, 14.8, dt.date(2000, 7, 4), 12), (5, 58.4, 14.8, dt.date(2000, 7, 4), 12),
           (None, 58.4, 14.8, dt.date(2000, 7, 4), 12)]
    rows = KT.kernel_regression_targets(measured(spark), places(spark), spark.createDataFrame(odd, TARGET)).collect()
    assert len(rows) == len(odd)
    for r in rows:
        assert (r["forecast_sum"] is None) == (r["target"] in (1, 2, 3, 4))
    none = KT.kernel_regression_targets(measured(spark), places(spark), spark.createDataFrame([], TARGET))
    assert none.count() == 0
    silent = KT.kernel_regression_targets(measured(spark).filter("false"), places(spark), spark.createDataFrame(ASKED, TARGET))
    assert all(r["forecast_sum"] is None for r in silent.collect())


def test_grid_finds_all_stations_in_the_radius(spark):
    rnd = random.Random(7)
    some = lambda: (math.degrees(math.asin(rnd.uniform(-1, 1))), rnd.uniform(-180, 180))
    stations = spark.createDataFrame([(f"s{k}", 1, *some()) for k in range(400)], "station string, on int, slat double, slon double")
    asked = spark.createDataFrame([(*some(), 1) for _ in range(60)] + [(90.0, 0.0, 1), (-90.0, 5.0, 1), (0.0, 180.0, 1)],
                                  "lat double, lon double, on int")
    from boreal.functions.geo import haversine_km
    km = haversine_km(F.col("slat"), F.col("slon"), F.col("lat"), F.col("lon"))
    for radius in (50.0, 700.0, 5000.0, math.pi * 6367.0):
        got = {tuple(r)[:4] for r in KT.met_on_grid(asked, stations, radius).collect()}
        want = {tuple(r) for r in asked.crossJoin(stations.drop("on")).where(km <= radius).select("lat", "lon", "on", "station").collect()}
        assert got == want


def test_plan_has_no_cross_join_and_reads_written_sums(spark):
    df = B.QUERIES["kernel_regression_targets"](spark, SF_SMALL)
    text = plan_text(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert scans_of(df, "lineitem") == 0  # the readings were scanned once, for the sums
