"""The weather questions and the forecast over station reading files, with their stated parameters.

Inputs are the positional ``;``-delimited files: temperature readings, precipitation readings,
a region's station list and the station table (see ``boreal.sources.schemas``). Each answer is a
DataFrame; ``write_answers`` stores each one as ordered CSV with a header.

    python -m boreal.plans.weather_questions --temperature T --precipitation P \\
        --region-stations R --stations S --out DIR
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boreal.functions.calendar import hour_of_time
from boreal.operators import daily as D
from boreal.operators import forecast as K
from boreal.operators import readings as R
from boreal.sinks import write_csv
from boreal.sources import (
    PRECIPITATION_READINGS,
    STATIONS,
    TEMPERATURE_READINGS,
    read_delimited,
    read_keys,
)

# The questions' periods, threshold, bands, and the forecast's place and date.
EXTREMES_PERIOD = (1950, 2014)
COUNT_PERIOD = (1950, 2014)
THRESHOLD = 10.0
MEAN_PERIOD = (1960, 2014)
TEMPERATURE_BAND = (25.0, 30.0)
PRECIPITATION_BAND = (100.0, 200.0)
REGION_PERIOD = (1993, 2016)
FORECAST_PLACE = (58.4274, 14.826)
FORECAST_DATE = dt.date(2013, 7, 4)


def stage_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write parsed rows once as parquet, in a folder of this run's own, and read them back: later jobs
    prune columns and push filters into the scan instead of re-parsing text, and the lineage ends there."""
    path = f"{path}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_daily(readings: DataFrame, band: tuple[float, float], name: str, path: str) -> DataFrame:
    """The readings as a stored daily table (``operators.daily``): one scan, and every question reads its rows."""
    spark = readings.sparkSession
    name = f"{name}_{uuid.uuid4().hex}"
    D.open_table(spark, name, f"{path}-{name}", int(spark.conf.get("spark.sql.shuffle.partitions")))
    D.add_batch(D.summarise(readings, THRESHOLD, band), name, "all")
    return D.daily_rows(spark, name)


def daily_answers(temps: DataFrame, precip: DataFrame, region: DataFrame) -> dict[str, DataFrame]:
    """The readings questions from the two daily tables."""
    return {
        "yearly_extrema": D.yearly_extrema(temps, *EXTREMES_PERIOD),
        "yearly_argmax": D.yearly_argmax(temps, *EXTREMES_PERIOD),
        "monthly_exceedance_count": D.monthly_exceedance_count(temps, *COUNT_PERIOD),
        "monthly_exceedance_station_count": D.monthly_exceedance_station_count(temps, *COUNT_PERIOD),
        "station_monthly_mean": D.station_monthly_mean(temps, *MEAN_PERIOD),
        "extremes_band_join": D.extremes_band_join(temps, precip, TEMPERATURE_BAND, PRECIPITATION_BAND),
        "extremes_prefilter_join": D.extremes_prefilter_join(temps, precip),
        "extremes_total_band_join": D.extremes_total_band_join(temps, precip, TEMPERATURE_BAND, PRECIPITATION_BAND),
        "regional_monthly_mean": D.regional_monthly_mean(precip, region, *REGION_PERIOD),
    }


def answers(spark: SparkSession, temperature: str, precipitation: str, region_stations: str,
            stations: str, mode: str = "FAILFAST", stage_dir: str | None = None
            ) -> dict[str, DataFrame]:
    """Every question's answer. With ``stage_dir`` (a shared folder), the readings are parsed once into parquet
    there and scanned once for a daily table, from which all questions but the forecast are answered."""
    temps = read_delimited(spark, temperature, TEMPERATURE_READINGS, mode=mode)
    precip = read_delimited(spark, precipitation, PRECIPITATION_READINGS, mode=mode)
    if stage_dir:
        temps = stage_parquet(temps, os.path.join(stage_dir, "temperature"))
        precip = stage_parquet(precip, os.path.join(stage_dir, "precipitation"))
    region = read_keys(spark, region_stations, mode=mode)
    station_table = read_delimited(spark, stations, STATIONS, mode=mode)
    readings = temps.withColumn("hour", hour_of_time("time"))
    forecast = K.kernel_regression(readings, station_table, *FORECAST_PLACE, FORECAST_DATE)
    results = {
        "yearly_extrema": R.yearly_extrema(temps, *EXTREMES_PERIOD),
        "yearly_argmax": R.yearly_argmax(temps, *EXTREMES_PERIOD),
        "monthly_exceedance_count": R.monthly_exceedance_count(temps, THRESHOLD, *COUNT_PERIOD),
        "monthly_exceedance_station_count": R.monthly_exceedance_station_count(
            temps, THRESHOLD, *COUNT_PERIOD),
        "station_monthly_mean": R.station_monthly_mean(temps, *MEAN_PERIOD),
        "extremes_band_join": R.extremes_band_join(temps, precip, TEMPERATURE_BAND,
                                                   PRECIPITATION_BAND),
        "extremes_prefilter_join": R.extremes_prefilter_join(temps, precip, TEMPERATURE_BAND,
                                                             PRECIPITATION_BAND),
        "extremes_total_band_join": R.extremes_total_band_join(temps, precip, TEMPERATURE_BAND,
                                                               PRECIPITATION_BAND),
        "regional_monthly_mean": R.regional_monthly_mean(precip, region, *REGION_PERIOD),
        "kernel_regression": forecast,
        "kernel_peak_hour": K.kernel_peak_hour(forecast),
        # the day distance as in the recorded forecasts (no leap-year wrap, 182 counted as 183)
        "kernel_regression_as_recorded": K.kernel_regression(
            readings, station_table, *FORECAST_PLACE, FORECAST_DATE, wrap_leap=False,
            exact_half=False),
    }
    if stage_dir:
        results |= daily_answers(
            stage_daily(temps, TEMPERATURE_BAND, "daily_temperature", os.path.join(stage_dir, "daily")),
            stage_daily(precip, PRECIPITATION_BAND, "daily_precipitation", os.path.join(stage_dir, "daily")), region)
    return results


def sort_columns(name: str) -> list[Column]:
    """Order of each stored answer: counts by count, most first; the others by key, last first, but the
    yearly extremes by year and the forecast in the order of its hours (midnight first, then 22 down)."""
    down = lambda *names: [F.col(n).desc() for n in names]
    return {
        "yearly_extrema": [F.col("year").asc()], "yearly_argmax": down("year"),
        "monthly_exceedance_count": down("n_readings", "year", "month"),
        "monthly_exceedance_station_count": down("n_stations", "year", "month"),
        "station_monthly_mean": down("mean_value", "year", "month", "station"),
        "regional_monthly_mean": down("year", "month"),
        "kernel_regression": [(F.col("hour") != 0).asc(), F.col("hour").desc()],
        "kernel_regression_as_recorded": [(F.col("hour") != 0).asc(), F.col("hour").desc()],
        "kernel_peak_hour": [F.col("kernel").asc()],
    }.get(name, down("station"))


#: Answers with one row per station (and month): written in parallel; the others are small by nature.
PER_STATION = {"station_monthly_mean", "extremes_band_join", "extremes_prefilter_join", "extremes_total_band_join"}


def write_answers(results: dict[str, DataFrame], out_dir: str) -> None:
    for name, df in results.items():
        write_csv(df, os.path.join(out_dir, name), sort_columns=sort_columns(name),
                  single_file=name not in PER_STATION)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for flag in ("--temperature", "--precipitation", "--region-stations", "--stations", "--out"):
        ap.add_argument(flag, required=True)
    ap.add_argument("--lenient", action="store_true", help="malformed fields become NULL")
    args = ap.parse_args(argv)
    from boreal.session import scratch_path, submitted_session
    spark = submitted_session("weather-questions")
    results = answers(spark, args.temperature, args.precipitation, args.region_stations,
                      args.stations, mode="PERMISSIVE" if args.lenient else "FAILFAST",
                      stage_dir=scratch_path(spark, "weather-readings"))
    write_answers(results, args.out)
    spark.stop()


if __name__ == "__main__":
    main()
