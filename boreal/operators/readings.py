"""Analytics over station readings: a DataFrame with a station key, a date (or timestamp) and a value.

Every function takes the readings DataFrame and the names of its columns, so the same job runs on
parsed text files (``boreal.sources.read_delimited``) or on any table with those roles. Period bounds
are inclusive on both ends and are applied as pushable date ranges. Every aggregate here is
decomposable (min, max, sum, count, avg, distinct), so Spark combines map-side before each shuffle:
a station holding a third of all readings becomes one partial row per task, not a hot partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.functions.calendar import year_range
from boreal.operators.joins import fits_broadcast, key_side


def sort_calendar_result(df: DataFrame, *order) -> DataFrame:
    """Order a result keyed by calendar units (years, months, day or hour distances).

    Such a result has at most 12 x 9999 rows whatever the input, so it is sorted inside one
    partition after a single exchange, instead of a range-partitioned sort that first samples its
    input in a separate job.
    """
    return df.repartition(1).sortWithinPartitions(*order)


def _period(readings: DataFrame, date: str, first_year: int | None, last_year: int | None):
    if first_year is None and last_year is None:
        return readings
    return readings.where(year_range(date, first_year, last_year))


def yearly_extrema(readings: DataFrame, first_year: int = 1950, last_year: int = 2014, *,
                   date: str = "date", value: str = "value", ascending: bool = True) -> DataFrame:
    """Lowest and highest value per year of the period, in one aggregate (one scan)."""
    return (_period(readings, date, first_year, last_year)
            .groupBy(F.year(date).alias("year"))
            .agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))
            .transform(lambda df: sort_calendar_result(
                df, F.col("year").asc() if ascending else F.col("year").desc())))


def yearly_argmax(readings: DataFrame, first_year: int = 1950, last_year: int = 2014, *,
                  station: str = "station", date: str = "date", value: str = "value") -> DataFrame:
    """Highest value per year with the station that measured it (ties: the larger station key).

    Hash-aggregated first to one maximum per (year, station); the arg-max, whose struct ordering
    key needs a sort-based aggregate, then runs over that small table only.
    """
    per_station = (_period(readings, date, first_year, last_year)
                   .where(F.col(value).isNotNull())
                   .groupBy(F.year(date).alias("year"), F.col(station).alias("__st"))
                   .agg(F.max(value).alias("__m")))
    return (per_station.groupBy("year")
            .agg(F.max("__m").alias("max_value"),
                 F.max_by(F.col("__st"), F.struct(F.col("__m"), F.col("__st"))).alias("station"))
            .transform(lambda df: sort_calendar_result(df, F.col("year").desc())))


def _exceedances(readings, threshold, first_year, last_year, station, date, value):
    return (_period(readings, date, first_year, last_year)
            .where(F.col(value) > F.lit(threshold))
            .select(F.year(date).alias("year"), F.month(date).alias("month"),
                    F.col(station).alias("__station")))


def monthly_exceedance_count(readings: DataFrame, threshold: float = 10.0,
                             first_year: int = 1950, last_year: int = 2014, *,
                             station: str = "station", date: str = "date",
                             value: str = "value") -> DataFrame:
    """Readings strictly above ``threshold`` per month, most first (ties by year, month)."""
    return (_exceedances(readings, threshold, first_year, last_year, station, date, value)
            .groupBy("year", "month")
            .agg(F.count("__station").alias("n_readings"))
            .transform(lambda df: sort_calendar_result(df, F.col("n_readings").desc(), "year",
                                                       "month")))


def monthly_exceedance_station_count(readings: DataFrame, threshold: float = 10.0,
                                     first_year: int = 1950, last_year: int = 2014, *,
                                     station: str = "station", date: str = "date",
                                     value: str = "value") -> DataFrame:
    """Stations with at least one reading above ``threshold`` per month.

    Planned as a partial distinct on (year, month, station) before the shuffle, so the second
    aggregate sees at most one row per station and month whatever the reading count.
    """
    return (_exceedances(readings, threshold, first_year, last_year, station, date, value)
            .groupBy("year", "month")
            .agg(F.countDistinct("__station").alias("n_stations"))
            .transform(lambda df: sort_calendar_result(df, F.col("n_stations").desc(), "year",
                                                       "month")))


def station_monthly_mean(readings: DataFrame, first_year: int = 1960, last_year: int = 2014, *,
                         station: str = "station", date: str = "date",
                         value: str = "value") -> DataFrame:
    """Mean per station and month (only station-months with readings appear)."""
    return (_period(readings, date, first_year, last_year)
            .groupBy(F.col(station).alias("station"), F.year(date).alias("year"),
                     F.month(date).alias("month"))
            .agg(F.avg(value).alias("mean_value"))
            .orderBy(F.col("station").desc(), F.col("year").desc(), F.col("month").desc()))


def station_monthly_mean_sumcount(readings: DataFrame, first_year: int = 1960,
                                  last_year: int = 2014, *, station: str = "station",
                                  date: str = "date", value: str = "value") -> DataFrame:
    """The same mean written as ``sum / count`` (a cross-check of the aggregate)."""
    return (_period(readings, date, first_year, last_year)
            .groupBy(F.col(station).alias("station"), F.year(date).alias("year"),
                     F.month(date).alias("month"))
            .agg((F.sum(value) / F.count(value)).alias("mean_value"))
            .orderBy(F.col("station").desc(), F.col("year").desc(), F.col("month").desc()))


def _max_per_station(readings, station, value, alias, band=None):
    out = readings.groupBy(F.col(station).alias("station")).agg(F.max(value).alias(alias))
    if band is not None:
        out = out.where(F.col(alias).between(*band))
    return out


def _max_daily_total(precip, station, date, value, band):
    daily = (precip.groupBy(F.col(station).alias("station"), F.to_date(date).alias("day"))
             .agg(F.sum(value).alias("daily_total")))
    return (daily.groupBy("station").agg(F.max("daily_total").alias("max_daily_precipitation"))
            .where(F.col("max_daily_precipitation").between(*band)))


def extremes_band_join(temperatures: DataFrame, precipitation: DataFrame,
                       temperature_band=(25.0, 30.0), precipitation_band=(100.0, 200.0), *,
                       station: str = "station", date: str = "date",
                       value: str = "value") -> DataFrame:
    """Stations whose maximum temperature and maximum *daily* precipitation both lie in bands.

    Daily precipitation is the sum of a station's readings of one calendar day; both sides are
    reduced to one row per station before they meet. When neither side is small enough to
    broadcast, both arrive hash-partitioned on the station from their last aggregate, so the
    sort-merge join adds no exchange of its own.
    """
    t = _max_per_station(temperatures, station, value, "max_temperature", temperature_band)
    p = _max_daily_total(precipitation, station, date, value, precipitation_band)
    return t.join(p, "station").orderBy(F.col("station").desc())


def extremes_prefilter_join(temperatures: DataFrame, precipitation: DataFrame,
                            temperature_band=(25.0, 30.0), precipitation_band=(100.0, 200.0), *,
                            station: str = "station", value: str = "value") -> DataFrame:
    """Maxima among the readings that lie inside the bands, for stations that have such readings
    on both sides (a station's true maximum may be above the band).

    Each side is aggregated before the join; joining readings to readings first would multiply rows
    per station without changing any maximum.
    """
    t = _max_per_station(temperatures.where(F.col(value).between(*temperature_band)),
                         station, value, "max_temperature")
    p = _max_per_station(precipitation.where(F.col(value).between(*precipitation_band)),
                         station, value, "max_precipitation")
    return t.join(p, "station").orderBy(F.col("station").desc())


def extremes_total_band_join(temperatures: DataFrame, precipitation: DataFrame,
                             temperature_band=(25.0, 30.0), precipitation_band=(100.0, 200.0), *,
                             station: str = "station", value: str = "value") -> DataFrame:
    """As ``extremes_band_join`` but with each station's total precipitation over all readings."""
    t = _max_per_station(temperatures, station, value, "max_temperature", temperature_band)
    p = (precipitation.groupBy(F.col(station).alias("station"))
         .agg(F.sum(value).alias("total_precipitation"))
         .where(F.col("total_precipitation").between(*precipitation_band)))
    return t.join(p, "station").orderBy(F.col("station").desc())


def regional_monthly_mean(precipitation: DataFrame, region_stations: DataFrame,
                          first_year: int = 1993, last_year: int = 2016, *,
                          station: str = "station", region_station: str | None = None,
                          date: str = "date", value: str = "value") -> DataFrame:
    """Monthly total per station of a region, averaged over the region's stations with readings.

    The region's station list stays a DataFrame and meets the readings in a left semi join instead
    of being collected into an ``IN`` list. A list that Catalyst estimates small enough to broadcast filters
    the readings map-side, before they are aggregated. A longer list would make the join shuffle the
    readings, so the readings are first summed per (year, month, station) — combined map-side —
    and only those sums are shuffled into the semi join (the filter commutes with the grouping,
    which includes the station).
    """
    keys = key_side(region_stations, region_station or station)
    readings = _period(precipitation, date, first_year, last_year)

    def monthly_totals(df):
        return (df.groupBy(F.year(date).alias("year"), F.month(date).alias("month"),
                           F.col(station).alias("station"))
                .agg(F.sum(value).alias("monthly_total")))

    if fits_broadcast(keys):
        per_station = monthly_totals(
            readings.join(F.broadcast(keys), readings[station] == keys["__k"], "left_semi"))
    else:
        totals = monthly_totals(readings)
        per_station = totals.join(keys, totals["station"] == keys["__k"], "left_semi")
    return (per_station.groupBy("year", "month")
            .agg(F.avg("monthly_total").alias("mean_monthly_total"))
            .transform(lambda df: sort_calendar_result(df, F.col("year").desc(),
                                                       F.col("month").desc())))
