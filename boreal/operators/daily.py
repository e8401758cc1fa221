"""Readings kept as one row per station and day, and the readings questions answered from those rows.

Number, sum, minimum, maximum, number above a threshold and maximum inside a band can all be merged, so a
(station, day) row answers every question on extremes, counts, means and totals, whatever the number of readings. The table is
kept up to date batch by batch: a batch adds rows for its own readings only, nothing is read again, and rows of one
day from several batches (late readings) are merged when read. Writing a batch a second time replaces it.

Layout: the table is bucketed by station. Grouping by station (and day or month) and joining two such tables by
station reuse that layout: no question shuffles (station, day) rows. A station holds one row per day and batch, so
one that sends a third of all readings is no larger bucket than others; its readings are summed map-side when a batch is
written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boreal.functions.calendar import year_range
from boreal.operators.joins import key_side
from boreal.operators.readings import sort_calendar_result

MEASURES = {"n_readings": "BIGINT", "total": "DOUBLE", "low": "DOUBLE", "high": "DOUBLE", "n_above": "BIGINT",
            "high_in_band": "DOUBLE"}
#: Readings of one bucket: at most as many rows, of which a task holds about 200 bytes each while it merges them.
BUCKET_READINGS = 500_000


def summarise(readings: DataFrame, threshold: float = 10.0, band: tuple[float, float] = (25.0, 30.0), *, station: str = "station",
              date: str = "date", value: str = "value") -> DataFrame:
    """One row per station and day of ``readings``: the measures. NULL values count nowhere; a day that has no
    other keeps its row. Readings without a station or a date are kept under NULL."""
    v = F.col(value)
    return readings.groupBy(F.col(station).alias("station"), F.to_date(date).alias("day")).agg(
        F.count(v).alias("n_readings"), F.sum(v.cast("double")).alias("total"), F.min(v).cast("double").alias("low"),
        F.max(v).cast("double").alias("high"), F.count_if(v > threshold).alias("n_above"),
        F.max(F.when(v.between(*band), v)).cast("double").alias("high_in_band"))


def merged(rows: DataFrame) -> DataFrame:
    """One row per station and day from any number of partial ones."""
    return rows.groupBy("station", "day").agg(
        F.sum("n_readings").alias("n_readings"), F.sum("total").alias("total"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.sum("n_above").alias("n_above"), F.max("high_in_band").alias("high_in_band"))


def bucket_count(readings: int, least: int = 1) -> int:
    """Buckets of a table for this many readings: a task sorts, merges and groups whole buckets, so their number, not their
    size, grows with the table."""
    return max(least, -(-readings // BUCKET_READINGS))


def open_table(spark: SparkSession, name: str, location: str, buckets: int, station_type: str = "STRING") -> None:
    """Declare the daily table ``name`` over ``location``, a folder in shared storage; batches that are there already,
    of an earlier session too, are found. ``buckets`` is fixed with the first batch: ``bucket_count`` of all readings expected."""
    measures = ", ".join(f"{c} {t}" for c, t in MEASURES.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (station {station_type}, day DATE, {measures}, batch STRING) USING parquet "
              f"PARTITIONED BY (batch) CLUSTERED BY (station) SORTED BY (station, day) INTO {buckets} BUCKETS LOCATION '{location}'")
    try:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    except Exception as e:
        if "FileNotFoundException" not in str(e):  # the folder comes with the first batch
            raise


def add_batch(summary: DataFrame, name: str, batch: str) -> None:
    """Store the daily rows of a batch of readings; a batch of that name is replaced, others stay as they are."""
    spark = summary.sparkSession
    buckets = int(next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r[0] == "Num Buckets"))
    # dealt as the buckets are, so that every task writes one file; the rows are already one per station and day
    rows = summary.select("station", "day", *MEASURES).repartition(buckets, "station").sortWithinPartitions("station", "day")
    rows.createOrReplaceTempView(view := f"{name}_incoming")
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (batch = '{batch}') SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def compact(spark: SparkSession, name: str, new_name: str, location: str) -> None:
    """A copy of the table with one merged batch, under another name and folder: after many small batches readers
    move on to it, and nothing of the old table is touched."""
    station = next(t for c, t in spark.table(name).dtypes if c == "station")
    buckets = int(next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r[0] == "Num Buckets"))
    open_table(spark, new_name, location, buckets, station)
    add_batch(daily_rows(spark, name), new_name, "compacted")


def daily_rows(spark: SparkSession, name: str) -> DataFrame:
    """The merged rows of the table, with batches that other sessions (a stream's, for one) have added by now: grouped
    inside its buckets."""
    spark.catalog.refreshTable(name)
    return merged(spark.table(name).drop("batch"))


def _period(daily: DataFrame, first_year: int | None, last_year: int | None) -> DataFrame:
    return daily if first_year is None and last_year is None else daily.where(year_range("day", first_year, last_year))


def _month() -> list[Column]:
    return [F.year("day").alias("year"), F.month("day").alias("month")]


def yearly_extrema(daily: DataFrame, first_year: int = 1950, last_year: int = 2014) -> DataFrame:
    """Lowest and highest value per year."""
    return (_period(daily, first_year, last_year).groupBy(F.year("day").alias("year"))
            .agg(F.min("low").alias("min_value"), F.max("high").alias("max_value"))
            .transform(lambda df: sort_calendar_result(df, "year")))


def yearly_argmax(daily: DataFrame, first_year: int = 1950, last_year: int = 2014) -> DataFrame:
    """Highest value per year with its station (ties: the larger key)."""
    per_station = (_period(daily, first_year, last_year).where("high IS NOT NULL")
                   .groupBy("station", F.year("day").alias("year")).agg(F.max("high").alias("high")))
    return (per_station.groupBy("year").agg(F.max("high").alias("max_value"), F.max_by("station", F.struct("high", "station")).alias("station"))
            .transform(lambda df: sort_calendar_result(df, F.col("year").desc())))


def monthly_exceedance_count(daily: DataFrame, first_year: int = 1950, last_year: int = 2014) -> DataFrame:
    """Readings above the threshold per month, most first."""
    return (_period(daily, first_year, last_year).where("n_above > 0 AND station IS NOT NULL").groupBy(*_month())
            .agg(F.sum("n_above").alias("n_readings"))
            .transform(lambda df: sort_calendar_result(df, F.col("n_readings").desc(), "year", "month")))


def monthly_exceedance_station_count(daily: DataFrame, first_year: int = 1950, last_year: int = 2014) -> DataFrame:
    """Stations with a reading above the threshold per month, most first."""
    per_station = (_period(daily, first_year, last_year).where("n_above > 0 AND station IS NOT NULL")
                   .groupBy("station", *_month()).agg(F.count(F.lit(1)).alias("days")))
    return (per_station.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_stations"))
            .transform(lambda df: sort_calendar_result(df, F.col("n_stations").desc(), "year", "month")))


def station_monthly_mean(daily: DataFrame, first_year: int = 1960, last_year: int = 2014) -> DataFrame:
    """Mean per station and month."""
    return (_period(daily, first_year, last_year).groupBy("station", *_month())
            .agg(F.try_divide(F.sum("total"), F.sum("n_readings")).alias("mean_value"))
            .orderBy(F.col("station").desc(), F.col("year").desc(), F.col("month").desc()))


def _joined(temperatures: DataFrame, precipitation: DataFrame) -> DataFrame:
    return temperatures.join(precipitation, "station").orderBy(F.col("station").desc())


def extremes_band_join(temperatures: DataFrame, precipitation: DataFrame, temperature_band=(25.0, 30.0),
                       precipitation_band=(100.0, 200.0)) -> DataFrame:
    """Stations whose highest temperature and highest daily precipitation lie in the bands."""
    t = temperatures.groupBy("station").agg(F.max("high").alias("max_temperature"))
    p = precipitation.groupBy("station").agg(F.max("total").alias("max_daily_precipitation"))
    return _joined(t.where(F.col("max_temperature").between(*temperature_band)),
                   p.where(F.col("max_daily_precipitation").between(*precipitation_band)))


def extremes_prefilter_join(temperatures: DataFrame, precipitation: DataFrame) -> DataFrame:
    """Highest values among the readings inside the bands that the two tables were summarised with."""
    t = temperatures.groupBy("station").agg(F.max("high_in_band").alias("max_temperature")).where("max_temperature IS NOT NULL")
    p = precipitation.groupBy("station").agg(F.max("high_in_band").alias("max_precipitation")).where("max_precipitation IS NOT NULL")
    return _joined(t, p)


def extremes_total_band_join(temperatures: DataFrame, precipitation: DataFrame, temperature_band=(25.0, 30.0),
                             precipitation_band=(100.0, 200.0)) -> DataFrame:
    """As ``extremes_band_join`` with each station's total precipitation."""
    t = temperatures.groupBy("station").agg(F.max("high").alias("max_temperature"))
    p = precipitation.groupBy("station").agg(F.sum("total").alias("total_precipitation"))
    return _joined(t.where(F.col("max_temperature").between(*temperature_band)),
                   p.where(F.col("total_precipitation").between(*precipitation_band)))


def regional_monthly_mean(precipitation: DataFrame, region_stations: DataFrame, first_year: int = 1993, last_year: int = 2016, *,
                          region_station: str = "station") -> DataFrame:
    """Monthly total per station of a region, averaged over its stations with readings."""
    keys = key_side(region_stations, region_station)
    totals = _period(precipitation, first_year, last_year).groupBy("station", *_month()).agg(F.sum("total").alias("monthly_total"))
    return (totals.join(keys, totals["station"] == keys["__k"], "left_semi").groupBy("year", "month")
            .agg(F.avg("monthly_total").alias("mean_monthly_total"))
            .transform(lambda df: sort_calendar_result(df, F.col("year").desc(), F.col("month").desc())))
