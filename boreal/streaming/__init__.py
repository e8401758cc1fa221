"""Readings arriving as files: the delimited scan as a Structured Streaming source.

Two ways to keep the readings questions up to date while files arrive:

* ``run_to_parquet`` runs a single-aggregate job of ``boreal.operators.readings`` (``yearly_extrema``,
  ``monthly_exceedance_count``, ``station_monthly_mean``, ``station_monthly_mean_sumcount``) incrementally in ``complete`` mode,
  with the state under the checkpoint folder. Structured Streaming rejects the other questions as streams: distinct
  counts, chained aggregates and joins of two aggregated streams.
* ``run_to_daily`` merges every micro-batch into a stored daily table (``boreal.operators.daily``), from which all
  questions are answered at any time, those included: a day's total, the set of stations above a threshold and the maxima of both
  sides of a join all follow from (station, day) rows. A micro-batch is a batch of that table under its own
  number, so one that is run again after a failure replaces itself: every reading counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from boreal.operators import daily
from boreal.session import scratch_path


def read_delimited_stream(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                          max_files_per_trigger: int | None = None,
                          date_format: str = "yyyy-MM-dd") -> DataFrame:
    reader = (spark.readStream.schema(schema).option("sep", sep).option("header", "false")
              .option("mode", "FAILFAST").option("dateFormat", date_format))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(path)


def run_to_parquet(result: DataFrame, path: str, checkpoint: str | None = None,
                   available_now: bool = True) -> StreamingQuery:
    """Run a streaming aggregate in ``complete`` mode; each micro-batch replaces the parquet table
    at ``path`` with the current full result (idempotent on replay)."""
    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = (result.writeStream.outputMode("complete").foreachBatch(write)
              .option("checkpointLocation", checkpoint or scratch_path(result.sparkSession,
                                                                       "stream-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def run_to_daily(readings: DataFrame, table: str, checkpoint: str, threshold: float = 10.0, band: tuple[float, float] = (25.0, 30.0),
                 available_now: bool = True, **columns: str) -> StreamingQuery:
    """Merge a stream of readings into the daily table ``table`` (see ``daily.open_table``). ``checkpoint`` is the stream's
    folder in shared storage: a query started again with it goes on where the last one ended."""
    def merge(batch: DataFrame, epoch: int) -> None:
        daily.add_batch(daily.summarise(batch, threshold, band, **columns), table, f"epoch-{epoch:012d}")

    writer = readings.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
