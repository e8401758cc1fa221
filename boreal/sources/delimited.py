"""Delimited text scan with a declared schema.

``spark.read.csv`` with an explicit ``StructType`` parses each line once in the JVM, prunes unread
positions and splits files across tasks; the path may be any Hadoop URI (``file://``, ``hdfs://``,
object stores). ``mode`` decides what a malformed field does: ``FAILFAST`` stops the job (a value
that is not a number), ``PERMISSIVE`` turns the field into NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


MODES = ("FAILFAST", "PERMISSIVE")  # fail on a malformed field, or read it as NULL; never drop rows


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                   mode: str = "FAILFAST", date_format: str = "yyyy-MM-dd") -> DataFrame:
    if mode.upper() not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return (spark.read.schema(schema)
            .option("sep", sep)
            .option("header", "false")
            .option("mode", mode)
            .option("dateFormat", date_format)
            .csv(path))


REJECTED, LINE = "__rejected", "__line"


def split_delimited(spark: SparkSession, path: str, schema: T.StructType, out: str, sep: str = ";",
                    date_format: str = "yyyy-MM-dd") -> tuple[DataFrame, DataFrame]:
    """Lines that hold ``schema`` and the rest, in one pass: (good, rejects).

    A line with a field that is not of its type, with fields missing or with too many is a reject, kept as it
    stands with the name of its file; no field of it is read as NULL. Both are parquet under ``out``, written by one
    scan of the text into a folder each, so that reading one never touches the other. Together they are all lines but the empty ones.
    """
    declared = T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])
    rows = (spark.read.schema(declared).option("sep", sep).option("header", "false").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", LINE).option("dateFormat", date_format).csv(path))
    rows.select("*", F.col("_metadata.file_name").alias("__file"), F.col(LINE).isNotNull().alias(REJECTED)) \
        .write.partitionBy(REJECTED).parquet(out)
    stored = T.StructType([*declared.fields, T.StructField("__file", T.StringType()), T.StructField(REJECTED, T.BooleanType())])
    found = spark.read.schema(stored).parquet(out)
    good = found.where(~F.col(REJECTED)).select(*[F.col(f"`{c}`") for c in schema.names])
    return good, found.where(F.col(REJECTED)).select(F.col(LINE).alias("line"), F.col("__file").alias("file"))


def read_keys(spark: SparkSession, path: str, key: str = "station", sep: str = ";",
              key_type: T.DataType = T.StringType(), mode: str = "FAILFAST") -> DataFrame:
    """The first field of each line as a one-column key table (e.g. a region's stations).

    A key that is not of ``key_type`` stops the job (``FAILFAST``) or becomes NULL (``PERMISSIVE``);
    lines without a key give no row.
    """
    if mode.upper() not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    # A one-field schema over a wider file: the CSV reader keeps the first field, drops the rest.
    schema = T.StructType([T.StructField("__key", T.StringType(), True)])
    text = F.trim("__key")
    value = text.try_cast(key_type) if mode.upper() == "PERMISSIVE" else text.cast(key_type)
    return (spark.read.schema(schema).option("sep", sep).option("header", "false")
            .option("mode", "PERMISSIVE").csv(path)
            .where(text != "").select(value.alias(key)))
