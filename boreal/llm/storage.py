"""Shared intermediate storage and small helpers of the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boreal.operators.joins import estimated_bytes
from boreal.session import checkpoint_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Cuts the lineage: later readers, and retries after a lost executor, read the files instead of
    computing ``df`` again.
    """
    path = f"{checkpoint_root(df.sparkSession).rstrip('/')}/boreal/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; ASCII texts take the fast built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of ``df``; 0 where it has none (it then says more than a petabyte)."""
    size = estimated_bytes(df)
    return size if size < 1 << 50 else 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
