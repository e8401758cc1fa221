"""Join helpers. All but ``staged`` are lazy: nothing runs before the caller's action.

Whether a side is broadcast is left to Catalyst (its size estimate in bytes against
``spark.sql.autoBroadcastJoinThreshold``) and to AQE (measured bytes). ``fits_broadcast`` asks the same
question where a job has two forms of the same result and the better one depends on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.session import scratch_path


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of ``df``: no job, file sizes at most."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's estimate of ``df`` in bytes is within its own broadcast threshold."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) <= threshold


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared scratch folder and read back: it is computed once, later plans
    know its size, and a lost executor reads it again instead of computing it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_side(keys: DataFrame, key: str) -> DataFrame:
    """The distinct non-NULL keys as ``__k``: combined map-side, so a hot key is one row per task."""
    return keys.select(F.col(key).alias("__k")).where(F.col("__k").isNotNull()).distinct()


def semi_join(facts: DataFrame, keys: DataFrame, fact_key: str, key: str | None = None) -> DataFrame:
    """Rows of ``facts`` whose ``fact_key`` is in ``keys`` (``IN (subquery)`` as a left semi join).

    Duplicates in ``keys`` never multiply rows.
    """
    right = key_side(keys, key or fact_key)
    return facts.join(right, facts[fact_key] == right["__k"], "left_semi")
