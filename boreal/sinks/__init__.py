"""Sinks: ordered text and CSV output.

A result is range-partitioned and sorted (``orderBy``) and written as many files whose names follow the global
order, so no single task holds the whole result. ``single_file=True`` asks for one file: the same parts, joined by
the store (``boreal.sinks.single``).

Sort keys are column names or Columns (``F.col("year").desc()``); all other columns break ties, so a
sort value shared by many rows spans several files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.sinks.single import join_parts, prepared


def _ordered(df: DataFrame, sort_columns) -> DataFrame:
    keys = [F.col(c) if isinstance(c, str) else c for c in sort_columns or []]
    ties = [F.col(f"`{c}`") for c in df.columns]
    return df.orderBy(*keys, *ties) if keys else df


def to_lines(df: DataFrame, sep: str = ";") -> DataFrame:
    """One ``value`` string per row, fields joined by ``sep``: NULL is an empty field, and a field that
    holds the separator, a quote or a line break is quoted, so positions never shift."""
    def field(c: str):
        text = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
        special = text.contains(sep) | text.rlike('["\\r\\n]')
        return F.when(special, F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    return df.select(F.concat_ws(sep, *[field(c) for c in df.columns]).alias("value"))


def _write_single(df: DataFrame, path: str, mode: str, extension: str, write, header: str | None = None) -> None:
    spark = df.sparkSession
    if prepared(spark, path, mode):
        parts = f"{path.rstrip('/')}-parts-{uuid.uuid4().hex}"
        write(df, parts)
        join_parts(spark, parts, path, extension, header)


def write_text(df: DataFrame, path: str, sort_columns=(), sep: str = ";", single_file: bool = False,
               mode: str = "errorifexists") -> None:
    """Delimited text lines, ordered by ``sort_columns``."""
    lines = to_lines(_ordered(df, sort_columns), sep)
    if single_file:
        _write_single(lines, path, mode, ".txt", lambda rows, to: rows.write.text(to))
    else:
        lines.write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, sort_columns=(), sep: str = ",", header: bool = True,
              single_file: bool = False, mode: str = "errorifexists") -> None:
    """CSV with a header, ordered by ``sort_columns``."""
    ordered = _ordered(df, sort_columns)
    if single_file:
        _write_single(ordered, path, mode, ".csv", lambda rows, to: rows.write.option("sep", sep).csv(to),
                      sep.join(f'"{c}"' if sep in c or '"' in c else c for c in df.columns) if header else None)
    else:
        ordered.write.mode(mode).option("sep", sep).option("header", str(header).lower()).csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = ";", mode: str = "errorifexists") -> None:
    """Headerless delimited files in parallel (no ordering), readable by ``read_delimited``."""
    df.write.mode(mode).option("sep", sep).option("header", "false") \
        .option("dateFormat", "yyyy-MM-dd").csv(path)
