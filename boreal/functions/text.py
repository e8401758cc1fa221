"""String helpers for the warehouse questions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_before(col: str | Column, sep: str) -> Column:
    """Text before the first ``sep``; empty when ``sep`` is absent (``substring(s, 1, pos - 1)``).

    ``substring_index`` would return the whole string when ``sep`` is absent; this keeps the
    ``position``-based answer: the length is -1 and the result is ``''``.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c, F.lit(1), F.instr(c, sep) - 1)


def normalized_equals(col: str | Column, value: str) -> Column:
    """Case- and space-insensitive equality: ``lower(trim(col)) = lower(trim(value))``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.trim(c)) == F.lit(value.strip().lower())
