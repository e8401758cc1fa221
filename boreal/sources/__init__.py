"""Sources: typed schemas, the delimited-text scan and the parquet table loader."""

from boreal.sources.delimited import read_delimited, read_keys, split_delimited
from boreal.sources.schemas import (
    PRECIPITATION_READINGS,
    REGION_STATIONS,
    STATIONS,
    TEMPERATURE_READINGS,
)
from boreal.sources.tables import TABLES, load_table

__all__ = [
    "PRECIPITATION_READINGS",
    "REGION_STATIONS",
    "STATIONS",
    "TABLES",
    "TEMPERATURE_READINGS",
    "load_table",
    "read_delimited",
    "read_keys",
    "split_delimited",
]
