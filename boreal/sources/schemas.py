"""Declared schemas of the positional reading files and of the company tables.

Reading files are headerless, ``;``-separated text; every field is addressed by position. The schema
names and types each position once, in the scan, instead of renaming ``_c0.._c4`` and casting per
query. Values are read as ``double`` (a 32-bit float drifts in the 7th digit of a mean).
"""

from pyspark.sql import types as T

_S = T.StringType()
_D = T.DoubleType()
_I = T.IntegerType()


def _fields(*pairs) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in pairs])


# station;YYYY-MM-DD;HH:MM:SS;value;quality
TEMPERATURE_READINGS = _fields(
    ("station", _S), ("date", T.DateType()), ("time", _S), ("value", _D), ("quality", _S))
PRECIPITATION_READINGS = TEMPERATURE_READINGS

# station;name;height;latitude;longitude (a region's station file has the same layout; only the
# key is read from it)
STATIONS = _fields(("station", _S), ("name", _S), ("height", _S),
                   ("latitude", _D), ("longitude", _D))
REGION_STATIONS = STATIONS

# Company tables: names, types and nullability of the relational schema.
def _strict(*triples) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in triples])


COMPANY = {
    "jbemployee": _strict(("id", _I, False), ("name", _S, True), ("salary", _I, True),
                          ("manager", _I, True), ("birthyear", _I, True), ("startyear", _I, True)),
    "jbdept": _strict(("id", _I, False), ("name", _S, True), ("store", _I, False),
                      ("floor", _I, True), ("manager", _I, True)),
    "jbitem": _strict(("id", _I, False), ("name", _S, True), ("dept", _I, False),
                      ("price", _I, True), ("qoh", _I, True), ("supplier", _I, False)),
    "jbparts": _strict(("id", _I, False), ("name", _S, True), ("color", _S, True),
                       ("weight", _I, True), ("qoh", _I, True)),
    "jbsupply": _strict(("supplier", _I, False), ("part", _I, False),
                        ("shipdate", T.DateType(), False), ("quan", _I, True)),
    "jbsale": _strict(("debit", _I, False), ("item", _I, False), ("quantity", _I, True)),
    "jbdebit": _strict(("id", _I, False), ("sdate", T.TimestampType(), True),
                       ("employee", _I, False), ("account", _I, False)),
    "jbcity": _strict(("id", _I, False), ("name", _S, True), ("state", _S, True)),
    "jbstore": _strict(("id", _I, False), ("city", _I, False)),
    "jbsupplier": _strict(("id", _I, False), ("name", _S, True), ("city", _I, False)),
}
