"""Declared schemas of the base tables. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()
_TS, _MONEY, _B, _F = T.TimestampNTZType(), T.DecimalType(18, 2), T.BooleanType(), T.DoubleType()


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


CUSTOMERS = _table(
    ("emailaddress", _S), ("firstname", _S), ("lastname", _S), ("address", _S),
    ("address2", _S), ("city", _S), ("state", _S), ("zip", _S), ("billingaddress", _S),
    ("billingzip", _S), ("notes", _S), ("datecreated", _TS), ("birthdate", _D),
    ("phone", _S), ("phone2", _S), ("id", _L), ("memberof", _S), ("referrer", _S),
    ("classcount", _I), ("firstclass", _TS), ("lastclass", _TS), ("company", _S),
    ("keytag", _S), ("emergencycontact", _S), ("emergencyphone", _S),
    ("preferredlocation", _S), ("gender", _S), ("weight", _F),
)

SALES = _table(
    ("dt", _TS), ("custid", _L), ("pmtype", _S), ("total", _MONEY), ("item", _S),
    ("typ", _S), ("firstname", _S), ("lastname", _S), ("studio", _S),
)

ATTENDANCE = _table(
    ("id", _L), ("custid", _L), ("firstname", _S), ("lastname", _S), ("emailaddress", _S),
    ("status", _S), ("spot", _I), ("datein", _TS), ("seriesid", _L), ("series", _S),
    ("classdate", _TS), ("classtype", _S), ("inst", _S), ("room", _S), ("cost", _MONEY),
)

# The two running counts are added by the attendance load.
ATTENDANCE_STORED = T.StructType(
    ATTENDANCE.fields + [T.StructField("num", _L, True), T.StructField("totnum", _L, True)]
)

OPEN_SERIES = _table(
    ("emailaddress", _S), ("firstname", _S), ("lastname", _S), ("series", _S),
    ("cost", _MONEY), ("count", _I), ("remaining", _I), ("purchdt", _TS),
    ("expiredt", _TS), ("comped", _B), ("lastclass", _TS), ("prefloc", _S),
)

OCCUPANCY = _table(("dt", _TS), ("site", _S), ("instr", _S), ("unavail", _I), ("total", _I))

# Header names an attendance export must carry, by our column.
ATTENDANCE_HEADER = {
    "custid": "CUSTOMERID",
    "status": "STATUS",
    "classdate": "CLASSDATE",
    "datein": "DATEIN",
}
