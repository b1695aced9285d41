"""Event-time column helpers.

Timestamps in the tables are TIMESTAMP_NTZ.  Arithmetic stays in that type
(intervals) so results never depend on a session time zone; epoch numbers go
through ``timestamp_diff`` from the NTZ epoch, which is zone-free too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_micros(col) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(col))


def epoch_millis(col) -> Column:
    return F.floor(epoch_micros(col) / 1000).cast("bigint")


def epoch_seconds(col) -> Column:
    return F.floor(epoch_micros(col) / 1_000_000).cast("bigint")


def ntz_from_micros(col) -> Column:
    """Inverse of :func:`epoch_micros`; result is TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", _c(col), F.expr(_EPOCH_NTZ))


def ntz_from_millis(col) -> Column:
    return ntz_from_micros(_c(col) * 1000)


def ntz_from_seconds(col) -> Column:
    return ntz_from_micros(_c(col) * 1_000_000)


def millis_text(col) -> Column:
    """Epoch milliseconds as the text a SQL timestamp prints as: seconds, a point and the fraction
    without trailing zeros, at least one digit (``2024-01-01 00:00:05.25``). UTC; NULL stays NULL."""
    millis = _c(col)
    digits = F.lpad(F.pmod(millis, F.lit(1000)).cast("string"), 3, "0")
    fraction = F.concat(F.substring(digits, 1, 1), F.rtrim(F.substring(digits, 2, 2), F.lit("0")))
    return F.concat(F.date_format(ntz_from_millis(millis), "yyyy-MM-dd HH:mm:ss"), F.lit("."), fraction)


def bucket_start(col, width_micros: int) -> Column:
    """Start of the fixed bucket of ``width_micros`` holding the timestamp."""
    e = epoch_micros(col)
    return ntz_from_micros(F.floor(e / width_micros).cast("bigint") * width_micros)


def bucket_index(col, width_micros: int) -> Column:
    return F.floor(epoch_micros(col) / width_micros).cast("bigint")


MICROS = {
    "ms": 1_000,
    "s": 1_000_000,
    "min": 60_000_000,
    "h": 3_600_000_000,
    "d": 86_400_000_000,
}


def micros(amount: float, unit: str) -> int:
    return int(amount * MICROS[unit])
