"""SAS-style date text (``01MAR2024``, ``04MAR2025:17:09:00``) to typed values.

``d`` (not ``dd``) accepts one- and two-digit days; month names parse in upper
case.  Timestamps come out as TIMESTAMP_NTZ (wall clock as written), so the
session time zone never shifts them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casegrid.functions._util import to_col

SAS_DATE_FORMAT = "dMMMyyyy"
SAS_TIMESTAMP_FORMAT = "dMMMyyyy:HH:mm:ss"


def sas_date(c, strict: bool = True) -> Column:
    src = to_col(c)
    tried = F.try_to_date(src, SAS_DATE_FORMAT)
    if not strict:
        return tried
    return F.when(src.isNull() | tried.isNotNull(), tried).otherwise(
        F.raise_error(F.concat(F.lit("bad SAS date: "), src)).cast("date"))


def sas_timestamp(c, strict: bool = True) -> Column:
    src = to_col(c)
    ok = F.try_to_timestamp(src, F.lit(SAS_TIMESTAMP_FORMAT)).isNotNull()
    # to_timestamp_ntz runs only on text the lenient parser accepted
    parsed = F.when(ok, F.to_timestamp_ntz(src, F.lit(SAS_TIMESTAMP_FORMAT)))
    if not strict:
        return parsed
    return F.when(src.isNull() | ok, parsed).otherwise(
        F.raise_error(F.concat(F.lit("bad SAS timestamp: "), src)).cast("timestamp_ntz"))


def render_sas_date(c) -> Column:
    """Date/timestamp -> ``DDMONYYYY`` upper-case text."""
    return F.upper(F.date_format(to_col(c), "ddMMMyyyy"))


def render_sas_timestamp(c) -> Column:
    return F.upper(F.date_format(to_col(c), "ddMMMyyyy:HH:mm:ss"))
