"""Event-time helpers.

Hour keys are computed from epoch seconds with integer arithmetic, so they are UTC whatever the
session time zone is; the reference used the JVM's local zone, which merges two hours at the
autumn clock change.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: A zone at the end of a time (not of a date, whose ``-01`` is a day).
ZONE_SUFFIX = "[T ]\\S*\\s*(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"
DATE_ONLY = "^[+-]?[0-9]{4,6}(-[0-9]{1,2}){0,2}$"


def parse_created_at(created_at: Column) -> Column:
    """ISO-8601 text (``2024-03-07T08:15:30.250Z``) to TIMESTAMP; a time without a zone and a date alone are UTC (not
    the session zone); unparsable text gives null."""
    text = F.trim(created_at)
    day = F.timestamp_seconds(F.unix_date(text.try_cast("date")).cast("long") * 86400)
    timed = F.when(text.rlike(ZONE_SUFFIX), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(text.rlike(DATE_ONLY), day).otherwise(F.try_to_timestamp(timed))


def utc_date(ts: Column) -> Column:
    """UTC calendar date of a TIMESTAMP (for the ``date`` partition of landed tables)."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int"))


def iso_millis_utc(ts_ntz: Column) -> Column:
    """A TIMESTAMP_NTZ holding UTC wall-clock time as ``yyyy-MM-ddTHH:mm:ss.SSSZ`` (truncated to ms).

    Built from the fields, which are zone-free for NTZ; ``date_format`` would go through the
    session zone and shift times that fall into a daylight-saving gap there.
    """
    ms = (F.date_part(F.lit("SECOND"), ts_ntz) * 1000).cast("int") % 1000
    return F.format_string("%04d-%02d-%02dT%02d:%02d:%02d.%03dZ", F.year(ts_ntz), F.month(ts_ntz),
                           F.dayofmonth(ts_ntz), F.hour(ts_ntz), F.minute(ts_ntz), F.second(ts_ntz), ms)


def hour_key(ts: Column, prefix: str = "") -> list[Column]:
    """year, month, day, hour (UTC) of a TIMESTAMP, as four int columns."""
    secs = F.unix_seconds(ts)
    day = F.date_from_unix_date(F.floor(secs / F.lit(86400)).cast("int"))
    return [F.year(day).alias(f"{prefix}year"), F.month(day).alias(f"{prefix}month"),
            F.dayofmonth(day).alias(f"{prefix}day"),
            F.pmod(F.floor(secs / F.lit(3600)), F.lit(24)).cast("int").alias(f"{prefix}hour")]
