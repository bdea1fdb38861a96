"""ISO timestamps: text to UTC timestamps and back, whatever the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HAS_OFFSET_PATTERN = r"(?:Z|[+-]\d\d(?::?\d\d)?)$"
HAS_TIME_PATTERN = r"\d[T ]\d"


def parse_utc(text: Column) -> Column:
    """ISO text to a timestamp. Text without an offset is UTC; unreadable text gives NULL."""
    known = text.rlike(HAS_TIME_PATTERN) & text.rlike(HAS_OFFSET_PATTERN)
    date_only = ~text.rlike(HAS_TIME_PATTERN)
    full = (
        F.when(known, text)
        .when(date_only, F.concat(text, F.lit("T00:00:00Z")))
        .otherwise(F.concat(text, F.lit("Z")))
    )
    return full.try_cast("timestamp")


def _utc_wall_clock(moment: Column) -> Column:
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))


def iso_utc(moment: Column) -> Column:
    """Timestamp to ISO text that ends in Z, with microseconds if there are any."""
    wall = _utc_wall_clock(moment)
    whole = F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(wall, "SSSSSS")
    return F.concat(whole, F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)), F.lit("Z"))


def run_stamp(moment: Column) -> Column:
    """Name of a run record: its finish time to the second."""
    return F.date_format(_utc_wall_clock(moment), "yyyyMMdd'T'HHmmss'Z'")


def report_time(moment: Column) -> Column:
    shown = F.date_format(_utc_wall_clock(moment), "yyyy-MM-dd HH:mm 'UTC'")
    return F.coalesce(shown, F.lit("N/A"))
