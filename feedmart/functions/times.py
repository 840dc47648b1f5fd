"""Wall-clock text, zones and durations. Text that does not parse gives null.

Local times carry no zone (``timestamp_ntz``), and instants come from text that names its zone. So
results do not depend on the session's zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the feeds' local time format, yyyyMMddHHmm.
LOCAL_FORMAT = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})$"


def local_time(text: Column | str) -> Column:
    whole = F.regexp_like(_col(text), F.lit(LOCAL_FORMAT))
    spaced = F.regexp_replace(_col(text), LOCAL_FORMAT, "$1-$2-$3 $4:$5:00")
    return F.when(whole, spaced.try_cast("timestamp_ntz"))


def to_utc(local: Column | str, zone: Column | str) -> Column:
    """The instant of a local time. A local time that occurs twice gives the earlier instant; a zone
    that does not exist gives null."""
    wall = _col(local).cast("timestamp_ntz").cast("string")
    return F.concat(wall, F.lit(" "), _col(zone)).try_cast("timestamp")


def real_zone(zone: Column | str) -> Column:
    """The zone if there is one of that name, else null."""
    return F.when(F.concat(F.lit("2000-01-01 00:00:00 "), _col(zone)).try_cast("timestamp").isNotNull(), _col(zone))


def minutes(hours: Column, mins: Column) -> Column:
    return hours.try_cast("int") * 60 + mins.try_cast("int")


def minutes_hh_mm(text: Column | str) -> Column:
    """``HH:MM`` with any one separator."""
    return minutes(F.substring(text, 1, 2), F.substring(text, 4, 2))


def minutes_hhmm(text: Column | str) -> Column:
    return minutes(F.substring(text, 1, 2), F.substring(text, 3, 2))


def minutes_pair(pair: Column | str) -> Column:
    """``[HH, MM]``; null when either is missing."""
    return minutes(F.get(_col(pair), F.lit(0)), F.get(_col(pair), F.lit(1)))


def minutes_any(text: Column | str) -> Column:
    """``HHMM`` or ``HH:MM``, else null."""
    digits = F.regexp_extract(_col(text), r"^(\d{2}):?(\d{2})$", 1), F.regexp_extract(
        _col(text), r"^(\d{2}):?(\d{2})$", 2
    )
    return minutes(*digits)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
