"""Keys and parts of keys, paths and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The path and URL formats of the feeds.
DATE_FOLDER = r"[/=](\d{4}-\d{2}-\d{2})/"
CABIN_IN_NAME = r"_([YPCF])_"
LEG_SEPARATOR = "+"
FARE_RULE_PARAM = "FareRuleItnInfo"


def composite_key(*parts: Column | str) -> Column:
    """The parts joined as text; null when any part is null."""
    return F.concat(*parts)


def is_connection(itinerary_id: Column | str) -> Column:
    """True for an id made of several leg ids."""
    return F.contains(_col(itinerary_id), F.lit(LEG_SEPARATOR))


def leg_id(itinerary_id: Column | str, ordinal: Column | str) -> Column:
    """The id of the leg at a 0-based position; null when the id has no such part."""
    return F.get(F.split(_col(itinerary_id), r"\+"), _col(ordinal))


def path_date(path: Column | str) -> Column:
    """The day of the folder a file lies in (``/2025-01-31/`` or ``/day=2025-01-31/``), else null."""
    day = F.regexp_extract(_col(path), DATE_FOLDER, 1)
    return F.try_to_date(day, "yyyy-MM-dd")


def path_cabin(path: Column | str) -> Column:
    """The cabin code in a file name, else empty text."""
    return F.regexp_extract(_col(path), CABIN_IN_NAME, 1)


def url_param_part(
    url: Column | str, param: str = FARE_RULE_PARAM, position: int = 2, default: str = "n"
) -> Column:
    """Part ``position`` (0-based, ``/`` between parts) of a URL parameter.

    The default stands in for a missing URL, a missing parameter and a value with too few parts.
    """
    value = F.nullif(F.regexp_extract(_col(url), f"{param}=([^&]+)", 1), F.lit(""))
    return F.coalesce(F.get(F.split(value, "/"), F.lit(position)), F.lit(default))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
