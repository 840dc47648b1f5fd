"""Code labels and encoded names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels that the output tables hold.
DOMESTIC_SEATS = {"Y": "일반석", "D": "할인석", "L": "특가석", "C": "비즈니스석"}
INTERNATIONAL_SEATS = {"Y": "일반석", "P": "이코노미", "C": "비즈니스석", "F": "일등석"}
ADULT_ANY_PAYMENT = "성인/모든 결제수단"
SEVERAL_AIRLINES = "airline 여러개"


def label(code: Column, names: Mapping[str, str]) -> Column:
    """The name of a code; null when the code is unknown."""
    pairs = [F.lit(text) for item in names.items() for text in item]
    return F.create_map(*pairs)[code]


def decoded(text: Column) -> Column:
    """URL-decoded text; null when the encoding is broken."""
    return F.try_url_decode(text)


def airline_label(airline: Column) -> Column:
    """The rollup's airline: one name, or a fixed label for itineraries flown by several."""
    return F.coalesce(airline, F.lit(SEVERAL_AIRLINES))
