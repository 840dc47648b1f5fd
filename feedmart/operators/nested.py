"""Nested values to rows. Null and empty collections give no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def elements(df: DataFrame, array: Column | str, name: str, keep: list[str | Column]) -> DataFrame:
    """One row per array element."""
    return df.select(*keep, F.explode(array).alias(name))


def positioned(
    df: DataFrame, array: Column | str, position: str, name: str, keep: list[str | Column]
) -> DataFrame:
    """One row per array element, with its 0-based position."""
    return df.select(*keep, F.posexplode(array).alias(position, name))


def entries(
    df: DataFrame, mapping: Column | str, key: str, value: str, keep: list[str | Column]
) -> DataFrame:
    """One row per map entry."""
    return df.select(*keep, F.explode(mapping).alias(key, value))
