"""Dimension lookups.

No join here carries a broadcast hint. Spark broadcasts a dimension when its size, as read from the
files or measured at run time, is below ``spark.sql.autoBroadcastJoinThreshold``; a larger one is
joined by key, and adaptive execution splits the codes that hold much of the data.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame,
    dim: DataFrame,
    code: str,
    dim_key: str,
    take: Mapping[str, str],
    defaults: Mapping[str, Column] | None = None,
    known: str | None = None,
) -> DataFrame:
    """Add dimension columns (``take``: dimension column to new name) for the code in ``df``.

    Rows with an unknown code stay and get the default, or null. ``known`` names an optional flag
    that tells whether the code was found and no value taken from it is null. The dimension must be
    unique by its key.
    """
    defaults = defaults or {}
    hit = "__hit"
    side = dim.select(
        F.col(dim_key).alias("__code"),
        reduce(and_, [F.col(c).isNotNull() for c in take], F.lit(True)).alias(hit),
        *[F.col(c).alias(f"__{new}") for c, new in take.items()],
    )
    joined = df.join(side, F.col(code) == F.col("__code"), "left")
    added = []
    for new in take.values():
        found = F.col(f"__{new}")
        added.append((F.coalesce(found, defaults[new]) if new in defaults else found).alias(new))
    if known:
        added.append(F.coalesce(F.col(hit), F.lit(False)).alias(known))
    return joined.select(*df.columns, *added)


def both_ends(df: DataFrame, dim: DataFrame, dim_key: str, first: str, second: str) -> DataFrame:
    """Keep the rows whose two codes are both in the dimension."""
    codes = dim.select(F.col(dim_key).alias("__code"))
    return df.join(codes, F.col(first) == F.col("__code"), "left_semi").join(
        codes, F.col(second) == F.col("__code"), "left_semi"
    )
