"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str] = (),
    total: bool = False,
) -> DataFrame:
    """Keep one row per key: the first in ``order``, with ties broken by all other columns.

    A column name in ``order`` means its largest value first, and nulls last. ``total`` says that
    ``order`` leaves no ties, so that columns nobody uses need not be read.

    The survivor does not depend on how the rows are spread. Spark limits each task to one row per
    key before the shuffle, so a key that holds much of the data is reduced where it is read.
    """
    named = [c for c in order if isinstance(c, str)]
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in {*keys, *named} and "map<" not in f.dataType.simpleString()
    ]
    ranking = [*order, *([] if total else rest)]
    first = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in ranking]
    ranked = Window.partitionBy(*keys).orderBy(*first)
    return df.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")


def by_version(names: Sequence[str], paths: Sequence[str] = ("file_path",)) -> list[Column | str]:
    """An order for ``newest``: the largest values first. Of file paths the longer one counts as larger, so
    that ``file-10`` follows ``file-9``; paths of one length go by their characters."""
    return [c for n in names for c in ([F.length(n).desc_nulls_last(), n] if n in paths else [n])]


def split_by_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is whole, and those that lack a part of it: together all rows, each once.

    Rows without a whole key cannot be told apart by it, so they must not be reduced to one per key. The
    second frame has one more column, ``lacks``: the names of the missing parts.
    """
    lacks = F.filter(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys]), lambda name: name.isNotNull())
    whole = F.size(lacks) == 0
    return df.where(whole), df.where(~whole).withColumn("lacks", lacks)


def valid_keys(*sides: DataFrame) -> DataFrame:
    """The distinct keys of all sides, which share one column."""
    first, *rest = sides
    for side in rest:
        first = first.unionByName(side)
    return first.distinct()


def having_key(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in the set.

    The set grows with the data, so nothing is hinted. It is made distinct first: a key that makes
    up much of it is then one row per task before the shuffle."""
    return df.join(keys.select(on).distinct(), on, "left_semi")
