"""Append to a database table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# Fixed value: rows per insert statement.
INSERT_ROWS = 30_000


def append(df: DataFrame, options: Mapping[str, str]) -> None:
    df.write.format("jdbc").mode("append").options(**options).save()


def options(
    url: str,
    table: str,
    writers: int | None = None,
    insert_rows: int = INSERT_ROWS,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Writer options. Each task opens one connection, and ``writers`` bounds how many there are.

    A task that is run again may insert its rows again, so the table should be a staging table.
    """
    chosen = {"url": url, "dbtable": table, "batchsize": str(insert_rows)}
    if writers:
        chosen["numPartitions"] = str(writers)
    return {**chosen, **(properties or {})}
