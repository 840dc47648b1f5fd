"""JSON feeds, read as a batch or as a stream of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

# The name endings of the two feeds' files.
DOMESTIC_FILES = "*domestic.json"
INTERNATIONAL_FILES = "*international.json"

BAD_RECORD = "_corrupt_record"
FILE_PATH = "file_path"


def prune(schema: StructType, paths: Sequence[str]) -> StructType:
    """The schema cut down to some nested fields.

    Spark does not prune nested fields of a JSON scan by itself. Paths step through arrays and map
    values: ``data.items.price`` also names the price of each element of ``items``.
    """
    wanted: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        wanted.setdefault(head, []).append(rest)
    missing = wanted.keys() - set(schema.names)
    if missing:
        raise ValueError(f"no such field: {sorted(missing)}")
    return StructType(
        [
            StructField(f.name, _cut(f.dataType, wanted[f.name]), f.nullable)
            for f in schema.fields
            if f.name in wanted
        ]
    )


def _cut(kind: DataType, paths: list[str]) -> DataType:
    if "" in paths:
        return kind
    if isinstance(kind, ArrayType):
        return ArrayType(_cut(kind.elementType, paths), kind.containsNull)
    if isinstance(kind, MapType):
        return MapType(kind.keyType, _cut(kind.valueType, paths), kind.valueContainsNull)
    if isinstance(kind, StructType):
        return prune(kind, paths)
    raise ValueError(f"{kind.simpleString()} has no fields: {paths}")


def scan(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    files: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read JSON files with the given schema, plus each row's file path and unparsed text, if bad.

    ``files`` is a glob on file names, for example ``*domestic.json``. One record per line is
    expected unless ``multi_line`` is set; only the former splits large files.
    """
    reader = spark.read.schema(_with_bad_record(schema)).options(**_options(files, multi_line))
    return _with_path(reader.json(path))


def scan_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    files: str | None = None,
    multi_line: bool = False,
    max_files: int | None = None,
    max_bytes: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """As ``scan``, for files that keep arriving. A trigger takes at most so many files or bytes, not both.

    Files of a finished trigger are moved to ``archive``, which must lie outside ``path``, when the next
    one ends."""
    options = _options(files, multi_line)
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    if max_bytes:
        options["maxBytesPerTrigger"] = str(max_bytes)
    reader = spark.readStream.schema(_with_bad_record(schema)).options(**options)
    return _with_path(reader.json(path))


def records(scanned: DataFrame) -> DataFrame:
    """The rows for processing. A record that could be read in part keeps what could be read."""
    return scanned.drop(BAD_RECORD)


def is_bad(scanned: DataFrame) -> Column:
    """True for a record that did not parse in full. Never null."""
    # Spark refuses a JSON query that reads the bad-record column alone, as a count would: hence
    # the condition on a data column too.
    text = F.coalesce(F.col(BAD_RECORD), F.lit(""))
    return (text != "") | (F.col(BAD_RECORD).isNotNull() & F.col(_data(scanned)).isNotNull())


def quarantine(scanned: DataFrame) -> DataFrame:
    """The text and the file of each record that did not parse in full."""
    return scanned.where(is_bad(scanned)).select(
        FILE_PATH, F.col(BAD_RECORD).alias("record"), F.col(_data(scanned)).isNotNull().alias("partly_read")
    )


def _data(scanned: DataFrame) -> str:
    return next(c for c in scanned.columns if c not in (BAD_RECORD, FILE_PATH))


def _with_bad_record(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BAD_RECORD, StringType())])


def _options(files: str | None, multi_line: bool) -> dict[str, str]:
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD_RECORD,
        "multiLine": str(multi_line).lower(),
    }
    if files:
        options["pathGlobFilter"] = files
    return options


def _with_path(df: DataFrame) -> DataFrame:
    return df.withColumn(FILE_PATH, F.col("_metadata.file_path"))
