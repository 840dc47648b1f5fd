"""What the operators of this subpackage share: words, fingerprints of ids, written intermediates."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart.session import work_dir

# The white space that parts words, and the letters that are put in lower case.
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python workers, once per application.

    Where the package is installed on the cluster this changes nothing.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        folder = tempfile.mkdtemp(prefix="feedmart-package-")  # the driver serves the file from here
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/feedmart", "zip", root, "feedmart"))
        _SHIPPED.add(app)
    return spark


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z put in lower case and all other letters left alone; null stays null."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: str | None) -> list[bytes]:
    """The UTF-8 words of a text between the six white-space characters, case kept."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """As ``words_of`` with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def crc_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of an id's decimal text, modulo ``buckets``: the folds that labels are learnt from."""
    return F.crc32(doc_id.cast("string")) % buckets


def crc_of(doc_id: int, buckets: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % buckets


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here.

    A lost executor repeats tasks of the write, and later steps read the files from any executor.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Texts of an Arrow column, with the empty text for null."""
    return ["" if t is None else t for t in column.to_pylist()]
