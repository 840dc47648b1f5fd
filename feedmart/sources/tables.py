"""Keyed Parquet tables with upsert.

A table is partitioned by a value that follows from its key, so a row never changes partition and
an upsert reads and rewrites only the partitions that its rows fall in. Where a table format with
row-level operations is at hand, ``merge_into`` leaves the work to it.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from feedmart.operators.dedupe import by_version, newest
from feedmart.operators.keyed import marked, same_key, without
from feedmart.session import reused
from feedmart.sources.feeds import FILE_PATH

#: The folder column of held micro-batches.
HELD = "held_batch"
#: Held rows are brought in once they have so many times the bytes of what is stored. Bringing in rewrites
#: what is stored, so all in all the share of one part in so many is written again.
OUTGROWN = 16


@dataclass(frozen=True)
class Slot:
    """The partition column: a key column itself, or an expression (SQL text) over the key.

    ``parts`` names columns the expression is over in place of the key, each with its own expression over the key.
    They have few values, so the partitions of many rows are found without a text per row."""

    name: str
    expression: str | None = None
    type_name: str = "string"
    parts: tuple[tuple[str, str], ...] = ()


def by_column(name: str) -> Slot:
    return Slot(name)


def by_hash(keys: Sequence[str], slots: int) -> Slot:
    """``slots`` partitions by key hash. The count is part of the column name: a table written with
    one count cannot be read with another by mistake."""
    return Slot(f"slot_of_{slots}", f"pmod(xxhash64({', '.join(keys)}), {slots})", "int")


def by_leading_month(key: str, slots: int) -> Slot:
    """Partitions by the month of a key that starts with a day of the years 1970 to 2099 as
    ``yyyyMMdd``, so that new data leaves past months alone; all other keys go to ``slots`` hash
    partitions. So there are 1560 months at most, whatever the keys look like."""
    day = f"left({key}, 8)"
    # by rising cost: most other keys are told by their first two characters
    is_day = f"left({key}, 2) IN ('19', '20') AND {day} RLIKE '^(19[7-9]|20[0-9])[0-9]{{5}}$' AND try_to_date({day}, 'yyyyMMdd') IS NOT NULL"
    return Slot(
        f"month_or_slot_of_{slots}",
        f"CASE WHEN {is_day} THEN left({key}, 6) ELSE concat('h', pmod(xxhash64({key}), {slots})) END",
    )


def by_day_and_hash(day: str, key: str, slots: int) -> Slot:
    """Partitions by a day and, within it, by the hash of a key: either alone narrows a scan."""
    return Slot(
        f"day_and_slot_of_{slots}",
        "concat(coalesce(cast(__day as string), 'none'), '_', __hash)",
        parts=(("__day", day), ("__hash", f"pmod(xxhash64({key}), {slots})")),
    )


@dataclass(frozen=True)
class KeyedTable:
    """One row per key below ``path``.

    ``version`` names columns that order the versions of a row. With it, an older version never
    replaces a newer one, in whatever order they arrive; without it, the last upsert wins.
    One writer at a time; see ``Lease``.
    """

    path: str
    schema: StructType
    keys: tuple[str, ...]
    slot: Slot
    version: tuple[str, ...] = ()

    @property
    def staging(self) -> str:
        return f"{self.path.rstrip('/')}_staging"

    def read(self, spark: SparkSession) -> DataFrame:
        return self.stored(spark).select(*self.schema.names)

    def read_where(self, spark: SparkSession, in_slot: Column) -> DataFrame:
        """The stored rows in the partitions of which a condition on the slot column is true."""
        return self.stored(spark).where(in_slot).select(*self.schema.names)

    def read_slots(self, spark: SparkSession, slots: list) -> DataFrame:
        return self.read_where(spark, self.in_slots(slots))

    def upsert(
        self, updates: DataFrame, order: Sequence[Column | str] = (), landed: bool = False
    ) -> None:
        """Insert new keys and replace the other columns of existing ones.

        Rows that share a key are first reduced to one: the newest version, then by ``order``.
        ``landed`` says that the rows are unique by key already and are read from files.
        """
        updates = updates.select(*self.schema.names)
        if landed:
            self._rewrite(updates.sparkSession, updates, self.merged)
            return
        with reused(newest(updates, self.keys, [*by_version(self.version), *order])) as new:
            self._rewrite(updates.sparkSession, new, self.merged)

    def hold(self, updates: DataFrame, batch_id: int) -> None:
        """Keep a micro-batch's rows beside the table, and upsert all that is held once it has outgrown the table.

        An upsert of keys from everywhere rewrites the whole table, so one per micro-batch would write the
        square of what comes in; this way it is a multiple. A batch that is run again replaces what it held.
        Call ``settle_held`` at the end."""
        updates.select(*self.schema.names).write.mode("overwrite").parquet(f"{self._held}/{HELD}={batch_id}")
        self.settle_held(updates.sparkSession, OUTGROWN)

    def settle_held(self, spark: SparkSession, outgrown: float = 0) -> None:
        """Upsert what is held, if it has ``outgrown`` times the bytes of the table."""
        held = Folder(spark, self._held)
        if not held.exists() or held.bytes() < outgrown * Folder(spark, self.path).bytes():
            return
        with reused(self.newest_held(spark, self._held)) as new:
            self._rewrite(spark, new, self.merged)
        held.delete()

    def newest_held(self, spark: SparkSession, folder: str) -> DataFrame:
        """The rows of all batches held in ``folder``, one per key: the newest version, then the last batch."""
        return newest(self.all_held(spark, folder), self.keys, [*by_version(self.version), HELD]).drop(HELD)

    def all_held(self, spark: SparkSession, folder: str) -> DataFrame:
        """The rows of all batches held in ``folder``, with the batch."""
        fields = [*self.schema.fields, StructField(HELD, LongType())]
        return spark.read.schema(StructType(fields)).parquet(folder)

    @property
    def _held(self) -> str:
        return f"{self.path.rstrip('/')}_held"

    def replace(self, touched: DataFrame, rows: DataFrame) -> None:
        """Remove the keys in ``touched`` and add ``rows``, whose keys are among them.

        ``touched`` is read twice, so it should be kept or lie in files.
        """

        def content(gone: DataFrame, slots: list) -> DataFrame:
            current = self.read_slots(touched.sparkSession, slots)
            return without(current, gone, self.keys).unionByName(rows.select(*self.schema.names))

        self._rewrite(touched.sparkSession, touched.select(*self.keys), content)

    def merged(self, offered: DataFrame, slots: list, before: Sequence[str] = ()) -> DataFrame:
        """What the partitions ``slots`` hold once ``offered``, unique by key, has come in.

        Three further columns tell how: ``__offered``, ``__changed`` (the offered row is the newer one),
        and ``__before``, the columns ``before`` of the row as stored, null for a new row.
        """
        current = self.read_slots(offered.sparkSession, slots)
        names = self.schema.names
        left = current.select(*self.keys, F.struct(*names).alias("__before"))
        right = marked(offered, self.keys, F.struct(*names).alias("__new"))
        both = left.join(right, same_key(self.keys), "full_outer")
        changed = F.col("__new").isNotNull()
        if self.version:
            old, new = (F.struct(*[c for v in self.version for c in _version_parts(side, v)]) for side in ("__before", "__new"))
            changed &= F.col("__before").isNull() | ~(old > new)
        return both.select(
            F.when(changed, F.col("__new")).otherwise(F.col("__before")).alias("__row"),
            F.col("__new").isNotNull().alias("__offered"),
            changed.alias("__changed"),
            F.when(F.col("__before").isNotNull(), F.struct(*[F.col("__before")[c].alias(c) for c in before or self.keys])).alias("__before"),
        ).select("__row.*", "__offered", "__changed", "__before")

    def recover(self, spark: SparkSession) -> None:
        """Finish a publication that the driver did not live to finish."""
        Publication(spark, self.staging).publish({"table": self})

    def _rewrite(self, spark: SparkSession, keyed: DataFrame, content) -> None:
        self.recover(spark)
        out = Publication(spark, self.staging)
        slots = self.slots_of(keyed)
        out.stage("table", self, content(keyed, slots), slots)
        out.mark()
        out.publish({"table": self})

    # -- partitions ----------------------------------------------------------------------------

    def slotted(self, df: DataFrame) -> DataFrame:
        if self.slot.expression is None:
            return df
        value = F.expr(self.slot.expression).cast(self.slot.type_name)
        parts = {name: F.expr(expression) for name, expression in self.slot.parts}
        return (df.withColumns(parts) if parts else df).withColumn(self.slot.name, value).drop(*parts)

    def distinct_slots(self, df: DataFrame) -> DataFrame:
        """The partitions the rows fall in, each once."""
        if not self.slot.parts:
            return self.slotted(df).select(self.slot.name).distinct()
        parts = df.select(*[F.expr(expression).alias(name) for name, expression in self.slot.parts]).distinct()
        return parts.select(F.expr(self.slot.expression).cast(self.slot.type_name).alias(self.slot.name)).distinct()

    def slots_of(self, df: DataFrame) -> list:
        """The same as a list: at most as many values as the table has partitions."""
        return [row[0] for row in self.distinct_slots(df).collect()]

    def in_slots(self, slots: list) -> Column:
        inside = F.col(self.slot.name).isin([s for s in slots if s is not None])
        return inside | F.col(self.slot.name).isNull() if None in slots else inside

    def stored_schema(self) -> StructType:
        fields = list(self.schema.fields)
        if self.slot.expression is not None:
            fields += StructType.fromDDL(f"{self.slot.name} {self.slot.type_name}").fields
        return StructType([StructField(f.name, f.dataType) for f in fields])

    def stored(self, spark: SparkSession) -> DataFrame:
        """The stored rows with the partition column."""
        full = self.stored_schema()
        table = Folder(spark, self.path)
        if not table.exists():
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in full.fields]
            return spark.range(1).select(*nothing).limit(0)  # the optimizer knows it to be empty
        others = [p for p in table.partitions() if not p.startswith(f"{self.slot.name}=")]
        if others:
            raise ValueError(f"{self.path} is partitioned otherwise: {others[0]}")
        return spark.read.schema(full).parquet(self.path).select(*full.names)


class Publication:
    """New partitions of one or more tables: written aside, marked as whole, then brought in.

    ``stage`` writes the whole new content of partitions and changes no table. ``mark`` says that all of
    it is there. ``publish`` has Spark overwrite just those partitions, by whatever committer the store
    has, removes the partitions that are empty now, and clears the staged files. A run that is cut short
    before the mark has changed nothing; after it, ``publish`` can be repeated until it comes through.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = Folder(spark, folder)
        self._path = folder
        self._emptied: dict[str, list[str]] = {}

    def stage(self, name: str, table: KeyedTable, rows: DataFrame, slots: list) -> DataFrame:
        """Write the new content of ``slots``, and return it with any further columns it has."""
        if not self._emptied:
            self._folder.delete()
        path = f"{self._path}/{name}"
        rows = table.slotted(rows)
        rows.hint("rebalance", table.slot.name).write.mode("overwrite").partitionBy(table.slot.name).parquet(path)
        filled = set(Folder(self._spark, path).partitions())
        self._emptied[name] = [
            n for n in Folder(self._spark, table.path).partitions() if n not in filled and _value_of(n) in set(map(_text_of, slots))
        ]
        reached(f"staged {name}")
        return self._spark.read.schema(rows.schema).parquet(path)

    def mark(self) -> None:
        self._folder.child("_STAGED").write_new(json.dumps(self._emptied))
        reached("marked")

    def publish(self, tables: Mapping[str, KeyedTable]) -> bool:
        """Bring in what is marked, if anything is; true if so."""
        mark = self._folder.child("_STAGED")
        if not mark.exists():
            return False
        for name, emptied in json.loads(mark.text()).items():
            table = tables[name]
            schema = table.stored_schema()
            rows = self._spark.read.schema(schema).parquet(f"{self._path}/{name}").select(*schema.names)
            (
                rows.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(table.slot.name)
                .parquet(table.path)
            )
            reached(f"published {name}")
            for partition in emptied:
                Folder(self._spark, table.path).child(partition).delete()
            reached(f"emptied {name}")
        mark.delete()
        reached("unmarked")
        self._folder.delete()
        return True


def reached(step: str) -> None:
    """Called between the steps of a publication; tests cut it short here."""


@contextmanager
def lease(spark: SparkSession, path: str, owner: str, patience: float = 600, stale: float = 6 * 3600) -> Iterator[None]:
    """Hold the right to write, or raise ``Held`` after ``patience`` seconds.

    The right is a file that one writer manages to create. Its owner, running again after a failure, takes
    its own file over; another one may do so once the file is ``stale`` seconds old.
    """
    file = Folder(spark, path)
    give_up = time.monotonic() + patience
    while not file.write_new(owner):
        holder, age = file.text_if_there(), file.age()
        if holder == owner or age is not None and age > stale:
            break
        if time.monotonic() >= give_up:
            raise Held(f"{path} is held by {holder}")
        time.sleep(min(1.0, max(0.0, give_up - time.monotonic())))
    try:
        yield
    finally:
        file.delete()


class Held(RuntimeError):
    """Another writer has the right to write."""


def merge_into(updates: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Upsert into a catalog table whose format supports row-level operations."""
    same = reduce(
        lambda a, b: a & b, [F.col(f"{table}.{k}").eqNullSafe(F.col(f"updates.{k}")) for k in keys]
    )
    merge = updates.alias("updates").mergeInto(table, same)
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Append one micro-batch. A batch that is run again replaces what it wrote before."""
    (
        df.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


class Folder:
    """A folder or file of whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def child(self, name: str) -> Folder:
        return Folder(
            self._spark, self._spark._jvm.org.apache.hadoop.fs.Path(self._path, name).toString()
        )

    def exists(self) -> bool:
        return self._fs.exists(self._path)

    def delete(self) -> None:
        self._fs.delete(self._path, True)

    def bytes(self) -> int:
        """The size of all files below."""
        return self._fs.getContentSummary(self._path).getLength() if self.exists() else 0

    def names(self) -> list[str]:
        """Names of what lies directly below."""
        if not self.exists():
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path)]

    def partitions(self) -> list[str]:
        """Names of the partition folders directly below."""
        return [n for n in self.names() if "=" in n]

    def write_new(self, text: str) -> bool:
        """Create the file with a short text; false if it is there already."""
        try:
            out = self._fs.create(self._path, False)
        except Py4JJavaError as e:
            if self.exists():
                return False
            raise e
        out.write(bytearray(text, "utf-8"))
        out.close()
        return True

    def text(self) -> str:
        stream = self._fs.open(self._path)
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def text_if_there(self) -> str | None:
        try:
            return self.text()
        except Py4JJavaError:
            if self.exists():
                raise
            return None

    def age(self) -> float | None:
        """Seconds since the last change."""
        try:
            return time.time() - self._fs.getFileStatus(self._path).getModificationTime() / 1000
        except Py4JJavaError:
            return None


def _version_parts(row: str, name: str) -> list[Column]:
    """In the order of ``by_version``."""
    value = F.col(row)[name]
    return [F.length(value), value] if name == FILE_PATH else [value]


def _value_of(partition: str) -> str:
    return unquote(partition.partition("=")[2])


def _text_of(slot) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if slot is None else str(slot)
