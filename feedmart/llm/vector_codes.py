"""Product-quantised vector codes, learnt by Lloyd's rounds over resident members.

Components become integers, and a vector is cut into ``PARTS`` equal parts. Every part position has a
codebook of ``ENTRIES`` entries, learnt in ``ROUNDS`` rounds of assigning and averaging.

Between rounds a part lives with the owner of its entry: parts are partitioned by (position, entry,
salt), and an owner adds up the members it holds. After the entries have moved, an owner looks for the
nearest entry of each member. Members that keep their entry stay where they are; only those that change
it are sent, to the owner of their new entry, and joined to its residents by a union of equally
partitioned sets, which shuffles nothing else. That is done on RDDs of column blocks, as no DataFrame
operator keeps its partitioning through Python. The salt splits an entry that holds much of the data.
What comes back to the driver in a round is one sum per entry, which does not grow with the data.

The last assignment needs no owners: it is one narrow pass over the table. Owners' blocks are kept for one
round; a lost executor's blocks are made again from the input and the rounds' shuffles.

All arithmetic is exact: in doubles where they hold every sum exactly, else in Python's integers. An error
beyond a long is given as the largest long.

Defined results: a vector that is null or holds a null or non-finite component has no row. Shorter
vectors, and all if the longest does not split evenly, are filled up with zeros. Null ids come after all
others, equal ids are ordered by their components; each row has a code of its own. Fewer than
``ENTRIES`` rows make as many entries. Entries that no part uses stay as they are. With no row left the
result is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024

#: Owners of one entry. An entry with a third of all parts is held by so many.
SALTS = 16

#: Rows of the table that are worked on together.
CHUNK = 4096

#: Whole numbers up to here are exact in doubles.
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1

Books = list[np.ndarray]  # per position, entries x width, whole numbers
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # position, entry, salt, parts


def usable(vector: Column) -> Column:
    """True for a vector whose components can all be scaled; never null."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def scaled(vectors: pa.Array, width: int) -> np.ndarray:
    """Whole numbers, as doubles: rows x (PARTS * width). A double holds each of them exactly."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), PARTS * width))
    filled = np.arange(PARTS * width)[None, :] < lengths[:, None]
    out[filled] = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype("f8") * SCALE)
    return out


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, of equally near ones the first, and its squared distance."""
    most = max(_most(parts), _most(book))
    if 4 * most * most * book.shape[1] <= _EXACT:
        far = (parts**2).sum(axis=1)[:, None] - 2.0 * (parts @ book.T) + (book**2).sum(axis=1)[None, :]
        entry = far.argmin(axis=1)
        return entry, far[np.arange(len(parts)), entry].astype("i8")
    whole = [[int(x) for x in entry] for entry in book]
    entries, errors = [], []
    for part in parts:
        far = [sum((int(x) - y) ** 2 for x, y in zip(part, entry, strict=True)) for entry in whole]
        entries.append(min(range(len(far)), key=far.__getitem__))
        errors.append(min(far[entries[-1]], _LONG))
    return np.array(entries, dtype="i8"), np.array(errors, dtype="i8")


def first_books(vectors: DataFrame, width: int, entries: int = ENTRIES) -> Books:
    """The parts of the ``entries`` smallest ids: a bounded top-k."""
    rows = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    whole = scaled(pa.array([r[0] for r in rows], pa.list_(pa.float64())), width)
    return [whole[:, p * width : (p + 1) * width].copy() for p in range(PARTS)]


def learnt(vectors: DataFrame, width: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Books, list[int]]:
    """The codebooks, and how many parts changed their owner in each round after the first."""
    books = first_books(vectors, width, entries)
    owners = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = _placed(vectors, books, width, owners).partitionBy(owners, _owner)
    kept, moved = None, []
    for turn in range(rounds):
        if turn:
            assigned = placed.mapPartitions(_reassigned(books, placed.getNumPartitions()), preservesPartitioning=True)
            assigned.persist(StorageLevel.MEMORY_AND_DISK)
            placed = resident(assigned)
        sums = placed.mapPartitions(_sums).reduceByKey(_added, min(owners, PARTS * len(books[0]))).collect()
        moved.append(sum(s[2] for _, s in sums))
        books = [book.copy() for book in books]
        for (position, entry), (count, total, _) in sums:  # one row per entry in use
            books[position][entry] = [t // count for t in total]
        if turn:
            if kept is not None:
                kept.unpersist()
            kept = assigned
    if kept is not None:
        kept.unpersist()
    return books, moved[1:]


def resident(assigned: RDD) -> RDD:
    """Blocks that stay and blocks that have come in: equally partitioned, so the union moves nothing."""
    stay = assigned.mapPartitions(lambda found: ((k, (b, 0)) for k, (b, away) in found if not away), preservesPartitioning=True)
    come = assigned.mapPartitions(lambda found: ((k, (b, len(b[0]))) for k, (b, away) in found if away))
    return stay.union(come.partitionBy(assigned.getNumPartitions(), _owner))


def encoded(vectors: DataFrame, books: Books, width: int) -> DataFrame:
    """(id, label, code, error) of every row under fixed codebooks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in _chunks(batches, width):
            codes, errors = [], np.zeros(len(rows), "i8")
            for p in range(PARTS):
                entry, far = nearest(rows[:, p * width : (p + 1) * width], books[p])
                codes.append(entry)
                errors = np.where(errors > _LONG - far, _LONG, errors + far)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.array([bytes(c).hex() for c in np.stack(codes, axis=1).astype("u1")], pa.string()),
                    pa.array(errors, pa.int64()),
                ],
                ["id", "label", "code", "error"],
            )

    kinds = dict(vectors.dtypes)
    return vectors.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def books_digest(books: Books) -> str:
    numbers = (str(int(x)) for book in books for entry in book for x in entry)
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compress(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Per kept row: its code, its error, the error of its label, and the digest of the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError(f"two hex digits hold 256 entries: {entries}")
    vectors = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")).filter(
        usable(F.col("vector"))
    )
    longest = vectors.agg(F.max(F.size("vector"))).first()[0]
    width = -(-(longest or 0) // PARTS)
    books, _ = learnt(vectors, width, entries, rounds) if longest is not None else ([np.zeros((1, 0))] * PARTS, [])
    found = encoded(vectors, books, width)
    # A label's rows meet its sum in one of SALTS places, so a common label is not one task.
    salt = F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int")
    sums = found.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"))
    salted = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    total = F.least(F.col("sum"), F.lit(_LONG)).cast("long")
    return (
        found.withColumn("salt", salt)
        .join(salted.withColumnRenamed("salt", "s"), (F.col("salt") == F.col("s")) & F.col("label").eqNullSafe(F.col("of")))
        .select(F.col("id").alias(id_col), "code", "error", total.alias("label_error"), F.lit(books_digest(books)).alias("codebooks_sha256"))
    )


def _most(numbers: np.ndarray) -> float:
    return float(np.abs(numbers).max(initial=0))


def _owner(key: int) -> int:
    return key


def _owners_of(position: np.ndarray, entry: np.ndarray, salt: np.ndarray, owners: int) -> np.ndarray:
    """Cells dealt over the owners by a multiplicative hash."""
    cell = ((position.astype("u8") << np.uint64(8) | entry.astype("u8")) << np.uint64(16)) | salt.astype("u8")
    return ((cell * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(owners)


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            piece = batch.slice(start, CHUNK)
            yield piece, scaled(piece.column("vector"), width)


def _dealt(block: Block, owners: int) -> Iterator[tuple[int, Block]]:
    """A block cut by the owners of its cells."""
    owner = _owners_of(*block[:3], owners)
    order = np.argsort(owner, kind="stable")
    cuts = np.flatnonzero(np.diff(owner[order])) + 1
    for chosen in np.split(order, cuts) if len(order) else []:
        yield int(owner[chosen[0]]), tuple(column[chosen] for column in block)


def _placed(vectors: DataFrame, books: Books, width: int, owners: int) -> RDD:
    """Blocks by owner under the first codebooks: the one time that all parts are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for _, rows in _chunks(batches, width):
            salt = ((np.arange(len(rows)) + seen) % SALTS).astype("u2")
            seen += len(rows)
            for p in range(PARTS):
                parts = rows[:, p * width : (p + 1) * width]
                entry = nearest(parts, books[p])[0].astype("u2")
                keys, blocks = [], []
                for owner, (_, e, s, x) in _dealt((np.full(len(rows), p, "u1"), entry, salt, parts), owners):
                    keys.append(owner)
                    blocks.append(e.tobytes() + s.tobytes() + np.ascontiguousarray(x).tobytes())
                yield pa.RecordBatch.from_pydict(
                    {"owner": pa.array(keys, pa.int32()), "position": pa.array([p] * len(keys), pa.int32()), "block": pa.array(blocks, pa.binary())}
                )

    def block(row) -> tuple[int, tuple[Block, int]]:
        data = bytes(row["block"])
        n = len(data) // (4 + 8 * width)
        entry, salt = np.frombuffer(data, "u2", n), np.frombuffer(data, "u2", n, 2 * n)
        parts = np.frombuffer(data, "f8", n * width, 4 * n).reshape(n, width)
        return row["owner"], ((np.full(n, row["position"], "u1"), entry, salt, parts), n)

    return vectors.select("vector").mapInArrow(run, "owner int, position int, block binary").rdd.map(block)


def _reassigned(books: Books, owners: int) -> Callable:
    """Members under new codebooks: (owner, (block, True if the members have to go))."""

    def run(blocks: Iterator) -> Iterator[tuple[int, tuple[Block, bool]]]:
        for owner, held in _gathered(blocks):
            position, entry, salt, parts = held
            new = entry.copy()
            for p in range(PARTS):
                at = np.flatnonzero(position == p)
                if len(at):
                    new[at] = nearest(parts[at], books[p])[0]
            stay = new == entry
            if stay.any():
                yield owner, (tuple(c[stay] for c in held), False)
            go = ~stay
            if go.any():
                for to, block in _dealt((position[go], new[go], salt[go], parts[go]), owners):
                    yield to, (block, True)

    return run


def _gathered(blocks: Iterator) -> Iterator[tuple[int, Block]]:
    """Blocks of an owner put together up to a bounded size, so that arithmetic runs on many rows."""
    held: list[Block] = []
    owner, n = -1, 0
    for owner, (block, _) in blocks:  # noqa: B007  # one owner per partition
        held.append(block)
        n += len(block[0])
        if n >= CHUNK:
            yield owner, tuple(map(np.concatenate, zip(*held, strict=True)))
            held, n = [], 0
    if held:
        yield owner, tuple(map(np.concatenate, zip(*held, strict=True)))


def _sums(blocks: Iterator) -> Iterator[tuple[tuple[int, int], tuple[int, list[int], int]]]:
    """Per entry: members, their sum, and how many came in this round."""
    found: dict[tuple[int, int], tuple[int, list[int], int]] = {}
    for _, (block, came) in blocks:
        position, entry, _, parts = block
        cell = position.astype("i8") * ENTRIES + entry
        order = np.argsort(cell, kind="stable")
        for chosen in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1) if len(order) else []:
            members = parts[chosen]
            if _most(members) * len(members) <= _EXACT:
                total = [int(x) for x in members.sum(axis=0)]
            else:
                total = [sum(map(int, column)) for column in members.T]
            key = divmod(int(cell[chosen[0]]), ENTRIES)
            one = (len(chosen), total, len(chosen) if came else 0)
            found[key] = _added(found[key], one) if key in found else one
    yield from found.items()


def _added(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], list(map(add, a[1], b[1])), a[2] + b[2]
