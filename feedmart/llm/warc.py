"""WARC archives in Zstandard: a dictionary in the leading skippable frame, one frame per record.

Writing: each task writes one archive under a name of its own and returns a manifest row, so only the
archives of tasks that Spark committed are ever read; what a lost executor left is ignored. Payloads
that occur once or that stand for their group are response records, the others revisit them. Which is
which is decided on (id, digest) rows, with a partial maximum per digest in each task, so a payload that
a third of all pages share travels as one row per task.

Reading: a task opens the archives of its manifest rows one after the other, loads the dictionary,
decodes frame by frame and checks version line, headers, block length and digest; memory follows the
longest record. What is wrong raises ``WarcError`` with the archive and offset.

Defined results: null pages have an empty payload; equal payloads of fewer than ``least`` bytes are
responses of their own; repeated rows are records of their own, and of rows with the largest id all are
responses; null ids are kept and never referred to unless a group has no other id; empty tables give
empty results.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import landed
from feedmart.session import work_dir

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The namespace record ids are made in, so that reruns agree.
NAMESPACE = uuid.UUID("5c7a4f0e-64a1-5b8f-9c55-7f2c5b1c7e11")

#: Payload bytes an archive's dictionary is trained on, taken from its first records, and its size.
TRAIN_BYTES, DICTIONARY_BYTES = 2 << 20, 32 << 10
LEVEL = 3
#: Tasks that read archives, at most; there are no more than archives.
MOST_READERS = 4096


class WarcError(ValueError):
    """An archive that breaks the format."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, key)}>"


# --- one record -------------------------------------------------------------------------------------


def record(page_id: object, url: str, payload: bytes, revisits: str | None, refers_to: object) -> bytes:
    """A response record, or a revisit record whose block ends after the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisits else http + payload
    headers = {
        "WARC-Type": "revisit" if revisits else "response",
        "WARC-Record-ID": record_id(f"{page_id}"),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": " ".join((url or "urn:none").split()),
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "X-Page-ID": "" if page_id is None else str(page_id),
    }
    if revisits:
        headers |= {"WARC-Refers-To": revisits, "WARC-Profile": PROFILE, "X-Refers-To-Page": "" if refers_to is None else str(refers_to)}
    headers |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items()).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes, where: str) -> tuple[dict[str, str], bytes]:
    """Headers (lower case) and block of a record, checked."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in (b"WARC/1.0", VERSION):
        raise WarcError(f"{where}: no WARC header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"{where}: header line without a colon")
        headers[name.strip().decode().lower()] = value.strip().decode()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"{where}: no {name}")
    if not headers["content-length"].isdecimal():
        raise WarcError(f"{where}: bad content length")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"{where}: content length {n} does not fit a record of {len(rest)} bytes")
    return headers, rest[:n]


# --- one archive ------------------------------------------------------------------------------------


def _trained(samples: list[bytes]) -> bytes:
    """A dictionary, or raw sample bytes where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def write_archive(out: BinaryIO, records: Iterator[bytes]) -> int:
    """Write the dictionary frame and one frame per record; returns the number of records."""
    held, size = [], 0
    for raw in records:
        held.append(raw)
        size += len(raw)
        if size >= TRAIN_BYTES:
            break
    dictionary = _trained([r[: TRAIN_BYTES // 16] for r in held])
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
    press = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True, write_checksum=True
    )
    n = 0
    while held:
        for raw in held:
            out.write(press.compress(raw))
            n += 1
        held = [raw] if (raw := next(records, None)) is not None else []
    return n


def _refill(source: BinaryIO, buffer: bytes, least: int) -> bytes:
    while len(buffer) < least and (more := source.read(max(1 << 20, least - len(buffer)))):
        buffer += more
    return buffer


def read_archive(source: BinaryIO, name: str) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of every frame, in order."""
    buffer = _refill(source, b"", 8)
    if len(buffer) < 8:
        raise WarcError(f"{name}: shorter than a frame")
    magic, length = struct.unpack("<II", buffer[:8])
    if magic != DICTIONARY_MAGIC:
        raise WarcError(f"{name}: no dictionary frame at the start")
    buffer = _refill(source, buffer, 8 + length)
    if len(buffer) < 8 + length:
        raise WarcError(f"{name}: the dictionary frame is cut off")
    content, buffer, offset = buffer[8 : 8 + length], buffer[8 + length :], 8 + length
    if content[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may itself be packed
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    open_frame = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    while buffer := _refill(source, buffer, 4):
        if buffer[:4] != struct.pack("<I", FRAME_MAGIC):
            raise WarcError(f"{name} at {offset}: no frame where one should begin")
        frame, raw, fed = open_frame.decompressobj(), [], 0
        while True:
            try:
                raw.append(frame.decompress(buffer))
            except zstandard.ZstdError as e:
                raise WarcError(f"{name} at {offset}: {e}") from e
            fed += len(buffer)
            if frame.eof:
                break
            buffer = source.read(1 << 20)
            if not buffer:
                raise WarcError(f"{name} at {offset}: the frame is cut off")
        buffer = frame.unused_data
        yield offset, b"".join(raw)
        offset += fed - len(buffer)


# --- tables -----------------------------------------------------------------------------------------


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def write(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least: int = 0
) -> DataFrame:
    """Write all rows to archives in ``folder``; returns the manifest (path, n_records)."""
    kind = pages.schema[id_col].dataType.simpleString()
    body = F.coalesce(F.col(body_col), F.lit(""))
    bare = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), body.alias("body"))
    marked = bare.withColumn("sha", F.sha1("body"))
    heads = (
        marked.filter(F.octet_length("body") >= least)
        .groupBy("sha")
        .agg(F.max("id").alias("head"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("sha", "head")
    )
    # payloads that occur once have no row here; adaptive execution splits a frequent digest
    rows = marked.join(heads, "sha", "left").select("id", "url", "body", "head").withColumn(
        "revisit", F.col("head").isNotNull() & ~F.col("id").eqNullSafe(F.col("head")) & (F.octet_length("body") >= least)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    for r in batch.slice(at, 256).to_pylist():
                        payload = r["body"].encode("utf-8", "surrogatepass")
                        target = record_id(f"{r['head']}") if r["revisit"] else None
                        yield record(r["id"], r["url"], payload, target, r["head"])

        every = records()
        first = next(every, None)
        if first is None:
            return

        def again() -> Iterator[bytes]:
            yield first
            yield from every

        store, path = _place(f"{folder}/{uuid.uuid4().hex}.warc.zst")  # a name of this attempt alone
        store.create_dir(path.rpartition("/")[0], recursive=True)
        with store.open_output_stream(path) as out:
            n = write_archive(out, again())
        yield pa.RecordBatch.from_pydict({"path": [path.rpartition("/")[2]], "n_records": [n]})

    return landed(rows.mapInArrow(run, "path string, n_records long"), f"manifest-{kind}")


def read(manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """A row per record of the archives in the manifest, checked."""
    shape = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, body string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, promised in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, place = _place(f"{folder}/{path}")
                rows, size, n = [], 0, 0
                with store.open_input_stream(place) as source:
                    for offset, raw in read_archive(source, path):
                        rows.append(_row(*parsed(raw, f"{path} at {offset}"), f"{path} at {offset}"))
                        size, n = size + len(raw), n + 1
                        if size > 4 << 20 or len(rows) >= 2000:
                            yield _frame(rows)
                            rows, size = [], 0
                if n != promised:
                    raise WarcError(f"{path}: {n} records instead of {promised}")
                if rows:
                    yield _frame(rows)

    # a number is given, as Spark would put the few rows of a manifest into one partition otherwise
    spread = manifest.repartition(min(MOST_READERS, max(1, manifest.count())))
    return spread.mapInArrow(run, shape).select(
        F.nullif("page_id", F.lit("")).cast(id_type).alias("page_id"), "url", "payload_bytes", "payload_digest", "record_type",
        F.nullif("refers_to", F.lit("")).cast(id_type).alias("refers_to"), "body",
    )


def _row(headers: dict[str, str], block: bytes, where: str) -> tuple:
    head, gap, payload = block.partition(b"\r\n\r\n")
    length = [line.partition(b":")[2].strip() for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    if not gap or len(length) != 1 or not length[0].isdigit():
        raise WarcError(f"{where}: no HTTP header")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response":
        if len(payload) != int(length[0]):
            raise WarcError(f"{where}: payload of {len(payload)} bytes instead of {int(length[0])}")
        if digest_of(payload) != digest:
            raise WarcError(f"{where}: payload digest differs")
    elif kind == "revisit":
        if "warc-refers-to" not in headers or payload:
            raise WarcError(f"{where}: a revisit without reference or with a payload")
    else:
        raise WarcError(f"{where}: record type {kind}")
    return (
        headers.get("x-page-id", ""), headers.get("warc-target-uri", ""), int(length[0]), digest, kind,
        headers.get("x-refers-to-page", ""), payload.decode("utf-8", "surrogatepass") if kind == "response" else None,
    )


def _frame(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "body"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives in the shared folder and read them back."""
    folder = work_dir(pages.sparkSession, "warc")
    return read(write(pages, folder, least=least), folder, pages.schema["page_id"].dataType.simpleString())
