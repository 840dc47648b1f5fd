"""Archives: exact round trips, revisits, and what is wrong with an archive."""

from __future__ import annotations

import base64
import hashlib
import io
import random

import pytest

from feedmart.llm import warc
from feedmart.llm.common import ship


def archive(records):
    out = io.BytesIO()
    warc.write_archive(out, iter(records))
    return out.getvalue()


def records(n=40):
    return [warc.record(k, f"http://x/{k}", (f"<p>page {k} " * (k * 30)).encode(), None, None) for k in range(n)]


def test_frames_give_records_back():
    raw = records()
    assert [r for _, r in warc.read_archive(io.BytesIO(archive(raw)), "a")] == raw
    big = [warc.record(1, "u", random.Random(1).randbytes(5 << 20), None, None), *raw]
    assert [r for _, r in warc.read_archive(io.BytesIO(archive(big)), "a")] == big
    assert [r for _, r in warc.read_archive(io.BytesIO(archive(raw[:1])), "a")] == raw[:1]


def test_offsets_point_at_frames():
    data = archive(records())
    for offset, raw in warc.read_archive(io.BytesIO(data), "a"):
        assert data[offset : offset + 4] == b"\x28\xb5\x2f\xfd"


@pytest.mark.parametrize(
    "harm",
    [
        lambda d: d[4:],
        lambda d: d[:-7],
        lambda d: d + b"junk",
        lambda d: d[:6],
        lambda d: d[:-30] + bytes([d[-30] ^ 255]) + d[-29:],
    ],
)
def test_broken_archives_are_refused(harm):
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(io.BytesIO(harm(archive(records()))), "a"))


def test_broken_records_are_refused():
    good = records(2)[1]
    for bad in (
        good.replace(b"WARC/1.1", b"WARC/9"),
        good[:-2],
        good.replace(b"Content-Length: ", b"Content-Length: 1", 1),
        good.replace(b"WARC-Date", b"X-Date"),
    ):
        with pytest.raises(warc.WarcError):
            warc.parsed(bad, "r")
    headers, block = warc.parsed(good, "r")
    with pytest.raises(warc.WarcError):
        warc._row(headers, block[:-1] + b"?", "r")


def expect(rows, least):
    heads = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= least:
            heads.setdefault(b, []).append(i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        head = max((x for x in heads.get(b, []) if x is not None), default=None)
        again = len(b) >= least and head is not None and i != head
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", head if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 6])
def test_round_trip(spark, least):
    ship(spark)
    bodies = [None, "", "<p>é</p>", "<p>é</p>", "<p>é</p>", "tiny", "tiny", "x" * 300000, None]
    rows = [(k * 5 % 11, f"http://x/{k}", b) for k, b in enumerate(bodies)] + [(None, None, "<p>é</p>"), (None, "u v", "only")]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, body string")
    got = warc.round_trip(pages, least)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == expect(rows, least)
    texts = {i: h for i, _, h in rows}
    for r in got.filter("record_type = 'response' and page_id is not null").collect():
        assert r["body"] == (texts[r["page_id"]] or "")


def test_empty_table(spark):
    ship(spark)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).count() == 0
