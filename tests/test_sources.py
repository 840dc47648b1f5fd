from __future__ import annotations

import json

import pytest
from pyspark.sql.types import StructType

from feedmart.sources import feeds, jdbc, schemas
from tests import fixtures as fx

FLAT = StructType().add("data", StructType().add("id", "integer").add("name", "string"))


def test_prune_keeps_only_the_named_fields(spark):
    schema = schemas.struct("a struct<b:array<struct<c:int,d:int>>,m:map<string,struct<x:int,y:int>>>,z int")
    cut = feeds.prune(schema, ["a.b.d", "a.m.x"])
    assert cut.simpleString() == "struct<a:struct<b:array<struct<d:int>>,m:map<string,struct<x:int>>>>"
    with pytest.raises(ValueError):
        feeds.prune(schema, ["a.q"])


def test_files_are_chosen_by_name(spark, tmp_path, rows):
    for name in ("1_domestic.json", "2_domestic.json", "3_international.json", "4_domestic.txt"):
        folder = fx.write(tmp_path, "2025-05-29", "all", name, {"data": {"id": int(name[0])}})
    (tmp_path / "2025-05-29" / "all" / "deeper").mkdir()
    (tmp_path / "2025-05-29" / "all" / "deeper" / "5_domestic.json").write_text('{"data":{"id":5}}')
    found = feeds.scan(spark, folder, FLAT, files=feeds.DOMESTIC_FILES)
    assert rows(found, "data.id") == [(1,), (2,)]
    names = [path.rsplit("/", 1)[1] for (path,) in rows(found, "file_path")]
    assert names == ["1_domestic.json", "2_domestic.json"]


def test_quarantine(spark, tmp_path, rows):
    good = json.dumps({"data": {"id": 1, "name": "a"}})
    folder = fx.write(tmp_path, "2025-05-29", "all", "1.json", None, good)
    fx.write(tmp_path, "2025-05-29", "all", "2.json", None, good[:-4])
    fx.write(tmp_path, "2025-05-29", "all", "3.json", None, '{"data":{"id":"x","name":"b"}}')
    scanned = feeds.scan(spark, folder, FLAT)
    assert rows(feeds.records(scanned).where("data is not null"), "data.name") == [("a",), ("b",)]
    assert rows(feeds.quarantine(scanned), "record", "partly_read") == [
        (good[:-4], False), ('{"data":{"id":"x","name":"b"}}', True)
    ]


def test_multi_line_documents(spark, tmp_path, rows):
    text = json.dumps({"data": {"id": 1, "name": "a"}}, indent=2)
    folder = fx.write(tmp_path, "2025-05-29", "all", "1.json", None, text)
    by_line = feeds.scan(spark, folder, FLAT)
    assert feeds.quarantine(by_line).count() == len(text.splitlines())
    whole = feeds.scan(spark, folder, FLAT, multi_line=True)
    assert rows(feeds.records(whole), "data.id") == [(1,)]
    assert feeds.quarantine(whole).count() == 0


def test_jdbc_options():
    chosen = jdbc.options("jdbc:x:y", "t_staging", writers=4, properties={"user": "u"})
    assert chosen == {
        "url": "jdbc:x:y", "dbtable": "t_staging", "batchsize": "30000", "numPartitions": "4",
        "user": "u",
    }
