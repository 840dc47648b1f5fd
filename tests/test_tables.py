from __future__ import annotations

import datetime as dt

import pytest

from feedmart.sources import tables
from feedmart.sources.tables import Folder, KeyedTable, append_batch, by_column, by_day_and_hash, by_hash, by_leading_month
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DDL = "k string, day date, price int, seen int"
D1, D2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)


@pytest.fixture
def table(spark, tmp_path):
    def make(slot=None, version=()):
        slot = slot or by_column("day")
        return KeyedTable(str(tmp_path / "t"), StructType.fromDDL(DDL), ("k", "day"), slot, version)

    return make


def frame(spark, *values):
    return spark.createDataFrame(list(values), StructType.fromDDL(DDL))


def test_insert_and_replace(spark, table, rows):
    t = table()
    assert t.read(spark).count() == 0
    t.upsert(frame(spark, ("a", D1, 1, 0), ("b", D1, 2, 0), ("c", D2, 3, 0)))
    t.upsert(frame(spark, ("b", D1, 20, 1), ("d", D1, 4, 1)))
    expected = [("a", D1, 1, 0), ("b", D1, 20, 1), ("c", D2, 3, 0), ("d", D1, 4, 1)]
    assert rows(t.read(spark)) == expected
    t.upsert(frame(spark, ("b", D1, 20, 1), ("d", D1, 4, 1)))
    assert rows(t.read(spark)) == expected


@pytest.mark.parametrize("slot", [by_hash(["k", "day"], 3), by_leading_month("k", 2)])
def test_other_layouts(spark, table, rows, slot):
    t = table(slot)
    t.upsert(frame(spark, ("20250101A", D1, 1, 0), ("b", D1, 2, 0), (None, D1, 3, 0)))
    t.upsert(frame(spark, ("20250101A", D1, 10, 0), (None, D1, 30, 0)))
    assert rows(t.read(spark)) == [
        ("20250101A", D1, 10, 0), ("b", D1, 2, 0), (None, D1, 30, 0)
    ]


def test_only_days_make_month_partitions(spark, table):
    t = table(by_leading_month("k", 2))
    keys = ["99999999X", "12345678-1", "00000000", "20250231A", "20250228A", None]
    t.upsert(frame(spark, *[(k, D1, 1, 0) for k in keys]))
    slots = {r[0] for r in t.stored(spark).select(t.slot.name).distinct().collect()}
    assert {str(s) for s in slots if not str(s).startswith("h")} == {"202502"}
    assert t.read(spark).count() == len(keys)


def test_null_key_parts_are_found_again(spark, table, rows):
    t = table()
    for price in (1, 2):
        t.upsert(frame(spark, (None, D1, price, 0), ("a", None, price, 0)))
    assert rows(t.read(spark)) == [("a", None, 2, 0), (None, D1, 2, 0)]


def test_repeated_keys_in_one_batch(spark, table, rows):
    t = table()
    t.upsert(frame(spark, ("a", D1, 1, 5), ("a", D1, 9, 4)), order=["seen"])
    assert rows(t.read(spark)) == [("a", D1, 1, 5)]


def test_untouched_partitions_stay_as_they_are(spark, table, tmp_path):
    t = table()
    t.upsert(frame(spark, ("a", D1, 1, 0), ("c", D2, 3, 0)))
    before = sorted(p.name for p in (tmp_path / "t" / "day=2025-01-02").iterdir())
    t.upsert(frame(spark, ("a", D1, 2, 0)))
    assert sorted(p.name for p in (tmp_path / "t" / "day=2025-01-02").iterdir()) == before


def test_newest_version_wins_in_any_order(spark, table, rows):
    batches = [frame(spark, ("a", D1, 1, 1), ("b", D1, 1, 7)), frame(spark, ("a", D1, 2, 2), ("b", D1, 0, 3))]
    t = table(version=("seen",))
    for b in batches:
        t.upsert(b)
    assert rows(t.read(spark)) == [("a", D1, 2, 2), ("b", D1, 1, 7)]
    t.upsert(batches[0])
    assert rows(t.read(spark)) == [("a", D1, 2, 2), ("b", D1, 1, 7)]


def test_rows_read_from_the_table_can_be_its_updates(spark, table, rows):
    t = table()
    t.upsert(frame(spark, ("a", D1, 1, 0), ("b", D1, 2, 0)))
    t.upsert(t.read(spark).withColumn("price", F.col("price") + 1))
    assert rows(t.read(spark)) == [("a", D1, 2, 0), ("b", D1, 3, 0)]


def test_replace_removes_keys_and_emptied_partitions(spark, table, rows, tmp_path):
    t = table()
    t.upsert(frame(spark, ("a", D1, 1, 0), ("b", D1, 2, 0), ("c", D2, 3, 0)))
    t.replace(frame(spark, ("a", D1, 0, 0), ("c", D2, 0, 0)), frame(spark, ("a", D1, 7, 7)))
    assert rows(t.read(spark)) == [("a", D1, 7, 7), ("b", D1, 2, 0)]
    assert not (tmp_path / "t" / "day=2025-01-02").exists()


STEPS = ["staged table", "marked", "published table", "emptied table", "unmarked"]


@pytest.mark.parametrize("step", STEPS)
def test_an_upsert_cut_short_is_finished_or_repeated(spark, table, rows, monkeypatch, step):
    t = table()
    t.upsert(frame(spark, ("a", D1, 1, 0), ("c", D2, 3, 0)))

    def dies(at):
        if at == step:
            raise OSError("driver lost")

    monkeypatch.setattr(tables, "reached", dies)
    update = frame(spark, ("a", D1, 2, 0), ("d", D2, 4, 0))
    with pytest.raises(OSError):
        t.upsert(update)
    monkeypatch.undo()
    if step != "staged table":
        t.recover(spark)
        assert rows(t.read(spark)) == [("a", D1, 2, 0), ("c", D2, 3, 0), ("d", D2, 4, 0)]
    t.upsert(update)
    assert rows(t.read(spark)) == [("a", D1, 2, 0), ("c", D2, 3, 0), ("d", D2, 4, 0)]
    assert not Folder(spark, t.staging).exists()


def test_a_lost_partition_comes_back_from_the_staged_files(spark, table, rows, monkeypatch):
    t = table()
    t.upsert(frame(spark, ("a", D1, 1, 0), ("b", D1, 2, 0)))

    def dies(at):
        if at == "marked":
            raise OSError("driver lost")

    monkeypatch.setattr(tables, "reached", dies)
    with pytest.raises(OSError):
        t.upsert(frame(spark, ("a", D1, 5, 0)))
    monkeypatch.undo()
    Folder(spark, t.path).child("day=2025-01-01").delete()  # as a committer that dies between its steps leaves it
    t.recover(spark)
    assert rows(t.read(spark)) == [("a", D1, 5, 0), ("b", D1, 2, 0)]


def test_merged_tells_what_changes(spark, table, rows):
    t = table(version=("seen",))
    t.upsert(frame(spark, ("a", D1, 1, 5), ("b", D1, 2, 5), ("c", D1, 3, 5)))
    out = t.merged(frame(spark, ("a", D1, 9, 6), ("b", D1, 9, 4), ("n", D1, 9, 1)), [D1], ["price"])
    assert rows(out, "k", "price", "__offered", "__changed", "__before.price") == [
        ("a", 9, True, True, 1), ("b", 2, True, False, 2), ("c", 3, False, False, 3), ("n", 9, True, True, None)
    ]


def test_one_writer_at_a_time(spark, tmp_path):
    path = str(tmp_path / "w" / "_writer")
    with tables.lease(spark, path, "domestic"):
        with pytest.raises(tables.Held, match="domestic"), tables.lease(spark, path, "international", patience=0):
            pass
        assert Folder(spark, path).text() == "domestic"
    with tables.lease(spark, path, "international", patience=0):
        pass
    assert not Folder(spark, path).exists()


def test_a_lost_writer_is_followed(spark, tmp_path):
    path = str(tmp_path / "_writer")
    Folder(spark, path).write_new("domestic")
    with tables.lease(spark, path, "domestic", patience=0):  # the same feed, started again
        pass
    Folder(spark, path).write_new("domestic")
    with tables.lease(spark, path, "international", patience=0, stale=-1):
        pass


def test_changed_layout_is_refused(spark, table):
    table(by_hash(["k"], 3)).upsert(frame(spark, ("a", D1, 1, 0)))
    with pytest.raises(ValueError):
        table(by_hash(["k"], 4)).upsert(frame(spark, ("a", D1, 1, 0)))


def test_append_batch_can_be_repeated(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    for batch_id in (0, 1, 1):
        append_batch(frame(spark, ("a", D1, batch_id, 0)), path, batch_id)
    assert rows(spark.read.parquet(path), "price", "batch_id") == [(0, 0), (1, 1)]


def test_held_batches_equal_upserts_one_by_one(spark, tmp_path, rows, monkeypatch):
    published = []
    monkeypatch.setattr(tables, "reached", lambda at: published.append(at) if at == "marked" else None)
    made = [
        KeyedTable(str(tmp_path / name), StructType.fromDDL("k int,v int,w string"), ("k",), by_hash(["k"], 2), ("v",))
        for name in ("held", "direct")
    ]
    batches = [[(k or None, (b * 7 + k) % 5, f"{b}") for k in range(5)] for b in range(9)]
    for b, batch in enumerate(batches):
        df = spark.createDataFrame(batch, "k int,v int,w string")
        made[0].hold(df, b)
    made[0].settle_held(spark)
    assert len(published) < 9
    for batch in batches:
        made[1].upsert(spark.createDataFrame(batch, "k int,v int,w string"))
    assert rows(made[0].read(spark)) == rows(made[1].read(spark))


def test_partitions_are_found_by_their_parts(spark, table):
    """The partitions of rows, from the distinct parts they follow from: the same as row by row."""
    keys = ["20250228A", "20250230A", "19691231A", "20991231", "2099123", "21000101A", "2025022\n8", "1970010१", "", "K1", None]
    days = ["2025-02-28", "2025-03-01", None]
    rows = spark.createDataFrame([(k, d) for k in keys for d in days], "k string, d string").withColumn("d", F.col("d").cast("date"))
    day = "try_to_date(regexp_extract(k, '^(19[7-9]|20[0-9])[0-9]{5}', 0), 'yyyyMMdd')"
    plain = {
        by_day_and_hash("d", "k", 3): "concat(coalesce(cast(d as string), 'none'), '_', pmod(xxhash64(k), 3))",
        by_leading_month("k", 3): f"coalesce(date_format({day}, 'yyyyMM'), concat('h', pmod(xxhash64(k), 3)))",
    }
    for slot, expression in plain.items():
        t = table(slot)
        per_row = [tuple(r) for r in t.slotted(rows).select("k", "d", slot.name).collect()]
        assert sorted(per_row, key=repr) == sorted(map(tuple, rows.select("k", "d", F.expr(expression)).collect()), key=repr)
        found = t.distinct_slots(rows)
        assert found.columns == [slot.name]
        assert sorted(r[0] for r in found.collect()) == sorted({r[2] for r in per_row}) == sorted(t.slots_of(rows))
