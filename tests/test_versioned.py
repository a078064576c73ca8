"""Loads that happen once, upserts that touch only their buckets, crashes that leave the old table."""

import os
import random

import pytest

from ledgerlens.sources import versioned
from ledgerlens.sources.versioned import ConcurrentLoad, VersionedTable


def files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(f"{path}/data") for n in names}


def rows_of(table):
    return sorted(map(tuple, table.read().collect()), key=str)


def test_upserts_equal_a_dict_and_leave_other_buckets_alone(spark, tmp_path):
    path, r = str(tmp_path / "t"), random.Random(4)
    table, want = VersionedTable(spark, path, key="k", buckets=8), {}
    for load, keys in enumerate(([*range(200), None, None], [3, 3, 7, 900], [None, 901], [3])):
        rows = [(k, load, r.random()) for k in keys]
        before = files(path)
        written = table.upsert(spark.createDataFrame(rows, "k long, v int, x double"), ["v", "x"])
        for k, v, x in rows:
            want[k] = max(want.get(k, (k, -1, 0.0)), (k, v, x), key=lambda t: t[1:])
        assert rows_of(table) == sorted(want.values(), key=str)
        after = files(path)
        assert {f: t for f, t in after.items() if f in before} == before  # nothing that was there is written again
        new = {f.split("_bucket=")[1].split("/")[0] for f in after.keys() - before.keys() if "_bucket=" in f}
        assert new == {str(b) for b in written} and len(written) <= len(set(keys))
    gone = table.vacuum()
    assert gone and rows_of(table) == sorted(want.values(), key=str) and not table.vacuum()


def test_a_crash_or_a_second_writer_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table = VersionedTable(spark, path, key="k", buckets=4)
    table.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", crash)
        with pytest.raises(OSError):
            table.upsert(spark.createDataFrame([(1, "z")], "k int, v string"))
    assert rows_of(table) == [(1, "a"), (2, "b")]
    old = table.manifest()
    table.upsert(spark.createDataFrame([(1, "c")], "k int, v string"))
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "manifest", lambda self: old)  # a load that began before the other ended
        with pytest.raises(ConcurrentLoad):
            table.upsert(spark.createDataFrame([(2, "z")], "k int, v string"))
    assert rows_of(table) == [(1, "c"), (2, "b")]


def test_a_load_is_appended_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table = VersionedTable(spark, path, partition_by=("y", "m"))
    first = spark.createDataFrame([(1, 2023, 5), (2, 2023, 6), (3, None, None)], "v int, y int, m int")
    assert table.append_once(first, "a") and not table.append_once(first, "a")
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.append_once(first, "b")
    assert len(rows_of(table)) == 3
    second = first.selectExpr("m", "y", "cast(v + 10 as string) AS v")  # other order and type
    assert table.append_once(second, "b") and not VersionedTable(spark, path, partition_by=("y", "m")).append_once(second, "b")
    assert rows_of(table) == sorted([(1, 2023, 5), (2, 2023, 6), (3, None, None), (11, 2023, 5), (12, 2023, 6), (13, None, None)], key=str)
    plan = table.read().where("y = 2023 AND m = 5")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(y" in plan
    assert [len(table.vacuum()), len(table.vacuum())] == [1, 0]  # what the crash left


def test_empty_loads_and_tables(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), key="k")
    with pytest.raises(ValueError):
        table.read()
    assert table.upsert(spark.createDataFrame([], "k int")) == [] and table.manifest().version == 0
    assert table.upsert(spark.createDataFrame([(1,), (1,)], "k int"), load_id="x") and table.upsert(spark.createDataFrame([(2,)], "k int"), load_id="x") == []
    assert rows_of(table) == [(1,)]
    empty = VersionedTable(spark, str(tmp_path / "e"))
    assert empty.append_once(spark.createDataFrame([], "k int"), "a") and empty.read().count() == 0
    assert versioned.ROWS_PER_TASK > 0
