"""Loads as transactions: all or nothing, repeated epochs, newest rows, readers of an older state."""

import uuid

import pytest
from pyspark.sql import functions as F

from barspark.session import checkpoint_dir
from barspark.sources.versions import LoadConflict, VersionedTable


@pytest.fixture
def table(spark):
    return VersionedTable(spark, f"{checkpoint_dir(spark)}/versions-{uuid.uuid4().hex[:8]}", ["grain", "symbol"])


def df(spark, rows):
    return spark.createDataFrame(rows, "grain string, symbol string, ts long, close double, seen int")


def rows(d):
    return sorted((r.grain, r.symbol, r.ts, r.close) for r in d.collect())


def test_replace_changes_only_its_partitions(spark, table):
    table.replace(df(spark, [("1d", "A.NS", 1, 1.0, 0), ("1d", "B/x", 1, 2.0, 0), ("1h", "007", 1, 3.0, 0)]))
    table.replace(df(spark, [("1d", "A.NS", 5, 9.0, 0), ("1d", "C", 1, 4.0, 0)]))
    assert rows(table.read()) == [("1d", "A.NS", 5, 9.0), ("1d", "B/x", 1, 2.0), ("1d", "C", 1, 4.0), ("1h", "007", 1, 3.0)]
    assert rows(table.read(grain="1d", symbol="B/x")) == [("1d", "B/x", 1, 2.0)]
    assert rows(table.read(symbol="007")) == [("1h", "007", 1, 3.0)] and table.read(symbol="none").count() == 0
    assert len(table.read(symbol="007").inputFiles()) == 1


def test_a_load_killed_before_the_switch_leaves_the_old_table(spark, table, monkeypatch):
    table.replace(df(spark, [("1d", "A", 1, 1.0, 0)]))

    def dies(self, manifest):
        raise OSError("killed")

    monkeypatch.setattr(VersionedTable, "switch", dies)
    with pytest.raises(OSError):
        table.replace(df(spark, [("1d", "A", 2, 2.0, 0), ("1d", "B", 2, 2.0, 0)]))
    monkeypatch.undo()
    assert rows(table.read()) == [("1d", "A", 1, 1.0)]
    table.replace(df(spark, [("1d", "A", 3, 3.0, 0)]))
    assert rows(table.read()) == [("1d", "A", 3, 3.0)] and table.vacuum() == 2
    assert rows(table.read()) == [("1d", "A", 3, 3.0)] and len(table._names("manifests")) == 1


def test_a_reader_keeps_what_it_opened_and_a_second_writer_is_refused(spark, table):
    table.replace(df(spark, [("1d", "A", 1, 1.0, 0)]))
    before, stale = table.read(), table.manifest()
    table.replace(df(spark, [("1d", "A", 2, 2.0, 0)]))
    assert rows(before) == [("1d", "A", 1, 1.0)] and rows(table.read()) == [("1d", "A", 2, 2.0)]
    with pytest.raises(LoadConflict):
        table._load(df(spark, [("1d", "A", 3, 3.0, 0)]), stale, None)
    assert rows(table.read()) == [("1d", "A", 2, 2.0)]


def test_merge_keeps_the_newest_row_and_knows_its_epochs(spark, table):
    one = df(spark, [("1d", "A", 1, 1.0, 5), ("1d", "A", 1, 8.0, 7), ("1d", "A", 2, 2.0, 1), ("1d", "B", 1, 3.0, 1)])
    for order in (one, one.orderBy(F.desc("seen"))):  # within a batch the row order does not matter
        table.merge(order, ["grain", "symbol", "ts"], ["seen"], ("s", 0))
    assert rows(table.read()) == [("1d", "A", 1, 8.0), ("1d", "A", 2, 2.0), ("1d", "B", 1, 3.0)]
    n = table.manifest()["n"]
    two = df(spark, [("1d", "A", 2, 5.0, 0), ("1d", "C", 9, 6.0, 0)])
    table.merge(two, ["grain", "symbol", "ts"], ["seen"], ("s", 1))
    table.merge(df(spark, [("1d", "A", 2, 77.0, 0)]), ["grain", "symbol", "ts"], ["seen"], ("s", 1))  # the epoch again: left out
    assert rows(table.read()) == [("1d", "A", 1, 8.0), ("1d", "A", 2, 5.0), ("1d", "B", 1, 3.0), ("1d", "C", 9, 6.0)]
    assert table.manifest()["n"] == n + 1
    live = table.manifest()["live"]
    assert live["grain=1d/symbol=B"] != live["grain=1d/symbol=A"]  # untouched partitions keep their version


def test_a_table_without_loads(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read()
