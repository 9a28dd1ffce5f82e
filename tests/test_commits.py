"""Tables with commits: atomic imports, versions, keys, zone maps, and what happens between two writers."""

from __future__ import annotations

from datetime import date, datetime
from pathlib import Path
from threading import Barrier, Thread

import pytest
from conftest import bag, sales_frame
from pyspark.sql import functions as F

from shopsieve.functions.casts import to_schema
from shopsieve.operators.analytics import aggregate
from shopsieve.schema import KEY, SALES_TYPED, SNAPSHOT
from shopsieve.sinks.commits import CommitLog, Storage
from shopsieve.sinks.keyed import KeyedTable, OtherSettings
from shopsieve.sinks.snapshot_log import SnapshotLog

T1, T2, T3 = (datetime(2026, 1, day, 12, 45) for day in (6, 13, 20))


@pytest.fixture
def aggregated(edge):
    return aggregate(edge.filter("region IS NOT NULL"))


def at(table, ts):
    return bag(table.filter(F.col("import_date") == F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")).select("region", "product_id"))


def groups(aggregated):
    return bag(aggregated.select("region", F.col("product_id").cast("int")))


# The log


def test_a_number_is_taken_once(spark, tmp_path):
    storage = Storage(spark, str(tmp_path))
    log = CommitLog(storage)
    assert log.newest() == (0, {})
    assert log.try_commit(1, {"a": 1}) and not log.try_commit(1, {"a": 2})
    assert log.commit(lambda state: state | {"b": "ü"}) == 2
    assert log.newest() == (2, {"a": 1, "b": "ü"}) and log.at(1) == {"a": 1}
    log.forget_before(2)
    assert log.versions() == [2]
    log.forget_before(9)
    assert log.versions() == [2]
    assert not [p for p in Path(tmp_path, "_commits").iterdir() if "-" in p.name]


def test_many_writers_lose_nothing(spark, tmp_path):
    start = Barrier(6)

    def write(number):
        log = CommitLog(Storage(spark, str(tmp_path)))
        start.wait()
        for turn in range(5):
            log.commit(lambda state, name=f"{number}-{turn}": state | {name: True})

    writers = [Thread(target=write, args=(n,)) for n in range(6)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    version, state = CommitLog(Storage(spark, str(tmp_path))).newest()
    assert version == 30 and len(state) == 30


# Snapshots


def test_imports_versions_and_replacement(spark, aggregated, tmp_path):
    table = SnapshotLog(spark, str(tmp_path / "t"))
    assert table.read().count() == 0 and table.read().schema == SNAPSHOT
    assert [table.add(aggregated, T1), table.add(aggregated, T2)] == [1, 2]
    assert table.add(aggregated.filter("product_id = 2"), T1) == 3
    assert at(table.read(), T1) == groups(aggregated.filter("product_id = 2")) and at(table.read(), T2) == groups(aggregated)
    assert at(table.read(2), T1) == groups(aggregated) and at(table.read(1), T2) == []
    assert at(table.read(imports=[T2, T3]), T1) == []
    table.add(aggregated.filter("false"), T2)
    assert at(table.read(), T2) == [] and at(table.read(), T1)
    assert table.zones(imports=[T2]).count() == 0


def test_an_import_that_breaks_off_is_not_seen(spark, aggregated, tmp_path, monkeypatch):
    table = SnapshotLog(spark, str(tmp_path / "t"))
    table.add(aggregated, T1)
    before = bag(table.read())
    table.prepare(aggregated, T2)  # files, but no manifest
    assert bag(table.read()) == before
    with pytest.raises(Exception, match="has no region"):
        table.add(aggregated.withColumn("region", F.lit(None).cast("string")), T1)
    assert bag(table.read()) == before


def test_of_two_imports_at_once_neither_is_lost(spark, aggregated, tmp_path):
    path = str(tmp_path / "t")
    one, two = SnapshotLog(spark, path), SnapshotLog(spark, path)
    first, second = one.prepare(aggregated, T1), two.prepare(aggregated, T2)
    taken = one.log.try_commit

    def late(version, state):  # the other writer commits between reading the state and writing it
        if not two.log.versions():
            two.publish(T2, second)
        return taken(version, state)

    one.log.try_commit = late
    assert one.publish(T1, first) == 2
    assert at(table := one.read(), T1) == at(table, T2) == groups(aggregated)


def test_a_region_opens_few_files(spark, tmp_path):
    rows = spark.range(4000).selectExpr(
        "element_at(array('A', 'B', 'C', 'D'), CAST(id % 4 + 1 AS INT)) AS region", "id % 997 AS product_id", "1L AS total_sales",
        "CAST(1 AS DECIMAL(20,2)) AS total_sales_amount", "1D AS average_sale_amount",
    )
    table = SnapshotLog(spark, str(tmp_path / "t"))
    for ts in (T1, T2):
        table.add(rows, ts, files=16)
    whole = table.read()
    for regions, products in ((["B"], None), (["A", "D"], None), (["C"], (100, 200)), (["Z"], None), (["B"], (5000, 6000)), ([], None)):
        few = table.read_region(regions, products)
        wanted = whole.filter(F.col("region").isin(*regions)) if regions else whole.limit(0)
        if products:
            wanted = wanted.filter(F.col("product_id").between(*products))
        assert bag(few) == bag(wanted)
        assert len(few.inputFiles()) < len(whole.inputFiles())
    assert len(table.read_region(["C"], (100, 200)).inputFiles()) <= 4 < 32 == len(whole.inputFiles())
    assert table.read_region(["B"], imports=[T1]).count() == 1000
    assert table.zones().agg(F.sum("n_rows")).first()[0] == 8000


def test_vacuum_keeps_what_versions_need(spark, aggregated, tmp_path):
    table = SnapshotLog(spark, str(tmp_path / "t"))
    for _ in range(4):
        table.add(aggregated, T1)
    orphan = table.prepare(aggregated, T2)
    assert table.vacuum(keep_versions=2) == []  # all written lately
    assert table.log.versions() == [3, 4]
    gone = table.vacuum(keep_versions=2, untouched_seconds=0)
    assert len(gone) == 3 and orphan in gone
    assert at(table.read(), T1) == at(table.read(3), T1) == groups(aggregated)


# Keys


def sales(spark, *ids, quantity=1):
    from decimal import Decimal

    return to_schema(sales_frame(spark, [(i, 1, 1, quantity, Decimal("5.00"), "North", "2026-01-01") for i in ids]))


def files_of(table):
    return {f for f in table.read().inputFiles()}


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SALES_TYPED, KEY, width=100)
    assert table.read().count() == 0
    table.merge(sales(spark, *range(-150, 500)))
    before = files_of(table)
    assert len(before) == 7
    table.merge(sales(spark, 120, 121, 999, quantity=9))
    after = files_of(table)
    assert len(before - after) == 1 and len(after - before) == 2  # one bucket rewritten, one new
    assert all("__bucket=1/" in f or "__bucket=9/" in f for f in (before ^ after))
    rows = {r[KEY]: r.quantity for r in table.read().collect()}
    assert len(rows) == 651 == table.read().count()
    assert {k for k, q in rows.items() if q == 9} == {120, 121, 999}
    assert table.read(1).count() == 650 and table.read(1).filter("quantity = 9").count() == 0
    part = table.read_keys(-120, -90)
    assert sorted(r[KEY] for r in part.collect()) == list(range(-120, -89)) and len(part.inputFiles()) == 2
    assert table.read().schema == SALES_TYPED and table.read().filter(F.col("sale_date") != date(2026, 1, 1)).count() == 0


def test_hash_buckets_agree_with_ranges(spark, tmp_path):
    loads = [sales(spark, *range(0, 300)), sales(spark, *range(200, 400), quantity=2), sales(spark)]
    tables = [
        KeyedTable(spark, str(tmp_path / name), SALES_TYPED, KEY, **how)
        for name, how in (("range", {"width": 64}), ("hash", {"buckets": 5}))
    ]
    for table in tables:
        for load in loads:
            table.merge(load)
    assert bag(tables[0].read()) == bag(tables[1].read()) and tables[0].read().count() == 400
    assert tables[1].read_keys(10, 20).count() == 11


def test_keys_are_enforced(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SALES_TYPED, KEY, width=100)
    table.merge(sales(spark, 1, 2))
    with pytest.raises(Exception, match="holds this key twice: 7"):
        table.merge(sales(spark, 7, 8, 7))
    with pytest.raises(Exception, match="must not be missing"):
        table.merge(sales(spark, None))
    assert table.log.versions() == [1] and table.read().count() == 2
    with pytest.raises(OtherSettings):
        KeyedTable(spark, str(tmp_path / "t"), SALES_TYPED, KEY, width=50).merge(sales(spark, 3))


def test_a_named_load_is_taken_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SALES_TYPED, KEY, width=100)
    assert table.merge(sales(spark, 1), "monday") == 1
    assert table.merge(sales(spark, 1, quantity=5), "tuesday") == 2
    assert table.merge(sales(spark, 1), "monday") == 2
    assert table.read().first().quantity == 5


@pytest.mark.parametrize("same_bucket", [True, False])
def test_two_merges_at_once(spark, tmp_path, same_bucket):
    path = str(tmp_path / "t")
    one, two = (KeyedTable(spark, path, SALES_TYPED, KEY, width=100) for _ in range(2))
    one.merge(sales(spark, 1, 101))
    taken, tried = one.log.try_commit, []

    def late(version, state):
        if not tried:
            two.merge(sales(spark, 2 if same_bucket else 102, 101, quantity=2))
        tried.append(version)
        return taken(version, state)

    one.log.try_commit = late
    one.merge(sales(spark, 1, 3, quantity=7))
    other = 2 if same_bucket else 102
    assert {r[KEY]: r.quantity for r in one.read().collect()} == {1: 7, 3: 7, 101: 2, other: 2}
    assert tried == [2, 3]
