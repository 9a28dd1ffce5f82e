"""The resumable chain, incremental checks, and CSV lines that do not fit."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from conftest import EDGE_END, EDGE_START, bag, edge_rows, sales_frame
from pyspark.sql import functions as F

from shopsieve.operators.incremental import CheckState
from shopsieve.operators.quality import by_id, report
from shopsieve.operators.rules import sales_rules
from shopsieve.plans.chain import Chain, ChainConfig, files_fingerprint, run_chain
from shopsieve.plans.flow import FlowConfig, run
from shopsieve.schema import SALES_RAW
from shopsieve.sinks.keyed import OtherSettings
from shopsieve.sources.files import read_parquet
from shopsieve.sources.rejects import split_csv

T1, T2 = datetime(2026, 6, 30, 12, 45), datetime(2026, 7, 7, 12, 45)
STAGES = ["split", "report", "duplicates", "violations", "samples", "lost", "load", "aggregate", "snapshot"]


class Stop(Exception):
    pass


@pytest.fixture
def raw(spark, tmp_path):
    rows = [r for r in edge_rows() if r[5] is not None]
    sales_frame(spark, rows).write.parquet(str(tmp_path / "raw"))
    return lambda: read_parquet(spark, str(tmp_path / "raw"), SALES_RAW)


def folders(path):
    return {p.name: p.stat().st_mtime_ns for p in Path(path, "tables").iterdir()}


@pytest.mark.parametrize("stop", ["split", "samples", "load", "snapshot"])
def test_a_broken_run_goes_on(raw, edge_rules, tmp_path, stop):
    config = ChainConfig(edge_rules, str(tmp_path / "chain"), T1)
    ran = []

    def before(stage):
        ran.append(stage)
        if stage == stop and ran.count(stop) == 1:
            raise Stop

    with pytest.raises(Stop):
        run_chain(raw(), config, before=before)
    earlier = folders(config.folder) if stop != "split" else {}
    tables = run_chain(raw(), config, before=before)
    assert ran == [*STAGES[: STAGES.index(stop) + 1], *STAGES[STAGES.index(stop) :]]
    assert earlier.items() <= folders(config.folder).items()
    whole = run(raw(), FlowConfig(edge_rules, str(tmp_path / "flow"), T1))
    for name, table in whole.items():
        assert bag(tables[name].select(table.columns)) == bag(table), name
    ran.clear()
    run_chain(raw(), config, before=before)
    assert ran == []


def test_what_changed_runs_again(spark, raw, edge_rules, tmp_path):
    folder, ran = str(tmp_path / "chain"), []
    run_chain(raw(), ChainConfig(edge_rules, folder, T1))
    run_chain(raw(), ChainConfig(edge_rules, folder, T1, samples=1), before=ran.append)
    assert ran == ["samples"]
    ran.clear()
    again = run_chain(raw(), ChainConfig(edge_rules, folder, T2), before=ran.append)
    assert ran == ["snapshot"] and again["snapshots"].select("import_date").distinct().count() == 2
    ran.clear()
    run_chain(raw(), ChainConfig(edge_rules, folder, T2, times_quantity=True), before=ran.append)
    assert ran == ["aggregate", "snapshot"]
    ran.clear()
    run_chain(raw(), ChainConfig(sales_rules(EDGE_START, EDGE_END, ["North"]), folder, T2), before=ran.append)
    assert ran[0] == "split" and "load" in ran
    before = files_fingerprint(raw())
    raw().limit(1).write.mode("append").parquet(str(tmp_path / "raw"))
    assert files_fingerprint(raw()) != before != files_fingerprint(raw(), "another plan")
    ran.clear()
    run_chain(raw(), ChainConfig(edge_rules, folder, T1), before=ran.append)
    assert ran == STAGES


def test_of_two_runs_at_once_the_first_counts(spark, tmp_path):
    one, two = (Chain(spark, str(tmp_path / "c"), "same") for _ in range(2))
    paths = []

    def slow(to):
        paths.append(two.stage("s", lambda inner: spark.range(2).write.parquet(inner)))
        spark.range(3).write.parquet(to)

    assert one.stage("s", slow) == paths[0]
    assert spark.read.parquet(paths[0]).count() == 2


def test_values_lost_in_the_load_are_counted(raw, edge_rules, tmp_path):
    lost = run_chain(raw(), ChainConfig(edge_rules, str(tmp_path / "c"), T1))["lost"].first()
    assert lost.sale_date == 2 and lost.price == 0  # 2026-01-01xyz and 2026-02-30 pass as texts in range


# Incremental checks


@pytest.mark.parametrize("how", [{"width": 4}, {"buckets": 3}])
def test_batches_give_what_the_whole_gives(spark, edge, edge_rules, tmp_path, how):
    state = CheckState(spark, str(tmp_path / "s"), edge_rules, **how)
    assert bag(state.per_id()) == []
    for number in range(4):
        version = state.add(edge.filter(F.pmod(F.hash("quantity", "price", "region"), F.lit(4)) == number), f"b{number}")
    assert bag(state.per_id()) == bag(by_id(edge, edge_rules))
    assert bag(report(state.per_id(), edge_rules)) == bag(report(by_id(edge, edge_rules), edge_rules))
    assert state.add(edge, "b2") == version and bag(state.per_id()) == bag(by_id(edge, edge_rules))
    assert state.per_id(1).count() < state.per_id().count()
    assert state.add(edge.limit(0), "none") == version + 1


def test_a_batch_reads_the_state_and_itself(spark, edge_rules, tmp_path, monkeypatch):
    state = CheckState(spark, str(tmp_path / "s"), edge_rules, width=100)
    rows = [(i, 1, 1, 1, None, "North", "2026-01-01") for i in range(1000)]
    state.add(sales_frame(spark, rows), "first")
    read, opened = state.table._read, []
    monkeypatch.setattr(state.table, "_read", lambda paths: opened.append(paths) or read(paths))
    state.add(sales_frame(spark, [(150, 1, 1, 99, None, "North", "2026-01-01"), (2000, 1, 1, 1, None, "x", "2026-01-01")]), "second")
    assert [p.rpartition("=")[2] for p in opened[0]] == ["1"]
    found = {r.sale_id: (r.n_rows, r.broken) for r in state.per_id().filter("broken <> 0").collect()}
    assert found == {150: (2, edge_rules.bit("duplicate") | edge_rules.bit("quantity")), 2000: (1, edge_rules.bit("region"))}


def test_a_state_belongs_to_its_rules(spark, edge, edge_rules, tmp_path):
    CheckState(spark, str(tmp_path / "s"), edge_rules).add(edge, "a")
    with pytest.raises(OtherSettings):
        CheckState(spark, str(tmp_path / "s"), sales_rules(EDGE_START, EDGE_END, ["North"])).per_id()


# CSV lines

HEAD = "sale_id,customer_id,product_id,quantity,price,region,sale_date"
LINES = {
    "1,2,3,4,5.00,North,2026-01-01": None,
    '2,2,3,4,5.00,"No, rth",2026-01-01': None,
    "3,,,,,,": None,
    "4,2,3,4,5.00,North": ("ragged", None),
    "5,2,3,4,5.00,North,2026-01-01,more": ("ragged", None),
    "x6,2,3,four,5.00,North,2026-01-01": ("unreadable", ["sale_id", "quantity"]),
    "7,2,3,99999999999,cheap,North,never": ("unreadable", ["quantity", "price"]),
    "8": ("ragged", None),
    '9,2,3,4,5.00,"two",2026-01-01': None,
}


def test_lines_that_do_not_fit_are_kept(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    half = list(LINES)[:5], list(LINES)[5:]
    for name, lines in zip("ab", half, strict=True):
        (folder / f"{name}.csv").write_text("\n".join([HEAD, *lines, ""]))
    accepted, rejected = split_csv(spark, str(folder), str(tmp_path / "split"))
    assert accepted.schema == SALES_RAW
    assert sorted(r.sale_id for r in accepted.collect()) == [1, 2, 3, 9]
    assert {r.region for r in accepted.collect()} == {"North", "No, rth", None, "two"}
    got = {r.line: (r.reason, r["columns"]) for r in rejected.collect()}
    assert got == {line: why for line, why in LINES.items() if why}
    assert {(Path(r.file).name, r.line) for r in rejected.collect()} == {
        (name + ".csv", line) for name, lines in zip("ab", half, strict=True) for line in lines if LINES[line]
    }


def test_csv_without_lines(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text(HEAD + "\n")
    accepted, rejected = split_csv(spark, str(tmp_path / "csv"))
    assert accepted.count() == rejected.count() == 0 and accepted.schema == SALES_RAW
