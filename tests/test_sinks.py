"""What is written is what is read back; targets keep their declared layout."""

from __future__ import annotations

import os
from datetime import UTC, datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import EDGE_END, EDGE_START, bag, ids_of, sales_frame
from pyspark.sql import functions as F

from shopsieve.functions.casts import as_text, to_schema
from shopsieve.operators.analytics import aggregate
from shopsieve.operators.rules import sales_rules
from shopsieve.plans.flow import FlowConfig, run
from shopsieve.schema import (
    AGGREGATED,
    AGGREGATED_DDL,
    CORRUPT,
    SALES_DDL,
    SALES_RAW,
    SALES_TYPED,
    SNAPSHOT,
    SNAPSHOT_DDL,
    SchemaMismatch,
    assert_schema,
)
from shopsieve.sinks import scratch
from shopsieve.sinks.files import write_csv, write_json, write_parquet
from shopsieve.sinks.jdbc import not_yet_loaded, save_jdbc, write_options
from shopsieve.sinks.snapshot import append_snapshot, read_snapshots, snapshot_rows
from shopsieve.sources.files import read_csv, read_json, read_parquet
from shopsieve.sources.jdbc import KeyRange, read_jdbc, read_options

T1, T2 = datetime(2026, 1, 6, 12, 45), datetime(2026, 1, 13, 12, 45)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "out")


def test_csv(spark, edge, folder):
    write_csv(edge, folder)
    assert bag(read_csv(spark, folder)) == bag(edge)


def test_csv_text_that_looks_like_markup(spark, folder):
    odd = sales_frame(spark, [(1, 1, 1, 1, None, 'a,"b"', "two words"), (2, 1, 1, 1, None, "line\\", " x ")])
    write_csv(odd, folder)
    assert bag(read_csv(spark, folder).select("region")) == [('a,"b"',), ("line\\",)]


def test_csv_lines_that_do_not_fit(spark, folder):
    spark.createDataFrame(
        [("sale_id,customer_id,product_id,quantity,price,region,sale_date",), ("1,x,3,4,5.00,North,2026-01-01",)],
        "value string",
    ).coalesce(1).write.text(folder)
    row = read_csv(spark, folder, keep_corrupt=True).collect()[0]
    assert (row.sale_id, row.customer_id, row.quantity) == (1, None, 4)
    assert row[CORRUPT].startswith("1,x,3")
    assert read_csv(spark, folder).schema == SALES_RAW


def test_csv_inferred_types_follow_the_data(spark, edge, folder):
    write_csv(edge, folder)
    assert dict(read_csv(spark, folder, infer=True).dtypes)["sale_date"] == "string"
    write_csv(edge.filter("sale_id IN (1, 2)"), folder)
    assert dict(read_csv(spark, folder, infer=True).dtypes)["sale_date"] == "date"


def test_an_empty_result_replaces_an_older_one(spark, edge, folder):
    for write, read in ((write_parquet, read_parquet), (write_csv, read_csv)):
        path = f"{folder}/{read.__name__}"
        write(edge, path)
        write(edge.filter("false"), path)
        assert read(spark, path, SALES_RAW).count() == 0


def test_json(spark, edge, folder):
    write_json(edge, folder)
    assert bag(read_json(spark, folder, SALES_RAW)) == bag(edge)


def test_schema_is_asserted(edge, folder):
    assert assert_schema(edge, SALES_RAW) is edge
    for wrong in (edge.drop("price"), as_text(edge), edge.select(*reversed(edge.columns))):
        with pytest.raises(SchemaMismatch):
            write_parquet(wrong, folder, SALES_RAW)


def test_filters_reach_the_file(spark, edge, folder):
    write_parquet(edge, folder)
    plan = read_parquet(spark, folder).filter("sale_id > 3").select("price")._jdf.queryExecution().toString()
    assert "GreaterThan(sale_id,3)" in plan
    assert "ReadSchema: struct<sale_id:bigint,price:decimal(10,2)>" in plan


def test_snapshots_add_up_and_can_be_run_again(spark, edge, folder):
    aggregated = aggregate(edge.filter("region IS NOT NULL"))
    for import_ts in (T1, T2, T1):
        append_snapshot(aggregated, folder, import_ts)
    table = read_snapshots(spark, folder)
    assert table.schema == SNAPSHOT
    assert bag(table.groupBy("import_date").count()) == [(T1, aggregated.count()), (T2, aggregated.count())]
    first_only = table.filter("import_date = TIMESTAMP_NTZ '2026-01-06 12:45:00'")
    assert first_only.count() == aggregated.count()
    plan = first_only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(import_date" in plan


def test_snapshot_files_are_in_order_of_region(spark, edge, folder):
    append_snapshot(aggregate(edge.filter("region IS NOT NULL")), folder, T1)
    files = list(Path(folder).glob("*/*.parquet"))
    assert files
    for path in files:
        found = pq.ParquetFile(path).read(["region", "product_id"]).to_pylist()
        assert found == sorted(found, key=lambda row: (row["region"], row["product_id"]))


def test_a_snapshot_needs_regions(edge):
    with pytest.raises(Exception, match="has no region"):
        snapshot_rows(aggregate(edge), T1).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_snapshot_refuses_product_ids_it_would_cut(set_conf, spark, edge, ansi):
    set_conf(spark__sql__ansi__enabled=ansi)
    wide = aggregate(edge.filter("sale_id = 1").withColumn("product_id", F.lit(2**40)))
    with pytest.raises(Exception, match="does not fit 32 bits"):
        snapshot_rows(wide, T1).collect()
    assert snapshot_rows(wide.withColumn("product_id", F.lit(None).cast("bigint")), T1).first().product_id is None


def test_snapshot_time_defaults_to_now(edge):
    rows = snapshot_rows(aggregate(edge.filter("sale_id = 1"))).collect()
    assert abs((datetime.now(UTC).replace(tzinfo=None) - rows[0].import_date).total_seconds()) < 600


def test_hand_off_goes_to_the_shared_folder(spark, edge):
    table = scratch.hand_off(edge, "edge")
    assert bag(table) == bag(edge)
    root = spark.conf.get("spark.checkpoint.dir")
    assert all(root in f for f in table.inputFiles())


def test_no_machine_local_folder_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "yarn"}.get(name, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        scratch.scratch_root(Session())


def test_flow(spark, edge, folder):
    rules = sales_rules(EDGE_START, EDGE_END)
    # A clean row without a region could not enter the snapshot.
    raw = edge.filter("sale_id IS NULL OR sale_id <> 11")
    first = run(raw, FlowConfig(rules, folder, T1))
    assert ids_of(first["clean"].select("sale_id")) == {1, 2, 5, 14}
    assert ids_of(first["quarantine"].select("sale_id")) == {None, 3, 4, 6, 7, 8, 9, 10, 12, 13, 15}
    assert first["sales"].schema == SALES_TYPED
    assert first["aggregated"].schema == AGGREGATED
    assert {r.rule: r.bad_ids for r in first["report"].collect()}["total"] == 11
    assert read_json(spark, f"{folder}/report", first["report"].schema).count() == 7
    assert first["samples"].count() == 11
    assert bag(first["duplicates"]) == [(None, 2), (12, 2), (13, 2)]
    assert first["violations"].groupBy("rule").count().count() == 6
    groups = first["snapshots"].count()
    second = run(raw, FlowConfig(rules, folder, T2, duplicates="keep_one"))
    assert ids_of(second["clean"].select("sale_id")) == {None, 1, 2, 5, 12, 13, 14}
    assert second["snapshots"].filter("import_date < TIMESTAMP_NTZ '2026-01-10 00:00:00'").count() == groups


def test_jdbc_options():
    connection = {"url": "jdbc:some:db", "user": "u", "password": "p"}
    assert read_options(connection, "sales", KeyRange("sale_id", 1, 10**9, 200), 5) == {
        **connection,
        "dbtable": "sales",
        "fetchsize": "5",
        "partitionColumn": "sale_id",
        "lowerBound": "1",
        "upperBound": "1000000000",
        "numPartitions": "200",
    }
    assert "partitionColumn" not in read_options(connection, "sales")
    options = write_options(connection, "sales", SALES_DDL)
    assert options["truncate"] == "true"
    assert options["createTableColumnTypes"] == SALES_DDL
    assert "createTableColumnTypes" not in write_options(connection, "sales")


def test_flow_on_an_empty_table(spark, edge, edge_rules, folder):
    """Twice: the second time it replaces tables that held rows."""
    run(edge.filter("sale_id IN (1, 2, 3)"), FlowConfig(edge_rules, folder, T1))
    for path in (folder, f"{folder}-new"):
        tables = run(edge.filter("false"), FlowConfig(edge_rules, path, T2))
        for name in ("clean", "quarantine", "sales", "aggregated", "duplicates", "violations", "samples"):
            assert tables[name].count() == 0, name
        assert tables["report"].first().total_rows == 0
    assert tables["snapshots"].count() == 0
    assert bag(read_snapshots(spark, f"{folder}/snapshots").select("import_date").distinct()) == [(T1,)]


def test_flow_loads_a_database(monkeypatch, edge, edge_rules, folder):
    loaded = {}
    monkeypatch.setattr(
        "shopsieve.plans.flow.save_jdbc",
        lambda df, connection, table, **given: loaded.update({table: (df.count(), connection, given)}),
    )
    raw = edge.filter("sale_id IN (1, 2, 3)")
    run(raw, FlowConfig(edge_rules, folder, T1, database={"url": "jdbc:some:db"}))
    assert {t: (n, c) for t, (n, c, _) in loaded.items()} == {
        "sales_data": (2, {"url": "jdbc:some:db"}),
        "aggregated_sales_data": (2, {"url": "jdbc:some:db"}),
    }
    assert loaded["sales_data"][2] == {"schema": SALES_TYPED, "column_types": SALES_DDL}


@pytest.mark.parametrize(
    ("ddl", "schema"), [(SALES_DDL, SALES_TYPED), (AGGREGATED_DDL, AGGREGATED), (SNAPSHOT_DDL, SNAPSHOT)]
)
def test_declared_types_are_those_of_the_schema(spark, ddl, schema):
    declared = spark.createDataFrame([], ddl.replace("VARCHAR(50)", "STRING")).schema
    assert all(schema[f.name].dataType == f.dataType for f in declared)


def test_a_repeated_database_import_adds_only_what_is_missing(edge):
    rows = snapshot_rows(aggregate(edge.filter("region IS NOT NULL")), T1)
    half = rows.filter("region = 'West'")
    other = snapshot_rows(aggregate(edge.filter("region IS NOT NULL")), T2)
    missing = not_yet_loaded(rows, half.unionByName(other), T1)
    assert missing.columns == rows.columns
    assert bag(missing) == bag(rows.filter("region <> 'West'"))


def test_jdbc_refuses_another_layout(edge):
    with pytest.raises(SchemaMismatch):
        save_jdbc(edge, {"url": "jdbc:none:"}, "sales", schema=SALES_TYPED)


@pytest.mark.skipif("SHOPSIEVE_JDBC_URL" not in os.environ, reason="no database given")
def test_jdbc_round_trip(spark, edge):
    connection = {
        option: os.environ[f"SHOPSIEVE_JDBC_{option.upper()}"]
        for option in ("url", "user", "password", "driver")
        if f"SHOPSIEVE_JDBC_{option.upper()}" in os.environ
    }
    sales = to_schema(edge)
    for _ in range(2):
        save_jdbc(sales, connection, "shopsieve_sales", schema=SALES_TYPED, column_types=SALES_DDL)
        table = read_jdbc(spark, connection, "shopsieve_sales", KeyRange("sale_id", 1, 16, 4))
        assert table.rdd.getNumPartitions() == 4
        assert bag(table) == bag(sales)
    save_jdbc(sales, connection, "shopsieve_sales", mode="append")
    assert read_jdbc(spark, connection, "shopsieve_sales").count() == 2 * sales.count()
