"""One product, one order line id and one buyer that each own a third of a star schema."""

from __future__ import annotations

import pytest
from compare import differences, duck

from __spark_entry__ import oracle_sql, queries

LINES, ORDERS = 60_000, 6_000


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("star")
    numbers = spark.range(0, LINES, 1, 8)
    tables = {
        "lineitem": numbers.selectExpr(
            f"CASE WHEN id % 3 = 1 THEN 4 ELSE id % {ORDERS} END AS l_orderkey",
            "CASE WHEN id % 3 = 0 THEN 7 ELSE pmod(xxhash64(id), 900) END AS l_partkey",
            "CAST(CASE WHEN id % 6 = 1 THEN 1 ELSE pmod(xxhash64(id, 1), 7) + 1 END AS INT) AS l_linenumber",
            "CAST(id % 50 + 1 AS DOUBLE) AS l_quantity",
            "CAST(date_add(DATE '1995-01-01', CAST(id % 2500 AS INT)) AS TIMESTAMP_NTZ) AS l_shipdate",
        ),
        "orders": spark.range(ORDERS).selectExpr(
            "id AS o_orderkey", "CASE WHEN id % 3 = 0 THEN 11 ELSE id % 400 END AS o_custkey"
        ),
        "customer": spark.range(400).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey"),
        "nation": spark.range(25).selectExpr("CAST(id AS INT) AS n_nationkey", "CAST(id % 5 AS INT) AS n_regionkey"),
        "region": spark.range(5).selectExpr(
            "CAST(id AS INT) AS r_regionkey",
            "element_at(array('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'), CAST(id + 1 AS INT)) AS r_name",
        ),
        "part": spark.range(900).selectExpr("id AS p_partkey", "900 + CAST(id % 1000 AS DOUBLE) / 10 AS p_retailprice"),
    }
    connection = duck(str(folder))
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return str(folder), connection


NAMES = [
    "agg_region_product",
    "agg_grouping_sets",
    "win_region_product",
    "bad_ids_all",
    "dq_report",
    "dq_id_samples",
    "duplicate_counts",
    "dedup_keep_one",
    "clean_rows",
    "quarantine_rows",
    "quarantine_rows_by_id_list",
    "sales_e2e",
]


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_broadcasts(spark, skewed, name):
    folder, connection = skewed
    assert differences(queries()[name](spark, folder), connection, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_shuffled_joins(spark, set_conf, skewed, name):
    set_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    folder, connection = skewed
    frame = queries()[name](spark, folder)
    assert differences(frame, connection, oracle_sql()[name]) is None
    frame._jdf.queryExecution().toRdd().count()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # in these the joins ran when the query was built; their view is that of the others
    if "_e2e" not in name and name not in ("win_region_product", "quarantine_rows_by_id_list"):
        assert "SortMergeJoin(skew=true) [l_partkey" in plan
        assert "SortMergeJoin(skew=true) [l_orderkey" in plan
