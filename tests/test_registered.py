"""Every registered query against its SQL in another engine, on whole tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import differences, duck
from conftest import MIDDLE, SMALL

from __spark_entry__ import entry, oracle_sql, queries
from shopsieve.plans.catalog import QUERIES
from shopsieve.plans.oracle import ORACLE_SQL

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def small():
    return duck(SMALL)


@pytest.fixture(scope="module")
def middle():
    return duck(MIDDLE)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees(spark, small, name):
    assert differences(queries()[name](spark, SMALL), small, oracle_sql()[name]) is None


# At the smallest scale these find nothing.
@pytest.mark.parametrize("name", ["bad_ids_price", "gen_duplicates", "dq_report", "gen_report"])
def test_agrees_on_more(spark, middle, name):
    frame = queries()[name](spark, MIDDLE)
    assert frame.count() > 0
    assert differences(frame, middle, oracle_sql()[name]) is None


WITH_TIMES_OR_CASTS = ["typed_sales", "snapshot_append", "gen_combined", "gen_report", "dq_report", "agg_grouping_sets"]


@pytest.mark.parametrize("name", WITH_TIMES_OR_CASTS)
def test_agrees_in_any_time_zone_and_with_lenient_casts(spark, set_conf, small, name):
    # This zone once left out a whole day.
    set_conf(spark__sql__session__timeZone="Pacific/Apia", spark__sql__ansi__enabled="false")
    assert differences(queries()[name](spark, SMALL), small, oracle_sql()[name]) is None


def test_known_counts(spark):
    report = {r.rule: r for r in queries()["dq_report"](spark, MIDDLE).collect()}
    assert {name: line.bad_ids for name, line in report.items()} == {
        "duplicate": 11785,
        "date_format": 111,
        "date_range": 7206,
        "region": 8987,
        "quantity": 5805,
        "price": 5967,
        "total": 26549,
    }
    assert report["total"].total_rows == 60000
    assert round(report["total"].valid_pct_reference, 2) == 55.75
    assert report["region"].message == "Неверные регионы: 8987 записей"
    assert report["total"].message is None
    sizes = queries()["split_counts"](spark, MIDDLE).first()
    assert (sizes.quarantine_rows, sizes.clean_rows) == (26549, 19283)
