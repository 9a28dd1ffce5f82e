from __future__ import annotations

import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from shopsieve.operators.rules import sales_rules  # noqa: E402
from shopsieve.schema import SALES_RAW  # noqa: E402
from shopsieve.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def set_conf(spark):
    """Change settings for one test."""
    before = {}

    def change(**settings):
        for name, value in settings.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


EDGE_START, EDGE_END = date(2026, 1, 1), date(2026, 6, 30)

_EDGE = """
1  1 1 1  10.00   North 2026-01-01
2  1 1 10 1000.00 South 2026-06-30
3  1 1 1  10.00   East  invalid
4  1 1 1  10.00   West  2026-13-99
5  1 1 1  10.00   West  2026-01-01xyz
6  1 1 1  10.00   West  2025-12-31
7  1 1 1  10.00   West  2026-07-01
8  1 1 11 10.00   West  2026-02-01
9  1 1 0  0.00    West  2026-02-01
10 1 1 1  0.01    Central 2026-02-01
11 1 1 -  -       -     -
12 1 2 2  20.00   East  2026-03-01
12 1 2 2  20.00   East  2026-03-01
13 1 2 3  30.00   East  2026-03-01
13 2 3 4  40.00   North 2026-03-02
-  1 4 1  5.00    North 2026-04-01
-  1 4 1  6.00    North 2026-04-01
14 1 1 1  10.00   West  2026-02-30
15 1 1 1  10.00   West  2026-06-30T10:00
"""


def edge_rows() -> list[tuple]:
    rows = []
    for line in _EDGE.strip().splitlines():
        cells = [None if cell == "-" else cell.replace("T", " ") for cell in line.split()]
        whole = [None if c is None else int(c) for c in cells[:4]]
        rows.append((*whole, None if cells[4] is None else Decimal(cells[4]), cells[5], cells[6]))
    return rows


def sales_frame(spark, rows):
    return spark.createDataFrame(rows, SALES_RAW)


@pytest.fixture
def edge(spark):
    return sales_frame(spark, edge_rows())


@pytest.fixture
def edge_rules(spark):
    return sales_rules(EDGE_START, EDGE_END)


def bag(df) -> list[tuple]:
    """The rows of a small result, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def ids_of(df) -> set:
    """The only column of a small result, checked to hold no value twice."""
    values = [r[0] for r in df.collect()]
    assert len(values) == len(set(values))
    return set(values)
