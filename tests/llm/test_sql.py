"""Operators that SQL can express, against it."""

from __future__ import annotations

import pytest
from compare import differences, duck
from conftest import SMALL

from shopsieve.llm.catalog import QUERIES
from shopsieve.llm.oracle import ORACLE_SQL


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_agrees(spark, name):
    assert differences(QUERIES[name](spark, SMALL), duck(SMALL), ORACLE_SQL[name]) is None
