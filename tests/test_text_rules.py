"""Raw CSV is judged by its text: no unreadable field passes, no price is rounded first."""

from __future__ import annotations

from datetime import date

import pytest

from shopsieve.functions.casts import lost_values, to_schema
from shopsieve.operators.quality import by_id, violations
from shopsieve.operators.rules import text_sales_rules
from shopsieve.sources.files import read_csv_text

HEADER = "sale_id,customer_id,product_id,quantity,price,region,sale_date"
ROWS = {
    "1": "1,1,1,1,10.00,North,2026-02-01",
    "2": "2,1,1,abc,10.00,North,2026-02-01",
    "3": "3,1,1,99999999999,10.00,North,2026-02-01",
    "4": "4,1,1,1,100000000000,North,2026-02-01",
    "5": "5,1,1,1,1000.004,North,2026-02-01",
    "6": "6,1,1,1,0.006,North,2026-02-01",
    "x": "x,1,1,1,10.00,North,2026-02-01",
    "7": "07,1,1,1,10.00,North,2026-02-01\n7,1,1,1,10.00,North,2026-02-01",
    "8": "8,1,1,1,10.00,North,2026-02-30",
    "9": "9,1,1,,10.00,North,2026-02-01",
}


@pytest.fixture
def text(spark, tmp_path):
    (tmp_path / "sales.csv").write_text("\n".join([HEADER, *ROWS.values()]) + "\n", encoding="utf-8")
    return read_csv_text(spark, str(tmp_path))


@pytest.mark.parametrize("strict", [False, True])
def test_each_defect_is_flagged(text, strict):
    rules = text_sales_rules(date(2026, 1, 1), date(2026, 6, 30), strict_dates=strict)
    found = {(r.rule, r.sale_id) for r in violations(by_id(text, rules), rules).collect()}
    assert found == {
        ("unread_quantity", "2"),
        ("unread_quantity", "3"),
        ("unread_price", "4"),
        ("price", "4"),
        ("price", "5"),
        ("price", "6"),
        ("unread_sale_id", "x"),
        ("duplicate", "7"),
        *([("date_parse", "8")] if strict else []),
    }


def test_lost_values_are_those_that_become_null(text):
    lost = lost_values(text).first().asDict()
    assert lost == {"sale_id": 1, "customer_id": 0, "product_id": 0, "quantity": 2, "price": 1, "region": 0, "sale_date": 1}
    typed, names = to_schema(text), text.columns
    before, after = (frame.selectExpr(*[f"count({c}) AS {c}" for c in names]).first() for frame in (text, typed))
    assert {c: before[c] - after[c] for c in names} == lost
