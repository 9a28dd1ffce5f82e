"""Declarative quality rules: what counts as a violation.

A rule about one row is a boolean column. As in SQL, a comparison with NULL is neither
true nor false, and only what is true is a violation: a NULL is never flagged, unless
``not_null`` asks for it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsieve.functions.casts import DAY_FORMAT, coerce
from shopsieve.schema import KEY, SALES_RAW

# Patterns, domains, bounds and report lines that results are compared by.
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}"
REGIONS = ("North", "South", "East", "West")
QUANTITY_BOUNDS = (1, 10)
PRICE_BOUNDS = (Decimal("0.01"), Decimal("1000"))
MESSAGES = {
    "duplicate": "Найдены дубликаты ID: %s записей",
    "date_format": "Неверный формат даты: %s записей",
    "date_range": "Дата вне диапазона: %s записей",
    "region": "Неверные регионы: %s записей",
    "quantity": "Некорректное количество: %s записей",
    "price": "Некорректная цена: %s записей",
}


@dataclass(frozen=True)
class RowRule:
    """``violation`` is true on a bad row."""

    name: str
    violation: Column
    message: str


@dataclass(frozen=True)
class UniqueRule:
    """No two rows share the key. Rows without a key count as sharing one."""

    name: str
    message: str


@dataclass(frozen=True)
class RuleSet:
    """The rules on one table. Rules are numbered in this order: uniqueness, then rows."""

    rows: tuple[RowRule, ...]
    unique: UniqueRule | None = None
    key: str = KEY
    ordered: tuple[RowRule | UniqueRule, ...] = field(init=False)

    def __post_init__(self) -> None:
        ordered = ((self.unique,) if self.unique else ()) + self.rows
        names = [rule.name for rule in ordered]
        if len(set(names)) != len(names):
            raise ValueError(f"rule names repeat: {names}")
        if len(ordered) > 63:
            raise ValueError("the rules broken by a row are kept as bits of one long: at most 63 rules")
        object.__setattr__(self, "ordered", ordered)

    def bit(self, name: str) -> int:
        for position, rule in enumerate(self.ordered):
            if rule.name == name:
                return 1 << position
        raise KeyError(name)

    def violation(self, *names: str) -> Column:
        """True where a row breaks any of the named row rules."""
        by_name = {rule.name: rule.violation for rule in self.rows}
        any_of = by_name[names[0]]
        for name in names[1:]:
            any_of = any_of | by_name[name]
        return any_of


def _message(name: str, given: str | None) -> str:
    return given or MESSAGES.get(name, f"{name}: %s")


def unique(name: str = "duplicate", message: str | None = None) -> UniqueRule:
    return UniqueRule(name, _message(name, message))


def matches(name: str, column: str, pattern: str, message: str | None = None) -> RowRule:
    """Text must match; a pattern that starts with ^ says nothing about how the text ends."""
    return RowRule(name, ~F.col(column).rlike(pattern), _message(name, message))


def between_text(name: str, column: str, low: str, high: str, message: str | None = None) -> RowRule:
    """Text must lie between two texts in character order."""
    value = F.col(column)
    return RowRule(name, (value < F.lit(low)) | (value > F.lit(high)), _message(name, message))


def in_set(name: str, column: str, allowed: Sequence[str], message: str | None = None) -> RowRule:
    return RowRule(name, ~F.col(column).isin(*allowed), _message(name, message))


def between(
    name: str, column: str, low: object, high: object, message: str | None = None, kind: str | None = None
) -> RowRule:
    """A number must lie in a range, bounds included. ``kind`` is the type to read text as; text that
    is no such number breaks ``parses``, not this."""
    value = F.col(column) if kind is None else F.col(column).try_cast(kind)
    return RowRule(name, ~value.between(F.lit(low), F.lit(high)), _message(name, message))


def parses(name: str, column: str, kind: T.DataType, message: str | None = None) -> RowRule:
    """Text must be a value of type ``kind``; a missing text is none that fails."""
    unread = F.col(column).isNotNull() & coerce(F.col(column), kind).isNull()
    return RowRule(name, unread, _message(name, message))


def not_null(name: str, column: str, message: str | None = None) -> RowRule:
    return RowRule(name, F.col(column).isNull(), _message(name, message))


def date_parse(name: str, column: str, fmt: str = DAY_FORMAT, message: str | None = None) -> RowRule:
    """Stricter than a pattern: the text must be a day of the calendar."""
    unparsed = F.col(column).isNotNull() & F.try_to_date(F.col(column), fmt).isNull()
    return RowRule(name, unparsed, _message(name, message))


def year_to_date(as_of: date) -> tuple[date, date]:
    """From 1 January of the year of ``as_of`` up to that day."""
    return as_of.replace(month=1, day=1), as_of


def sales_rules(
    start: date,
    end: date,
    regions: Sequence[str] = REGIONS,
    quantity: tuple[int, int] = QUANTITY_BOUNDS,
    price: tuple[Decimal, Decimal] = PRICE_BOUNDS,
    extra: Sequence[RowRule] = (),
) -> RuleSet:
    """The standard checks on a raw sales table."""
    return RuleSet(
        unique=unique(),
        rows=(
            matches("date_format", "sale_date", DATE_PATTERN),
            between_text("date_range", "sale_date", start.isoformat(), end.isoformat()),
            in_set("region", "region", regions),
            between("quantity", "quantity", *quantity),
            between("price", "price", *price),
            *extra,
        ),
    )


#: Prices are judged as written, before they are rounded to two places.
UNROUNDED = "decimal(38,18)"


def text_sales_rules(
    start: date,
    end: date,
    regions: Sequence[str] = REGIONS,
    quantity: tuple[int, int] = QUANTITY_BOUNDS,
    price: tuple[Decimal, Decimal] = PRICE_BOUNDS,
    strict_dates: bool = False,
    extra: Sequence[RowRule] = (),
) -> RuleSet:
    """The standard checks on a sales table that is all text (``read_csv_text``), and for each column
    whether it parses. ``strict_dates`` also asks dates to be days of the calendar."""
    dates = (date_parse("date_parse", "sale_date"),) if strict_dates else ()
    return RuleSet(
        unique=unique(),
        rows=(
            matches("date_format", "sale_date", DATE_PATTERN),
            between_text("date_range", "sale_date", start.isoformat(), end.isoformat()),
            in_set("region", "region", regions),
            between("quantity", "quantity", *quantity, kind="int"),
            between("price", "price", *price, kind=UNROUNDED),
            *(parses(f"unread_{f.name}", f.name, f.dataType) for f in SALES_RAW if not isinstance(f.dataType, T.StringType)),
            *dates,
            *extra,
        ),
    )
