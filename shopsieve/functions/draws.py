"""Reproducible pseudo-random values: pure functions of a row's key, so a retried or
recomputed task produces the same row, on any partitioning."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS_PER_DRAW = 8
DRAWS_PER_DIGEST = 32 // DIGITS_PER_DRAW


def digest(key: Column, tag: str, seed: int) -> Column:
    """32 hexadecimal digits that depend on the key, the tag and the seed."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{tag}:{seed}")))


def draw(hex_digest: Column, slot: int) -> Column:
    """The ``slot``-th 32-bit number of a digest (0 to 3)."""
    if not 0 <= slot < DRAWS_PER_DIGEST:
        raise ValueError(f"a digest holds {DRAWS_PER_DIGEST} draws, slot {slot} asked for")
    part = F.substring(hex_digest, 1 + slot * DIGITS_PER_DRAW, DIGITS_PER_DRAW)
    return F.conv(part, 16, 10).cast("bigint")


def uniform_int(number: Column, low: int, high: int) -> Column:
    """Map a draw onto low…high, both included."""
    return F.lit(low) + F.pmod(number, F.lit(high - low + 1))


def uniform_cents(number: Column, low_cents: int, high_cents: int) -> Column:
    """Map a draw onto an exact amount with two places."""
    cents = uniform_int(number, low_cents, high_cents).cast("decimal(10,0)")
    return (cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)")


def choice(number: Column, values: Sequence[str]) -> Column:
    """Pick one of a fixed list."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, uniform_int(number, 1, len(values)).cast("int"))


def day_text(start: date, offset: Column) -> Column:
    """``start`` plus a number of days, written yyyy-MM-dd in any time zone."""
    return F.date_add(F.lit(start.isoformat()).cast("date"), offset.cast("int")).cast("string")
