"""Run the registered queries and their SQL side by side: ``python tests/compare.py [folder] [query …]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from shopsieve.session import local_session  # noqa: E402

KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _kind(simple: str) -> str:
    return KINDS.get(simple, simple.upper())


def _key(row: tuple) -> tuple:
    return tuple((value is None, "" if value is None else str(value)) for value in row)


def differences(frame, connection, sql: str) -> str | None:
    """None if both sides agree in names, types and rows (as bags)."""
    names = sorted(frame.columns)
    result = connection.sql(sql)
    if sorted(result.columns) != names:
        return f"columns {names} / {sorted(result.columns)}"
    ours = {f.name: _kind(f.dataType.simpleString()) for f in frame.schema}
    theirs = {name: str(kind) for name, kind in zip(result.columns, result.types, strict=True)}
    if ours != theirs:
        return f"types {ours} / {theirs}"
    quoted = ", ".join(f'"{n}"' for n in names)
    left = sorted((tuple(r) for r in frame.select(*names).collect()), key=_key)
    right = sorted(connection.sql(f"SELECT {quoted} FROM ({sql})").fetchall(), key=_key)
    if len(left) != len(right):
        return f"{len(left)} rows / {len(right)} rows"
    for a, b in zip(left, right, strict=True):
        if a != b:
            return f"row {a} / {b}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark = local_session(8)
    connection = duck(sf_dir)
    failed = 0
    for name in wanted:
        started = time.time()
        try:
            problem = differences(queries()[name](spark, sf_dir), connection, oracle_sql()[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
