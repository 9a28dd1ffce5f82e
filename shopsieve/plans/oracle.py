"""For each registered query, SQL that gives the same result in another engine."""

from __future__ import annotations

SALES = """
s AS (
  SELECT l_orderkey * 10 + l_linenumber AS sale_id, o_custkey AS customer_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         r_name AS region,
         CASE WHEN l_orderkey % 400 = 0 THEN 'invalid'
              ELSE SUBSTRING(CAST(l_shipdate AS VARCHAR), 1, 10) END AS sale_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

COLUMNS = "sale_id, customer_id, product_id, quantity, price, region, sale_date"

STAR_BOUNDS = {
    "start": "1995-07-01",
    "end": "2001-06-30",
    "regions": "'AFRICA', 'AMERICA', 'ASIA', 'EUROPE'",
    "max_quantity": "45",
    "max_price": "990",
}
GEN_BOUNDS = {
    "start": "2026-01-01",
    "end": "2026-06-30",
    "regions": "'North', 'South', 'East', 'West'",
    "max_quantity": "10",
    "max_price": "1000",
}


def _conditions(bounds: dict[str, str]) -> dict[str, str]:
    return {
        "date_format": r"NOT regexp_matches(sale_date, '^\d{4}-\d{2}-\d{2}')",
        "date_range": f"(sale_date < '{bounds['start']}' OR sale_date > '{bounds['end']}')",
        "region": f"region NOT IN ({bounds['regions']})",
        "quantity": f"quantity NOT BETWEEN 1 AND {bounds['max_quantity']}",
        "price": f"price NOT BETWEEN 0.01 AND {bounds['max_price']}",
    }


def _found(table: str, bounds: dict[str, str]) -> str:
    """CTE ``found(rule, sale_id)``: each rule's distinct bad ids."""
    parts = [f"SELECT 'duplicate' AS rule, sale_id FROM {table} GROUP BY sale_id HAVING COUNT(*) > 1"]
    for name, condition in _conditions(bounds).items():
        parts.append(f"SELECT DISTINCT '{name}', sale_id FROM {table} WHERE {condition}")
    return "found AS (" + " UNION ALL ".join(parts) + ")"


def _first(table: str) -> str:
    """CTE ``one``: the first row of each id in the order of all columns."""
    order = ", ".join(f"{c} NULLS FIRST" for c in COLUMNS.split(", ")[1:])
    return (
        f"one AS (SELECT {COLUMNS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sale_id ORDER BY {order}) AS rn "
        f"FROM {table}) WHERE rn = 1)"
    )


def _aggregate(table: str, amount: str = "price", keys: str = "region, product_id") -> str:
    return f"""SELECT {keys}, COUNT(sale_id) AS total_sales,
       CAST(SUM({amount}) AS DECIMAL(20,2)) AS total_sales_amount,
       CAST(SUM({amount}) AS DOUBLE) / COUNT(sale_id) AS average_sale_amount
FROM {table} GROUP BY {keys}"""


LINE_AMOUNT = "CAST(quantity * price AS DECIMAL(20,2))"
ROW_RULES = "WHERE rule <> 'duplicate'"


def _marked(table: str, which: str = "", name: str = "marked") -> str:
    """CTE: the rows of ``table`` and whether their id is among those found; a missing id matches a missing one."""
    return (
        f"{name} AS (SELECT t.*, f.bad IS NOT NULL AS bad FROM {table} t "
        f"LEFT JOIN (SELECT DISTINCT sale_id, TRUE AS bad FROM found {which}) f ON f.sale_id IS NOT DISTINCT FROM t.sale_id)"
    )


# The report lines, in front of the count.
MESSAGES = """
  SELECT * FROM (VALUES ('duplicate', 'Найдены дубликаты ID: '), ('date_format', 'Неверный формат даты: '),
    ('date_range', 'Дата вне диапазона: '), ('region', 'Неверные регионы: '),
    ('quantity', 'Некорректное количество: '), ('price', 'Некорректная цена: ')) AS t(rule, lead)"""


def _report(ctes: str, table: str, bounds: dict[str, str], keep_one: bool = False) -> str:
    clean = "COUNT(DISTINCT sale_id) + COUNT(DISTINCT CASE WHEN sale_id IS NULL THEN 1 END)" if keep_one else "COUNT(*)"
    return f"""WITH {ctes}, {_found(table, bounds)}, {_marked(table, ROW_RULES if keep_one else "")}, messages AS ({MESSAGES}),
bad AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT sale_id FROM found)),
lines AS (
  SELECT m.rule, COUNT(f.rule) AS bad_ids,
         CASE WHEN COUNT(f.rule) > 0 THEN ANY_VALUE(lead) || CAST(COUNT(f.rule) AS VARCHAR) || ' записей' END AS message
  FROM messages m LEFT JOIN found f ON f.rule = m.rule GROUP BY m.rule
  UNION ALL SELECT 'total', n, NULL FROM bad),
whole AS (SELECT COUNT(*) AS n FROM {table}),
clean AS (SELECT {clean} AS n FROM marked WHERE NOT bad)
SELECT rule, bad_ids, message, whole.n AS total_rows,
       CAST(whole.n - bad.n AS DOUBLE) / CAST(whole.n AS DOUBLE) * 100 AS valid_pct_reference,
       CAST(clean.n AS DOUBLE) / CAST(whole.n AS DOUBLE) * 100 AS valid_pct_rows
FROM lines, whole, bad, clean"""


def _snapshot(source: str, import_ts: str) -> str:
    return f"""SELECT region, CAST(product_id AS INTEGER) AS product_id, total_sales,
       CAST(total_sales_amount AS DOUBLE) AS total_sales_amount, average_sale_amount,
       TIMESTAMP '{import_ts}' AS import_date FROM ({source})"""


# Synthetic sales: the same digests, cut into the same numbers.


def _draw(tag: str, slot: int) -> str:
    return f"CAST('0x' || SUBSTRING(md5(concat(CAST(sale_id AS VARCHAR), ':{tag}:7')), {1 + 8 * slot}, 8) AS BIGINT)"


def _drawn(ids: str, sale_date: str) -> str:
    return f"""SELECT sale_id, 1 + {_draw('a', 0)} % 1000 AS customer_id, 1 + {_draw('a', 1)} % 500 AS product_id,
       CAST(1 + {_draw('a', 2)} % 10 AS INTEGER) AS quantity,
       CAST(CAST(1000 + {_draw('a', 3)} % 99001 AS DECIMAL(12,0)) * 0.01 AS DECIMAL(10,2)) AS price,
       CASE {_draw('b', 0)} % 4 WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East' ELSE 'West' END AS region,
       {sale_date} AS sale_date
FROM {ids}"""


GEN_VALID = "valid AS ({})".format(
    _drawn(
        "(SELECT o_orderkey + 1 AS sale_id FROM orders)",
        f"strftime(DATE '2026-01-01' + CAST({_draw('b', 1)} % 181 AS INTEGER), '%Y-%m-%d')",
    )
)
GEN_BAD = "bad_dates AS ({})".format(
    _drawn(
        "(SELECT unnest(range((SELECT MAX(o_orderkey) + 2 FROM orders), "
        "(SELECT MAX(o_orderkey) + 2 + CAST(FLOOR(COUNT(*) * 0.005) AS BIGINT) FROM orders))) AS sale_id)",
        f"CASE WHEN {_draw('b', 1)} % 2 = 0 THEN 'invalid' ELSE "
        f"strftime(DATE '2026-06-30' + CAST(1 + {_draw('b', 2)} % 730 AS INTEGER), '%Y-%m-%d') END",
    )
)
GEN_COPIES = f"""copies AS (
  SELECT {COLUMNS} FROM (
    SELECT *, ROW_NUMBER() OVER (ORDER BY md5(concat(CAST(sale_id AS VARCHAR), ':sample:7'))) AS rn FROM valid)
  WHERE rn <= (SELECT FLOOR(COUNT(*) * 0.0005) FROM valid))"""
GEN_ALL = (
    f"{GEN_VALID}, {GEN_BAD}, {GEN_COPIES}, "
    "g AS (SELECT * FROM valid UNION ALL SELECT * FROM copies UNION ALL SELECT * FROM bad_dates)"
)


NULL_IDS = f"""n AS (SELECT CASE WHEN sale_id % 50 <> 0 THEN sale_id END AS sale_id, {COLUMNS[len("sale_id, "):]} FROM s)"""

SPLIT_COUNTS = """SELECT (SELECT COUNT(*) FROM s) AS rows_before, COUNT(*) AS rows_deduplicated,
  COUNT(*) FILTER (bad) AS quarantine_rows, COUNT(*) FILTER (NOT bad) AS clean_rows FROM marked"""


def _dedup_stats(table: str) -> str:
    return f"""SELECT CAST(SUM(n) AS BIGINT) AS rows_before, COUNT(*) AS rows_after,
  CAST(SUM(n) AS BIGINT) - COUNT(*) AS removed FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY sale_id)"""


def _csv_defects() -> str:
    """Fields spoilt as in the query; what does not cast is unread, and prices are judged unrounded."""
    spoilt = """d AS (SELECT CASE WHEN sale_id % 97 = 0 THEN 'x' ELSE '' END || CAST(sale_id AS VARCHAR) AS sale_id,
  CAST(customer_id AS VARCHAR) AS customer_id, CAST(product_id AS VARCHAR) AS product_id,
  CASE sale_id % 89 WHEN 1 THEN 'abc' WHEN 2 THEN '99999999999' ELSE CAST(quantity AS VARCHAR) END AS quantity,
  CASE sale_id % 83 WHEN 1 THEN '100000000000' WHEN 2 THEN '990.004' WHEN 3 THEN '0.006' ELSE CAST(price AS VARCHAR) END AS price,
  region, CASE WHEN sale_id % 79 = 1 THEN '1996-02-30' ELSE sale_date END AS sale_date FROM s)"""
    rules = _conditions(STAR_BOUNDS) | {
        "quantity": "TRY_CAST(quantity AS INTEGER) NOT BETWEEN 1 AND 45",
        "price": "TRY_CAST(price AS DECIMAL(38,18)) NOT BETWEEN 0.01 AND 990",
        **{
            f"unread_{column}": f"{column} IS NOT NULL AND TRY_CAST({column} AS {kind}) IS NULL"
            for column, kind in (("sale_id", "BIGINT"), ("customer_id", "BIGINT"), ("product_id", "BIGINT"),
                                 ("quantity", "INTEGER"), ("price", "DECIMAL(10,2)"))
        },
        "date_parse": "sale_date IS NOT NULL AND TRY_CAST(sale_date AS DATE) IS NULL",
    }
    parts = ["SELECT 'duplicate' AS rule, sale_id FROM d GROUP BY sale_id HAVING COUNT(*) > 1"]
    parts += [f"SELECT DISTINCT '{name}' AS rule, sale_id FROM d WHERE {condition}" for name, condition in rules.items()]
    return f"WITH {SALES}, {spoilt} " + " UNION ALL ".join(parts)


# Lines spoilt as in the query; too many or too few fields come before words for numbers.
SPOILT_LINES = """l AS (SELECT s.*, sale_id % 97 = 0 AS short, sale_id % 97 <> 0 AND sale_id % 89 = 1 AS long,
  sale_id % 83 = 1 AS no_quantity, sale_id % 79 = 2 AS no_price,
  concat_ws(',', sale_id, customer_id, product_id, CASE WHEN sale_id % 83 = 1 THEN 'abc' ELSE CAST(quantity AS VARCHAR) END,
    CASE WHEN sale_id % 79 = 2 THEN 'n/a' ELSE CAST(price AS VARCHAR) END, region)
  || CASE WHEN sale_id % 97 = 0 THEN '' WHEN sale_id % 89 = 1 THEN ',' || sale_date || ',x' ELSE ',' || sale_date END AS line FROM s)"""


def _ids(condition: str) -> str:
    return f"WITH {SALES} SELECT DISTINCT sale_id FROM s WHERE {condition}"


def _build() -> dict[str, str]:
    rule = _conditions(STAR_BOUNDS)
    found = _found("s", STAR_BOUNDS)
    s_found = f"WITH {SALES}, {found}"
    s_one = f"WITH {SALES}, {found}, {_first('s')}"
    whole = f"WITH {SALES} SELECT {COLUMNS} FROM s"
    agg = f"WITH {SALES} {_aggregate('s')}"
    s_marked = f"{s_one}, {_marked('one')}"
    s_lenient = f"{s_one}, {_marked('one', ROW_RULES)}"
    clean = f"{s_marked} SELECT {COLUMNS} FROM marked WHERE NOT bad"
    quarantine = f"{s_marked} SELECT {COLUMNS} FROM marked WHERE bad"
    n_marked = f"WITH {SALES}, {NULL_IDS}, {_found('n', STAR_BOUNDS)}, {_first('n')}, {_marked('one')}"
    report = _report(SALES, "s", STAR_BOUNDS)
    levels = " UNION ALL ".join(
        f"SELECT {level} AS grouping_id, {region} AS region, {product} AS product_id, COUNT(sale_id) AS total_sales, "
        f"CAST(SUM(price) AS DECIMAL(20,2)) AS total_sales_amount, "
        f"CAST(SUM(price) AS DOUBLE) / COUNT(sale_id) AS average_sale_amount FROM s GROUP BY {keys}"
        for level, region, product, keys in (
            (1, "region", "NULL", "region"),
            (2, "NULL", "product_id", "product_id"),
            (0, "region", "product_id", "region, product_id"),
        )
    )
    gaps = """gaps AS (SELECT sale_id, nullif(quantity, 1) AS quantity, nullif(price, 900.00) AS price,
  nullif(region, 'ASIA') AS region, nullif(sale_date, 'invalid') AS sale_date FROM s)"""
    outcomes = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, CASE WHEN {c} THEN 'violated' WHEN NOT ({c}) THEN 'kept' ELSE 'unknown' END "
        f"AS outcome FROM gaps"
        for name, c in rule.items()
    )
    asia = f"SELECT * FROM ({agg}) WHERE region = 'ASIA'"
    newest = f"{_snapshot(asia, '2026-01-06 12:45:00')} UNION ALL {_snapshot(agg, '2026-01-13 12:45:00')}"
    loaded = f"t AS (SELECT {COLUMNS[: -len('sale_date')]}TRY_CAST(sale_date AS DATE) AS sale_date FROM one)"
    return {
        "snapshot_newest": newest,
        "snapshot_as_of": f"{_snapshot(agg, '2026-01-06 12:45:00')} UNION ALL {_snapshot(agg, '2026-01-13 12:45:00')}",
        "snapshot_region": f"SELECT * FROM ({newest}) WHERE region = 'EUROPE' AND product_id BETWEEN 100 AND 900",
        "sales_upsert": f"""WITH {SALES}, {_first('s')}, {loaded}
  SELECT {COLUMNS} FROM t WHERE sale_id % 3 <> 0 AND sale_id % 2 <> 0
  UNION ALL SELECT sale_id, customer_id, product_id, quantity + 1 AS quantity, price, region, sale_date FROM t WHERE sale_id % 2 = 0""",
        "dq_report_incremental": report,
        "bad_ids_incremental": f"{s_found} SELECT DISTINCT sale_id FROM found",
        "pipeline_e2e": _snapshot(
            f"{s_marked}, kept AS (SELECT * FROM marked WHERE NOT bad) {_aggregate('kept')}", "2026-01-06 12:45:00"
        ),
        "csv_rejects": f"""WITH {SALES}, {SPOILT_LINES}
  SELECT line, CASE WHEN short OR long THEN 'ragged' ELSE 'unreadable' END AS reason,
  CASE WHEN NOT short AND NOT long THEN concat_ws(',', CASE WHEN no_quantity THEN 'quantity' END, CASE WHEN no_price THEN 'price' END) END AS columns
  FROM l WHERE short OR long OR no_quantity OR no_price""",
        "csv_accepted": f"WITH {SALES}, {SPOILT_LINES} SELECT {COLUMNS} FROM l WHERE NOT (short OR long OR no_quantity OR no_price)",
        "win_running_total": f"""WITH {SALES} SELECT {COLUMNS}, COUNT(*) OVER w AS running_count,
  CAST(SUM(price) OVER w AS DECIMAL(20,2)) AS running_total FROM s
  WINDOW w AS (PARTITION BY region ORDER BY sale_date, sale_id, customer_id, product_id, quantity, price
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        "dq_rule_sketches": f"""{s_found}, messages AS ({MESSAGES}),
  hashed AS (SELECT rule, CAST('0x' || SUBSTRING(md5(CAST(sale_id AS VARCHAR)), 1, 15) AS BIGINT) AS hash FROM found),
  kept AS (SELECT rule, hash FROM hashed QUALIFY ROW_NUMBER() OVER (PARTITION BY rule ORDER BY hash) <= 256)
  SELECT m.rule, COUNT(hash) AS kept, COALESCE(string_agg(CAST(hash AS VARCHAR), ',' ORDER BY hash), '') AS hashes,
  ROUND(CASE WHEN COUNT(hash) < 256 THEN CAST(COUNT(hash) AS DOUBLE) ELSE 255.0::DOUBLE * 1152921504606846976::DOUBLE / CAST(MAX(hash) AS DOUBLE) END, 3) AS estimated
  FROM messages m LEFT JOIN kept k ON k.rule = m.rule GROUP BY m.rule""",
        "gen_duplicates_drawn": f"""WITH {GEN_VALID}, ranked AS (
    SELECT {COLUMNS}, ROW_NUMBER() OVER (ORDER BY md5(concat(CAST(sale_id AS VARCHAR), ':sample:7'))) - 1 AS place FROM valid),
  drawn AS (SELECT CAST('0x' || SUBSTRING(md5(concat(CAST(i AS VARCHAR), ':draw:7')), 1, 15) AS BIGINT) % (SELECT COUNT(*) FROM valid) AS place
            FROM (SELECT unnest(range(CAST(FLOOR((SELECT COUNT(*) FROM valid) * 0.1) AS BIGINT))) AS i))
  SELECT {COLUMNS} FROM ranked JOIN drawn USING (place)""",
        "agg_region_product": agg,
        "agg_preview": f"{agg} ORDER BY region, product_id LIMIT 20",
        "agg_sale_amount": f"WITH {SALES} {_aggregate('s', LINE_AMOUNT)}",
        "agg_grouping_sets": f"WITH {SALES} {levels}",
        "win_region_product": f"""WITH {SALES} SELECT {COLUMNS}, COUNT(sale_id) OVER w AS total_sales,
  CAST(SUM(price) OVER w AS DECIMAL(20,2)) AS total_sales_amount,
  CAST(SUM(price) OVER w AS DOUBLE) / COUNT(sale_id) OVER w AS average_sale_amount
  FROM s WINDOW w AS (PARTITION BY region, product_id)""",
        "sale_amount": f"WITH {SALES} SELECT {COLUMNS}, {LINE_AMOUNT} AS sale_amount FROM s",
        "bad_ids_date_format": _ids(rule["date_format"]),
        "bad_ids_date_range": _ids(rule["date_range"]),
        "bad_ids_date": _ids(f"{rule['date_format']} OR {rule['date_range']}"),
        "bad_ids_region": _ids(rule["region"]),
        "bad_ids_quantity": _ids(rule["quantity"]),
        "bad_ids_price": _ids(rule["price"]),
        "bad_ids_numeric": _ids(f"{rule['quantity']} OR {rule['price']}"),
        "bad_ids_duplicate": f"WITH {SALES} SELECT sale_id FROM s GROUP BY sale_id HAVING COUNT(*) > 1",
        "bad_ids_all": f"{s_found} SELECT DISTINCT sale_id FROM found",
        "null_semantics": f"WITH {SALES}, {gaps} SELECT rule, outcome, COUNT(*) AS n_rows FROM ({outcomes}) "
        "GROUP BY rule, outcome",
        "duplicate_counts": f"WITH {SALES} SELECT sale_id, COUNT(*) AS count FROM s GROUP BY sale_id "
        "HAVING COUNT(*) > 1",
        "dedup_keep_one": f"WITH {SALES}, {_first('s')} SELECT {COLUMNS} FROM one",
        "dedup_stats": f"WITH {SALES} {_dedup_stats('s')}",
        "dq_rule_counts": f"{s_found}, messages AS ({MESSAGES}) SELECT m.rule, COUNT(f.rule) AS bad_ids "
        "FROM messages m LEFT JOIN found f ON f.rule = m.rule GROUP BY m.rule",
        "dq_violations": f"{s_found} SELECT rule, sale_id FROM found",
        "dq_id_samples": f"{s_found} SELECT rule, CAST(position AS INTEGER) AS position, sale_id FROM (SELECT *, "
        "ROW_NUMBER() OVER (PARTITION BY rule ORDER BY sale_id) AS position FROM found) WHERE position <= 3",
        "dq_totals": f"""{s_found}, {_marked('s')}, ids AS (SELECT sale_id, COUNT(*) AS n, ANY_VALUE(bad) AS bad FROM marked GROUP BY sale_id)
  SELECT CAST(SUM(n) AS BIGINT) AS total_rows, COUNT(*) AS total_ids, COUNT(*) FILTER (bad) AS bad_ids,
  COUNT(*) FILTER (NOT bad) AS clean_ids, CAST(COALESCE(SUM(n) FILTER (NOT bad), 0) AS BIGINT) AS clean_rows,
  CAST(SUM(n) AS BIGINT) - COUNT(*) AS repeated_rows FROM ids""",
        "dq_report": report,
        "report_roundtrip": report,
        "clean_rows": clean,
        "quarantine_rows": quarantine,
        "clean_rows_keep_one": f"{s_lenient} SELECT {COLUMNS} FROM marked WHERE NOT bad",
        "clean_rows_by_id_list": clean,
        "quarantine_rows_by_id_list": quarantine,
        "split_counts": f"{s_marked} {SPLIT_COUNTS}",
        "split_counts_keep_one": f"{s_lenient} {SPLIT_COUNTS}",
        "dq_report_keep_one": _report(SALES, "s", STAR_BOUNDS, keep_one=True),
        "bad_ids_year_to_date": _ids("sale_date < '1998-01-01' OR sale_date > '1998-08-02'"),
        "clean_rows_null_ids": f"{n_marked} SELECT {COLUMNS} FROM marked WHERE NOT bad",
        "quarantine_rows_null_ids": f"{n_marked} SELECT {COLUMNS} FROM marked WHERE bad",
        "dedup_stats_null_ids": f"WITH {SALES}, {NULL_IDS} {_dedup_stats('n')}",
        "sample_null_key": f"""WITH {SALES}, {NULL_IDS}, {_first('n')} SELECT {COLUMNS} FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY CASE WHEN sale_id IS NULL THEN repeat('0', 32)
    ELSE md5(concat(CAST(sale_id AS VARCHAR), ':sample:7')) END) AS place FROM one) WHERE place <= 500""",
        "sample_fraction": f"WITH {SALES} SELECT {COLUMNS} FROM s WHERE {_draw('sample', 0)} < 429496730",
        "csv_defects": _csv_defects(),
        "snapshot_rerun_empty": _snapshot(agg, "2026-01-13 12:45:00"),
        "typed_sales": f"WITH {SALES} SELECT sale_id, customer_id, product_id, quantity, price, region, "
        "TRY_CAST(sale_date AS DATE) AS sale_date FROM s",
        "csv_roundtrip": whole,
        "csv_inferred": f"WITH {SALES} SELECT CAST(sale_id AS INTEGER) AS sale_id, "
        "CAST(customer_id AS INTEGER) AS customer_id, CAST(product_id AS INTEGER) AS product_id, quantity, "
        "CAST(price AS DOUBLE) AS price, region, sale_date FROM s",
        "parquet_roundtrip": whole,
        "snapshot_typed": _snapshot(agg, "2026-01-06 12:45:00"),
        "snapshot_append": f"{_snapshot(agg, '2026-01-06 12:45:00')} UNION ALL {_snapshot(agg, '2026-01-13 12:45:00')}",
        "gen_sales": f"WITH {GEN_VALID} SELECT * FROM valid",
        "gen_invalid": f"WITH {GEN_BAD} SELECT * FROM bad_dates",
        "gen_duplicates": f"WITH {GEN_VALID}, {GEN_COPIES} SELECT * FROM copies",
        "gen_combined": f"WITH {GEN_ALL} SELECT * FROM g",
        "gen_report": _report(GEN_ALL, "g", GEN_BOUNDS),
        "sales_e2e": _snapshot(
            f"{s_marked}, kept AS (SELECT * FROM marked WHERE NOT bad) {_aggregate('kept')}", "2026-01-06 12:45:00"
        ),
        "gen_e2e": _snapshot(
            f"WITH {GEN_ALL}, {_found('g', GEN_BOUNDS)}, {_first('g')}, {_marked('one')}, "
            f"kept AS (SELECT * FROM marked WHERE NOT bad) {_aggregate('kept')}",
            "2026-01-06 12:45:00",
        ),
    }


ORACLE_SQL = _build()
