"""SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

from shopsieve.llm.secret_scan import RULES


def _any(pattern: str) -> str:
    return pattern.replace("'", "''")


def _spans(kind: str, pattern: str, group: int, least: int, order: int) -> str:
    """Rows (doc_id, kind, start, stop) of one rule: offsets from the lengths of matches and of what lies between."""
    p = _any(pattern)
    return f"""
      SELECT id, '{kind}' AS kind, {order} AS place,
             list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS start,
             list_sum(list_transform(b[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS stop
      FROM (SELECT id, unnest(range(1, len(m) + 1)) AS i, m, g, b
            FROM (SELECT id, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {group}) AS g, string_split_regex(t, '{p}') AS b
                  FROM texts WHERE regexp_matches(t, '{p}')))
      WHERE length(g[i]) >= {least}"""


def _secrets() -> str:
    rules = " UNION ALL ".join(_spans(r.kind, r.pattern, r.group, r.least, k) for k, r in enumerate(RULES))
    listed = "string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, place)"
    base = "kind IN ('assign', 'access', 'hex')"
    return f"""
    WITH texts AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
    spans AS ({rules}),
    per AS (SELECT id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                   count(*) FILTER (kind = 'hex') AS n_hex, {listed} FILTER ({base}) AS based, {listed} AS spans
            FROM spans GROUP BY id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(based, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN per USING (id)"""


_COMPONENTS = r"""
    WITH RECURSIVE texts AS (
      SELECT row_number() OVER () AS id, doc_id,
             list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
      FROM documents),
    shingled AS (
      SELECT id, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
      FROM texts),
    sets AS (SELECT min(id) AS node, s, len(s) AS n, list(id) AS ids FROM (SELECT id, list_sort(s) AS s FROM shingled) WHERE len(s) > 0 GROUP BY s),
    items AS (SELECT node, n, unnest(s) AS x FROM sets),
    links AS (
      SELECT a.node AS u, b.node AS v FROM items a JOIN items b ON a.x = b.x AND a.node < b.node
      GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
    ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
    reached AS (SELECT node AS u, node AS v FROM sets UNION SELECT r.u, b.v FROM reached r JOIN ways b ON r.v = b.u),
    member AS (SELECT node, unnest(ids) AS id FROM sets),
    least AS (SELECT r.u AS node, min(t.doc_id) AS component_id FROM reached r JOIN member m ON r.v = m.node JOIN texts t ON t.id = m.id GROUP BY r.u)
    SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE l.component_id END AS component_id
    FROM shingled s LEFT JOIN member m ON m.id = s.id LEFT JOIN least l ON l.node = m.node"""


def _repairs() -> str:
    """The damage, the verdicts, and the cheapest edits row by row: for each state the least of (cost, audit, rows)."""

    def put(state: str, cost: str, letters: str, *lines: str) -> str:
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'x': {state}.x || '{letters}', 'r': {state}.r || [{', '.join(lines)}]::VARCHAR[]}} END"

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    said = {None: "role || ':' || text", "user": "'user:' || text", "assistant": "'assistant:' || text"}

    def reach(after: str, initial: str, name: str) -> list[str]:
        ways = []
        for state in ("e", "s", "u", "a"):
            direct = (state == "u") == (after == "a")
            letter, cost, other = ("", 0, []) if direct else ("I", 2, ["'assistant:'" if after == "u" else "'user:'"])
            ways.append(f"CASE WHEN NOT must AND ini = '{initial}' THEN {put(state, f'{cost} + cut', letter + 'K', *other, said[None])} END")
            ways.append(f"CASE WHEN NOT must THEN {put(state, f'{cost + 2} + cut', letter + 'R', *other, said[name])} END")
        return ways

    keep_s = f"CASE WHEN NOT must AND ini = 's' THEN {put('e', 'cut', 'K', said[None])} END"
    gone = {state: put(state, "3", "D") for state in "esua"}
    nobody = "NULL::STRUCT(c BIGINT, x VARCHAR, r VARCHAR[])"
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda ch: ascii(ch)::BIGINT)), "
        "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT)"
    )
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    WITH RECURSIVE keyed AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
    fated AS (SELECT *, {crc} % 20 AS fate FROM keyed),
    hurt AS (
      SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
      FROM fated WHERE fate <> 0),
    ids AS (SELECT conv_id, row_number() OVER () AS cid FROM (SELECT DISTINCT conv_id FROM conversations)),
    placed AS (
      SELECT cid, turn, role, text, left(role, 1) AS ini, rtrim(text, {white}) AS bare,
             row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, md5(role || chr(10) || text)) AS k
      FROM hurt JOIN ids ON hurt.conv_id IS NOT DISTINCT FROM ids.conv_id),
    judged AS (
      SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY cid, role, text ORDER BY k) > 1 AS again,
             ini NOT IN ('s', 'u', 'a') AS odd, lag(ini) OVER (PARTITION BY cid ORDER BY k) || ini AS pair FROM placed),
    verdict AS (
      SELECT *, blank OR again AS must, CASE WHEN NOT blank AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut
      FROM judged),
    way AS (
      SELECT cid, 0::BIGINT AS k, {{'c': 0::BIGINT, 'x': '', 'r': []::VARCHAR[]}} AS e, {nobody} AS s, {nobody} AS u, {nobody} AS a FROM ids
      UNION ALL
      SELECT w.cid, v.k, {least(gone['e'])}, {least(gone['s'], keep_s)}, {least(gone['u'], *reach('u', 'u', 'user'))},
             {least(gone['a'], *reach('a', 'a', 'assistant'))}
      FROM way w JOIN verdict v ON v.cid = w.cid AND v.k = w.k + 1),
    ended AS (
      SELECT cid, {least('e', 'a', put('u', '2', 'I', "'assistant:'"), put('s', '4', 'II', "'user:'", "'assistant:'"))} AS best
      FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY k DESC) AS back FROM way) WHERE back = 1),
    counts AS (
      SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
             count(*) FILTER (again) AS duplicate, CAST(sum(cut) AS BIGINT) AS truncated,
             count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM verdict GROUP BY cid)
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.x AS audit,
           sha256(array_to_string(best.r, chr(10))) AS repaired_sha256
    FROM ids JOIN ended USING (cid) LEFT JOIN counts USING (cid)"""


_INTERACTIONS = r"""
    WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    worded AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
                      coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS again FROM texts),
    marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    cells AS (
      SELECT part, CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN again THEN 16 ELSE 0 END AS mask,
             count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM worded LEFT JOIN marks USING (doc_id) GROUP BY ALL),
    filters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(name, bit)),
    orders AS (
      SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM filters a, filters b, filters c, filters d, filters e
      WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
    steps AS (
      SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step-1]), 0) AS INTEGER) AS done
      FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
    taken AS (
      SELECT part, filter_order, step, bit,
             coalesce(sum(n) FILTER (mask & (done | bit) = 0), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (mask & done = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (mask & done <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (mask & done = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
             coalesce(sum(toxic) FILTER (mask & done = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
      FROM cells, steps GROUP BY ALL)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
    FROM taken"""

ORACLE_SQL = {
    "op2_secret_ledger": _secrets(),
    "op6_partenum_components": _COMPONENTS,
    "op11_survivor_repair": _repairs(),
    "op13_filter_interactions": _INTERACTIONS,
}
