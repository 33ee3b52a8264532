"""SQL that gives the rows of a query, where SQL can express it."""

from __future__ import annotations

TOPK = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id ASC NULLS LAST) AS rank
  FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

FILL_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s
  FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts
"""

_PLACES = (0, 1, 2, 3)


def _least(ways: list[str]) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))[1]"


def _way(state: str, cost: str, letter: str, line: str, given: str = "TRUE") -> str:
    text = f"{state}.t || [{line}]" if line else f"{state}.t"
    return f"CASE WHEN {state} IS NOT NULL AND ({given}) THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}} END"


def _row_step() -> str:
    """The states after a row, from the states s0 to s3 before it: delete, keep, rerole."""
    columns = []
    for q in _PLACES:
        ways = [_way(f"s{q}", "4", "D", "")]
        into = {1: [("s", 0)], 2: [("u", p) for p in (0, 1, 3)], 3: [("a", 2)]}.get(q, [])
        for c, p in into:
            line = "k.role || ':' || k.text"
            ways.append(_way(f"s{p}", "k.more", "K", line, f"NOT k.gone AND k.initial = '{c}'"))
            if c != "s":
                role = "user" if c == "u" else "assistant"
                ways.append(_way(f"s{p}", "3 + k.more", "R", f"'{role}:' || k.text", "NOT k.gone"))
        columns.append(f"{_least(ways)} AS e{q}")
    return ",\n    ".join(columns)


def _insertions(of: str) -> str:
    """States closed under insertions; two in a row reach all that can be reached."""
    ways = {0: [], 1: [], 2: [(0, "I", ["user:"]), (1, "I", ["user:"]), (3, "I", ["user:"])]}
    ways[3] = [(2, "I", ["assistant:"]), (0, "II", ["user:", "assistant:"]), (1, "II", ["user:", "assistant:"])]
    columns = []
    for q in _PLACES:
        made = [f"{of}{q}", *[_way(f"{of}{p}", str(3 * len(lines)), i, ", ".join(f"'{x}'" for x in lines)) for p, i, lines in ways[q]]]
        columns.append(f"{_least(made)} AS s{q}")
    return ",\n    ".join(columns)


_STATE = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])"
REPAIR = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), drawn AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT))),
             lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS draw
  FROM given, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN draw = 1 THEN '' WHEN draw = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN draw = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM drawn WHERE draw <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS k,
         rtrim(text, E' \\t\\n\\x0b\\x0c\\r') AS trimmed
  FROM damaged
), faults AS (
  SELECT *, trimmed = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS again,
         right(trimmed, 1) NOT IN ('.', '!', '?') AS open_ended, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY k) || role[1] AS pair
  FROM numbered
), kept AS (
  SELECT conv_id, k, role, text, role[1] AS initial, blank OR again AS gone, CASE WHEN open_ended THEN 3 ELSE 0 END AS more
  FROM faults
), start AS (
  SELECT CAST({{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}} AS {_STATE}) AS e0,
         CAST(NULL AS {_STATE}) AS e1, CAST(NULL AS {_STATE}) AS e2, CAST(NULL AS {_STATE}) AS e3
), ids AS (
  SELECT DISTINCT conv_id FROM damaged
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS k, {_insertions("e")}
  FROM ids, start
  UNION ALL
  SELECT conv_id, k, {_insertions("e")}
  FROM (
    SELECT k.conv_id, k.k, {_row_step()}
    FROM walk w JOIN kept k ON w.conv_id IS NOT DISTINCT FROM k.conv_id AND k.k = w.k + 1
  ) AS stepped
), ends AS (
  SELECT conv_id, {_least(["s0", "s3"])} AS best FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) = 1
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (NOT blank AND NOT again AND open_ended) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), every AS (
  SELECT DISTINCT conv_id FROM conversations
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM every o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""

ORACLES = {"op11_exact_topk": TOPK, "op12_fill_middle": FILL_MIDDLE, "op13_conversation_repair": REPAIR}
