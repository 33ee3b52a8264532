"""SQL restatements of the registered queries, for DuckDB on the same tables.

Queries that fit or train a model have none; tests check their properties.
"""

from __future__ import annotations

from vellumark.functions import kinds
from vellumark.functions.formats import (
    ATTACHMENTS_JSON,
    DESCRIPTOR_SPACE,
    DRAFT,
    RESERVED_NAMES,
    SCHEMA_VERSION,
    URN_START,
    XSD_ATTACHMENTS,
    XSD_HEAD,
    XSD_TAIL,
)
from vellumark.functions.values import TYPE_NAMES
from vellumark.operators import enrichment
from vellumark.plans.inputs import (
    APPLICATION,
    CHUNK,
    FOLDER,
    HOLDING,
    PACKAGE_BYTES,
    PACKAGE_ROWS,
    STAMP,
)

ORACLES: dict[str, str] = {}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def trimmed(expr: str) -> str:
    return rf"regexp_replace({expr}, '^\s+|\s+$', '', 'g')"


def el(name: str, expr: str, attributes: str = "") -> str:
    """XML element of a value."""
    text = f"replace(replace(replace({expr}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return (
        f"CASE WHEN coalesce({expr}, '') = '' THEN '<{name}{attributes} />' "
        f"ELSE '<{name}{attributes}>' || {text} || '</{name}>' END"
    )


def uuid_of(*parts: str) -> str:
    digest = "sha256(" + " || chr(31) || ".join(parts) + ")"
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({digest}, {at}, {n})" for at, n in cuts)


def number_of(*parts: str) -> str:
    digest = "sha256(" + " || chr(31) || ".join(parts) + ")"
    return f"CAST(1000000000 + CAST('0x' || substr({digest}, 1, 12) AS BIGINT) % 9000000000 AS VARCHAR)"


META = """meta AS (
  SELECT d.doc_id, sha256(d.text) || '.txt' AS filename, '/' || d.source AS folder_path,
    nullif(d.lang, 'es') AS document_type,
    CASE WHEN n_chars < 500 THEN 'draft' WHEN n_chars < 3000 THEN 'review' ELSE 'final' END AS document_status,
    CASE WHEN l.toxic = 1 THEN 'restricted' WHEN l.quality = 1 THEN 'public' WHEN l.quality = 0 THEN 'internal' END
      AS sensitivity_labels,
    CASE WHEN n_chars > 5000 THEN '10y' WHEN n_chars > 1000 THEN '5y' END AS retention_policies,
    'v' || (n_chars % 5) AS version, nullif(d.source, 'src0') AS creator, d.source AS modifier,
    o.o_orderdate AS creation_date, o.o_orderdate + n_chars * INTERVAL 1 MINUTE AS last_modified
  FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN orders o ON o.o_orderkey = d.doc_id)"""

PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
ORDER_DAY = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"
ORDER_COLUMNS = [
    ("o_orderkey", "CAST(o_orderkey AS VARCHAR)"),
    ("o_custkey", "CAST(o_custkey AS VARCHAR)"),
    ("o_orderstatus", "o_orderstatus"),
    ("o_totalprice", PRICE),
    ("o_orderdate", ORDER_DAY),
    ("order priority", "o_orderpriority"),
    (
        "mixed",
        f"CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey AS VARCHAR) WHEN 'O' THEN {PRICE} ELSE {ORDER_DAY} END",
    ),
]
EXPORT = {
    "SALES_customer": (
        "customer", "c_custkey",
        [
            ("c_custkey", "CAST(c_custkey AS VARCHAR)"),
            ("c_name", "c_name"),
            ("c_nationkey", "CAST(c_nationkey AS VARCHAR)"),
            ("c_acctbal", "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)"),
            ("type", "nullif(c_mktsegment, 'MACHINERY')"),
        ],
    ),
    "SALES_orders": ("orders", "o_orderkey", ORDER_COLUMNS),
    "TEXT_documents": (
        "documents", "doc_id",
        [
            ("doc_id", "CAST(doc_id AS VARCHAR)"),
            ("text", "text"),
            ("lang", "lang"),
            ("seen", "strftime(make_timestamp(doc_id * 1000000), '%Y-%m-%dT%H:%M:%SZ')"),
            ("attachment", "source || '.txt'"),
        ],
    ),
}

CELLS = "cells AS (" + " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, {i} AS ordinal, '{name}' AS name, {key} AS ord, {expr} AS v FROM {source}"
    for table, (source, key, columns) in EXPORT.items()
    for i, (name, expr) in enumerate(columns, 1)
) + ")"


def catalogue(kind: str, type_of: str) -> str:
    """CTEs `cells`, `kinded` and `catalogue`."""
    return f"""{CELLS}, kinded AS (SELECT *, {kind} AS kind FROM cells),
catalogue AS (SELECT *, CASE WHEN type IN ('VARCHAR', 'string', 'xs:string') THEN '255' ELSE '64' END AS type_length
  FROM (SELECT table_name, ordinal, name, {type_of} AS type, count(*) AS record_count
        FROM kinded GROUP BY table_name, ordinal, name))"""


def relational(strict: bool) -> str:
    text = trimmed("v")
    number = f"TRY_CAST(replace({text}, '_', '') AS DOUBLE)"
    not_finite = f"regexp_full_match({text}, {quoted(kinds.NOT_FINITE)})"
    parses = f"(regexp_full_match({text}, {quoted(kinds.NUMBER)}) OR {not_finite})"
    fraction = f"({not_finite} OR isnan({number}) OR isinf({number}) OR round({number}) <> {number})"
    is_float = f"({parses} AND (contains(v, '.') OR {fraction}))" if strict else (
        f"(contains(v, '.') OR ({parses} AND {fraction}))"
    )
    missing = ", ".join(quoted(m) for m in kinds.MISSING)
    kind = f"""CASE WHEN v IS NULL OR v IN ({missing}) THEN NULL
      WHEN regexp_matches(v, '[-/:]') AND regexp_full_match({text}, {quoted(kinds.DATE)}) THEN 'date'
      WHEN {is_float} THEN 'float' WHEN regexp_full_match({text}, {quoted(kinds.INTEGER)}) THEN 'int'
      ELSE 'string' END"""
    first = "arg_min(kind, ord) FILTER (WHERE kind IN ('date', 'string'))"
    type_of = f"""CASE WHEN {first} = 'date' THEN 'DATE' WHEN {first} = 'string' THEN 'VARCHAR'
      WHEN bool_or(kind = 'float') THEN 'FLOAT' ELSE 'INT' END"""
    return catalogue(kind, type_of)


def strongest(patterns: list[tuple[str, str]], classes: tuple[str, ...], text: str) -> tuple[str, str]:
    cases = " ".join(f"WHEN regexp_full_match({text}, {quoted(p)}) THEN {i}" for i, (p, _) in enumerate(patterns))
    kind = f"CASE WHEN v IS NULL OR {trimmed('v')} = '' THEN NULL {cases} ELSE {len(patterns)} END"
    named = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(classes))
    return kind, f"CASE min(kind) {named} ELSE '{classes[-1]}' END"


JSON_CATALOGUE = catalogue(
    *strongest(
        [(kinds.ISO_STAMP, ""), (kinds.ISO_DAY, ""), (kinds.PLAIN_NUMBER, "")], kinds.JSON_CLASSES, trimmed("v")
    )
)
_XSD_KIND, _XSD_TYPE = strongest(
    [(kinds.XSD_STAMP, ""), (kinds.ISO_DAY, ""), (kinds.XSD_LONG, ""), (kinds.XSD_DECIMAL, "")],
    kinds.XSD_CLASSES, "v",
)
_LAST = " OR ".join(
    f"(table_name = '{table}' AND ordinal = {len(columns)})" for table, (_, _, columns) in EXPORT.items()
)
_RESERVED = ", ".join(quoted(n.lower()) for n in RESERVED_NAMES)
XSD_CATALOGUE = catalogue(
    _XSD_KIND,
    f"CASE WHEN {_LAST} THEN 'attachment' ELSE {_XSD_TYPE} END",
) + f""", xsd_catalogue AS (SELECT table_name, ordinal,
  CASE WHEN lower(name) IN ({_RESERVED}) AND NOT ({_LAST}) THEN name || '_field' ELSE name END AS name,
  type, type_length, record_count FROM catalogue)"""
LAX, STRICT = relational(False), relational(True)

_ROW = " || ".join(el(name.replace(" ", "_"), f"({expr})") for name, expr in ORDER_COLUMNS)
ORDER_DOCS = f"""numbered AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders),
rowed AS (SELECT position, position // {CHUNK} AS chunk_id, '<ROW>' || {_ROW} || '</ROW>' AS x FROM numbered),
joined AS (SELECT chunk_id, count(*) AS rows,
  '<SALES><orders>' || string_agg(x, '' ORDER BY position) || '</orders></SALES>' AS payload FROM rowed GROUP BY 1),
docs AS (SELECT chunk_id, rows, CAST(strlen(payload) AS BIGINT) AS bytes, sha256(payload) AS sha,
  instr('0123456789abcdef', substr(sha256(payload), 1, 1)) - 1 AS digit FROM joined)"""

ATTACHED = f"""recs AS (SELECT doc_id, lang, source, n_chars, 'doc_' || doc_id || '.txt' AS a0,
  CASE WHEN lang <> 'en' THEN 'doc_' || (doc_id - doc_id % 10) || '.txt' END AS a1 FROM documents),
refs AS (SELECT doc_id, 0 AS slot, a0 AS name, '{FOLDER}/' || a0 AS path FROM recs UNION ALL
  SELECT doc_id, 1 AS slot, a1 AS name, '{FOLDER}/shared/' || a1 AS path FROM recs WHERE a1 IS NOT NULL),
all_files AS (SELECT lang, 'doc_' || doc_id || '.txt' AS name, CAST(strlen(text) AS BIGINT) AS size,
  to_base64(unhex(sha256(text))) AS checksum FROM documents)"""
MATCHED = ATTACHED + """, matched AS (SELECT r.doc_id, r.slot, r.name, r.path, f.size, f.checksum,
  'text/plain' AS mimetype FROM refs r LEFT JOIN all_files f USING (name))"""


def greedy(sizes: str) -> str:
    """CTE `packed` over a query giving (position, doc_id, size)."""
    full = f"(p.used + s.size > {PACKAGE_BYTES} OR p.n >= {PACKAGE_ROWS})"
    return f"""sizes AS MATERIALIZED ({sizes}), packed AS (
  SELECT position, doc_id, size, CAST(0 AS BIGINT) AS package_id, size AS used, 1 AS n FROM sizes WHERE position = 0
  UNION ALL
  SELECT s.position, s.doc_id, s.size, p.package_id + CASE WHEN {full} THEN 1 ELSE 0 END,
    CASE WHEN {full} THEN s.size ELSE p.used + s.size END, CASE WHEN {full} THEN 1 ELSE p.n + 1 END
  FROM packed p JOIN sizes s ON s.position = p.position + 1)"""


PACKED = MATCHED + ", " + greedy(
    "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, doc_id, "
    "CAST(coalesce(sum(size), 0) + 2048 AS BIGINT) AS size FROM matched GROUP BY doc_id"
)
DOCUMENT_PACKS = greedy(
    "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, doc_id, n_chars + 2048 AS size FROM documents"
)
_ATTACHMENT = " || ".join(
    [
        "'<Attachment>'",
        el("mimetype", "mimetype"),
        el("Size", "CAST(size AS VARCHAR)"),
        el("EASFile", "name"),
        el("checksum", "checksum", ' algorithm="SHA-256" encoding="base64"'),
        el("FilePath", f"('{FOLDER}/' || name)"),
        "'</Attachment>'",
    ]
)
_META = " || ".join(el(c, f"CAST({c} AS VARCHAR)") for c in ("doc_id", "lang", "source", "n_chars"))
PAYLOADS = PACKED + f""", attached AS (SELECT doc_id, string_agg({_ATTACHMENT}, '' ORDER BY slot) AS a
  FROM matched GROUP BY doc_id),
fragments AS (SELECT doc_id, '<Record>' || {_META} || '<Attachments>' || a || '</Attachments></Record>' AS x
  FROM recs JOIN attached USING (doc_id)),
payloads AS (SELECT package_id, count(*) AS aiu_count,
  '<Records xmlns="{URN_START}{HOLDING.lower()}.1.0">' || string_agg(x, '' ORDER BY position)
  || '</Records>' AS payload FROM fragments JOIN packed USING (doc_id) GROUP BY package_id)"""

USERS = """users AS (SELECT c_custkey AS id,
  CASE WHEN c_nationkey = 3 THEN substr(lower(c_name), 1, 2) WHEN c_nationkey = 4 THEN NULL ELSE lower(c_name) END
    AS username,
  lower(c_name) || CASE WHEN c_nationkey = 5 THEN '@nowhere' ELSE '@example.org' END AS email,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'admin' WHEN 'HOUSEHOLD' THEN 'guest' ELSE 'user' END AS role,
  c_acctbal > 0 AS is_active, CASE WHEN c_nationkey <> 0 THEN c_custkey * 2 END AS created_by FROM customer)"""


def shares(source: str, column: str) -> str:
    return f"""SELECT {column} AS label, count(*) AS count,
  round(count(*) / CAST((SELECT count(*) FROM {source}) AS DOUBLE) * 100, 2) AS percentage
FROM {source} GROUP BY {column}"""


# Sources

_columns = ", ".join(f"{expr} AS {name.replace(' ', '_')}" for name, expr in ORDER_COLUMNS)
ORACLES["src_csv_strings"] = f"SELECT {_columns} FROM orders"
ORACLES["src_csv_folder"] = f"""WITH {CELLS} SELECT table_name, ordinal, name, count(v) AS filled,
  CAST(coalesce(sum(length(v)), 0) AS BIGINT) AS chars FROM cells GROUP BY ALL"""
ORACLES["src_name_parts"] = """WITH s AS (SELECT c_custkey,
  CASE WHEN c_nationkey < 5 THEN c_name ELSE c_mktsegment || '_' || c_name || '_2024' END AS stem FROM customer)
SELECT c_custkey, stem, split_part(stem, '_', 1) AS schema_name,
  coalesce(nullif(split_part(stem, '_', 2), ''), 'Unknown') AS table_name FROM s"""
ORACLES["src_text_head"] = """WITH f AS (SELECT 'doc_' || doc_id || '.txt' AS name, text AS t FROM documents
  WHERE lang <> 'es')
SELECT name, CASE WHEN len(string_split(t, chr(10))) > 50
  THEN array_to_string(string_split(t, chr(10))[1:50], chr(10)) || chr(10) ELSE t END AS head
FROM f ORDER BY name LIMIT 10"""
ORACLES["src_limit_intake"] = (
    "SELECT 'doc_' || doc_id || '.txt' AS name, n_chars FROM documents ORDER BY name LIMIT 10"
)
ORACLES["src_attachments"] = f"""WITH {ATTACHED} SELECT f.name, f.size, f.checksum,
  'ea_' || lower(hex(from_base64(f.checksum))) AS content_name, 'text/plain' AS mimetype FROM all_files f"""
ORACLES["src_doc_kind"] = """SELECT 'doc_' || doc_id || '.txt' AS name,
  CASE lang WHEN 'de' THEN 'pdf' WHEN 'fr' THEN 'image' ELSE 'text' END AS kind FROM documents"""
ORACLES["src_jdbc_documents"] = "SELECT doc_id, lang, source, n_chars, sha256(text) AS text_sha FROM documents"
ORACLES["src_json_metadata"] = f"""WITH {LAX} SELECT '{APPLICATION}' AS application_name, 'SAP' AS schema_name,
  table_name, ordinal, name, type, type_length, record_count FROM catalogue"""
ORACLES["src_zip_check"] = f"""WITH RECURSIVE {PACKED} SELECT count(DISTINCT package_id) AS valid_zips,
  (SELECT count(*) FROM region) AS broken_zips, true AS newest_is_valid FROM packed"""
ORACLES["src_json_config"] = (
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"
)

# Sinks

ORACLES["sink_xml_chunks"] = f"WITH {ORDER_DOCS} SELECT chunk_id, rows, bytes, sha FROM docs"
ORACLES["sink_delivery_ledger"] = f"""WITH {ORDER_DOCS}
SELECT CAST(0 AS BIGINT) AS batch_id, chunk_id, rows, bytes, sha, CASE WHEN digit < 4 THEN 503 ELSE 201 END AS status,
  CASE WHEN digit < 4 THEN 3 WHEN digit < 8 THEN 2 ELSE 1 END AS attempt FROM docs
UNION ALL SELECT 0, chunk_id, rows, bytes, sha, 201, 1 FROM docs WHERE digit < 4"""
_TOTALS = """CAST(sum(rows) AS BIGINT) AS {0}, CAST(coalesce(sum(rows) FILTER (WHERE digit >= 4), 0) AS BIGINT) AS {1},
  CAST(coalesce(sum(rows) FILTER (WHERE digit < 4), 0) AS BIGINT) AS {2}"""
ORACLES["sink_run_metrics"] = f"""WITH {ORDER_DOCS} SELECT CAST(1 AS BIGINT) AS id, 'archive_orders' AS dag_id, 'run-1' AS run_id,
  {_TOTALS.format('records_processed', 'records_successful', 'records_failed')} FROM docs"""
ORACLES["sink_json_report"] = f"WITH {META} " + " UNION ALL ".join(
    f"""SELECT '{analysis}' AS analysis, CAST(to_json(struct_pack(labels := list(label ORDER BY count DESC, label NULLS FIRST),
  counts := list(count ORDER BY count DESC, label NULLS FIRST),
  percentages := list(percentage ORDER BY count DESC, label NULLS FIRST))) AS VARCHAR) AS report FROM ({shares('meta', column)})"""
    for analysis, column in (
        ("document_types", "document_type"),
        ("document_status", "document_status"),
        ("sensitivity_labels", "sensitivity_labels"),
        ("retention_policies", "retention_policies"),
    )
)
ORACLES["sink_csv_dump"] = f"""WITH {META} SELECT CAST(doc_id AS VARCHAR) AS doc_id, filename, folder_path,
  document_type, sensitivity_labels, version FROM meta"""
ORACLES["sink_pdi_json"] = f"""WITH {ATTACHED} SELECT m.doc_id, r.lang,
  CAST(row_number() OVER (PARTITION BY m.doc_id ORDER BY m.slot) - 1 AS INTEGER) AS slot, 'text/plain' AS mimetype,
  coalesce(f.size, 0) AS "Size", 'ea_' || lower(hex(from_base64(f.checksum))) AS "EASFile", f.checksum,
  m.path AS "FilePath"
FROM refs m JOIN recs r USING (doc_id) LEFT JOIN all_files f ON f.name = m.name AND f.lang <> 'es'"""

_TERMS = rf"regexp_extract_all(lower(text), '{enrichment.TERM}')"
_HITS = ", ".join(
    f"len(list_filter({_TERMS}, lambda t: t IN ({', '.join(quoted(w) for w in words)}))) AS {name}"
    for name, words in sorted(enrichment.INTENT_CUES.items())
)
_BEST = "greatest(" + ", ".join(sorted(enrichment.INTENT_CUES)) + ")"
_WHICH = " ".join(f"WHEN {name} = {_BEST} THEN '{name}'" for name in sorted(enrichment.INTENT_CUES))
INTENTS = f"""hits AS (SELECT doc_id, {_HITS} FROM documents),
intents AS (SELECT doc_id, CASE WHEN {_BEST} = 0 THEN 'unknown' {_WHICH} END AS intent,
  CAST({_BEST} AS BIGINT) AS score FROM hits)"""
ORACLES["sink_enrich_append"] = f"""WITH {INTENTS} SELECT 'doc_' || doc_id || '.txt' AS filename, intent,
  '' AS summary, '' AS keywords, '' AS topic, '' AS named_entities, '' AS pii_entities, '' AS synonyms,
  '2025-07-09 12:00:00' AS created_at FROM intents"""


def points(text: str) -> str:
    source = "'label_' || label"
    return f"""SELECT {uuid_of(source, 'CAST(vec_id AS VARCHAR)', text)} AS id, {text} AS text,
  {source} AS source_file, CAST(len(embedding) AS INTEGER) AS dimensions FROM embeddings"""


ORACLES["sink_vector_upsert"] = points("('chunk ' || vec_id)") + " UNION " + points(
    "(CASE WHEN label < 5 THEN 'part ' ELSE 'chunk ' END || vec_id)"
)
ORACLES["sink_package_zip"] = f"""WITH RECURSIVE {PACKED} SELECT package_id,
  CAST(2 + count(DISTINCT name) AS INTEGER) AS files, CAST(NULL AS VARCHAR) AS error
FROM packed JOIN matched USING (doc_id) GROUP BY package_id"""
_OLD = "SELECT id, username, role, is_active, '2020-01-01' AS created_at, '2020-01-01' AS updated_at FROM users"
UPSERT = f"""{USERS}, o AS ({_OLD}), n AS (SELECT o_custkey * 2 AS id,
  arg_max('order ' || o_orderkey, o_orderkey) AS username,
  arg_max(CASE WHEN o_orderstatus = 'P' THEN 'admin' ELSE 'user' END, o_orderkey) AS role, true AS is_active,
  arg_max(strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) AS created_at,
  arg_max(strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) AS updated_at FROM orders GROUP BY 1)"""


def upserted(mode: str, picks: dict[str, str]) -> str:
    columns = ", ".join(f"{expr} AS {c}" for c, expr in picks.items())
    return f"SELECT '{mode}' AS mode, coalesce(o.id, n.id) AS id, {columns} FROM o FULL JOIN n ON o.id = n.id"


_FIELDS = ("username", "role", "is_active", "created_at", "updated_at")
_NEW = {c: f"CASE WHEN n.id IS NULL THEN o.{c} ELSE n.{c} END" for c in _FIELDS}
_KNOWN = {c: f"CASE WHEN o.id IS NOT NULL THEN o.{c} ELSE n.{c} END" for c in _FIELDS}
_STAMPED = "CASE WHEN n.id IS NULL THEN o.updated_at WHEN o.id IS NOT NULL THEN '2025-07-09' ELSE n.updated_at END"
ORACLES["sink_upsert"] = f"WITH {UPSERT} " + " UNION ALL ".join(
    [
        upserted("update", {**_NEW, "created_at": _KNOWN["created_at"], "updated_at": _STAMPED}),
        upserted("ignore", _KNOWN),
        upserted("replace", _NEW),
    ]
)
ORACLES["sink_replace_load"] = """SELECT c_custkey AS key, 'customer' AS table_name FROM customer
UNION ALL SELECT o_orderkey, 'orders' FROM orders"""

# Projections, filters, scalars

ORACLES["prj_element_names"] = (
    "SELECT p_partkey, replace(trim(' ' || p_name || ' ' || p_type || ' '), ' ', '_') AS element FROM part"
)
ORACLES["prj_reserved_suffix"] = f"""WITH f AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'Type'
  WHEN 'view' THEN 'complexType' WHEN 'error' THEN 'sequence' ELSE event_type END AS name FROM events)
SELECT event_id, CASE WHEN lower(name) IN ({_RESERVED}) THEN name || '_field' ELSE name END AS field FROM f"""
_split = [("doc_id", "doc_id"), ("lang", "lang"), ("source", "source"), ("n_chars", "n_chars")]
ORACLES["prj_split_columns"] = f"WITH {ATTACHED} " + " UNION ALL ".join(
    [f"SELECT '{c}' AS name, 'metadata' AS kind, false AS main, count({c}) AS filled FROM recs" for c, _ in _split]
    + [
        "SELECT 'attachment', 'attachment', true, count(a0) FROM recs",
        "SELECT 'Second Attachment', 'attachment', false, count(a1) FROM recs",
    ]
)
ORACLES["flt_valid_rows"] = """SELECT CAST(o_orderkey AS VARCHAR) AS a, o_orderstatus AS b, o_orderpriority AS c
FROM orders WHERE o_orderstatus = 'P'"""
ORACLES["scl_split_paths"] = """WITH c AS (SELECT o_orderkey, CASE
    WHEN o_orderstatus = 'F' THEN o_orderkey || '.pdf; ' || o_custkey || '|x.txt;;'
    WHEN o_orderstatus = 'O' THEN o_orderkey || '.pdf | ' || o_custkey || '.txt| '
    WHEN o_orderpriority = '5-LOW' THEN '' ELSE ' ' || o_orderkey END AS cell FROM orders),
p AS (SELECT o_orderkey, list_filter(list_transform(string_split(cell, CASE WHEN contains(cell, ';') THEN ';'
  ELSE '|' END), lambda x: trim(x)), lambda x: x <> '') AS parts FROM c)
SELECT o_orderkey, CAST(len(parts) AS INTEGER) AS paths, coalesce(array_to_string(parts, '>'), '') AS joined FROM p"""
ORACLES["scl_basename"] = "SELECT doc_id, 'doc_' || doc_id || '.txt' AS name FROM documents"
ORACLES["scl_mime"] = """SELECT event_id, CASE event_type WHEN 'click' THEN 'application/pdf'
  WHEN 'view' THEN 'image/jpeg' WHEN 'error' THEN 'text/plain' ELSE 'application/octet-stream' END AS mimetype
FROM events"""
ORACLES["scl_strip_think"] = rf"""SELECT doc_id, {trimmed("regexp_replace('<think>' || text || '</think>' || chr(10)"
    " || text || ' <think>a' || chr(10) || 'b</think>' || source || chr(10), '<think>.*?</think>', '', 'gs')")} AS text
FROM documents"""
ORACLES["scl_format_month"] = """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS stamp FROM orders"""
ORACLES["scl_parse_run_ts"] = """SELECT event_id, CASE event_type WHEN 'error' THEN NULL
  WHEN 'view' THEN epoch_us(ts) // 1000000 * 1000000 WHEN 'click' THEN epoch_us(ts) // 1000 * 1000
  ELSE epoch_us(ts) END AS micros FROM events"""


def mapped(position: int) -> str:
    cases = " ".join(
        f"WHEN '{k}' THEN {quoted(v[position]) if v[position] else 'NULL'}" for k, v in TYPE_NAMES.items()
    )
    return f"CASE type {cases} END"


ORACLES["scl_type_map"] = f"""WITH {LAX} SELECT table_name, ordinal, name, {mapped(0)} AS json_type,
  {mapped(1)} AS json_format, {mapped(2)} AS xsd_type, {mapped(3)} AS type_length FROM catalogue"""
ORACLES["scl_fill_null"] = f"""WITH {META} SELECT doc_id, document_type, creator,
  coalesce(sensitivity_labels, 'Unknown') AS sensitivity_labels,
  coalesce(retention_policies, 'Unknown') AS retention_policies
FROM meta WHERE document_type IS NOT NULL AND creator IS NOT NULL"""
ORACLES["prj_run_metrics_view"] = """SELECT event_id AS id, event_type AS "ProcessName",
  'run-' || event_id AS "InstanceId", strftime(ts, '%Y-%m-%d %H:%M:%S') AS execution_date,
  user_id AS records_processed, CASE WHEN event_type = 'error' THEN user_id ELSE 0 END AS records_failed FROM events"""
ORACLES["scl_ids"] = f"""SELECT doc_id, '{URN_START}' || lower(source) || '.1.0' AS urn,
  {number_of('source', 'CAST(doc_id AS VARCHAR)')} AS package_number,
  {uuid_of('source', 'CAST(doc_id AS VARCHAR)', 'text')} AS point_id FROM documents"""

# Joins

AGES = """ages AS (SELECT date_diff('day', o_orderdate, TIMESTAMP '2001-08-02 00:00:00') // 365 AS age_years,
  count(*) AS count FROM orders GROUP BY 1)"""
ORACLES["join_age_bins"] = f"""WITH {AGES} SELECT y AS age_years, y || '-' || (y + 1) AS age_bin,
  coalesce(count, 0) AS count FROM range(6) r(y) LEFT JOIN ages ON age_years = y"""
ORACLES["join_attachments"] = f"""WITH {ATTACHED} SELECT r.doc_id, r.slot, r.name, r.path, f.size, f.checksum,
  'text/plain' AS mimetype FROM refs r LEFT JOIN all_files f ON f.name = r.name AND f.lang <> 'es'"""
ORACLES["join_missing_attachments"] = f"""WITH {ATTACHED} SELECT DISTINCT name FROM refs
WHERE name NOT IN (SELECT name FROM all_files WHERE lang <> 'es')"""
ORACLES["join_export_route"] = """SELECT doc_id, source AS table_name,
  CASE WHEN source <> 'src0' THEN 'https://archive.example.org/export/' || source END AS destination,
  CASE WHEN source = 'src0' THEN 'unsupported table ' || source END AS error FROM documents"""
ORACLES["join_catalog_path"] = """WITH located AS (SELECT c_custkey, c_name, c_nationkey, n_name AS nation,
    n_regionkey, c_mktsegment, 'S' || right(c_name, 1) AS schema_name
  FROM customer JOIN nation ON n_nationkey = c_nationkey),
first_tenant AS (SELECT min(r_regionkey) AS t FROM region),
first_db AS (SELECT c_nationkey, min(c_mktsegment) AS seg FROM located GROUP BY 1),
open_apps AS (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = (SELECT t FROM first_tenant)),
cat AS (SELECT l.* FROM located l JOIN open_apps a ON a.n_nationkey = l.c_nationkey
  JOIN first_db d ON d.c_nationkey = l.c_nationkey AND d.seg = l.c_mktsegment),
paths AS (SELECT nation AS application, schema_name, c_name AS table_name,
  arg_min('/tables/' || c_custkey, c_custkey) AS href FROM cat GROUP BY 1, 2, 3),
asked AS (SELECT DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN 'NOWHERE' ELSE l.nation END AS application,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'S' ELSE l.schema_name END AS schema_name,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'none' ELSE l.c_name END AS table_name
  FROM orders JOIN located l ON l.c_custkey = o_custkey)
SELECT q.application, q.schema_name, q.table_name, p.href, CASE WHEN p.href IS NOT NULL THEN NULL
  WHEN (q.application, q.schema_name) IN (SELECT (nation, schema_name) FROM cat) THEN 'table'
  WHEN q.application IN (SELECT n_name FROM open_apps) THEN 'schema' ELSE 'application' END AS not_found
FROM asked q LEFT JOIN paths p USING (application, schema_name, table_name)"""

# Aggregations

ORACLES["agg_share_by_type"] = shares("events", "event_type")
ORACLES["agg_share_by_status"] = shares("orders", "o_orderstatus")
ORACLES["agg_share_by_sensitivity"] = f"WITH {META} " + shares("meta", "sensitivity_labels")
ORACLES["agg_share_by_retention"] = f"WITH {META} " + shares("meta", "retention_policies")
ORACLES["agg_classification"] = shares("documents", "source")
ORACLES["agg_age_histogram"] = f"WITH {AGES} SELECT age_years, count FROM ages"
ORACLES["agg_monthly_volume"] = """WITH m AS (SELECT date_trunc('month', o_orderdate) AS mo, count(*) AS new_docs
  FROM orders GROUP BY 1)
SELECT strftime(mo, '%Y-%m') AS month, new_docs, CAST(sum(new_docs) OVER (ORDER BY mo) AS BIGINT) AS cumulative_total
FROM m"""
ORACLES["agg_completeness"] = f"WITH {META} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(100.0 * CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*), 2)
  AS missing, round(100.0 - round(100.0 * CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*), 2), 2)
  AS complete FROM meta"""
    for c in ("document_type", "creator", "retention_policies", "sensitivity_labels")
)


def duplicated(source: str, columns: str, label: str) -> str:
    return f"""SELECT count(*) AS duplicate_files, CAST(sum(n) AS BIGINT) AS total_occurrences, '{label}' AS keys
FROM (SELECT count(*) AS n FROM {source} GROUP BY {columns} HAVING count(*) > 1)"""


ORACLES["agg_duplicates"] = f"WITH {META} " + " UNION ALL ".join(
    [
        duplicated("documents", "text", "text"),
        duplicated("meta", "folder_path, filename", "path"),
        duplicated("pages", "url", "url"),
    ]
)
_CATALOGUE = "SELECT table_name, ordinal, name, type, type_length, record_count"
ORACLES["agg_infer_relational"] = f"""SELECT *, 'lax' AS mode FROM (WITH {LAX} {_CATALOGUE} FROM catalogue)
UNION ALL SELECT *, 'strict' AS mode FROM (WITH {STRICT} {_CATALOGUE} FROM catalogue)"""
ORACLES["agg_infer_json"] = f"WITH {JSON_CATALOGUE} {_CATALOGUE} FROM catalogue"
ORACLES["agg_infer_xsd"] = f"WITH {XSD_CATALOGUE} {_CATALOGUE} FROM xsd_catalogue"
ORACLES["agg_record_counts"] = " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, count(*) AS record_count,
  CAST((count(*) + {CHUNK - 1}) // {CHUNK} AS BIGINT) AS chunk_count FROM {source}"""
    for table, (source, _, _) in EXPORT.items()
)
ORACLES["agg_delivery_totals"] = (
    f"WITH {ORDER_DOCS} SELECT {_TOTALS.format('rows_in_chunks', 'rows_delivered', 'rows_failed')} FROM docs"
)
ORACLES["agg_package_study"] = f"""WITH {MATCHED} SELECT (SELECT count(*) FROM recs) AS total_records,
  count(*) AS unique_attachments, CAST(coalesce(sum(size), 0) AS BIGINT) AS attachment_bytes
FROM (SELECT name, max(size) AS size FROM matched GROUP BY name)"""
ORACLES["agg_user_summary"] = f"""WITH {USERS} SELECT count(*) AS total_users,
  count(*) FILTER (WHERE role = 'admin') AS admin_users, count(*) FILTER (WHERE is_active) AS active_users,
  max(id) AS max_id FROM users"""
ORACLES["agg_aiu_count"] = f"""WITH RECURSIVE {PACKED} SELECT package_id, count(*) AS aiu_count, count(*) AS counted
FROM packed GROUP BY package_id"""

# Windows, packing, ordering, sets

ORACLES["win_chunk_assign"] = f"""SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position,
  (row_number() OVER (ORDER BY o_orderkey) - 1) // {CHUNK} AS chunk_id FROM orders"""
ORACLES["win_pack_greedy"] = (
    f"WITH RECURSIVE {DOCUMENT_PACKS} SELECT doc_id, position, size, package_id FROM packed"
)
ORACLES["srt_orderings"] = f"""WITH {META} SELECT folder_path, count(*) AS documents,
  arg_max(doc_id, (last_modified, doc_id)) AS newest FROM meta GROUP BY folder_path"""
ORACLES["set_distinct_attachments"] = f"""WITH RECURSIVE {PACKED} SELECT DISTINCT package_id, name, m.size
FROM packed JOIN matched m USING (doc_id)"""
ORACLES["set_table_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS record_count FROM {t}"
    for t in ("customer", "documents", "lineitem", "orders")
)

# Data quality

_RULES = {
    "role_known": "role NOT IN ('admin', 'user')",
    "username_length": "length(username) < 3",
    "email_format": "email NOT LIKE '%@%.%'",
    "username_given": "username IS NULL",
    "email_given": "email IS NULL",
}
ORACLES["dq_checks"] = f"WITH {USERS} " + " UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {broken}) AS violations FROM users"
    for name, broken in _RULES.items()
)
ORACLES["dq_unique"] = f"""WITH {USERS}
SELECT 'username' AS key, username AS value, count(*) AS occurrences FROM users WHERE username IS NOT NULL
GROUP BY username HAVING count(*) > 1
UNION ALL SELECT 'run', event_type || '/' || user_id, count(*) FROM events GROUP BY event_type, user_id
HAVING count(*) > 1"""
ORACLES["dq_self_fk"] = f"""WITH {USERS} SELECT created_by, count(*) AS rows FROM users
WHERE created_by IS NOT NULL AND created_by NOT IN (SELECT id FROM users) GROUP BY created_by"""
ORACLES["dq_xsd_rows"] = (
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus <> 'F' AS valid FROM orders"
)

# Schema documents

_ENTRY = """'{"name":' || to_json(name) || ',"type":"' || type || '","typeLength":"' || type_length || '"}'"""
ORACLES["doc_metadata_json"] = f"""WITH {LAX}, t AS (SELECT table_name,
  '{{"table_name":' || to_json(table_name) || ',"columns":[' || string_agg({_ENTRY}, ',' ORDER BY ordinal)
  || '],"record_count":' || max(record_count) || '}}' AS x FROM catalogue GROUP BY table_name)
SELECT '{{"schema_name":"SAP","default_schema":"SAP","locale":"en-US","application_name":"{APPLICATION}","tables":['
  || string_agg(x, ',' ORDER BY table_name) || ']}}' AS document FROM t"""
_COLUMN = " || ".join(
    [
        "'<column>'",
        el("name", "name"),
        el("ordinal", "CAST(ordinal AS VARCHAR)"),
        el("type", "type"),
        el("typeLength", "type_length"),
        "'<indexing>VALUE</indexing></column>'",
    ]
)
ORACLES["doc_metadata_xml"] = f"""WITH {LAX}, t AS (SELECT table_name, '<tableMetadata><name>' || table_name
  || '</name><recordCount>' || max(record_count) || '</recordCount><columnList>'
  || string_agg({_COLUMN}, '' ORDER BY ordinal) || '</columnList></tableMetadata>' AS x
  FROM catalogue GROUP BY table_name)
SELECT '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' || chr(10)
  || '<metadata><defaultSchema>SAP</defaultSchema><locale>en-US</locale><schemaMetadataList><schemaMetadata>'
  || '<name>SAP</name><tableCount>' || count(*) || '</tableCount><tableMetadataList>'
  || string_agg(x, '' ORDER BY table_name)
  || '</tableMetadataList></schemaMetadata></schemaMetadataList></metadata>' AS document FROM t"""
_PROPERTY = f"""to_json(name) || ':' || CASE WHEN name = 'attachment' THEN '{ATTACHMENTS_JSON}'
  WHEN type = 'number' THEN '{{"type":"number"}}'
  WHEN type IN ('date', 'date-time') THEN '{{"type":"string","format":"' || type || '"}}'
  ELSE '{{"type":"string"}}' END"""
ORACLES["doc_json_schema"] = f"""WITH {JSON_CATALOGUE} SELECT table_name,
  '{{"type":"object","title":"Records","$schema":"{DRAFT}","properties":{{"Record":{{"type":"object","properties":{{'
  || string_agg({_PROPERTY}, ',' ORDER BY ordinal) || '}},"xsd_sequence":['
  || string_agg(CAST(to_json(name) AS VARCHAR), ',' ORDER BY ordinal) || ']}}}},"xsd_sequence":["Record"]}}' AS document
FROM catalogue GROUP BY table_name"""

_HEAD = XSD_HEAD.format(urn=f"{URN_START}{HOLDING.lower()}.{SCHEMA_VERSION}", version="1.0", root="Records", child="Record")
# A column called attachment, as its JSON schema renders.
_NESTED = """\
              <xs:element name="attachment">
                <xs:complexType>
                  <xs:sequence>
                    <xs:element name="Attachment">
                      <xs:complexType>
                        <xs:sequence>
                          <xs:element name="mimetype" type="xs:string"/>
                          <xs:element name="Size" type="xs:decimal"/>
                          <xs:element name="EASFile" type="xs:string"/>
                          <xs:element name="checksum" minOccurs="0">
                            <xs:complexType>
                              <xs:simpleContent>
                                <xs:extension base="xs:string">
                                  <xs:attribute name="encoding" type="xs:string" use="required"/>
                                  <xs:attribute name="algorithm" type="xs:string" use="required"/>
                                </xs:extension>
                              </xs:simpleContent>
                            </xs:complexType>
                          </xs:element>
                          <xs:element name="FilePath" type="xs:string"/>
                        </xs:sequence>
                      </xs:complexType>
                    </xs:element>
                  </xs:sequence>
                </xs:complexType>
              </xs:element>
"""


def xsd_text(catalogue_name: str, type_expr: str, attachment: str, is_attachment: str) -> str:
    line = f"""CASE WHEN {is_attachment} THEN {quoted(attachment)} ELSE '{' ' * 14}<xs:element name="' || replace(name, ' ', '_')
  || '" type="' || {type_expr} || '"/>' || chr(10) END"""
    return f"""SELECT table_name, {quoted(_HEAD)} || string_agg({line}, '' ORDER BY ordinal) || {quoted(XSD_TAIL)} AS xsd
FROM {catalogue_name} GROUP BY table_name"""


_JSON_XSD = "CASE type WHEN 'number' THEN 'xs:decimal' WHEN 'date' THEN 'xs:date' WHEN 'date-time' THEN 'xs:dateTime' ELSE 'xs:string' END"
ORACLES["doc_xsd"] = f"""SELECT *, 'types' AS origin FROM (WITH {XSD_CATALOGUE}
  {xsd_text('xsd_catalogue', 'type', XSD_ATTACHMENTS, "type = 'attachment'")})
UNION ALL SELECT *, 'json' AS origin FROM (WITH {JSON_CATALOGUE}
  {xsd_text('catalogue', _JSON_XSD, _NESTED, "name = 'attachment'")})"""
ORACLES["doc_xsd_columns"] = f"""WITH {XSD_CATALOGUE} SELECT table_name, ordinal,
  CASE WHEN type = 'attachment' THEN 'Attachments' ELSE replace(name, ' ', '_') END AS name,
  CASE WHEN type = 'attachment' THEN 'object' ELSE type END AS xsd_type,
  CASE WHEN type = 'attachment' THEN 'object' WHEN type IN ('xs:long', 'xs:decimal') THEN 'number' ELSE 'string' END
    AS json_type,
  CASE type WHEN 'xs:dateTime' THEN 'date-time' WHEN 'xs:date' THEN 'date' END AS json_format FROM xsd_catalogue"""

# Packages

ORACLES["pkg_payload_xml"] = f"WITH RECURSIVE {PAYLOADS} SELECT package_id, payload FROM payloads"
_ID = number_of(f"'{HOLDING}'", "CAST(package_id AS VARCHAR)")
ORACLES["pkg_descriptor"] = f"""WITH RECURSIVE {PACKED}, n AS (SELECT package_id, count(*) AS aiu_count, {_ID} AS id
  FROM packed GROUP BY package_id)
SELECT package_id, id, aiu_count, '<sip xmlns="{DESCRIPTOR_SPACE}"><dss><holding>{HOLDING}</holding><id>'
  || id || '</id><pdi_schema>{URN_START}{HOLDING.lower()}.1.0</pdi_schema>'
  || '<production_date>{STAMP}</production_date><base_retention_date>{STAMP}</base_retention_date>'
  || '<producer>{APPLICATION}</producer><entity>{APPLICATION}</entity><priority>0</priority>'
  || '<application>{APPLICATION}</application></dss><production_date>{STAMP}</production_date><seqno>1</seqno>'
  || '<is_last>true</is_last><aiu_count>' || aiu_count || '</aiu_count><page_count>0</page_count></sip>' AS descriptor
FROM n"""
ORACLES["pkg_summary"] = f"""WITH RECURSIVE {DOCUMENT_PACKS} SELECT package_id, count(*) AS records,
  CAST(sum(size) AS BIGINT) AS bytes FROM packed GROUP BY package_id"""

# Text chunks


def words_of(expr: str) -> str:
    return rf"list_filter(string_split_regex({expr}, '\s+'), lambda w: w <> '')"


def runs(source: str, length: int) -> str:
    """Chunks of a query giving (doc_id, parts)."""
    return f"""SELECT doc_id, CAST(i AS INTEGER) AS chunk_no,
  array_to_string(parts[i * {length} + 1 : (i + 1) * {length}], ' ') AS text
FROM (SELECT doc_id, parts, unnest(range((len(parts) + {length - 1}) // {length})) AS i FROM ({source}))"""


def sentences_of(expr: str) -> str:
    marked = rf"regexp_replace({trimmed(expr)}, '([.!?])\s+([A-Z])', '\1' || chr(1) || '\2', 'g')"
    return f"string_split({marked}, chr(1))"


STRUCTURED = """structured AS (SELECT doc_id,
  '# ' || lang || chr(10) || 'PART TWO: ' || replace(text, chr(10), chr(10) || chr(10) || '1. ') AS text
  FROM documents)"""
_HEADING = r"(?:^|\n)(?:#+\s|[A-Z][A-Z\s]+:|\d+\.\s)"


def pieces(split: str) -> str:
    return f"list_filter(list_transform({split}, lambda p: {trimmed('p')}), lambda p: p <> '')"


def headings_of(expr: str) -> str:
    return pieces(f"string_split(regexp_replace({expr}, '{_HEADING}', chr(1), 'g'), chr(1))")


def numbered_pieces(source: str, parts: str) -> str:
    return f"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_no, parts[i] AS text
FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, {parts} AS parts FROM {source}))"""


ORACLES["chunk_fixed"] = runs(f"SELECT doc_id, {words_of('text')} AS parts FROM documents", 500)
ORACLES["chunk_sentence"] = runs(f"SELECT doc_id, {sentences_of('text')} AS parts FROM documents", 5)
ORACLES["chunk_heading"] = f"WITH {STRUCTURED} " + numbered_pieces("structured", headings_of("text"))
ORACLES["chunk_paragraph"] = f"WITH {STRUCTURED} " + numbered_pieces(
    "structured", pieces("string_split(text, chr(10) || chr(10))")
)
ORACLES["chunk_hybrid"] = f"""WITH {STRUCTURED}, both_forms AS (SELECT doc_id, text FROM structured UNION ALL
  SELECT -doc_id - 1, '# ' || replace(text, chr(10), ' ') FROM documents),
cut AS (SELECT doc_id, i, parts[i] AS piece, {words_of('parts[i]')} AS w FROM (SELECT doc_id, parts,
  unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, {headings_of('text')} AS parts FROM both_forms))),
small AS (SELECT doc_id, i, 0 AS j, piece AS text FROM cut WHERE len(w) <= 500 UNION ALL
  SELECT doc_id, i, j, array_to_string(w[j * 500 + 1 : (j + 1) * 500], ' ')
  FROM (SELECT *, unnest(range((len(w) + 499) // 500)) AS j FROM cut WHERE len(w) > 500))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i, j) - 1 AS INTEGER) AS chunk_no, text FROM small"""

# Vectors

ORACLES["vec_embed"] = f"""WITH chunks AS ({ORACLES["chunk_fixed"]}),
words AS (SELECT doc_id, chunk_no, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS word FROM chunks),
counts AS (SELECT doc_id, chunk_no, CAST('0x' || md5(word)[1:8] AS BIGINT) % 256 AS d, count(*) AS n FROM words GROUP BY ALL),
seen AS (SELECT d, ln(((SELECT count(*) FROM chunks) + 1) / (count(*) + 1)) AS idf FROM counts GROUP BY d),
weighed AS (SELECT doc_id, chunk_no, d, n * idf AS w FROM counts JOIN seen USING (d)),
every AS (SELECT doc_id, chunk_no, d, coalesce(w, 0.0) AS w FROM (SELECT doc_id, chunk_no, unnest(range(256)) AS d FROM chunks)
  LEFT JOIN weighed USING (doc_id, chunk_no, d)),
units AS (SELECT doc_id, chunk_no, list(w ORDER BY d) AS v, sqrt(sum(w * w ORDER BY d)) AS length FROM every GROUP BY doc_id, chunk_no)
SELECT doc_id, chunk_no, array_to_string(list_transform(v,
  lambda x: CAST(round(round(CASE WHEN length > 0 THEN x / length ELSE 0.0 END, 6) * 1000000) AS BIGINT)), ',') AS vector FROM units"""
ORACLES["vec_points"] = points("('chunk ' || vec_id)")
ORACLES["vec_quantize_int8"] = """WITH r AS (SELECT min(x) AS low, max(x) AS high FROM
  (SELECT CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)),
c AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, low, (high - low) / 255 AS step FROM embeddings, r),
q AS (SELECT *, list_transform(v, lambda x: CAST(floor((x - low) / step + 0.5) - 128 AS INTEGER)) AS code FROM c)
SELECT vec_id, array_to_string(code, ',') AS codes, round(list_max(list_transform(v,
  lambda x, i: abs(x - ((CAST(code[i] AS DOUBLE) + 128) * step + low)))), 9) AS max_error FROM q"""
ORACLES["vec_cosine_topk"] = """WITH x AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS pos, embedding
  FROM embeddings),
m AS (SELECT label, pos, avg(CAST(embedding[pos] AS DOUBLE)) AS m FROM x GROUP BY 1, 2),
centres AS (SELECT label, list(m ORDER BY pos) AS v FROM m GROUP BY label),
s AS (SELECT c.label AS query_id, vec_id AS id,
  round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c.v), 6) AS similarity FROM embeddings, centres c)
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, similarity FROM (SELECT *,
  row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM s) WHERE rank <= 10"""

# Enrichment and models

IDF = f"""tc AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents)
  GROUP BY ALL),
total AS (SELECT count(DISTINCT doc_id) AS docs FROM tc),
idf AS (SELECT term, ln(CAST((SELECT docs FROM total) AS DOUBLE) / count(*)) AS idf FROM tc GROUP BY term)"""
KEYWORDS = IDF + """, ranked AS (SELECT doc_id, term, score, row_number() OVER (PARTITION BY doc_id
  ORDER BY score DESC, term) AS rank FROM (SELECT doc_id, term, round(n * idf, 6) AS score FROM tc JOIN idf USING (term))),
keywords AS (SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, score FROM ranked WHERE rank <= 10)"""
ORACLES["enr_keywords"] = f"WITH {KEYWORDS} SELECT doc_id, rank, term, score FROM keywords"
_SENTENCE_TERMS = rf"regexp_extract_all(lower(sentence), '{enrichment.TERM}')"
ORACLES["enr_summary"] = f"""WITH {IDF},
parts AS (SELECT doc_id, {sentences_of('text')} AS s FROM documents),
each AS (SELECT doc_id, i AS pos, s[i] AS sentence FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM parts)),
used AS (SELECT doc_id, pos, unnest({_SENTENCE_TERMS}) AS term FROM each),
scored AS (SELECT doc_id, pos, round(sum(n * idf), 6) AS score FROM
  (SELECT doc_id, pos, term, count(*) AS n FROM used GROUP BY ALL) JOIN idf USING (term) GROUP BY doc_id, pos),
best AS (SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS r
  FROM scored) WHERE r <= 5)
SELECT doc_id, string_agg(sentence, ' ' ORDER BY pos) AS summary FROM best JOIN each USING (doc_id, pos) GROUP BY doc_id"""
_DAY = r"\d{4}-\d\d-\d\d|\d{1,2}/\d{1,2}/\d{4}"
_CAPITALISED = r"\p{Lu}\p{Ll}+( \p{Lu}\p{Ll}+)+"
_WORD_OR_SIGN = r"[\pL0-9_]+|[^\pL0-9_ \t\n\v\f\r]"
_ORGANISATION = (
    " (Agency|Association|Bank|Company|Corp|Corporation|Desk|Foundation|Group|Inc|Institute|Limited|Ltd|Ministry|Office|University)$"
)
ORACLES["enr_entities"] = f"""WITH notes AS (SELECT -doc_id - 1 AS doc_id, text FROM documents UNION ALL
  SELECT o_orderkey, 'Order of ' || c_name || ' from ' || n_name || ' in ' || r_name || ', placed '
    || strftime(o_orderdate, '%Y-%m-%d') || ' by Export Desk.'
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey),
found AS (SELECT doc_id, 'date' AS kind, unnest(regexp_extract_all(text, '{_DAY}')) AS value FROM notes
  UNION ALL SELECT doc_id, CASE WHEN regexp_matches(value, '{_ORGANISATION}') THEN 'organisation' ELSE 'person' END, value
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_CAPITALISED}')) AS value FROM notes)
  UNION ALL SELECT doc_id, 'place', listed.name FROM (SELECT doc_id, unnest(list_transform(range(1, len(t) + 1), lambda i: t[i:i + 5])) AS run
    FROM (SELECT doc_id, regexp_extract_all(text, '{_WORD_OR_SIGN}') AS t FROM notes))
  JOIN (SELECT name, regexp_extract_all(name, '{_WORD_OR_SIGN}') AS t FROM (SELECT n_name AS name FROM nation UNION
    SELECT r_name FROM region UNION SELECT n_name || ' in ' || r_name FROM nation JOIN region ON n_regionkey = r_regionkey)) listed
  ON run[1] = listed.t[1] AND run[1:len(listed.t)] = listed.t)
SELECT doc_id, kind, value, count(*) AS occurrences FROM found GROUP BY doc_id, kind, value"""
_PERSONAL = {
    "email": r"[0-9a-zA-Z.%_+-]+@[0-9a-zA-Z-]+(\.[0-9a-zA-Z-]+)*\.[a-zA-Z][a-zA-Z]+",
    "phone": r"\+\d{1,3}[ .-]?(\(\d{1,4}\)|\d{1,4})([ .-]?\d{2,4}){2,5}\b|\(\d{3}\) ?\d{3}[ .-]\d{4}\b|\b\d{3}[ .-]\d{3}[ .-]\d{4}\b",
    "ipv4": r"\b(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}\b",
    "card": r"\b(\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4})\b",
    "national_id": r"\b\d{3}-\d\d-\d{4}\b",
    "iban": r"\b[A-Z]{2}\d\d([0-9A-Z]{11,30}|( [0-9A-Z]{4}){3,7}( [0-9A-Z]{1,3})?)\b",
}
_DIGITS = "string_split(reverse(regexp_replace(value, '[^0-9]', '', 'g')), '')"
_LUHN = f"""list_sum(list_transform({_DIGITS}, lambda d, i: CASE WHEN i % 2 = 1 THEN CAST(d AS INTEGER)
  WHEN CAST(d AS INTEGER) > 4 THEN CAST(d AS INTEGER) * 2 - 9 ELSE CAST(d AS INTEGER) * 2 END)) % 10 = 0"""
ORACLES["enr_pii"] = "WITH found AS (" + " UNION ALL ".join(
    f"SELECT doc_id, '{kind}' AS kind, unnest(regexp_extract_all(text, '{pattern}')) AS value FROM documents"
    for kind, pattern in _PERSONAL.items()
) + f""") SELECT doc_id, kind, value, count(*) AS occurrences FROM found
WHERE CASE WHEN kind = 'card' THEN {_LUHN} ELSE true END GROUP BY doc_id, kind, value"""
ORACLES["enr_intent"] = f"WITH {INTENTS} SELECT doc_id, intent, score FROM intents"
ORACLES["enr_synonyms"] = f"""WITH {KEYWORDS},
toks AS (SELECT {_TERMS} AS t FROM documents),
used AS (SELECT place, term, count(*) AS n FROM (SELECT t[i - 1] || ' ' || t[i + 1] AS place, t[i] AS term
  FROM (SELECT t, unnest(range(2, len(t))) AS i FROM toks)) GROUP BY ALL),
usual AS (SELECT place, term AS alternate, n AS m FROM used),
met AS (SELECT term, alternate, CAST(sum(least(n, m)) AS BIGINT) AS score FROM used JOIN usual USING (place)
  WHERE term <> alternate GROUP BY term, alternate),
best AS (SELECT term, alternate, score, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
  (PARTITION BY term ORDER BY score DESC, alternate) AS r FROM met) WHERE r <= 5)
SELECT k.doc_id, k.term, b.rank, b.alternate, b.score FROM keywords k JOIN best b USING (term)"""
_RARE = ("version", "document_status", "retention_policies", "sensitivity_labels")
_FILLED = ", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in _RARE)
_RARITY = " + ".join(f"(-ln(count(*) OVER (PARTITION BY {c}) / CAST(count(*) OVER () AS DOUBLE)))" for c in _RARE)
ORACLES["ml_rarity_outliers"] = f"""WITH {META}, filled AS (SELECT doc_id, filename, creator, {_FILLED} FROM meta),
scored AS (SELECT doc_id, filename, creator, round({_RARITY}, 6) AS score FROM filled)
SELECT doc_id, filename, creator, score FROM scored WHERE score > (SELECT quantile_cont(score, 0.95) FROM scored)"""
_FOREST_TREES, _FOREST_SAMPLE, _FOREST_LIMIT = 100, 256, 8
_MEAN_PATH = """CASE WHEN {0} <= 1 THEN 0.0 WHEN {0} = 2 THEN 1.0
  ELSE 2.0 * (ln({0} - 1.0) + 0.5772156649015329) - 2.0 * ({0} - 1.0) / {0} END"""


def _forest() -> str:
    """The trees level by level: rows keep their node's path until it is a leaf."""
    shown = " UNION ALL ".join(f"SELECT tree, node, {i} AS f, {c} AS value FROM open" for i, c in enumerate(_RARE))
    match = "CASE pick.f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(_RARE)) + " END = pick.value"
    columns = ", ".join(f"l.{c}" for c in _RARE)
    levels = []
    for k in range(_FOREST_LIMIT):
        source = f"level{k}"
        levels.append(f"""level{k + 1} AS (
  WITH size AS (SELECT tree, node, CAST(sum(w) AS BIGINT) AS size FROM {source} WHERE leaf IS NULL GROUP BY tree, node),
  open AS (SELECT * FROM {source} WHERE leaf IS NULL AND w > 0),
  shown AS (SELECT DISTINCT tree, node, f, value FROM ({shown})),
  cuts AS (SELECT *, md5('42|' || tree || '|' || node || '|' || f || '|' || value) AS digest FROM shown
    WHERE (tree, node, f) IN (SELECT (tree, node, f) FROM shown GROUP BY tree, node, f HAVING count(*) > 1)),
  pick AS (SELECT tree, node, arg_min(f, digest) AS f, arg_min(value, digest) AS value FROM cuts
    WHERE (tree, node) IN (SELECT (tree, node) FROM size WHERE size > 1) GROUP BY tree, node)
  SELECT l.tree, {columns}, l.n, l.w,
    CASE WHEN l.leaf IS NULL AND pick.f IS NOT NULL THEN l.node || CASE WHEN {match} THEN '1' ELSE '0' END ELSE l.node END AS node,
    CASE WHEN l.leaf IS NOT NULL THEN l.leaf WHEN pick.f IS NULL THEN {k} + {_MEAN_PATH.format("size.size")} END AS leaf
  FROM {source} l LEFT JOIN size USING (tree, node) LEFT JOIN pick USING (tree, node))""")
    return ",\n".join(levels)


ORACLES["ml_outliers"] = f"""WITH {META}, filled AS (SELECT doc_id, filename, creator, {_FILLED} FROM meta),
combos AS (SELECT {", ".join(_RARE)}, count(*) AS n FROM filled GROUP BY ALL),
whole AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM combos),
shares AS (SELECT combos.*, tree, n * least({_FOREST_SAMPLE}, total) / total AS share,
    CAST('0x' || md5('42|' || tree || '|' || {" || '|' || ".join(_RARE)})[1:8] AS BIGINT) / 4294967296.0 AS chance
  FROM combos, whole, (SELECT unnest(range({_FOREST_TREES})) AS tree)),
level0 AS (SELECT tree, {", ".join(_RARE)}, n,
    CAST(floor(share) AS BIGINT) + CASE WHEN chance < share - floor(share) THEN 1 ELSE 0 END AS w,
    '' AS node, CAST(NULL AS DOUBLE) AS leaf FROM shares),
{_forest()},
ends AS (SELECT l.*, coalesce(leaf, {_FOREST_LIMIT} + {_MEAN_PATH.format("size")}) AS depth FROM level{_FOREST_LIMIT} l
  LEFT JOIN (SELECT tree, node, CAST(sum(w) AS BIGINT) AS size FROM level{_FOREST_LIMIT} WHERE leaf IS NULL GROUP BY tree, node) USING (tree, node)),
usual AS (SELECT {_MEAN_PATH.format("drawn")} AS usual FROM (SELECT least({_FOREST_SAMPLE}, total) AS drawn FROM whole)),
scored AS (SELECT {", ".join(_RARE)}, round(pow(2.0, -(sum(depth) / {_FOREST_TREES}) / (SELECT usual FROM usual)), 6) AS score
  FROM ends GROUP BY ALL),
every AS (SELECT doc_id, filename, creator, score FROM filled JOIN scored USING ({", ".join(_RARE)}))
SELECT doc_id, filename, creator, score FROM every WHERE score > (SELECT quantile_cont(score, 0.95) FROM every)"""
ORACLES["ml_knn_label"] = f"""WITH {META},
lab AS (SELECT doc_id, sensitivity_labels AS v, modifier AS m FROM meta
  WHERE sensitivity_labels IS NOT NULL AND modifier IS NOT NULL),
cand AS (SELECT doc_id, modifier AS m FROM meta WHERE sensitivity_labels IS NULL AND modifier IS NOT NULL),
near AS (SELECT c.m, lab.v, row_number() OVER (PARTITION BY c.m
  ORDER BY CASE WHEN lab.m = c.m THEN 0 ELSE 1 END, lab.doc_id) AS r FROM (SELECT DISTINCT m FROM cand) c, lab),
votes AS (SELECT m, v, count(*) AS c FROM near WHERE r <= 3 GROUP BY m, v),
pick AS (SELECT m, v FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY c DESC, v) AS r FROM votes) WHERE r = 1)
SELECT cand.doc_id, pick.v AS suggestion FROM cand JOIN pick USING (m)"""

# Streaming

ORACLES["stream_intake"] = "SELECT " + ", ".join(
    f"{expr} AS {name}" for name, expr in ORDER_COLUMNS if name not in ("o_orderdate", "order priority")
) + " FROM orders"
ORACLES["stream_chunk_export"] = """SELECT count(*) AS rows_in_chunks, count(*) AS rows_delivered,
  CAST(0 AS BIGINT) AS rows_failed, CAST(0 AS BIGINT) AS repeated_entries FROM orders"""
