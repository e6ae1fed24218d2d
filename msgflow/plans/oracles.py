"""SQL for another engine (DuckDB) that gives the results of the registered queries.

The messages' defects follow from their ids, so most statements compute the expected rows from the
base tables without parsing any JSON.
"""

from __future__ import annotations

from .catalog import BODY_BYTES, GROUP_IDLE, GROUP_MESSAGES, IMAGES_PER_REQUEST, PROMPT, REFUSED, SAMPLE_MESSAGES, SYSTEM
from .corpus import EDGE_VALUE, TIMESTAMP_TEXT, USER_KEY, USER_VALUE

GROUP_HOURS = int(GROUP_IDLE.removesuffix(" hours"))
AT = "CAST(event_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset"
ORIGIN = f"""coalesce({USER_KEY}, 'no_key') AS message_key, ts AS kafka_timestamp, event_type AS kafka_topic,
 {AT}"""
NARROW = f"{USER_KEY} AS message_key, ts AS kafka_timestamp"
C = "event_id % 20"

_LENIENT = f"""
SELECT {AT},
 CAST(CASE WHEN {C} IN (3, 4, 5) THEN -1 ELSE event_id END AS INTEGER) AS id,
 CASE WHEN {C} IN (3, 9) THEN 'Unknown' WHEN {C} = 5 THEN 'big' ELSE event_type END AS name,
 CAST(CASE WHEN {C} IN (3, 6, 9) THEN -1 WHEN {C} = 4 THEN 7 WHEN {C} = 5 THEN 1 ELSE user_id END AS INTEGER) AS age
FROM events WHERE {C} NOT IN (0, 1, 2, 7, 8, 12)"""

# Fields of a user record under the int schema, as far as they fit.
_USER_ID = f"CAST(CASE WHEN {C} IN (0, 1, 3, 4, 5, 7, 8, 12) THEN NULL ELSE event_id END AS INTEGER)"
_USER_NAME = f"""CASE WHEN {C} IN (0, 1, 3, 7, 8, 12) THEN NULL WHEN {C} = 5 THEN 'big' WHEN {C} = 9 THEN '7'
 ELSE event_type END"""
_USER_AGE = f"""CAST(CASE WHEN {C} IN (0, 1, 2, 3, 6, 7, 8, 9, 12) THEN NULL WHEN {C} = 4 THEN 7 WHEN {C} = 5 THEN 1
 ELSE user_id END AS INTEGER)"""
_BAD = f"{C} IN (0, 1, 4, 5, 6, 7, 8, 9)"
_GOOD = f"SELECT {NARROW}, {_USER_ID} AS id, {_USER_NAME} AS name, {_USER_AGE} AS age FROM events WHERE NOT ({_BAD})"
_BAD_ROWS = f"""
SELECT {NARROW}, {USER_VALUE} AS json_string, {_USER_ID} AS id, {_USER_NAME} AS name, {_USER_AGE} AS age,
 {USER_VALUE} AS corrupt_record
FROM events WHERE {_BAD}"""

# The same fields as text, as a widened schema holds them.
_TEXT_ID = f"""CASE WHEN {C} IN (0, 1, 3, 7, 8, 12) THEN NULL WHEN {C} = 5 THEN '99999999999'
 ELSE CAST(event_id AS VARCHAR) END"""
_TEXT_AGE = f"""CASE WHEN {C} IN (0, 1, 2, 3, 7, 8, 12) THEN NULL WHEN {C} = 4 THEN '7' WHEN {C} = 5 THEN '1'
 WHEN {C} = 6 THEN '2.5' WHEN {C} = 9 THEN 'true' ELSE CAST(user_id AS VARCHAR) END"""
_SPECS_V = f"CASE WHEN {C} = 11 THEN value END"
_SPECS_TEXT = f"CASE WHEN {C} = 11 THEN '2024-03-22T14:35:00Z' END"
_SPECS_TIME = f"CASE WHEN {C} = 11 THEN TIMESTAMP '2024-03-22 14:35:00' END"

_SAMPLED_ID = _TEXT_ID
_SAMPLED_AGE = f"""CAST(CASE WHEN {C} IN (0, 1, 2, 3, 6, 7, 8, 9, 12) THEN NULL WHEN {C} = 4 THEN 7
 WHEN {C} = 5 THEN 1 ELSE user_id END AS BIGINT)"""


def _with_elements(columns: str) -> str:
    """The rows of all messages but arrays, then the two elements of each array message."""
    return f"""
SELECT {columns}, {_TEXT_ID} AS id, {_USER_NAME} AS name, {_TEXT_AGE} AS age FROM events WHERE {C} <> 8
UNION ALL
SELECT {columns}, CAST(event_id AS VARCHAR), 'a', '1' FROM events WHERE {C} = 8
UNION ALL
SELECT {columns}, '0', 'b', '2' FROM events WHERE {C} = 8"""


_INFERRED = _with_elements(
    f"{ORIGIN}, {_SPECS_V} AS specs_v, {_SPECS_TEXT} AS specs_at, "
    f"CASE WHEN {C} IN (0, 7) THEN {USER_VALUE} END AS _corrupt_record"
)
_OBJECTS = f"{C} NOT IN (0, 1, 7, 8)"
_RECURSIVE = f"""{_TEXT_ID} AS id, {_USER_NAME} AS name, {_TEXT_AGE} AS age, {_SPECS_V} AS specs_v, {_SPECS_TIME} AS specs_at
FROM events WHERE {_OBJECTS}"""

_STRICT = f"""
SELECT {AT},
 CAST(CASE event_id % 16 WHEN 1 THEN 1215752191 WHEN 2 THEN 2 WHEN 4 THEN 7 WHEN 5 THEN 2 WHEN 6 THEN 0 WHEN 7 THEN 1
  WHEN 8 THEN 0 WHEN 9 THEN 0 WHEN 10 THEN 0 WHEN 11 THEN 1900168395 WHEN 12 THEN 2147483647 WHEN 13 THEN -2147483648
  WHEN 14 THEN 0 WHEN 15 THEN 0 ELSE event_id END AS INTEGER) AS id,
 CASE event_id % 16 WHEN 1 THEN CAST(event_id AS VARCHAR) WHEN 2 THEN '1.1' WHEN 3 THEN '2.0' WHEN 4 THEN '1.0E20'
  WHEN 5 THEN 'false' WHEN 6 THEN 'null' WHEN 7 THEN '' WHEN 8 THEN '' WHEN 9 THEN '12345678901234567890123'
  ELSE event_type END AS name,
 CAST(user_id AS INTEGER) AS age
FROM events"""

_PRODUCT_FIELDS = """CAST(CASE WHEN p_partkey % 10 IN (0, 3) THEN NULL ELSE p_partkey END AS INTEGER) AS id,
 CASE WHEN p_partkey % 10 IN (0, 4) THEN NULL ELSE p_name END AS product,
 CASE WHEN p_partkey % 10 IN (0, 1) THEN NULL WHEN p_partkey % 10 = 3 THEN 1.0 ELSE p_retailprice END AS price,
 CASE WHEN p_partkey % 10 IN (0, 2) THEN NULL WHEN p_partkey % 10 IN (1, 4) THEN TRUE WHEN p_partkey % 10 = 3 THEN FALSE
  ELSE p_size > 25 END AS in_stock"""

_TOPIC_PARTITIONS = """
SELECT event_type AS topic, CAST(event_id % 4 AS INTEGER) AS partition, min(event_id) AS first_offset,
 max(event_id) + 1 AS end_offset, count(*) AS messages
FROM events GROUP BY event_type, event_id % 4"""

_NUMBERED = f"""
SELECT source, doc_id, base64(encode(text)) AS content,
 (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // {IMAGES_PER_REQUEST} AS request_no
FROM documents"""

_PROMPT_JSON = PROMPT.replace('"', '\\"')
_BODIES = f"""
SELECT source, request_no, min_by(content, doc_id) AS first_image,
 '{{"domainName":"Text","modelName":"describer","modelPayload":{{"messages":[{{"role":"system","content":"{SYSTEM}"}},'
 || '{{"role":"user","content":[' || string_agg('{{"image":"' || content || '"}}', ',' ORDER BY doc_id)
 || ',{{"type":"text","text":"{_PROMPT_JSON}"}}]}}],"temperature":0.5,"top_p":0.95,"max_tokens":3000}}}}' AS body
FROM ({_NUMBERED}) GROUP BY source, request_no"""

_ITEMS = """
SELECT 'txn' || l_orderkey || '-' || l_linenumber AS transaction_id, 'STR' || l_suppkey AS store_id,
 date_trunc('day', l_shipdate) + INTERVAL 875 MINUTE AS timestamp, l_returnflag AS payment_method,
 CAST(l_partkey AS VARCHAR) AS item_id, 'line' AS name, l_extendedprice AS price, CAST(l_quantity AS BIGINT) AS quantity
FROM lineitem
UNION ALL
SELECT 'txn' || l_orderkey || '-' || l_linenumber, 'STR' || l_suppkey, date_trunc('day', l_shipdate) + INTERVAL 875 MINUTE,
 l_returnflag, 'delivery', l_linestatus, l_tax, 1
FROM lineitem"""

# A body is its frame and, for each item, the item's JSON and a comma.
_FRAME = f"""'{{"domainName":"Text","modelName":"describer","modelPayload":{{"messages":[{{"role":"system","content":"{SYSTEM}"}},'
 || '{{"role":"user","content":[' || ITEMS || '{{"type":"text","text":"{_PROMPT_JSON}"}}]}}],"temperature":0.5,"top_p":0.95,"max_tokens":3000}}}}'"""
_BOUNDED = f"""
WITH RECURSIVE sized AS MATERIALIZED (
 SELECT owner, doc_id, '{{"image":"' || content || '"}},' AS item, octet_length(encode('{{"image":"' || content || '"}},')) AS b,
  row_number() OVER (PARTITION BY owner ORDER BY doc_id) AS rn
 FROM (SELECT CASE WHEN doc_id % 10 > 0 THEN 'hot' ELSE source END AS owner, doc_id, base64(encode(text)) AS content FROM documents)),
room AS (SELECT {BODY_BYTES} - octet_length(encode({_FRAME.replace("ITEMS", "''")})) AS room),
walk AS (
 SELECT owner, rn, CAST(0 AS BIGINT) AS request_no, 1 AS n, CAST(b AS BIGINT) AS total FROM sized WHERE rn = 1
 UNION ALL
 SELECT s.owner, s.rn, CASE WHEN n < 7 AND total + b <= room THEN request_no ELSE request_no + 1 END,
  CASE WHEN n < 7 AND total + b <= room THEN n + 1 ELSE 1 END, CASE WHEN n < 7 AND total + b <= room THEN total + b ELSE b END
 FROM walk AS w JOIN sized AS s ON s.owner = w.owner AND s.rn = w.rn + 1 CROSS JOIN room),
bodies AS (
 SELECT owner, request_no, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rn) AS item_ids, CAST(sum(b) AS BIGINT) AS items_bytes,
  string_agg(item, '' ORDER BY rn) AS all_items
 FROM walk JOIN sized USING (owner, rn) GROUP BY owner, request_no)
SELECT owner, request_no, item_ids, items_bytes, octet_length(encode(body)) AS body_bytes, md5(body) AS body_md5
FROM (SELECT *, {_FRAME.replace("ITEMS", "all_items")} AS body FROM bodies)"""

_OFFSETS = """
SELECT event_id % 4 AS partition, event_id // 4 AS pos,
 CASE WHEN event_id // 4 % 100 = 12 THEN 3 WHEN event_id // 4 % 100 BETWEEN 10 AND 13 THEN 2 ELSE 1 END AS copies
FROM events WHERE NOT (event_id // 4 % 100 BETWEEN 40 AND 49)"""
_ACCOUNT = f"""
WITH places AS (SELECT * FROM ({_OFFSETS})),
every AS (SELECT partition, unnest(range(min(pos), max(pos) + 1)) AS pos FROM places GROUP BY partition),
copied AS (SELECT partition, pos, coalesce(copies, 0) AS copies FROM every LEFT JOIN places USING (partition, pos)),
stretches AS (SELECT *, pos - row_number() OVER (PARTITION BY partition, copies ORDER BY pos) AS stretch FROM copied)
SELECT 'events' AS topic, CAST(partition AS INTEGER) AS partition, min(pos) AS first_offset, max(pos) AS last_offset, CAST(copies AS BIGINT) AS copies
FROM stretches GROUP BY partition, copies, stretch"""

_GROUPS = f"""
WITH messages AS (SELECT event_type AS topic, event_id % 4 AS part, event_id, epoch_us(ts) AS pos FROM events),
paused AS (SELECT *, pos - lag(pos) OVER p > {GROUP_HOURS * 3_600_000_000} AS pause FROM messages WINDOW p AS (PARTITION BY topic, part ORDER BY event_id)),
runs AS (SELECT *, count(*) FILTER (WHERE pause) OVER (PARTITION BY topic, part ORDER BY event_id) AS run FROM paused),
numbered AS (SELECT *, (row_number() OVER (PARTITION BY topic, part, run ORDER BY event_id) - 1) // {GROUP_MESSAGES} AS piece FROM runs),
groups AS (
 SELECT topic, part, run, piece, min(event_id) AS first_offset, max(event_id) AS last_offset, count(*) AS messages, max(pos) AS last_at
 FROM numbered GROUP BY ALL),
placed AS (
 SELECT *, row_number() OVER p - 1 AS group_no, lead(run) OVER p IS NOT NULL AS followed
 FROM groups WINDOW p AS (PARTITION BY topic, part ORDER BY run, piece))
SELECT topic AS kafka_topic, CAST(part AS INTEGER) AS kafka_partition, group_no, first_offset, last_offset, messages,
 CASE WHEN messages = {GROUP_MESSAGES} THEN 'count' ELSE 'idle' END AS closed_by
FROM placed
WHERE messages = {GROUP_MESSAGES} OR followed
 OR (last_at + {GROUP_HOURS * 3_600_000_000}) // 1000 < (SELECT max(pos) // 1000 - 1000 FROM messages)"""

ORACLES = {
    "prj1_envelope_wide": f"SELECT {ORIGIN}, {USER_VALUE} AS json_string FROM events",
    "prj2_envelope_narrow": f"SELECT {NARROW}, {USER_VALUE} AS json_string FROM events",
    "snk10_produce_messages": "SELECT CAST(c_custkey AS VARCHAR) AS key, * FROM customer",
    "str1_utf8_check": """
SELECT event_id, CASE WHEN event_id % 10 <> 3 THEN event_type END AS text, event_id % 10 <> 3 AS valid FROM events""",
    "prs1_strict_coerce": _STRICT,
    "prs2_lenient_validate": _LENIENT,
    "prs3_fixed_permissive": f"SELECT {AT}, {_USER_ID} AS id, {_USER_NAME} AS name, {_USER_AGE} AS age FROM events",
    "prs3_fixed_products": f"SELECT CAST(p_partkey AS VARCHAR) AS message_key, {_PRODUCT_FIELDS} FROM part",
    "prs4_split_good": _GOOD,
    "prs4_split_bad": _BAD_ROWS,
    "prs4_fallback_events": f"""
SELECT {NARROW}, CAST(event_id AS VARCHAR) AS id,
 CASE WHEN event_id % 5 = 0 THEN CAST(user_id AS VARCHAR) ELSE '2024-03-22' END AS timestamp,
 CASE WHEN event_id % 5 <> 0 THEN event_type END AS payload
FROM events WHERE event_id % 5 NOT IN (1, 2)""",
    "agg1_split_counts": f"""
SELECT count(*) AS seen, count(*) FILTER (WHERE NOT ({_BAD})) AS good, count(*) FILTER (WHERE {_BAD}) AS bad
FROM events""",
    "prs5_sample_inferred": f"""
SELECT {AT}, {_SAMPLED_ID} AS id, {_USER_NAME} AS name, {_SAMPLED_AGE} AS age FROM events""",
    "inf6_sample_fallback": "SELECT doc_id AS kafka_offset, CAST(NULL AS VARCHAR) AS data FROM documents",
    "prs6_batch_inferred": _INFERRED,
    "prs7_recursive_infer": f"SELECT {AT}, {_RECURSIVE}",
    "prs7_rejected_rows": f"SELECT {AT}, {USER_VALUE} AS json_string FROM events WHERE NOT ({_OBJECTS})",
    "prs7_transaction_items": _ITEMS,
    "prs8_array_rows": _with_elements(AT),
    "prs9_corrupt_capture": f"""
SELECT {AT}, {_USER_ID} AS id, {_USER_NAME} AS name, {_USER_AGE} AS age,
 CASE WHEN {_BAD} THEN {USER_VALUE} END AS _corrupt_record
FROM events""",
    "prs8_empty_array": f"""
SELECT {AT}, CASE WHEN event_id % 6 > 3 THEN event_id END AS id,
 CAST(CASE event_id % 6 WHEN 4 THEN 3 WHEN 5 THEN user_id END AS BIGINT) AS age,
 CASE WHEN event_id % 6 < 3 THEN {EDGE_VALUE} END AS _corrupt_record
FROM events""",
    "prs9_blank_text": f"""
SELECT {AT}, CAST(CASE WHEN event_id % 6 > 3 THEN event_id END AS INTEGER) AS id,
 CASE event_id % 6 WHEN 4 THEN '{{"a":1,"a":2}}' WHEN 5 THEN event_type END AS name,
 CAST(CASE event_id % 6 WHEN 4 THEN 3 WHEN 5 THEN user_id END AS INTEGER) AS age,
 CASE WHEN event_id % 6 < 3 THEN {EDGE_VALUE} END AS _corrupt_record
FROM events""",
    "prs7_empty_objects": f"SELECT {AT}, '{{}}' AS json_string FROM events",
    "prs2_repeated_keys": f"""
SELECT {AT}, CAST(event_id AS INTEGER) AS id, CASE event_id % 6 WHEN 4 THEN 'Unknown' ELSE event_type END AS name,
 CAST(CASE event_id % 6 WHEN 4 THEN 3 ELSE user_id END AS INTEGER) AS age
FROM events WHERE event_id % 6 > 3""",
    "inf1_sample_schema": f"""
WITH first AS (SELECT {USER_VALUE} AS v FROM events WHERE {C} NOT IN (0, 1, 7, 8) ORDER BY event_id % 4, event_id LIMIT 1)
SELECT unnest(json_keys(v)) AS field,
 CASE json_type(v, '$.' || unnest(json_keys(v))) WHEN 'UBIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' END AS type
FROM first""",
    "inf2_batch_schema": f"""
WITH messages AS (SELECT {USER_VALUE} AS v FROM events WHERE {C} NOT IN (0, 1, 7))
SELECT field, CASE count(DISTINCT kind) WHEN 1 THEN min(kind) ELSE 'string' END AS type
FROM (
 SELECT unnest(['id', 'name', 'age', 'specs.v', 'specs.at']) AS field,
  CASE unnest([json_type(o, '$.id'), json_type(o, '$.name'), json_type(o, '$.age'), json_type(o, '$.specs.v'),
   json_type(o, '$.specs.at')])
   WHEN 'UBIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'VARCHAR' THEN 'string' END
  AS kind
 FROM (SELECT v AS o FROM messages WHERE json_type(v) = 'OBJECT'
  UNION ALL SELECT unnest(json_extract(v, '$[*]')) FROM messages WHERE json_type(v) = 'ARRAY'))
GROUP BY field""",
    "inf3_recursive_schema": f"""
WITH messages AS (SELECT {USER_VALUE} AS v FROM events WHERE {C} NOT IN (0, 1, 7, 8))
SELECT field, CASE WHEN count(DISTINCT kind) > 1 THEN 'string' ELSE min(kind) END AS type
FROM (
 SELECT unnest(['id', 'name', 'age', 'specs.v', 'specs.at']) AS field,
  unnest([json_type(v, '$.id'), json_type(v, '$.name'), json_type(v, '$.age'), json_type(v, '$.specs.v'),
   CASE WHEN regexp_matches(json_extract_string(v, '$.specs.at'), '^\\d{{4}}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\dZ$')
    THEN 'timestamp' ELSE json_type(v, '$.specs.at') END]) AS raw,
  CASE raw WHEN 'UBIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean'
   WHEN 'VARCHAR' THEN 'string' WHEN 'timestamp' THEN 'timestamp' END AS kind
 FROM messages)
GROUP BY field""",
    "cst4_timestamp_detect": f"""
SELECT event_id, {TIMESTAMP_TEXT} AS text,
 date_trunc('day', ts) + CASE event_id % 10 WHEN 1 THEN INTERVAL 0 SECOND WHEN 3 THEN INTERVAL 545 MINUTE
  WHEN 4 THEN INTERVAL 52500250 MILLISECOND WHEN 6 THEN INTERVAL 1535 MINUTE WHEN 7 THEN NULL WHEN 8 THEN NULL
  WHEN 9 THEN NULL ELSE INTERVAL 875 MINUTE END AS value,
 event_id % 10 < 7 AS is_timestamp
FROM events""",
    "snk1_stream_file_sink": f"SELECT {_PRODUCT_FIELDS} FROM part",
    "snk2_stream_partitioned": """
SELECT c_nationkey AS id, c_name AS product, c_acctbal AS price, c_acctbal > 0 AS in_stock FROM customer""",
    "stm2_stream_interval": """
SELECT c_nationkey AS id, c_name AS product, c_acctbal AS price, c_acctbal > 0 AS in_stock FROM customer""",
    "snk3_stream_lenient": f"SELECT id, name, age FROM ({_LENIENT})",
    "src10_stream_sampled": f"SELECT {_SAMPLED_ID} AS id, {_USER_NAME} AS name, {_SAMPLED_AGE} AS age FROM events",
    "snk4_stream_split_good": _GOOD,
    "snk5_stream_split_bad": _BAD_ROWS,
    "snk4_checkpoint_reset": f"""
SELECT message_key, id, name, age, 2 * count(*) AS copies FROM ({_GOOD}) GROUP BY message_key, id, name, age""",
    "stm5_stream_batch_inferred": _INFERRED,
    "stm5_widened_columns": f"""
SELECT {AT}, CASE WHEN event_id % 4 = 3 THEN 'soon' ELSE '2024-03-22T09:05:00Z' END AS at,
 CASE WHEN event_id % 4 >= 2 THEN '2.5' ELSE '9007199254740993' END AS n
FROM events""",
    "snk7_stream_variants": f"""
SELECT {AT}, CASE WHEN event_id % 4 = 3 THEN 'soon' ELSE '2024-03-22T14:35:00+05:30' END AS at,
 CASE WHEN event_id % 4 >= 2 THEN '2.5' ELSE '9007199254740993' END AS n,
 CAST(CASE WHEN event_id % 4 >= 2 THEN 2 ELSE 9007199254740993 END AS BIGINT) AS whole,
 CAST(CASE WHEN event_id % 4 >= 2 THEN 2.5 ELSE 9007199254740992 END AS DOUBLE) AS number
FROM events""",
    "prs6_variant_users": f"""
SELECT {AT}, CASE WHEN {C} IN (0, 1, 3, 7, 8, 12) THEN NULL WHEN {C} = 5 THEN 'big' WHEN {C} = 9 THEN '7' ELSE event_type END AS name,
 CASE WHEN {C} = 11 THEN value END AS specs_v, CASE WHEN {C} IN (0, 7) THEN {USER_VALUE} END AS _corrupt_record
FROM events""",
    "snk6_replayed_failure": f"""
SELECT CASE WHEN {_BAD} THEN 'bad' ELSE 'good' END AS side, count(*) AS messages FROM events GROUP BY 1""",
    # Batch n holds partition n; the last one is published twice, and both times the version before it is what readers see meanwhile.
    "snk4_snapshot": f"""
WITH moments AS (
 SELECT 'published' AS moment, v AS version, least(v, 3) AS last FROM range(5) AS r(v)
 UNION ALL SELECT 'in flight', v - 1, least(v - 1, CASE v WHEN 4 THEN 3 ELSE v - 1 END) FROM range(5) AS r(v))
SELECT moment, version, (SELECT count(*) FROM events WHERE event_id % 4 <= last AND NOT ({_BAD})) AS good,
 (SELECT count(*) FROM events WHERE event_id % 4 <= last AND {_BAD}) AS bad
FROM moments""",
    "snk6_transient_failure": f"SELECT {AT}, event_id % 4 = 3 AS failed, 2 AS attempts FROM events",
    "obs1_batch_counters": f"""
SELECT 'inferred' AS writer, count(*) AS seen, count(*) FILTER (WHERE {C} NOT IN (0, 7)) + count(*) FILTER (WHERE {C} = 8) AS kept,
 count(*) FILTER (WHERE {C} IN (0, 7)) AS rejected FROM events
UNION ALL
SELECT 'converted', count(*), count(*) FILTER (WHERE {_OBJECTS}), count(*) FILTER (WHERE NOT ({_OBJECTS})) FROM events""",
    "snk6_stream_dead_letter": f"SELECT {AT}, event_id % 4 = 3 AS failed FROM events",
    "stm6_stream_recursive": f"SELECT {_RECURSIVE}",
    "flt4_stream_rejected": f"SELECT {ORIGIN}, {USER_VALUE} AS json_string FROM events WHERE NOT ({_OBJECTS})",
    "stm4_stream_restart": f"""
SELECT kafka_partition, count(*) AS messages, count(DISTINCT kafka_offset) AS distinct_messages
FROM ({_LENIENT}) GROUP BY kafka_partition""",
    "obs1_stream_counters": f"""
SELECT count(*) AS seen, count(*) FILTER (WHERE {C} NOT IN (0, 1, 2, 7, 8, 12)) AS kept,
 count(*) FILTER (WHERE {C} IN (0, 1, 2, 7, 8, 12)) AS skipped
FROM events""",
    "snk8_legacy_layout": f"SELECT transaction_id, item_id, name, price, quantity FROM ({_ITEMS})",
    "snk9_compacted": _LENIENT,
    "snk9_second_run": f"""
WITH good AS (SELECT count(*) AS all_rows, count(*) FILTER (WHERE event_id % 6 < 4) AS early FROM events WHERE NOT ({_BAD}))
SELECT step, step <> 'again' AS merged, TRUE AS read_small_files_only, CASE step WHEN 'more' THEN all_rows ELSE early END AS n_rows, early AS rows_before
FROM good CROSS JOIN (VALUES ('first'), ('again'), ('more')) AS steps(step)""",
    "inf2_from_summaries": f"""
WITH messages AS (SELECT {USER_VALUE} AS v FROM events WHERE {_OBJECTS}),
kinds AS (
 SELECT unnest(['id', 'name', 'age', 'specs', 'specs.v', 'specs.at']) AS field,
  unnest([json_type(v, '$.id'), json_type(v, '$.name'), json_type(v, '$.age'), json_type(v, '$.specs'), json_type(v, '$.specs.v'),
   CASE WHEN json_type(v, '$.specs.at') = 'VARCHAR' THEN 'TIMESTAMP' END]) AS raw
 FROM messages),
named AS (
 SELECT field, CASE raw WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'DOUBLE' THEN 'FRACTION' WHEN 'VARCHAR' THEN 'STRING' WHEN 'NULL' THEN 'VOID' ELSE raw END
  AS kind
 FROM kinds WHERE raw IS NOT NULL)
SELECT field, kind, count(*) AS messages,
 CASE field WHEN 'specs' THEN NULL WHEN 'specs.v' THEN 'double' WHEN 'specs.at' THEN 'timestamp' ELSE 'string' END AS type
FROM named GROUP BY field, kind""",
    "agg3_topic_profile": _TOPIC_PARTITIONS,
    "agg3_running_profile": _TOPIC_PARTITIONS,
    "src10_kept_sample": f"""
SELECT event_type AS kafka_topic, {AT}, {USER_VALUE} AS json_string,
 md5(event_type || ':' || event_id % 4 || ':' || event_id) AS digest
FROM events ORDER BY digest LIMIT {SAMPLE_MESSAGES}""",
    "obs1_kept_sketches": """
SELECT event_type AS topic, count(*) AS messages, TRUE AS keys_close, TRUE AS median_close, TRUE AS tenth_close FROM events GROUP BY event_type""",
    "snk2_clustered": _LENIENT,
    "agg3_offset_account": _ACCOUNT,
    "agg3_offset_gaps": f"""
SELECT topic, partition, CASE copies WHEN 0 THEN 'missing' ELSE 'repeated' END AS kind, first_offset, last_offset, copies
FROM ({_ACCOUNT}) WHERE copies <> 1""",
    "stm6_count_or_idle": _GROUPS,
    "agg4_topic_totals": f"""
SELECT topic, count(*) AS partitions, CAST(sum(end_offset) AS BIGINT) AS approximate_messages,
 CAST(sum(messages) AS BIGINT) AS messages
FROM ({_TOPIC_PARTITIONS}) GROUP BY topic""",
    "agg5_topic_list": "SELECT DISTINCT event_type AS topic FROM events",
    "flt7_describe_topic": f"""
SELECT name AS topic, count(topic) > 0 AS found, count(topic) AS partitions,
 CAST(coalesce(sum(end_offset), 0) AS BIGINT) AS approximate_messages, CAST(coalesce(sum(messages), 0) AS BIGINT) AS messages
FROM (VALUES ('purchase'), ('refund')) AS wanted(name) LEFT JOIN ({_TOPIC_PARTITIONS}) ON topic = name
GROUP BY name""",
    "str2_base64_documents": "SELECT doc_id, base64(encode(text)) AS content FROM documents",
    "req1_request_batches": f"""
SELECT source, request_no, CAST(count(*) AS INTEGER) AS n_items,
 string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS item_ids
FROM ({_NUMBERED}) GROUP BY source, request_no""",
    "req1_hot_group": """
SELECT owner, request_no, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS item_ids,
 md5(string_agg(text, '|' ORDER BY doc_id)) AS contents_md5
FROM (SELECT *, (row_number() OVER (PARTITION BY owner ORDER BY doc_id) - 1) // 7 AS request_no
 FROM (SELECT CASE WHEN doc_id % 10 > 0 THEN 'hot' ELSE source END AS owner, doc_id, text FROM documents))
GROUP BY owner, request_no""",
    "req4_byte_bounded": _BOUNDED,
    "req3_request_bodies": f"""
SELECT source, request_no, 'describer' AS model, 3000 AS max_tokens, 'system' AS first_role, first_image,
 CAST(octet_length(encode(body)) AS INTEGER) AS body_bytes, md5(body) AS body_md5
FROM ({_BODIES})""",
    "udf4_score_requests": f"""
SELECT source, request_no, CASE WHEN bytes % {REFUSED} > 0 THEN 200 ELSE 413 END AS status,
 CASE WHEN bytes % {REFUSED} > 0 THEN 'bytes=' || bytes END AS response,
 CASE WHEN bytes % {REFUSED} = 0 THEN 'bytes=' || bytes END AS error
FROM (SELECT source, request_no, octet_length(encode(body)) AS bytes FROM ({_BODIES}))""",
}
