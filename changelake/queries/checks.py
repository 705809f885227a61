"""Check SQL: what each registered query must give, stated over the same tables."""

from __future__ import annotations

from changelake.queries.inputs import DEALT_TYPES, INGEST_MICROS

# --- shared inputs ---------------------------------------------------------------------------

TOPIC = """
msgs AS (
  SELECT CAST(user_id AS VARCHAR) AS key, props AS value, CAST(user_id % 4 AS INTEGER) AS part,
         event_id AS off, epoch_us(ts) // 1000 AS ms
  FROM events
)"""

DIRTY = """
dirty AS (
  SELECT CASE event_id % 10
           WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'not json' WHEN 3 THEN '{"k": "12"}'
           WHEN 4 THEN '{"k": null}' WHEN 5 THEN '{"other": 1}' WHEN 6 THEN '[1]'
           WHEN 7 THEN '{"k": 3.7}' ELSE props END AS value,
         event_id AS off
  FROM events
),
dirty_k AS (
  SELECT off, value,
         CAST(trunc(TRY_CAST(CASE WHEN json_valid(value) THEN json_extract_string(value, '$.k')
              END AS DECIMAL(38,18))) AS BIGINT) AS k
  FROM dirty
)"""

# Every change with its three tuple values, and the relation in force.
CHANGES = """
top AS (SELECT max(o_orderkey) AS k FROM orders),
data AS (
  SELECT o_orderkey AS key, 4 * o_orderkey + 1 AS seq, 16384 + o_orderkey % 3 AS oid,
         CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'P' THEN 'U' ELSE 'D' END AS op,
         CAST(o_orderkey AS VARCHAR) AS v0,
         CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN NULL
              ELSE CAST(o_custkey AS VARCHAR) END AS v1,
         o_orderstatus AS v2, epoch_us(o_orderdate) AS us
  FROM orders
),
rel AS (
  SELECT * FROM (VALUES
    (-2, 16384, 'shop.orders_a', 'o_orderkey', 'o_custkey', 'o_orderstatus'),
    (-1, 16385, 'shop.orders_b', 'o_orderkey', 'o_custkey', NULL),
    (4003, 16384, 'shop.orders_a', 'o_orderkey', 'o_custkey', 'status')
  ) t(rseq, roid, tab, n0, n1, n2)
),
res AS (
  SELECT d.*, coalesce(r.tab, 'unknown.' || CAST(d.oid AS VARCHAR)) AS tab,
         r.n0 IS NOT NULL AS announced,
         concat_ws(',', r.n0, r.n1, r.n2) AS names,
         coalesce(r.n0, 'col_0') AS n0, coalesce(r.n1, 'col_1') AS n1,
         coalesce(r.n2, 'col_2') AS n2
  FROM data d ASOF LEFT JOIN rel r ON d.oid = r.roid AND d.seq > r.rseq
),
img AS (
  SELECT *, (SELECT string_agg(n || '=' || coalesce(v, '<null>'), ',' ORDER BY n)
             FROM (VALUES (n0, v0), (n1, v1), (n2, v2)) x(n, v)) AS whole
  FROM res
)"""

INFO = f"""
info AS (
  SELECT CASE WHEN l_orderkey % 5 = 4 THEN 'audit' ELSE 'public' END AS sch,
         CASE l_orderkey % 10 WHEN 0 THEN 'pg_' WHEN 1 THEN 'sql_' ELSE 't_' END
           || CAST(l_orderkey AS VARCHAR) AS tab,
         concat_ws('_', 'c', l_linenumber, l_partkey, l_suppkey) AS col,
         list_extract({DEALT_TYPES!r}, CAST(l_partkey % {len(DEALT_TYPES)} + 1 AS INTEGER)) AS dt,
         CASE WHEN l_suppkey % 2 = 0 THEN '_int4' ELSE 'numeric' END AS udt,
         l_returnflag <> 'N' AS nullable, l_linenumber AS ord, l_orderkey AS okey
  FROM lineitem
)"""


def resolved(name: str) -> str:
    """Canonical type of a type name, as SQL."""
    n = f"lower(trim({name}))"
    return f"""
    CASE WHEN {n} IS NULL THEN 'STRING'
      WHEN {n} LIKE '\\_%' ESCAPE '\\' OR {n} LIKE '%[]' THEN 'ARRAY'
      WHEN {n} IN ('interval', 'point') THEN 'STRING'
      WHEN {n} IN ('smallint', 'int2', 'integer', 'int4', 'serial') THEN 'INT32'
      WHEN {n} IN ('bigint', 'int8', 'bigserial') THEN 'INT64'
      WHEN {n} IN ('real', 'float4') THEN 'FLOAT'
      WHEN {n} IN ('double precision', 'float8') THEN 'DOUBLE'
      WHEN {n} IN ('boolean', 'bool') THEN 'BOOLEAN'
      WHEN {n} IN ('text', 'varchar', 'character varying', 'char', 'character', 'name')
        THEN 'STRING'
      WHEN {n} = 'bytea' THEN 'BYTES'
      WHEN {n} = 'date' THEN 'DATE'
      WHEN {n} IN ('time', 'timetz', 'time without time zone', 'time with time zone') THEN 'TIME'
      WHEN {n} IN ('timestamp', 'timestamp without time zone') THEN 'TIMESTAMP'
      WHEN {n} IN ('timestamptz', 'timestamp with time zone') THEN 'TIMESTAMP_TZ'
      WHEN {n} IN ('numeric', 'decimal') THEN 'DECIMAL'
      WHEN {n} IN ('json', 'jsonb') THEN 'JSON'
      WHEN {n} = 'uuid' THEN 'UUID'
      WHEN {n} LIKE '%int%' THEN 'INT64'
      WHEN {n} LIKE '%float%' OR {n} LIKE '%double%' THEN 'DOUBLE'
      WHEN {n} LIKE '%bool%' THEN 'BOOLEAN'
      WHEN {n} LIKE '%timestamp%' THEN 'TIMESTAMP'
      WHEN {n} LIKE '%date%' THEN 'DATE'
      WHEN {n} LIKE '%time%' THEN 'TIME'
      WHEN {n} LIKE '%numeric%' OR {n} LIKE '%decimal%' THEN 'DECIMAL'
      ELSE 'STRING' END"""


DISCOVERED = INFO + f""",
keys AS (
  SELECT DISTINCT CASE WHEN o_orderkey % 5 = 4 THEN 'audit' ELSE 'public' END AS sch,
         CASE o_orderkey % 10 WHEN 0 THEN 'pg_' WHEN 1 THEN 'sql_' ELSE 't_' END
           || CAST(o_orderkey AS VARCHAR) AS tab, col
  FROM orders JOIN info ON okey = o_orderkey AND ord = 1 WHERE o_orderstatus <> 'O'
),
found AS (
  SELECT 'public.' || i.tab AS table_name, i.col AS column_name,
         {resolved("CASE WHEN dt IN ('USER-DEFINED', 'ARRAY') THEN udt ELSE dt END")} AS type,
         nullable, k.col IS NOT NULL AS primary_key, ord AS ordinal_position, okey
  FROM info i LEFT JOIN keys k ON k.sch = i.sch AND k.tab = i.tab AND k.col = i.col
  WHERE i.sch = 'public' AND i.tab LIKE 't\\_%' ESCAPE '\\'
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts)


def op_name(column: str) -> str:
    return f"CASE {column} WHEN 'I' THEN 'INSERT' WHEN 'U' THEN 'UPDATE' ELSE 'DELETE' END"


ENVELOPE = """'events' AS _kafka_topic, part AS _kafka_partition, off AS _kafka_offset,
       key AS _kafka_key, ms AS _kafka_timestamp_ms, value AS _payload"""

HEX = "upper(to_hex({0}))"


def lsn_parts(key: str) -> tuple[str, str]:
    return f"({key} // 256)", f"(({key} * 65537) % 4294967296)"


def lsn_position(key: str) -> str:
    high, low = lsn_parts(key)
    return f"({high} * 4294967296 + {low})"


def lsn_text(position: str) -> str:
    return (
        f"upper(to_hex({position} // 4294967296)) || '/' || upper(to_hex({position} % 4294967296))"
    )


CHECKS = {}

# --- sources ---------------------------------------------------------------------------------

CHECKS["q_snapshot"] = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(0 AS BIGINT) AS _cdc_position,
       'SNAPSHOT' AS _cdc_operation, CAST({INGEST_MICROS} AS BIGINT) AS _cdc_timestamp
FROM orders"""

CHECKS["q_chunk_plan"] = """
WITH tables AS (
  SELECT 'orders' AS table_name, max(o_orderkey) // 10 + 1 AS pages FROM orders UNION ALL
  SELECT 'lineitem', max(l_orderkey) // 2 + 1 FROM lineitem UNION ALL
  SELECT 'events', max(event_id) // 4 + 1 FROM events UNION ALL
  SELECT 'region', max(r_regionkey) // 1000 FROM region
),
starts AS (
  SELECT table_name, pages,
         unnest(CASE WHEN pages > 0 THEN range(0, pages, 500) ELSE [0] END) AS start_page
  FROM tables
)
SELECT table_name, CAST(pages AS BIGINT) AS pages, CAST(start_page // 500 AS BIGINT) AS chunk,
       CAST(start_page AS BIGINT) AS start_page,
       CAST(least(start_page + 500, pages + 1) AS BIGINT) AS end_page
FROM starts"""

RANGES = """
b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
ranges AS (
  SELECT CAST(n AS INTEGER) AS chunk, lo + n * 5000 AS first, lo + (n + 1) * 5000 AS past,
         (hi - lo) // 5000 + 1 AS total
  FROM (SELECT *, unnest(range(0, (hi - lo) // 5000 + 1)) AS n FROM b)
)"""

CHECKS["q_chunked_snapshot"] = with_(RANGES) + """
SELECT o_orderkey, o_totalprice, chunk
FROM orders JOIN ranges ON o_orderkey >= first AND o_orderkey < past"""

CHECKS["q_snapshot_resume"] = with_(RANGES) + """
SELECT o_orderkey, o_totalprice, chunk
FROM orders JOIN ranges ON o_orderkey >= first AND o_orderkey < past
WHERE chunk >= total // 3"""

CHECKS["q_envelope"] = with_(TOPIC) + f" SELECT {ENVELOPE} FROM msgs"

CHECKS["q_sample_events"] = """
SELECT CAST(event_id + 1001 AS VARCHAR) AS key,
       '{"user_id":' || CAST(event_id + 1001 AS VARCHAR) || ',"event_type":"test","created_at":"'
         || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '","seq":' || CAST(event_id + 1 AS VARCHAR)
         || ',"message":"hello"}' AS value
FROM events"""

CHECKS["q_publish_frame"] = with_(TOPIC) + " SELECT 'events' AS topic, key, value FROM msgs"

# --- catalog ---------------------------------------------------------------------------------

CHECKS["q_discover"] = with_(DISCOVERED) + """
SELECT table_name, column_name, type, nullable, primary_key, ordinal_position FROM found"""

CHECKS["q_discover_topics"] = """
SELECT DISTINCT 'shop.' || event_type || '.' || CAST(user_id AS VARCHAR) AS topic,
       'shop.' || event_type || '.' || CAST(user_id AS VARCHAR) || '.kafka_shop_' || event_type
         || '_' || CAST(user_id AS VARCHAR) AS stream_id
FROM events WHERE event_type <> 'error'"""

CHECKS["q_resolve_type"] = with_(INFO) + f"""
SELECT tab AS table_name, col AS column_name,
       {resolved("CASE WHEN nullable AND dt = 'inet' THEN NULL ELSE dt END")} AS type
FROM info"""

CHECKS["q_stream_select"] = with_(DISCOVERED) + """
SELECT table_name, column_name, type FROM found
WHERE okey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"""

CHECKS["q_sync_plan"] = """
WITH catalog AS (
  SELECT c_custkey AS key, lower(c_mktsegment) AS seg, CAST(c_custkey AS VARCHAR) AS t,
         CASE c_custkey % 6 WHEN 0 THEN 'full_load' WHEN 1 THEN 'cdc' WHEN 3 THEN 'cdc'
              ELSE 'full_load+cdc' END AS mode
  FROM customer
),
done AS (
  SELECT o_custkey AS key, bool_and(o_orderstatus <> 'P') AS completed FROM orders GROUP BY 1
)
SELECT CASE WHEN c.key % 4 = 3 THEN 'cust_' || t ELSE 'public.' || seg || '.' || t END AS "table",
       mode, mode <> 'cdc' AND NOT coalesce(completed, false) AS needs_full_load,
       mode <> 'full_load' AS needs_cdc,
       CASE WHEN c.key % 3 = 0 THEN 'dest_' || t WHEN c.key % 4 = 3 THEN 'cust_' || t
            ELSE seg || '.' || t END AS destination
FROM catalog c LEFT JOIN done d ON c.key = d.key"""

# --- change messages -------------------------------------------------------------------------

CHECKS["q_classify"] = with_(CHANGES) + f"""
SELECT seq, op AS msg_type, {op_name("op")} AS message, true AS yields_row FROM data
UNION ALL SELECT seq - 1, 'B', 'BEGIN', false FROM data
UNION ALL SELECT seq + 1, 'C', 'COMMIT', false FROM data, top WHERE key < k
UNION ALL SELECT rseq, 'R', 'RELATION', false FROM rel
UNION ALL SELECT 4 * k + 6, 'T', 'TRUNCATE', false FROM top
UNION ALL SELECT 4 * k + 7, 'Y', 'UNKNOWN', false FROM top"""

CHECKS["q_resolve_relation"] = with_(CHANGES) + """
SELECT seq, oid AS rel_oid, tab AS table_name,
       CASE WHEN announced THEN names END AS rel_columns
FROM res"""

CHECKS["q_resolve_many_relations"] = with_(CHANGES) + """,
announced AS (
  SELECT 4 * o_orderkey + 3 AS aseq, 16384 + o_custkey % 3 AS aoid,
         CAST(o_orderkey AS VARCHAR) AS a
  FROM orders WHERE o_orderstatus = 'P'
)
SELECT seq, oid AS rel_oid, coalesce('shop.v_' || a, 'unknown.' || CAST(oid AS VARCHAR))
         AS table_name, 'c_' || a AS rel_columns
FROM data ASOF LEFT JOIN announced ON oid = aoid AND seq > aseq"""

CHECKS["q_tuple_columns"] = with_(CHANGES) + """
SELECT seq, n0 AS name, v0 AS value FROM res
UNION ALL SELECT seq, n1, v1 FROM res
UNION ALL SELECT seq, n2, v2 FROM res"""

CHECKS["q_before_after"] = with_(CHANGES) + """
SELECT seq, op AS msg_type, CASE WHEN op <> 'D' THEN whole END AS after,
       CASE op WHEN 'U' THEN n0 || '=' || v0 WHEN 'D' THEN whole END AS before
FROM img"""

CHECKS["q_row_image"] = with_(CHANGES) + """
SELECT seq, op AS msg_type, whole AS image FROM img"""

CHECKS["q_target_filter"] = with_(CHANGES) + """
SELECT seq, tab AS table_name FROM res WHERE tab IN ('shop.orders_a', 'unknown.16386')"""

CHECKS["q_transactions"] = with_(CHANGES) + f"""
SELECT seq, op AS msg_type, key AS tx_xid, seq + 1 AS commit_seq,
       CAST({lsn_position("key")} AS BIGINT) AS commit_position
FROM data, top WHERE key < k"""

_HIGH, _LOW = lsn_parts("o_orderkey")
_LSN = f"upper(to_hex({_HIGH})) || '/' || upper(to_hex({_LOW}))"
CHECKS["q_lsn"] = f"""
SELECT o_orderkey, {_LSN} AS lsn, CAST({lsn_position("o_orderkey")} AS BIGINT) AS position,
       {_LSN} AS again
FROM orders"""

# --- records ---------------------------------------------------------------------------------

CHECKS["q_normalize"] = with_(TOPIC) + f"""
SELECT {ENVELOPE}, CAST(json_extract_string(value, '$.k') AS BIGINT) AS k FROM msgs"""

CHECKS["q_normalize_dirty"] = with_(DIRTY) + """
SELECT off AS _kafka_offset, value AS _payload, k FROM dirty_k"""

CHECKS["q_cast"] = """
WITH o AS (
  SELECT *, o_orderkey AS key, CAST(o_orderkey AS VARCHAR) AS t,
         epoch_us(o_orderdate) AS day_us, o_orderkey % 24 AS h, o_orderkey % 60 AS m
  FROM orders
)
SELECT key AS o_orderkey,
  CAST(CASE WHEN key % 5 IN (1, 3) THEN NULL ELSE key END AS INTEGER) AS i32,
  CASE WHEN key % 4 = 3 THEN -key ELSE key END AS i64,
  CASE WHEN key % 3 <> 2 THEN CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) END AS f32,
  CASE WHEN key % 3 <> 1 THEN o_totalprice END AS f64,
  CASE WHEN o_orderstatus IN ('O', 'F') THEN true WHEN key % 2 = 0 THEN false END AS flag,
  o_orderpriority AS name,
  CASE WHEN key % 3 = 0
       THEN upper(CASE WHEN length(to_hex(key + 4096)) % 2 = 1 THEN '0' ELSE '' END
                  || to_hex(key + 4096))
       ELSE upper(to_hex(CAST(t AS BLOB))) END AS raw,
  CASE WHEN key % 6 <> 5 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE WHEN key % 7 <> 6 THEN (h * 3600 + m * 60 + 9) * 1000000 + 250000 END AS clock,
  day_us + (h * 3600 + m * 60 + 9) * 1000000 + 250000 AS at,
  day_us + (h * 3600 + m * 60 + 9) * 1000000 + 250000
    - CASE WHEN key % 3 = 2 THEN 7200000000 ELSE 0 END AS at_tz,
  CASE WHEN key % 9 <> 8
       THEN CAST(CAST(t || '.' || lpad(CAST(m AS VARCHAR), 2, '0') AS DECIMAL(38,18)) AS VARCHAR)
       END AS price,
  '{"a": ' || t || '}' AS doc,
  '00000000-0000-0000-0000-' || lpad(t, 12, '0') AS id,
  CASE WHEN key % 4 <> 3 THEN t || '|b' END AS list
FROM o"""

CHECKS["q_project"] = """
SELECT o_custkey, CAST(NULL AS VARCHAR) AS missing, o_orderkey FROM orders"""

CHECKS["q_project_image"] = with_(CHANGES) + """
SELECT seq, CASE WHEN n0 = 'o_orderkey' THEN CAST(v0 AS BIGINT) END AS o_orderkey,
       CASE WHEN n1 = 'o_custkey' THEN CAST(v1 AS BIGINT) END AS o_custkey,
       CASE WHEN n2 = 'o_orderstatus' THEN v2 END AS o_orderstatus
FROM res"""

CHECKS["q_metadata"] = with_(CHANGES) + f"""
SELECT seq, {op_name("op")} AS _cdc_operation, us AS _cdc_timestamp FROM data"""

CHECKS["q_event_time"] = with_(TOPIC) + f"""
SELECT off AS _kafka_offset,
       CASE WHEN off % 3 <> 0 THEN ms * 1000 ELSE {INGEST_MICROS} END AS event_us
FROM msgs"""

CHECKS["q_required"] = with_(DIRTY) + """
SELECT off AS _kafka_offset, k, CASE WHEN k IS NULL THEN 'k' END AS reject_reason FROM dirty_k"""

# --- progress --------------------------------------------------------------------------------

CHECKS["q_watermark"] = with_(TOPIC) + """
SELECT 'events' AS topic, part AS partition, max(off) AS last_offset FROM msgs GROUP BY part"""

CHECKS["q_resume"] = with_(TOPIC) + """
SELECT part AS partition, off AS "offset", value FROM msgs
WHERE off > CASE WHEN part IN (0, 1) THEN 100 ELSE -1 END"""

CHECKS["q_batches"] = with_(TOPIC) + """,
cut AS (
  SELECT part, off, (row_number() OVER (PARTITION BY part ORDER BY off) - 1) // 1000 AS batch
  FROM msgs
)
SELECT part AS partition, batch, count(*) AS records, min(off) AS first_offset,
       max(off) AS last_offset
FROM cut GROUP BY part, batch"""

CHECKS["q_merge_offsets"] = """
SELECT 's' AS stream_id, 't' AS topic, CAST(p AS INTEGER) AS partition, max(o) AS last_offset
FROM (SELECT o_custkey AS p, o_orderkey AS o FROM orders
      UNION ALL SELECT user_id, event_id FROM events) GROUP BY p"""

CHECKS["q_merge_progress"] = f"""
WITH old AS (
  SELECT o_custkey AS id, max(o_orderkey) AS pos, max(epoch_us(o_orderdate)) AS us,
         bool_and(o_orderstatus <> 'P') AS completed, count(*) AS n
  FROM orders GROUP BY 1
),
new AS (SELECT user_id AS id, max(event_id) AS pos, max(epoch_us(ts)) AS us FROM events GROUP BY 1),
merged AS (
  SELECT coalesce(new.id, old.id) AS id, new.id IS NOT NULL AS seen,
         greatest(old.pos, new.pos) AS pos, greatest(old.us, new.us) AS us, completed, n
  FROM old FULL JOIN new ON old.id = new.id
)
SELECT 'u_' || CAST(id AS VARCHAR) AS stream_id,
       CASE WHEN seen THEN 'cdc' ELSE 'full_load' END AS sync_mode,
       {lsn_text("pos")} AS last_lsn, pos AS last_position, completed AS full_load_completed,
       CAST(n AS INTEGER) AS full_load_chunks_done, us AS last_sync_time
FROM merged"""

CHECKS["q_commit_positions"] = with_(CHANGES) + f""",
last AS (SELECT CAST(max({lsn_position("key")}) AS BIGINT) AS pos FROM data, top WHERE key < k)
SELECT DISTINCT tab AS table_name, pos AS last_position, 'cdc' AS sync_mode,
       {lsn_text("pos")} AS last_lsn
FROM res, last"""

CHECKS["q_load_progress"] = """
WITH total AS (SELECT max(o_orderkey) // 1000 + 1 AS chunks FROM orders),
per AS (SELECT o_orderkey // 1000 AS chunk, count(*) AS n FROM orders GROUP BY 1)
SELECT 'orders' AS table_name, chunk, n AS chunk_rows,
       CAST(sum(n) OVER (ORDER BY chunk) AS BIGINT) AS rows_so_far, chunk + 1 AS chunks_done,
       chunks AS chunks_total, chunk + 1 = chunks AS completed, (chunk + 1) % 10 = 0 AS flush
FROM per, total"""

CHECKS["q_counts"] = with_(CHANGES) + f"""
SELECT tab AS table_name, {op_name("op")} AS _cdc_operation, count(*) AS records
FROM res GROUP BY 1, 2"""

# --- jobs ------------------------------------------------------------------------------------

CHECKS["q_topic_change_log"] = with_(TOPIC) + f"""
SELECT {ENVELOPE}, CAST(json_extract_string(value, '$.k') AS BIGINT) AS k,
       'INSERT' AS _cdc_operation, ms * 1000 AS _cdc_timestamp
FROM msgs"""

CHECKS["q_table_change_log"] = with_(CHANGES) + f"""
SELECT CAST(v0 AS BIGINT) AS o_orderkey, CAST(v1 AS BIGINT) AS o_custkey,
       CASE WHEN n2 = 'o_orderstatus' THEN v2 END AS o_orderstatus, seq AS _cdc_position,
       {op_name("op")} AS _cdc_operation, CAST({INGEST_MICROS} AS BIGINT) AS _cdc_timestamp
FROM res, top WHERE key < k AND tab = 'shop.orders_a'"""

CHECKS["q_append"] = f"""
SELECT *, '2024-06-01' AS ingest_date FROM ({CHECKS["q_snapshot"]})"""

CHECKS["q_replay"] = with_(TOPIC) + """
SELECT part AS _kafka_partition, off AS _kafka_offset,
       CAST(json_extract_string(value, '$.k') AS BIGINT) AS k,
       CASE WHEN part < 2 THEN 'b1' ELSE 'b2' END AS batch_id
FROM msgs"""

CHECKS["q_topic_sync"] = with_(TOPIC) + f"""
SELECT {ENVELOPE}, CAST(json_extract_string(value, '$.k') AS BIGINT) AS k,
       'INSERT' AS _cdc_operation, ms * 1000 AS _cdc_timestamp, '2024-06-01' AS ingest_date
FROM msgs"""

CHECKS["q_table_sync"] = with_(CHANGES) + f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, epoch_us(o_orderdate) AS o_orderdate,
       o_orderpriority, CAST(0 AS BIGINT) AS _cdc_position, 'SNAPSHOT' AS _cdc_operation
FROM orders
UNION ALL
SELECT key, CAST(v1 AS BIGINT), CASE WHEN n2 = 'o_orderstatus' THEN v2 END, NULL, NULL, NULL,
       seq, {op_name("op")}
FROM res, top WHERE key < k AND tab = 'shop.orders_a'"""

CHECKS["q_text_messages"] = """
SELECT CAST(user_id AS VARCHAR) AS key, props AS value, 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
       event_id AS "offset", epoch_us(ts) AS "timestamp"
FROM events"""

CHECKS["q_destination_schema"] = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'SNAPSHOT' AS _cdc_operation,
       CAST({INGEST_MICROS} AS BIGINT) AS _cdc_timestamp
FROM orders"""

CHECKS["q_append_table"] = """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS o_orderstatus FROM orders"""

CHECKS["q_load_resumed"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, 'SNAPSHOT' AS _cdc_operation FROM orders"""

CHECKS["q_full_refresh"] = f"""
SELECT t.* FROM ({CHECKS["q_topic_sync"]}) t, range(2)"""

CHECKS["q_route_late_changes"] = with_(CHANGES) + f"""
SELECT CASE WHEN tab = 'shop.orders_a' THEN 'a' WHEN tab <> 'shop.orders_b' THEN 'c'
            WHEN v1 IS NULL AND op <> 'D' THEN 'b__rejects' ELSE 'b' END AS name,
       CAST(v0 AS BIGINT) AS key, seq AS _cdc_position, {op_name("op")} AS _cdc_operation
FROM res, top WHERE key < k"""

# --- state of tables -------------------------------------------------------------------------

# Customers' rows by construction: a row is a customer's from an insert on, whatever its key is.
ACCOUNTS = f"""
cut AS (SELECT max(o_orderkey) // 3 AS k, max(o_orderkey) AS last FROM orders),
raw AS (
  SELECT o_orderkey AS n, o_custkey AS customer, o_orderstatus AS status,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price, o_orderpriority || '/' || o_orderkey AS note,
         (o_orderkey > (SELECT k FROM cut))::INTEGER AS epoch, o_orderkey % 10 = 0 AS gone
  FROM orders
),
marked AS (
  SELECT *, lag(gone) OVER w AS was_gone, lag(epoch) OVER w AS was_epoch FROM raw WINDOW w AS (PARTITION BY customer ORDER BY n)
),
ops AS (
  SELECT *, CASE WHEN was_gone IS NULL OR was_gone OR was_epoch <> epoch THEN 'I' WHEN gone THEN 'D' ELSE 'U' END AS op FROM marked
),
lives AS (
  SELECT *, sum((op = 'I')::INTEGER) OVER (PARTITION BY customer ORDER BY n) AS life, (op = 'U' AND n % 13 = 0)::INTEGER AS flip FROM ops
),
history AS (
  SELECT *, customer * (CASE WHEN flipped % 2 = 1 THEN -1 ELSE 1 END) AS id,
         customer * (CASE WHEN (flipped - flip) % 2 = 1 THEN -1 ELSE 1 END) AS old_id
  FROM (SELECT *, sum(flip) OVER (PARTITION BY customer, life ORDER BY n) AS flipped FROM lives)
  WHERE n < (SELECT last FROM cut)
),
told AS (
  SELECT *, max(CASE WHEN op = 'I' OR (op = 'U' AND n % 3 = 0) THEN n END) OVER (PARTITION BY customer, life ORDER BY n) AS told_by FROM history
),
filled AS (
  SELECT t.* EXCLUDE (note), CASE WHEN t.told_by % 7 <> 0 THEN o.o_orderpriority || '/' || o.o_orderkey END AS note
  FROM told t LEFT JOIN orders o ON o.o_orderkey = t.told_by
)"""

_STATE = with_(ACCOUNTS) + """
SELECT id::BIGINT AS id, status, price, note, 4 * n + 1 AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY customer ORDER BY n DESC) AS back FROM filled
) WHERE back = 1 AND op <> 'D' AND n > (SELECT k FROM cut)
"""
CHECKS["q_current_state"] = _STATE
CHECKS["q_incremental_state"] = _STATE
CHECKS["q_truncate"] = with_(ACCOUNTS) + """
SELECT 4 * n + 1 AS _seq, op AS _op, id::BIGINT::VARCHAR AS key, CASE WHEN id <> old_id THEN old_id::BIGINT::VARCHAR END AS old_key
FROM history WHERE n > (SELECT k FROM cut)
"""
CHECKS["q_unchanged_values"] = with_(ACCOUNTS) + """
SELECT 4 * n + 1 AS _seq, id::BIGINT AS id, note, 0::INTEGER AS unknown FROM filled WHERE op <> 'D'
"""

CHECKS["q_reconciled_load"] = with_(ACCOUNTS) + """,
marks AS (
  SELECT i AS chunk, floor(last * (10 + 2 * i - 1) / 20)::BIGINT AS low, floor(last * (10 + 2 * i) / 20)::BIGINT AS read,
         floor(last * (10 + 2 * i + 1) / 20)::BIGINT AS high
  FROM cut, range(4) t(i)
),
seen AS (
  SELECT f.customer, f.id, f.op, m.low, m.high FROM filled f JOIN marks m ON f.customer % 4 = m.chunk
  WHERE f.n <= m.read AND f.n > (SELECT k FROM cut)
  QUALIFY row_number() OVER (PARTITION BY f.customer ORDER BY f.n DESC) = 1
),
kept AS (
  SELECT id FROM seen s WHERE op <> 'D' AND NOT EXISTS (
    SELECT 1 FROM filled f WHERE f.customer = s.customer AND f.n > s.low AND f.n <= s.high AND (f.id = s.id OR f.old_id = s.id)
  )
),
ends AS (
  SELECT *, row_number() OVER (PARTITION BY customer ORDER BY n DESC) AS back FROM filled
)
SELECT e.id::BIGINT AS id, e.status, e.price, e.note, CASE WHEN e.n > m.low THEN 4 * e.n + 1 END AS position,
       e.id IN (SELECT id FROM kept) AS kept
FROM ends e JOIN marks m ON e.customer % 4 = m.chunk
WHERE back = 1 AND op <> 'D' AND n > (SELECT k FROM cut)
"""
CHECKS["q_stream_positions"] = with_(CHANGES) + f""",
commits AS (SELECT key, key % 2 AS odd FROM data WHERE key < (SELECT k FROM top)),
lasts AS (SELECT odd, max(key) AS key FROM commits GROUP BY odd),
texts AS (
  SELECT odd, 4 * key + 2 AS commit_seq,
         ('0x' || CASE odd WHEN 1 THEN '7F' ELSE '' END || upper(to_hex(key // 256)))::BIGINT * 4294967296 + key * 65537 % 4294967296 AS position
  FROM lasts
),
tabs AS (SELECT DISTINCT key % 2 AS odd, 't_' || oid AS table_name FROM data)
SELECT CASE t.odd WHEN 1 THEN 's2' ELSE 's1' END AS stream_id, t.table_name, x.commit_seq, x.position AS last_position, 'cdc' AS sync_mode, {lsn_text("x.position")} AS last_lsn
FROM tabs t JOIN texts x ON t.odd = x.odd
"""
CHECKS["q_quantile_ranges"] = """
SELECT CASE WHEN l_linenumber <= 2 THEN 1000::BIGINT END AS value, count(*) AS rows, true AS fair FROM lineitem GROUP BY 1
"""
CHECKS["q_cursor_increment"] = """
WITH mid AS (SELECT quantile_cont(o_orderkey, 0.5) AS k FROM orders),
d AS (SELECT arg_min(o_orderdate::DATE, o_orderkey) AS day FROM orders WHERE o_orderkey >= (SELECT k FROM mid)),
o AS (SELECT *, o_orderdate::DATE AS day, (SELECT day FROM d) AS border FROM orders)
SELECT o_orderkey, 'increment-0-' || CASE WHEN day < border OR (day = border AND o_orderkey % 2 = 1) THEN '0000000000' ELSE '0000000001' END AS batch_id,
       (SELECT count(*) FROM o WHERE day < border AND o_orderkey % 17 = 0) AS late
FROM o WHERE day >= border OR o_orderkey % 17 <> 0
"""
CHECKS["q_malformed_values"] = with_(DIRTY) + """
SELECT 'events' AS table_name, 'cdc-0-0000000000' AS batch_id, 'k' AS column_name, count(*) AS records
FROM dirty WHERE CASE WHEN json_valid(value) THEN json_extract_string(value, '$.k') END IS NOT NULL
"""

CHECKS["q_schema_versions"] = """
WITH m AS (SELECT max(o_orderkey) AS m FROM orders),
placed AS (
    SELECT orders.*, CASE WHEN o_orderkey <= floor(m / 3) THEN 1 WHEN o_orderkey <= floor(m * 2 / 3) THEN 2 ELSE 3 END AS v FROM orders, m
)
SELECT 's1' AS stream_id, CAST(o_orderkey * 2 AS BIGINT) AS seq, CASE WHEN o_orderkey % 5 = 0 THEN 'D' ELSE 'U' END AS msg_type, CAST(v AS BIGINT) AS version,
    o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
    strftime(CASE WHEN v < 3 THEN date_trunc('day', o_orderdate) ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
    CASE WHEN v < 3 THEN o_orderstatus END AS o_orderstatus,
    CASE WHEN v > 1 AND o_orderkey % 13 <> 0 THEN o_totalprice END AS o_totalprice
FROM placed
"""
