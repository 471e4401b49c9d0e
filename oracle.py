"""The registered queries as SQL over the same tables, written independently.

Row-by-row definitions (window functions over the typed columns) rather than the
merge, change-feed and envelope paths the Spark side takes.
"""

from __future__ import annotations

OP = """CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END"""
STATUS = """CASE event_type WHEN 'signup' THEN 'created' WHEN 'click' THEN 'approved'
            WHEN 'view' THEN 'shipped' WHEN 'purchase' THEN 'delivered' END"""

CDC = f"""
cdc AS (
 SELECT event_id AS kafka_offset, CAST(user_id % 4 AS INTEGER) AS kafka_partition,
        event_id // 1000 AS batch_no, {OP} AS op,
        CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts_ms,
        CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'c_' || user_id END AS customer_id,
        CASE WHEN event_type = 'error' THEN NULL ELSE 'u_' || user_id END AS customer_unique_id,
        CASE WHEN event_type = 'error' THEN NULL ELSE 'city_' || (k % 7) END AS customer_city,
        CASE WHEN event_type = 'error' THEN NULL WHEN k % 10 = 0 THEN 'XXX'
             ELSE ['SP', 'RJ', 'MG', 'PR', 'BA'][CAST(1 + k % 5 AS INTEGER)] END AS customer_state
 FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
),
valid AS (
 SELECT * FROM cdc
 WHERE (op = 'd' AND customer_id IS NOT NULL)
    OR (op IN ('c','u','r') AND customer_id IS NOT NULL AND regexp_full_match(customer_state, '[A-Z]{{2}}'))
),
last AS (SELECT max(event_id // 1000) AS b FROM events)"""

CDC_O = f"""
cdc_o AS (
 SELECT event_id AS kafka_offset, event_id // 1000 AS batch_no, {OP} AS op,
        CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts_ms,
        'o_' || (event_id % 2500) AS order_id,
        CASE WHEN event_id % 89 = 0 THEN NULL ELSE 'c_' || user_id END AS customer_id,
        {STATUS} AS order_status, CAST(ts AS DATE) AS event_date
 FROM events
),
valid_o AS (
 SELECT * FROM cdc_o WHERE (op = 'd' AND order_id IS NOT NULL)
    OR (op IN ('c','u','r') AND order_id IS NOT NULL AND customer_id IS NOT NULL)
)"""


def _fact(name: str = "fact", where: str = "true") -> str:
    return f"""
{name} AS (
 SELECT order_id, customer_id, order_status, ts_ms AS event_ts_ms, event_date FROM (
   SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts_ms DESC NULLS LAST,
          CASE WHEN op = 'd' THEN 0 ELSE 1 END, kafka_offset DESC) AS rn FROM valid_o WHERE {where})
 WHERE rn = 1 AND op <> 'd'
)"""


def _scd2(name: str = "dim", where: str = "true") -> str:
    return f"""
{name}_b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_no, customer_id
        ORDER BY ts_ms DESC NULLS LAST, CASE WHEN op = 'd' THEN 0 ELSE 1 END) AS rn
        FROM valid WHERE {where}) WHERE rn = 1),
{_turns(name, 'batch_no')}"""


def _turns(name: str, order: str) -> str:
    return f"""{name}_p AS (SELECT *, lag(op) OVER w AS p_op, lag(customer_unique_id) OVER w AS p_u,
        lag(customer_city) OVER w AS p_c, lag(customer_state) OVER w AS p_s
      FROM {name}_b WINDOW w AS (PARTITION BY customer_id ORDER BY {order})),
{name}_m AS (SELECT * FROM {name}_p WHERE CASE WHEN op = 'd' THEN p_op IS NOT NULL AND p_op <> 'd'
        ELSE p_op IS NULL OR p_op = 'd'
          OR coalesce(customer_unique_id,'') <> coalesce(p_u,'')
          OR coalesce(customer_city,'') <> coalesce(p_c,'')
          OR coalesce(customer_state,'') <> coalesce(p_s,'') END),
{name}_e AS (SELECT *, lead(ts_ms) OVER (PARTITION BY customer_id ORDER BY {order}) AS nxt FROM {name}_m),
{name} AS (SELECT customer_id, customer_unique_id, customer_city, customer_state,
       ts_ms AS effective_start_ts_ms, nxt AS effective_end_ts_ms, nxt IS NULL AS is_current
 FROM {name}_e WHERE op <> 'd')"""


DIM = _scd2()
FACT = _fact()
CUSTOMER_COLUMNS = """op, ts_ms, customer_id, customer_unique_id, customer_city, customer_state,
 kafka_partition, kafka_offset"""
ORDER_COLUMNS = "op, ts_ms, order_id, customer_id, order_status, event_date, kafka_offset"
DIM_COLUMNS = """customer_id, customer_unique_id, customer_city, customer_state,
 effective_start_ts_ms, effective_end_ts_ms, is_current"""
FACT_COLUMNS = "order_id, customer_id, order_status, event_ts_ms, event_date"

BULK = """
bulk_fact AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
   o_orderstatus AS order_status, CAST(epoch_us(o_orderdate) // 1000 AS BIGINT) AS event_ts_ms,
   CAST(o_orderdate AS DATE) AS event_date FROM orders),
bulk_dim AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_mktsegment AS customer_city,
   n_name AS customer_state FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

# One row per (order, batch): what the batch did to the order, beside what was there.
FEED = """
w_o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_no, order_id
   ORDER BY ts_ms DESC NULLS LAST, CASE WHEN op = 'd' THEN 0 ELSE 1 END, kafka_offset DESC) AS rn
   FROM valid_o) WHERE rn = 1),
l_o AS (SELECT *, lag(op) OVER w AS o_op, lag(customer_id) OVER w AS o_customer,
   lag(order_status) OVER w AS o_status, lag(ts_ms) OVER w AS o_ts, lag(event_date) OVER w AS o_date
   FROM w_o WINDOW w AS (PARTITION BY order_id ORDER BY batch_no)),
feed AS (
 SELECT order_id, customer_id, order_status, ts_ms AS event_ts_ms, event_date,
   CASE WHEN o_op IS NOT NULL AND o_op <> 'd' THEN 'update_postimage' ELSE 'insert' END AS _change_type,
   batch_no AS _commit_version FROM l_o WHERE op <> 'd'
 UNION ALL
 SELECT order_id, o_customer, o_status, o_ts, o_date,
   CASE WHEN op = 'd' THEN 'delete' ELSE 'update_preimage' END, batch_no
   FROM l_o WHERE o_op IS NOT NULL AND o_op <> 'd')"""


def _latest(order: str, source: str, key: str, columns: str) -> str:
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
 FROM {source}) WHERE rn = 1"""


STREAM_ORDER = "ts_ms DESC NULLS LAST, coalesce(kafka_partition,-1) DESC, coalesce(kafka_offset,-1) DESC"
DELETE_WINS = "ts_ms DESC NULLS LAST, CASE WHEN op = 'd' THEN 0 ELSE 1 END, kafka_offset DESC"
SILVER = f"""WITH {CDC} SELECT customer_id, customer_unique_id, customer_city, customer_state, ts_ms AS _last_ts_ms
 FROM ({_latest(STREAM_ORDER, 'valid', 'customer_id', '*')}) WHERE op <> 'd'"""

# Event rows of the newest batch, latest per customer, beside the current version before it.
COMPARED = f"""{CDC}, {_scd2('dim', 'batch_no < (SELECT b FROM last)')},
s AS ({_latest(DELETE_WINS, 'valid WHERE batch_no = (SELECT b FROM last)', 'customer_id', '*')}),
cmp AS (SELECT s.*, d.customer_id IS NOT NULL AS has_current,
   coalesce(s.customer_unique_id,'') <> coalesce(d.customer_unique_id,'')
   OR coalesce(s.customer_city,'') <> coalesce(d.customer_city,'')
   OR coalesce(s.customer_state,'') <> coalesce(d.customer_state,'') AS differs
  FROM s LEFT JOIN (SELECT * FROM dim WHERE is_current) d ON s.customer_id = d.customer_id)"""


def _text(value: str) -> str:
    return f"""CASE WHEN {value} IS NULL THEN 'null' ELSE '"' || {value} || '"' END"""


def _envelope(offset: str, op: str, ts_ms: str, before: str, after: str) -> str:
    flat = (
        f"""'{{"op":"' || {op} || '","ts_ms":' || {ts_ms} || ',"before":' ||
        CASE WHEN {op} = 'd' THEN {before} ELSE 'null' END || ',"after":' ||
        CASE WHEN {op} = 'd' THEN 'null' ELSE {after} END || '}}'"""
    )
    return f"""CASE WHEN {offset} % 2 = 0 THEN {flat} ELSE '{{"payload":' || {flat} || '}}' END"""


CUSTOMER_KEY = f"""'{{"customer_id":' || {_text('customer_id')} || '}}'"""
CUSTOMER_IMAGE = f"""'{{"customer_id":' || {_text('customer_id')} || ',"customer_unique_id":' ||
   {_text('customer_unique_id')} || ',"customer_city":' || {_text('customer_city')} || ',"customer_state":' ||
   {_text('customer_state')} || '}}'"""
ORDER_KEY = f"""'{{"order_id":' || {_text('order_id')} || '}}'"""
ORDER_BEFORE = f"""'{{"order_id":' || {_text('order_id')} || ',"customer_id":' || {_text('customer_id')} || '}}'"""
ORDER_IMAGE = f"""'{{"order_id":' || {_text('order_id')} || ',"customer_id":' || {_text('customer_id')} ||
   ',"order_status":' || {_text('order_status')} || '}}'"""
PRODUCT_KEY = """'{"product_id":"p_' || p_partkey || '"}'"""
PRODUCT_IMAGE = """'{"product_id":"p_' || p_partkey || '","product_category":"' || p_type ||
   '","product_weight_g":' || p_size || '}'"""
ITEM_KEY = """'{"order_id":"o_' || l_orderkey || '","order_item_id":' || l_linenumber || '}'"""
ITEM_IMAGE = """'{"order_id":"o_' || l_orderkey || '","order_item_id":' || l_linenumber ||
   ',"product_id":"p_' || l_partkey || '","price":"' || CAST(l_extendedprice AS DECIMAL(10,2)) ||
   '","shipping_limit_dt":' || epoch_us(l_shipdate) || '}'"""

BRONZE = f"""WITH {CDC}, {CDC_O}, stamp AS (SELECT event_id, epoch_us(ts) AS us FROM events)
SELECT 'shop.public.customers' AS topic, {CUSTOMER_KEY} AS k,
   {_envelope('kafka_offset', 'op', 'ts_ms', CUSTOMER_KEY, CUSTOMER_IMAGE)} AS v,
   us AS kafka_ts_us, kafka_partition, kafka_offset FROM cdc JOIN stamp ON kafka_offset = event_id
UNION ALL
SELECT 'shop.public.orders', {ORDER_KEY},
   {_envelope('kafka_offset', 'op', 'ts_ms', ORDER_BEFORE, ORDER_IMAGE)},
   us, 0, kafka_offset FROM cdc_o JOIN stamp ON kafka_offset = event_id
UNION ALL
SELECT 'shop.public.products', {PRODUCT_KEY},
   {_envelope('p_partkey', "'r'", 'p_partkey * 1000', PRODUCT_KEY, PRODUCT_IMAGE)},
   p_partkey * 1000000, CAST(p_partkey % 4 AS INTEGER), p_partkey FROM part
UNION ALL
SELECT 'shop.public.order_items', {ITEM_KEY},
   {_envelope('(l_orderkey * 10 + l_linenumber)', "'c'", '(epoch_us(l_shipdate) // 1000)', ITEM_KEY, ITEM_IMAGE)},
   epoch_us(l_shipdate), CAST(l_orderkey % 4 AS INTEGER), l_orderkey * 10 + l_linenumber FROM lineitem"""


# --- suites: (expectation, column, observed, elements, missing, unexpected, success) --------

def _suite(name: str, source: str, checks: list[tuple[str, str, str, str, str, str, str]]) -> str:
    rows = []
    for position, (kind, column, observed, elements, missing, unexpected, success) in enumerate(checks, 1):
        rows.append(
            f"SELECT '{name}' AS suite, CAST({position} AS INTEGER) AS position, 'expect_{kind}' AS expectation, "
            f"'{column}' AS \"column\", CAST({observed} AS BIGINT) AS observed_value, "
            f"CAST({elements} AS BIGINT) AS element_count, CAST({missing} AS BIGINT) AS missing_count, "
            f"CAST({unexpected} AS BIGINT) AS unexpected_count, {success} AS success FROM {source}"
        )
    return " UNION ALL ".join(rows)


def _null(column: str):
    bad = f"count(*) FILTER ({column} IS NULL)"
    return ("column_values_to_not_be_null", column, "NULL", "count(*)", bad, bad, f"{bad} = 0")


def _breaks(kind: str, column: str, broken: str):
    bad = f"count(*) FILTER ({column} IS NOT NULL AND {broken})"
    return (kind, column, "NULL", "count(*)", f"count(*) FILTER ({column} IS NULL)", bad, f"{bad} = 0")


def _once(kind: str, columns: str, key: str, source: str):
    texts = ", ".join(f"CAST({k} AS VARCHAR)" for k in key.split(","))
    bad = f"""(SELECT coalesce(sum(c), 0) FROM (SELECT {key}, count(*) AS c FROM {source}
      GROUP BY {key}) WHERE c > 1 AND coalesce({texts}) IS NOT NULL)"""
    missing = " AND ".join(f"{k} IS NULL" for k in key.split(","))
    return (kind, columns, "NULL", "count(*)", f"count(*) FILTER ({missing})", bad, f"{bad} = 0")


def _rows(low: int):
    return ("table_row_count_to_be_between", "", "count(*)", "NULL", "NULL", "NULL", f"count(*) >= {low}")


def _exists(column: str):
    return ("column_to_exist", column, "NULL", "NULL", "NULL", "NULL", "count(*) >= 0")


FACT_SET = """('created','approved','invoiced','shipped','delivered','canceled','processing','unavailable',
 'in_review','returned')"""
AGG_SET = "('created','approved','delivered','canceled','invoiced','shipped','processing')"


def _silver_checks(source: str):
    return [
        _null("customer_id"), _once("column_values_to_be_unique", "customer_id", "customer_id", source),
        _breaks("column_values_to_match_regex", "customer_state",
                "NOT regexp_full_match(customer_state, '[A-Z]{2}')"),
        _rows(1),
    ]


def _fact_checks(source: str):
    return [
        _rows(1), _null("order_id"), _null("customer_id"),
        _once("column_values_to_be_unique", "order_id", "order_id", source), _null("order_status"),
        _breaks("column_values_to_be_in_set", "order_status", f"order_status NOT IN {FACT_SET}"),
        _null("event_date"),
        ("column_unique_value_count_to_be_between", "event_date", "count(DISTINCT event_date)", "count(*)",
         "NULL", "NULL", "count(DISTINCT event_date) >= 1"),
        _null("event_ts_ms"), _breaks("column_values_to_be_between", "event_ts_ms", "event_ts_ms < 0"),
    ]


def _agg_checks(source: str):
    return [
        _rows(0), _exists("event_date"), _exists("order_status"), _exists("order_cnt"),
        _null("event_date"), _null("order_status"),
        _breaks("column_values_to_be_between", "order_cnt", "order_cnt < 0"),
        _breaks("column_values_to_be_in_set", "order_status", f"order_status NOT IN {AGG_SET}"),
        _once("compound_columns_to_be_unique", "event_date,order_status", "event_date,order_status", source),
    ]


SILVER_SUITE = _suite("silver_customers", "silver", _silver_checks("silver"))
AGG_SUITE = _suite("agg_orders_daily", "agg", _agg_checks("agg"))
FACT_SUITE = _suite("fact_orders", "fact", _fact_checks("fact"))
BULK_SUITE = _suite("fact_orders", "bulk_fact", _fact_checks("bulk_fact"))
AGG = """agg AS (SELECT event_date, order_status, CAST(count(*) AS BIGINT) AS order_cnt FROM fact GROUP BY ALL)"""


def _counts(source: str) -> str:
    return f"SELECT event_date, order_status, CAST(count(*) AS BIGINT) AS order_cnt FROM {source} GROUP BY ALL"


def _both_counts(ours: str, kept: str) -> str:
    return f"""SELECT coalesce(a.event_date, b.event_date) AS event_date,
  coalesce(a.order_status, b.order_status) AS order_status, a.order_cnt AS cnt_fact, b.order_cnt AS cnt_agg
 FROM ({ours}) a FULL JOIN ({kept}) b
   ON a.event_date IS NOT DISTINCT FROM b.event_date AND a.order_status IS NOT DISTINCT FROM b.order_status
 WHERE coalesce(a.order_cnt, 0) <> coalesce(b.order_cnt, 0)"""


BEFORE_LAST = "batch_no < (SELECT b FROM last)"
NEWEST = "batch_no = (SELECT b FROM last)"

# The dimension as four micro-batches leave it: the slices the streamed query lands.
SLICED = f"""{CDC.replace("event_id // 1000 AS batch_no",
    "event_id // (SELECT max(event_id) // 4 + 1 FROM events) AS batch_no")}, {DIM}"""

ORACLE: dict[str, str] = {
    "cdc_events_by_topic": f"""
        SELECT topic, op, CAST(count(*) AS BIGINT) AS events, min(off) AS first_offset, max(off) AS last_offset
        FROM (SELECT 'shop.public.customers' AS topic, {OP} AS op, event_id AS off FROM events
          UNION ALL SELECT 'shop.public.orders', {OP}, event_id FROM events
          UNION ALL SELECT 'shop.public.products', 'r', p_partkey FROM part
          UNION ALL SELECT 'shop.public.order_items', 'c', l_orderkey * 10 + l_linenumber FROM lineitem)
        GROUP BY topic, op""",
    "bronze_projection": BRONZE,
    "parse_customers": f"WITH {CDC} SELECT {CUSTOMER_COLUMNS} FROM cdc",
    "parse_orders": f"WITH {CDC_O} SELECT {ORDER_COLUMNS} FROM cdc_o",
    "parse_products": """SELECT 'r' AS op, p_partkey * 1000 AS ts_ms, 'p_' || p_partkey AS product_id,
        p_type AS product_category, CAST(p_size AS INTEGER) AS product_weight_g, p_partkey AS kafka_offset
        FROM part""",
    "parse_order_items": """SELECT 'c' AS op, CAST(epoch_us(l_shipdate) // 1000 AS BIGINT) AS ts_ms,
        'o_' || l_orderkey AS order_id, CAST(l_linenumber AS INTEGER) AS order_item_id,
        'p_' || l_partkey AS product_id, CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
        CAST(l_shipdate AS DATE) AS shipping_limit_date, l_orderkey * 10 + l_linenumber AS kafka_offset
        FROM lineitem""",
    "valid_customers": f"WITH {CDC} SELECT {CUSTOMER_COLUMNS} FROM valid",
    "valid_orders": f"WITH {CDC_O} SELECT {ORDER_COLUMNS} FROM valid_o",
    "quarantine_customers": f"""WITH {CDC} SELECT {CUSTOMER_COLUMNS} FROM cdc
        WHERE kafka_offset NOT IN (SELECT kafka_offset FROM valid)""",
    "quarantine_dim": f"""WITH {CDC} SELECT {CUSTOMER_COLUMNS} FROM cdc
        WHERE customer_id IS NOT NULL AND kafka_offset NOT IN (SELECT kafka_offset FROM valid)""",
    "quarantine_orders": f"""WITH {CDC_O} SELECT {ORDER_COLUMNS} FROM cdc_o
        WHERE kafka_offset NOT IN (SELECT kafka_offset FROM valid_o)""",
    "dedupe_stream_order": f"WITH {CDC} {_latest(STREAM_ORDER, 'valid', 'customer_id', CUSTOMER_COLUMNS)}",
    "dedupe_delete_wins": f"WITH {CDC} {_latest(DELETE_WINS, 'valid', 'customer_id', CUSTOMER_COLUMNS)}",
    "dedupe_orders": f"WITH {CDC_O} {_latest(DELETE_WINS, 'valid_o', 'order_id', ORDER_COLUMNS)}",
    "silver_customers": SILVER,
    "silver_customers_merge": SILVER,
    "silver_customers_late": SILVER,
    "silver_customers_guarded": f"""WITH {CDC},
        late AS (SELECT * FROM ({_latest(STREAM_ORDER, f'valid WHERE {BEFORE_LAST}', 'customer_id', '*')})
                 WHERE op <> 'd'),
        newest AS (SELECT * FROM ({_latest(STREAM_ORDER, f'valid WHERE {NEWEST}', 'customer_id', '*')})
                   WHERE op <> 'd')
        SELECT customer_id, customer_unique_id, customer_city, customer_state, ts_ms AS _last_ts_ms FROM newest
        UNION ALL
        SELECT customer_id, customer_unique_id, customer_city, customer_state, ts_ms FROM late
        WHERE customer_id NOT IN (SELECT customer_id FROM newest)""",
    "fact_orders": f"WITH {CDC_O}, {FACT} SELECT {FACT_COLUMNS} FROM fact",
    "fact_orders_late": f"WITH {CDC_O}, {FACT} SELECT {FACT_COLUMNS} FROM fact",
    "fact_orders_merge": f"WITH {CDC_O}, {FACT} SELECT {FACT_COLUMNS} FROM fact",
    "scd2_changes": f"WITH {COMPARED} SELECT op, ts_ms, customer_id, has_current, differs FROM cmp",
    "scd2_close": f"""WITH {COMPARED},
        ends AS (SELECT customer_id, ts_ms FROM cmp
                 WHERE op = 'd' OR (op IN ('c','u','r') AND has_current AND differs))
        SELECT dim.customer_id, customer_unique_id, customer_city, customer_state, effective_start_ts_ms,
          CASE WHEN is_current AND ends.customer_id IS NOT NULL THEN ends.ts_ms
               ELSE effective_end_ts_ms END AS effective_end_ts_ms,
          is_current AND ends.customer_id IS NULL AS is_current
        FROM dim LEFT JOIN ends ON dim.customer_id = ends.customer_id""",
    "scd2_open": f"""WITH {COMPARED} SELECT {DIM_COLUMNS} FROM dim UNION ALL
        SELECT customer_id, customer_unique_id, customer_city, customer_state, ts_ms, NULL, true FROM cmp
        WHERE op IN ('c','u','r') AND (NOT has_current OR differs)""",
    "dim_customers_scd2": f"WITH {CDC}, {DIM} SELECT {DIM_COLUMNS} FROM dim",
    "dim_customers_scd2_merge": f"WITH {CDC}, {DIM} SELECT {DIM_COLUMNS} FROM dim",
    "dim_customers_every_change": f"""WITH {CDC}, dim_b AS (SELECT * FROM valid),
        {_turns('dim', 'kafka_offset')} SELECT {DIM_COLUMNS} FROM dim""",
    "dim_customers_late": f"""WITH {CDC}, dim_b AS (SELECT * FROM valid),
        {_turns('dim', "ts_ms, CASE WHEN op = 'd' THEN 1 ELSE 0 END, kafka_partition, kafka_offset")} SELECT {DIM_COLUMNS} FROM dim""",
    "dim_current": f"WITH {CDC}, {DIM} SELECT {DIM_COLUMNS} FROM dim WHERE is_current",
    "change_feed": f"""WITH {CDC_O}, {FEED} SELECT {FACT_COLUMNS}, _change_type, _commit_version FROM feed""",
    "change_feed_merge": f"""WITH {CDC}, {CDC_O}, {FEED} SELECT {FACT_COLUMNS}, _change_type FROM feed
        WHERE _commit_version = (SELECT b FROM last)""",
    "change_deltas": f"""WITH {CDC_O}, {FEED} SELECT event_date, order_status, CAST(sum(
          CASE WHEN _change_type IN ('insert', 'update_postimage') THEN 1 ELSE -1 END) AS BIGINT) AS delta_cnt
        FROM feed GROUP BY ALL""",
    "agg_orders_daily": f"WITH {CDC_O}, {FACT} {_counts('fact')}",
    "agg_orders_daily_next": f"""WITH {CDC}, {CDC_O}, {FACT}, {_fact('fact0', BEFORE_LAST)},
        g AS (SELECT event_date, order_status FROM fact UNION SELECT event_date, order_status FROM fact0)
        SELECT g.event_date, g.order_status, CAST(coalesce(n, 0) AS BIGINT) AS order_cnt FROM g
        LEFT JOIN (SELECT event_date, order_status, count(*) AS n FROM fact GROUP BY ALL) f
          ON g.event_date IS NOT DISTINCT FROM f.event_date
         AND g.order_status IS NOT DISTINCT FROM f.order_status""",
    "agg_orders_daily_seed": f"WITH {CDC_O}, {FACT} {_counts('fact')}",
    "fact_daily_counts": f"WITH {BULK} {_counts('bulk_fact')}",
    "reconcile": f"""WITH {BULK}, good AS ({_counts('bulk_fact')})
        {_both_counts('SELECT * FROM good', '''SELECT event_date, order_status,
           order_cnt + CASE WHEN order_status = 'P' THEN 1 ELSE 0 END AS order_cnt
           FROM good WHERE order_status <> 'F' ''')}""",
    "reconcile_cdc": f"""WITH {CDC}, {CDC_O}, {FACT}, {_fact('fact0', BEFORE_LAST)}
        {_both_counts(_counts('fact'), _counts('fact0'))}""",
    "mart_daily_orders": f"""WITH {CDC}, {DIM}, {CDC_O}, {FACT}
        SELECT event_date, customer_state, order_status, CAST(count(*) AS BIGINT) AS order_count
        FROM fact LEFT JOIN (SELECT * FROM dim WHERE is_current) d ON fact.customer_id = d.customer_id
        GROUP BY ALL""",
    "mart_orders_by_state": f"""WITH {CDC}, {DIM}, {CDC_O}, {FACT}
        SELECT event_date, customer_state, CAST(count(*) AS BIGINT) AS orders_cnt
        FROM fact LEFT JOIN (SELECT * FROM dim WHERE is_current) d ON fact.customer_id = d.customer_id
        GROUP BY ALL""",
    "orders_enriched": f"""WITH {CDC}, {DIM}, {CDC_O}, {FACT}, {_fact('fact0', BEFORE_LAST)},
        everyone AS (SELECT * FROM fact UNION ALL
                     SELECT * FROM fact0 WHERE order_id NOT IN (SELECT order_id FROM fact))
        SELECT order_id, e.customer_id, order_status, event_ts_ms, event_date, customer_city, customer_state
        FROM everyone e LEFT JOIN (SELECT * FROM dim WHERE is_current) d ON e.customer_id = d.customer_id""",
    "mart_daily_orders_bulk": f"""WITH {BULK}
        SELECT event_date, customer_state, order_status, CAST(count(*) AS BIGINT) AS order_count
        FROM bulk_fact f LEFT JOIN bulk_dim d ON f.customer_id = d.customer_id GROUP BY ALL""",
    "mart_orders_by_state_bulk": f"""WITH {BULK}
        SELECT event_date, customer_state, CAST(count(*) AS BIGINT) AS orders_cnt
        FROM bulk_fact f LEFT JOIN bulk_dim d ON f.customer_id = d.customer_id GROUP BY ALL""",
    "orders_enriched_bulk": f"""WITH {BULK}
        SELECT order_id, f.customer_id, order_status, event_ts_ms, event_date, customer_city, customer_state
        FROM bulk_fact f LEFT JOIN bulk_dim d ON f.customer_id = d.customer_id""",
    "dml_insert": f"""WITH {BULK} SELECT {FACT_COLUMNS} FROM bulk_fact UNION ALL
        SELECT 'new_' || customer_id, customer_id, 'created', 1756860199471, DATE '2025-09-03' FROM bulk_dim""",
    "dml_update": f"""WITH {BULK} SELECT order_id, customer_id,
        CASE WHEN hit THEN 'was_' || order_status ELSE order_status END AS order_status,
        CASE WHEN hit THEN event_ts_ms + 1 ELSE event_ts_ms END AS event_ts_ms, event_date
        FROM (SELECT *, order_status = 'P' OR event_date < DATE '1995-01-01' AS hit FROM bulk_fact)""",
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}"
        for t in (
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
            "pages", "benchmark", "labels", "conversations",
        )
    ),
    "suite_silver_customers": f"WITH silver AS ({SILVER}) {SILVER_SUITE}",
    "suite_fact_orders": f"WITH {CDC_O}, {FACT} {FACT_SUITE}",
    "suite_agg_orders_daily": f"WITH {CDC_O}, {FACT}, {AGG} {AGG_SUITE}",
    "suite_bulk_orders": f"WITH {BULK} {BULK_SUITE}",
    "suite_unexpected_values": f"""WITH {CDC}
        SELECT 'expect_column_values_to_match_regex' AS expectation, 'customer_state' AS "column",
          customer_state AS value, CAST(count(*) AS BIGINT) AS count FROM cdc
        WHERE customer_state IS NOT NULL AND NOT regexp_full_match(customer_state, '[A-Z]{{2}}') GROUP BY ALL
        UNION ALL
        SELECT 'expect_column_values_to_be_unique', 'customer_id', customer_id, CAST(count(*) AS BIGINT)
        FROM cdc WHERE customer_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
    "suite_statistics": f"""WITH silver AS ({SILVER}), {CDC_O}, {FACT}, {AGG}, {BULK},
        results AS ({SILVER_SUITE} UNION ALL {AGG_SUITE} UNION ALL {BULK_SUITE})
        SELECT suite, count(*) AS evaluated_expectations,
          count(*) FILTER (success) AS successful_expectations,
          count(*) FILTER (NOT success) AS unsuccessful_expectations,
          100.0::DOUBLE * count(*) FILTER (success) / count(*) AS success_percent,
          bool_and(success) AS success FROM results GROUP BY suite""",
    "scalar_json": """SELECT event_id, json_extract_string(props, '$.k') AS k_text,
        CAST(NULL AS VARCHAR) AS absent, json_extract_string(props, '$.k') AS first_found,
        CAST(NULL AS VARCHAR) AS malformed FROM events""",
    "scalar_cast": """SELECT event_id, CAST(trunc(value) AS BIGINT) AS whole, CAST(NULL AS BIGINT) AS junk,
        CAST(json_extract_string(props, '$.k') AS BIGINT) * 2 + 1 AS odd,
        CAST(user_id AS VARCHAR) AS user_text, CAST(user_id AS INTEGER) AS user_int,
        CAST(event_id AS DOUBLE) / 4 AS quarter FROM events""",
    "scalar_predicates": """
        WITH r AS (SELECT event_id, event_type AS kind, k,
            CASE WHEN k % 3 <> 0 THEN upper(substr(event_type, 1, 2)) END AS state
            FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)),
        m AS (SELECT *, regexp_full_match(state, '[A-Z]{2}') AS matches FROM r)
        SELECT event_id, matches, kind IN ('click', 'view') AS in_list, matches AND k > 50 AS and_null,
          matches OR k > 50 AS or_null, state <> 'CL' AS not_equal, state IS NULL AS missing,
          CASE WHEN k < 10 THEN 'low' WHEN k < 50 THEN 'mid' END AS bucket,
          coalesce(state, '') AS state_or_blank FROM m""",
    "scalar_event_date": """SELECT event_id, CAST(ts AS DATE) AS utc_date,
        CAST(ts - INTERVAL 5 HOUR AS DATE) AS bogota_date, CAST(ts + INTERVAL 9 HOUR AS DATE) AS tokyo_date
        FROM events""",
}

for streamed, same in {
    "reconcile_tree": "reconcile", "mart_daily_orders_next": "mart_daily_orders", "quarantine_stream": "quarantine_customers", "mart_by_name": "mart_daily_orders",
    "bronze_ingest": "bronze_projection", "silver_customers_stream": "silver_customers",
    "fact_orders_stream": "fact_orders", "agg_orders_daily_stream": "agg_orders_daily",
    "agg_orders_daily_native": "agg_orders_daily", "agg_orders_daily_snapshot": "agg_orders_daily",
    "customer_history_stream": "dim_customers_late",
}.items():
    ORACLE[streamed] = ORACLE[same]
ORACLE["dim_customers_stream"] = f"WITH {SLICED} SELECT {DIM_COLUMNS} FROM dim"
