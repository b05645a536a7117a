"""SQL twins of the registered queries, for DuckDB over the same Parquet tables."""

from __future__ import annotations

import re

# Input tables as common table expressions; each query gets the ones it needs.
INPUTS = {
    "behavior_events": """
        SELECT event_id, user_id + 1 AS user_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) + 1 AS item_id,
          CASE event_type WHEN 'view' THEN 'VIEW' WHEN 'click' THEN 'CLICK' WHEN 'signup' THEN 'ADD_TO_CART'
            WHEN 'purchase' THEN 'PURCHASE' ELSE 'RATE' END AS behavior_type,
          CASE WHEN event_type = 'error' THEN CAST(1.0 + (event_id % 9) * 0.5 AS DOUBLE) END AS rating,
          ts AS event_time
        FROM events""",
    "scored_events": """
        SELECT *, CAST(CASE behavior_type WHEN 'VIEW' THEN 1.0 WHEN 'CLICK' THEN 1.0 WHEN 'ADD_TO_CART' THEN 3.0
            WHEN 'PURCHASE' THEN 5.0
            WHEN 'RATE' THEN greatest(0.0, least(4.0, coalesce(rating, 1.0) - 1.0)) ELSE 0.0 END AS DOUBLE) AS score
        FROM behavior_events""",
    "item_catalog": """
        SELECT p_partkey + 1 AS item_id, p_name AS name, p_type AS category,
          CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_brand AS tags FROM part WHERE p_partkey % 10 <> 7""",
    "user_profiles": """
        SELECT c_custkey + 1 AS user_id, c_name AS nickname,
          CASE c_custkey % 3 WHEN 0 THEN 'MALE' WHEN 1 THEN 'FEMALE' ELSE 'UNKNOWN' END AS gender,
          CASE WHEN c_custkey % 4 <> 0 THEN '25-34' END AS age_range,
          CASE WHEN c_custkey % 5 <> 0 THEN 'N' || c_nationkey END AS region,
          CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS preference_tags FROM customer""",
    "deltas_30s": """
        SELECT time_bucket(INTERVAL 30 SECOND, event_time) AS window_start,
          time_bucket(INTERVAL 30 SECOND, event_time) + INTERVAL 30 SECOND AS window_end, user_id, item_id,
          round(sum(score), 2) AS score_delta, count(*) AS interaction_delta
        FROM scored_events GROUP BY ALL HAVING round(sum(score), 2) > 0""",
    "deltas_day": """
        SELECT date_trunc('day', event_time) AS window_start,
          date_trunc('day', event_time) + INTERVAL 1 DAY AS window_end, user_id, item_id,
          round(sum(score), 2) AS score_delta, count(*) AS interaction_delta
        FROM scored_events GROUP BY ALL HAVING round(sum(score), 2) > 0""",
    "batched_deltas": "SELECT *, CAST(day(window_start) AS BIGINT) AS batch_id FROM deltas_day",
    "aggregates_day": """
        SELECT CAST(date_trunc('day', event_time) AS TIMESTAMP) AS window_start,
          CAST(date_trunc('day', event_time) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end, user_id, behavior_type,
          count(*) AS event_count, round(avg(rating), 2) AS avg_rating
        FROM behavior_events GROUP BY ALL""",
    "preference": """
        SELECT user_id, item_id, sum(score_delta) AS preference_score, CAST(sum(interaction_delta) AS BIGINT)
          AS interaction_count, min(window_start) AS last_window_start, max(window_end) AS last_window_end
        FROM deltas_30s GROUP BY 1, 2""",
    "preference_day": """
        SELECT user_id, item_id, sum(score_delta) AS preference_score, CAST(sum(interaction_delta) AS BIGINT)
          AS interaction_count, min(window_start) AS last_window_start, max(window_end) AS last_window_end
        FROM deltas_day GROUP BY 1, 2""",
    "recall": """
        SELECT v.model_version, p.user_id - 1 AS user_id, p.item_id, p.preference_score AS score,
          CAST(row_number() OVER (PARTITION BY v.model_version, p.user_id ORDER BY p.preference_score DESC, p.item_id) AS INTEGER)
            AS rank_position
        FROM (VALUES ('als_v0'), ('als_v1'), ('als_v2')) v(model_version), preference p""",
    "summary_7d": """
        SELECT user_id, behavior_type, CAST(sum(event_count) AS BIGINT) AS total_count FROM aggregates_day
        WHERE window_start >= TIMESTAMP '2024-01-24' GROUP BY 1, 2""",
    "patterns": """
        SELECT user_id, CAST(sum(total_count) AS BIGINT) AS total,
          CAST(coalesce(sum(total_count) FILTER (behavior_type IN ('VIEW', 'CLICK')), 0) AS BIGINT) AS browsing,
          CAST(coalesce(sum(total_count) FILTER (behavior_type = 'PURCHASE'), 0) AS BIGINT) AS purchases,
          CASE WHEN CAST(browsing AS DOUBLE) / total > 0.7 THEN 'COMPARER'
            WHEN CAST(purchases AS DOUBLE) / total > 0.3 THEN 'DECISIVE' ELSE 'EXPLORER' END AS pattern
        FROM summary_7d GROUP BY 1""",
    "order_events": """
        SELECT o_orderkey * 2 + d AS seq, 'evt-' || o_orderkey AS event_id, 'ORD-' || o_orderkey AS order_id,
          o_custkey AS user_id,
          CASE o_orderstatus WHEN 'O' THEN 'PAID' WHEN 'F' THEN 'COMPLETED' ELSE 'CREATED' END AS status,
          CAST(CASE WHEN o_orderkey % 97 = 0 THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(18,2)) AS amount,
          CASE o_orderkey % 5 WHEN 0 THEN 'CNY' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' WHEN 3 THEN 'JPY' ELSE 'GBP' END
            AS currency, o_orderdate AS occurred_at
        FROM orders, (VALUES (0), (1)) x(d) WHERE d = 0 OR o_orderkey % 7 = 0""",
    "rates": """
        SELECT * FROM (VALUES ('CNY', 1.000), ('USD', 7.200), ('EUR', 7.850), ('JPY', 0.048)) r(currency, rate)""",
    "order_fates": """
        SELECT e.*, r.rate,
          CASE WHEN amount < 0 THEN 'DEAD_LETTER'
            WHEN row_number() OVER (PARTITION BY event_id, amount < 0 ORDER BY seq) > 1 THEN 'DUPLICATE'
            WHEN r.rate IS NULL THEN 'DEAD_LETTER' ELSE 'PROCESSED' END AS outcome,
          CASE WHEN amount < 0 THEN 'DESERIALIZE_FAIL: NegativeAmount'
            ELSE 'PERMANENT: unsupported currency ' || e.currency END AS error_reason
        FROM order_events e LEFT JOIN rates r USING (currency)""",
    "raw_payloads": """
        SELECT c_custkey * 2 + d AS seq, c_custkey + 1 AS supplier_id, c_custkey, c_nationkey,
          CASE c_custkey % 3 WHEN 0 THEN 'KD_' WHEN 1 THEN 'YY_' ELSE 'GEN_' END || c_custkey AS supplier_code,
          CASE c_custkey % 3 WHEN 0 THEN 'KINGDEE' WHEN 1 THEN 'YONYOU' ELSE 'GENERIC' END AS erp_type,
          CASE WHEN c_custkey % 10 = 9 THEN '{"code":500,"message":"mock error"}'
            WHEN c_custkey % 3 = 0 THEN '[["FID-' || c_custkey || '","' || c_name || '-' || d || '","SUP-' || c_custkey
              || '","' || CASE WHEN c_nationkey % 2 = 0 THEN 'A' ELSE 'B' END || '","2024-01-01 00:00:00"]]'
            WHEN c_custkey % 3 = 1 THEN '{"code":0,"data":{"rows":[{"code":"SUP-' || c_custkey || '","name":"'
              || c_name || '-' || d || '","status":"' || CASE WHEN c_nationkey % 2 = 0 THEN '1' ELSE 'N' END || '"}]}}'
            ELSE '{"records":[{"id":' || c_custkey || ',"name":"' || c_name || '-' || d || '","status":"'
              || CASE c_nationkey % 3 WHEN 0 THEN 'valid' WHEN 1 THEN 'INVALID' ELSE 'odd' END || '"}]}' END
            AS raw_payload,
          'p' || c_custkey AS next_page_token,
          TIMESTAMP '2024-01-01' + (CASE WHEN c_custkey % 2 = 1 THEN -d ELSE d END) * INTERVAL 1 HOUR AS pulled_at
        FROM customer, (VALUES (0), (1)) x(d)""",
    "kingdee": """
        SELECT seq, supplier_id, supplier_code, erp_type, raw_payload ->> '$[0][0]' AS source_record_id,
          raw_payload ->> '$[0][2]' AS source_business_code, raw_payload ->> '$[0][1]' AS supplier_name,
          raw_payload ->> '$[0][3]' AS source_supplier_status,
          CASE WHEN raw_payload ->> '$[0][3]' = 'A' THEN 'ACTIVE' ELSE 'INACTIVE' END AS supplier_status,
          '' AS tax_no, raw_payload ->> '$[0][4]' AS source_modified_at, '' AS page_token, next_page_token, pulled_at,
          CAST(raw_payload -> '$[0]' AS VARCHAR) AS raw_item_json
        FROM raw_payloads WHERE erp_type = 'KINGDEE' AND raw_payload LIKE '[%'""",
    "yonyou": """
        SELECT seq, supplier_id, supplier_code, erp_type, r ->> '$.code' AS source_record_id,
          r ->> '$.code' AS source_business_code, r ->> '$.name' AS supplier_name,
          r ->> '$.status' AS source_supplier_status,
          CASE r ->> '$.status' WHEN '1' THEN 'ACTIVE' ELSE 'INACTIVE' END AS supplier_status, '' AS tax_no,
          '' AS source_modified_at, '' AS page_token, next_page_token, pulled_at, CAST(r AS VARCHAR) AS raw_item_json
        FROM (SELECT *, raw_payload -> '$.data.rows[0]' AS r FROM raw_payloads
              WHERE erp_type = 'YONYOU' AND raw_payload LIKE '{"code":0%')""",
    "generic": """
        SELECT seq, supplier_id, supplier_code, erp_type, r ->> '$.id' AS source_record_id,
          r ->> '$.id' AS source_business_code, r ->> '$.name' AS supplier_name,
          r ->> '$.status' AS source_supplier_status,
          CASE r ->> '$.status' WHEN 'valid' THEN 'ACTIVE' WHEN 'INVALID' THEN 'INACTIVE' ELSE 'UNKNOWN' END
            AS supplier_status, '' AS tax_no, '' AS source_modified_at, '' AS page_token, next_page_token, pulled_at,
          CAST(r AS VARCHAR) AS raw_item_json
        FROM (SELECT *, raw_payload -> '$.records[0]' AS r FROM raw_payloads
              WHERE erp_type = 'GENERIC' AND raw_payload LIKE '{"records"%')""",
    "supplier_records": "SELECT * FROM kingdee UNION ALL SELECT * FROM yonyou UNION ALL SELECT * FROM generic",
    "record_fates": """
        SELECT *, CASE WHEN pulled_at < max(pulled_at) OVER (PARTITION BY supplier_id, erp_type, source_record_id
            ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
          THEN 'STALE_SKIPPED' ELSE 'UPSERTED' END AS outcome FROM supplier_records""",
    "bad_payloads": """
        SELECT *, CASE erp_type WHEN 'KINGDEE' THEN 'Expected JSON array as root'
            WHEN 'YONYOU' THEN 'YONYOU response code is not success: 500'
            ELSE 'GENERIC records node is missing or invalid' END AS error
        FROM raw_payloads WHERE raw_payload LIKE '{"code":500%'""",
    "pull_audit": """
        SELECT event_id AS audit_id, user_id + 1 AS supplier_id,
          CASE event_type WHEN 'error' THEN 'FAILURE' WHEN 'signup' THEN 'SKIPPED_DUPLICATE' ELSE 'SUCCESS' END
            AS outcome, CAST(floor(value * 10) AS BIGINT) AS duration_ms, ts AS executed_at FROM events""",
    "connections": """
        SELECT c_custkey + 1 AS supplier_id, c_custkey AS k,
          CASE c_custkey % 3 WHEN 0 THEN 'KD_' WHEN 1 THEN 'YY_' ELSE 'GEN_' END || c_custkey AS supplier_code,
          CASE c_custkey % 11 WHEN 0 THEN 'SUSPENDED' WHEN 1 THEN 'PAUSED' ELSE 'ACTIVE' END AS status,
          CAST(300 + (c_custkey % 4) * 300 AS INTEGER) AS pull_interval_seconds,
          TIMESTAMP '2024-01-31' + ((c_custkey * 37) % 1440 - 720) * INTERVAL 1 MINUTE AS next_pull_at,
          '2024-01-01|' || (c_custkey % 50) AS last_cursor, CAST(c_custkey % 8 AS INTEGER) AS retry_count,
          CASE c_custkey % 6 WHEN 0 THEN TIMESTAMP '2024-01-31 00:05:00' WHEN 1 THEN TIMESTAMP '2024-01-30 23:55:00' END
            AS lease_until, c_custkey % 3 AS version FROM customer""",
    "pull_outcomes": """
        SELECT c_custkey + 1 AS supplier_id, c_custkey % 3 + CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END AS version,
          CASE c_custkey % 6 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'SUCCESS' WHEN 2 THEN 'AUTH_FAILURE'
            WHEN 3 THEN 'RATE_LIMITED' WHEN 4 THEN 'TIMEOUT' ELSE 'DATA_ERROR' END AS outcome,
          TIMESTAMP '2024-01-31' + (c_custkey % 60) * INTERVAL 1 SECOND AS finished_at,
          '2024-01-31|' || (c_custkey % 50 + 1) AS next_cursor,
          CASE WHEN c_custkey % 2 = 1 THEN TIMESTAMP '2024-01-31 00:10:00' END AS retry_after FROM customer""",
    "payment_requests": """
        SELECT o_orderkey AS order_no, o_orderkey * 2 + d AS seq, o_custkey AS user_id,
          'idem-' || o_orderkey || CASE WHEN d = 1 AND o_orderkey % 15 = 0 THEN '-x' ELSE '' END AS idempotency_key,
          CAST(round(o_totalprice * 100) AS BIGINT) AS amount_fen
        FROM orders, (VALUES (0), (1)) x(d) WHERE d = 0 OR o_orderkey % 3 = 0""",
    "payment_orders": """
        SELECT o_orderkey AS order_no, CASE WHEN o_orderkey % 101 <> 0 THEN 'idem-' || o_orderkey ELSE ' ' END
            AS idempotency_key,
          CASE o_orderkey % 4 WHEN 0 THEN 'UNPAID' WHEN 1 THEN 'PAYING' WHEN 2 THEN 'SUCCESS' ELSE 'CLOSED' END AS status,
          CASE WHEN o_orderkey % 4 = 2 AND o_orderkey % 17 <> 2 THEN 'CH-' || o_orderkey END AS channel_trade_no,
          CASE WHEN o_orderkey % 4 IN (1, 2) AND o_orderkey % 13 <> 1 THEN o_orderdate END AS paying_started_at,
          CASE WHEN o_orderkey % 4 = 2 THEN o_orderdate END AS paid_at,
          CASE WHEN o_orderkey % 4 = 3 OR o_orderkey % 19 = 0 THEN o_orderdate END AS closed_at FROM orders""",
    "payment_log": """
        SELECT l_orderkey AS order_no, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,
            l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_discount) AS n,
          CASE l_partkey % 3 WHEN 0 THEN 'START' WHEN 1 THEN 'SUCCESS' ELSE 'CLOSE' END AS action,
          CASE l_partkey % 7 WHEN 0 THEN 'ORDER' WHEN 1 THEN 'PAY' WHEN 2 THEN 'CANCEL' WHEN 3 THEN 'EXPIRE'
            WHEN 4 THEN 'RELEASE' WHEN 5 THEN 'ORDER' ELSE 'PAY' END AS step
        FROM lineitem""",
    "reserve_requests": """
        SELECT event_id AS seq, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 20 AS sku_id, user_id + 1 AS user_id
        FROM events WHERE event_type IN ('view', 'click')""",
    "stock_moves": """
        SELECT sku_id, event_type, row_number() OVER (PARTITION BY sku_id ORDER BY event_id) AS n
        FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 20 AS sku_id FROM events)
        WHERE sku_id IN (SELECT sku_id FROM reserve_requests) AND sku_id <> 19""",
    "access_log": """
        SELECT event_id AS seq, '10.1.0.' || (user_id % 20) AS client, ts AS asked_at,
          CASE WHEN k % 10 = 0 THEN 'LOCALHOST' WHEN k % 10 = 1 THEN 'db' || k || '.local'
            ELSE 'db' || k || '.example.org' END AS host,
          CASE WHEN k % 11 = 4 THEN list_extract(['2001:4860:4860::8888', '::ffff:8.8.8.8', '2A00:1450:4001:80b::200e', '2001:::::1',
              '2002:7f00:1::', '::ffff:10.0.0.1', '::1', 'fe80::1'], k // 11 + 1)
            WHEN k = 99 THEN '169.254.169.254' ELSE CASE k % 7 WHEN 0 THEN '10.0.' WHEN 1 THEN '192.168.'
            WHEN 2 THEN '8.8.' WHEN 3 THEN '172.20.' WHEN 4 THEN '203.0.' WHEN 5 THEN '127.0.' ELSE '169.254.' END
            || (k % 13) || '.' || (k % 29) END AS address
        FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events)""",
}

# Inputs that a recursive query walks once per step: computed once and kept.
KEPT = {"payment_log", "stock_moves"}


def _needed(sql: str) -> list[str]:
    """Inputs a statement uses, directly or through other inputs, in dependency order."""
    found: list[str] = []
    for name, body in INPUTS.items():
        if re.search(rf"\b{name}\b", sql):
            for inner in [*_needed(body), name]:
                if inner not in found:
                    found.append(inner)
    return sorted(found, key=list(INPUTS).index)


def _with_inputs(sql: str) -> str:
    head = ", ".join(
        f"{name} AS {'MATERIALIZED ' if name in KEPT else ''}({INPUTS[name].strip()})" for name in _needed(sql))
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql, re.I)
    if own:
        recursive = "RECURSIVE " if own.group(1) else ""
        return f"WITH {recursive}{head + ', ' if head else ''}{sql[own.end():]}"
    return f"WITH {head} {sql}" if head else sql


def _number(expression: str) -> str:
    """Decimal without trailing zeros as text."""
    return f"regexp_replace(CAST(CAST({expression} AS DECIMAL(28,8)) AS VARCHAR), '\\.?0+$', '')"


_SUMMARY_ROW = """'{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
    || ',"c_mktsegment":"' || c_mktsegment || '"}'"""

SQL = {
    "window_behavior_agg": """
        SELECT time_bucket(INTERVAL 30 SECOND, event_time) AS window_start,
          time_bucket(INTERVAL 30 SECOND, event_time) + INTERVAL 30 SECOND AS window_end, user_id, behavior_type,
          count(*) AS event_count, round(avg(rating), 2) AS avg_rating
        FROM behavior_events GROUP BY ALL""",
    "window_behavior_agg_day": "SELECT * FROM aggregates_day",
    "window_item_score": "SELECT window_start, window_end, user_id, item_id, score_delta AS score FROM deltas_30s",
    "preference_delta": "SELECT * FROM deltas_30s",
    "preference_delta_day": """
        SELECT CAST(window_start AS TIMESTAMP) AS window_start, CAST(window_end AS TIMESTAMP) AS window_end, user_id,
          item_id, score_delta, interaction_delta FROM deltas_day""",
    "latest_window_topn": """
        WITH s AS (SELECT time_bucket(INTERVAL 6 HOUR, event_time) AS window_start, user_id, item_id,
            round(sum(score), 2) AS score FROM scored_events GROUP BY ALL HAVING round(sum(score), 2) > 0),
          l AS (SELECT *, max(window_start) OVER (PARTITION BY user_id) AS latest FROM s)
        SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, user_id, item_id, score,
          CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
        FROM l WHERE window_start = latest
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) <= 10""",
    "recommendation_items": """
        SELECT user_id, CAST(window_start AS TIMESTAMP) AS window_start, CAST(window_end AS TIMESTAMP) AS window_end,
          CAST(row_number() OVER (PARTITION BY user_id ORDER BY score_delta DESC, item_id) AS INTEGER) AS rank, item_id,
          score_delta AS score
        FROM (SELECT *, max(window_start) OVER (PARTITION BY user_id) AS latest FROM deltas_day)
        WHERE window_start = latest
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score_delta DESC, item_id) <= 10""",
    "recommendation_messages": """
        WITH r AS (SELECT user_id, window_start, window_end, item_id, score_delta,
            row_number() OVER (PARTITION BY user_id ORDER BY score_delta DESC, item_id) AS rank
          FROM (SELECT *, max(window_start) OVER (PARTITION BY user_id) AS latest FROM deltas_day)
          WHERE window_start = latest)
        SELECT CAST(user_id AS VARCHAR) AS key, '{"userId":' || user_id || ',"generatedAt":"2024-01-31T00:00:00.000"'
          || ',"windowStart":"' || strftime(any_value(window_start), '%Y-%m-%dT%H:%M:%S.000')
          || '","windowEnd":"' || strftime(any_value(window_end), '%Y-%m-%dT%H:%M:%S.000') || '","items":['
          || string_agg('{"rank":' || rank || ',"itemId":' || item_id || ',"score":' || score_delta || '}', ','
             ORDER BY rank) || ']}' AS value
        FROM r WHERE rank <= 10 GROUP BY user_id""",
    "window_agg_upsert": """
        SELECT window_start, window_end, user_id, behavior_type, avg_rating,
          event_count + CASE WHEN window_start >= TIMESTAMP '2024-01-15' THEN 1000 ELSE 0 END AS event_count
        FROM aggregates_day""",
    "preference_matrix": "SELECT * FROM preference",
    "preference_incremental": """
        SELECT user_id, item_id, preference_score, interaction_count, CAST(last_window_start AS TIMESTAMP)
          AS last_window_start, CAST(last_window_end AS TIMESTAMP) AS last_window_end FROM preference_day""",
    "high_water_mark": "SELECT coalesce(max(batch_id), 0) AS high_water_mark FROM batched_deltas",
    "delta_purge": """
        SELECT CAST(window_start AS TIMESTAMP) AS window_start, CAST(window_end AS TIMESTAMP) AS window_end, user_id,
          item_id, score_delta, interaction_delta, batch_id FROM batched_deltas
        WHERE NOT (window_end < TIMESTAMP '2024-01-21' AND batch_id <= 15)""",
    "delta_purge_count": """
        SELECT count(*) AS deleted_rows FROM batched_deltas
        WHERE window_end < TIMESTAMP '2024-01-21' AND batch_id <= 15""",
    "preference_above": """
        SELECT user_id, count(*) AS preference_count FROM preference WHERE preference_score > 4 GROUP BY 1""",
    "delta_windows_after": """
        SELECT CAST(window_start AS TIMESTAMP) AS window_start, CAST(window_end AS TIMESTAMP) AS window_end, user_id,
          item_id, score_delta, interaction_delta, batch_id FROM batched_deltas
        WHERE window_start > TIMESTAMP '2024-01-25'""",
    "recall_serving": """
        SELECT r.user_id, r.item_id, r.rank_position, r.score, c.name, c.category, CAST(c.price AS DOUBLE) AS price, c.tags
        FROM recall r JOIN item_catalog c USING (item_id)
        WHERE r.model_version = 'als_v2' AND NOT EXISTS
          (SELECT 1 FROM preference p WHERE p.user_id = r.user_id AND p.item_id = r.item_id)
        QUALIFY row_number() OVER (PARTITION BY r.user_id ORDER BY r.rank_position) <= 10""",
    "recall_for_users": """
        SELECT model_version, user_id, item_id, rank_position, score FROM recall
        WHERE model_version = 'als_v2' AND user_id IN (SELECT user_id FROM behavior_events
          WHERE behavior_type = 'PURCHASE' AND event_time BETWEEN TIMESTAMP '2024-01-29' AND TIMESTAMP '2024-01-31')""",
    "recall_active": """
        WITH g AS (SELECT p_brand AS model_name, 'als_v' || count(*) % 3 AS version FROM part GROUP BY 1 HAVING sum(p_size) % 3 <> 0)
        SELECT g.model_name, r.user_id, r.item_id, r.rank_position, r.score, c.name FROM g JOIN recall r ON r.model_version = g.version
          JOIN item_catalog c USING (item_id)
        WHERE NOT EXISTS (SELECT 1 FROM preference p WHERE p.user_id = r.user_id AND p.item_id = r.item_id)
        QUALIFY row_number() OVER (PARTITION BY g.model_name, r.user_id ORDER BY r.rank_position) <= 2""",
    "recall_purge": "SELECT * FROM recall WHERE model_version <> 'als_v0'",
    "model_switch": """
        SELECT b.model_name, coalesce(n.v, b.current_version) AS current_version,
          CASE WHEN n.v IS NULL THEN b.previous_version ELSE b.current_version END AS previous_version,
          'ACTIVE' AS status,
          CASE WHEN n.v IS NULL THEN TIMESTAMP '2024-01-31' ELSE TIMESTAMP '2024-02-01' END AS updated_at
        FROM (SELECT p_brand AS model_name, 'als_' || max(p_partkey) AS current_version,
                'als_' || min(p_partkey) AS previous_version FROM part GROUP BY 1) b
        LEFT JOIN (SELECT p_brand AS model_name, 'als_new_' || count(*) AS v FROM part GROUP BY 1 HAVING max(p_size) % 2 = 0) n
          USING (model_name)""",
    "catalog_by_price": """
        SELECT item_id, name, CAST(price AS DOUBLE) AS price FROM item_catalog
        WHERE category = 'ECONOMY' AND price BETWEEN 950 AND 1000""",
    "als_invariants": """
        WITH trained AS (SELECT * FROM preference WHERE last_window_end >= TIMESTAMP '2023-11-02' AND interaction_count >= 1
            AND preference_score >= 0.1),
          most AS (SELECT least(50, count(DISTINCT item_id)) AS n FROM trained)
        SELECT DISTINCT user_id, n AS items, n AS known_items, true AS ranks_dense, true AS scores_fall, true AS items_distinct
        FROM trained, most""",
    "als_training_rows": """
        SELECT * FROM preference WHERE last_window_end >= TIMESTAMP '2024-01-06' AND interaction_count >= 1
          AND preference_score >= 0.1""",
    "als_training_users": """
        SELECT count(DISTINCT user_id) AS user_count FROM preference
        WHERE last_window_end >= TIMESTAMP '2024-01-06' AND interaction_count >= 1 AND preference_score >= 0.1""",
    "event_checks": """
        SELECT event_id, CASE WHEN event_time > TIMESTAMP '2024-01-29' THEN 'FUTURE' END AS reason,
          event_time <= TIMESTAMP '2024-01-29' AS is_valid FROM behavior_events""",
    "event_scores": """
        SELECT event_id, score AS preference_score, CAST(CASE behavior_type WHEN 'VIEW' THEN 1 WHEN 'CLICK' THEN 1
            WHEN 'ADD_TO_CART' THEN 3 WHEN 'PURCHASE' THEN 5 ELSE 4 * (rating - 1) / 4 END AS DOUBLE) AS event_weight
        FROM scored_events""",
    "events_in_range": """
        SELECT event_id, user_id, event_time FROM behavior_events
        WHERE event_time BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12 06:00:00'""",
    "expired_events": """
        SELECT event_id, event_time FROM behavior_events
        WHERE TIMESTAMP '2024-01-31' > event_time + INTERVAL 240 HOUR""",
    "behavior_summary": """
        SELECT user_id, behavior_type, count(*) AS total_count FROM behavior_events
        WHERE time_bucket(INTERVAL 30 SECOND, event_time) >= TIMESTAMP '2024-01-24' GROUP BY 1, 2""",
    "category_preference": """
        WITH w AS (SELECT user_id, 'category_' || (item_id % 10) AS category, sum(CAST(CASE behavior_type
            WHEN 'VIEW' THEN 1 WHEN 'CLICK' THEN 1 WHEN 'ADD_TO_CART' THEN 3 WHEN 'PURCHASE' THEN 5
            ELSE rating - 1 END AS DOUBLE)) AS weight FROM behavior_events GROUP BY 1, 2)
        SELECT user_id, category, CASE WHEN sum(weight) OVER (PARTITION BY user_id) > 0
          THEN weight / sum(weight) OVER (PARTITION BY user_id) ELSE weight END AS preference FROM w""",
    "active_users": """
        SELECT user_id, count(*) FILTER (event_time > TIMESTAMP '2024-01-24') AS recent_events, recent_events >= 10
          AS is_active FROM behavior_events GROUP BY 1""",
    "favorite_type": """
        SELECT user_id, behavior_type AS favorite_type, count(*) AS event_count FROM behavior_events GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, behavior_type) = 1""",
    "bot_users": """
        SELECT user_id, count(*) AS recent_events, count(DISTINCT behavior_type) AS distinct_types,
          count(*) > 25 OR (count(*) > 1 AND count(DISTINCT behavior_type) = 1) AS is_bot
        FROM behavior_events WHERE event_time BETWEEN TIMESTAMP '2024-01-24' AND TIMESTAMP '2024-01-31' GROUP BY 1""",
    "behavior_pattern": "SELECT * FROM patterns",
    "dedup_gap": """
        WITH RECURSIVE numbered AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY user_id, item_id, behavior_type ORDER BY event_time, event_id) AS n
            FROM behavior_events),
          walk AS (
            SELECT *, event_time AS last_kept, true AS kept FROM numbered WHERE n = 1
            UNION ALL
            SELECT e.*, CASE WHEN w.last_kept > e.event_time - INTERVAL 5 MINUTE THEN w.last_kept ELSE e.event_time END,
              NOT (w.last_kept > e.event_time - INTERVAL 5 MINUTE)
            FROM walk w JOIN numbered e ON e.user_id = w.user_id AND e.item_id = w.item_id
              AND e.behavior_type = w.behavior_type AND e.n = w.n + 1)
        SELECT event_id, user_id, item_id, event_time FROM walk WHERE kept""",
    "dedup_gap_day": """
        WITH RECURSIVE numbered AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY user_id, behavior_type ORDER BY event_time, event_id) AS n
            FROM behavior_events),
          walk AS (
            SELECT *, event_time AS last_kept, true AS kept FROM numbered WHERE n = 1
            UNION ALL
            SELECT e.*, CASE WHEN w.last_kept > e.event_time - INTERVAL 1 DAY THEN w.last_kept ELSE e.event_time END,
              NOT (w.last_kept > e.event_time - INTERVAL 1 DAY)
            FROM walk w JOIN numbered e ON e.user_id = w.user_id AND e.behavior_type = w.behavior_type AND e.n = w.n + 1)
        SELECT event_id, user_id, behavior_type, event_time FROM walk WHERE kept""",
    "bounded_history": """
        WITH n AS (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) AS c,
            row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) AS p FROM behavior_events)
        SELECT event_id, user_id FROM n WHERE p <= CASE WHEN c <= 60 THEN c ELSE 51 + (c - 61) % 10 END""",
    "user_portrait": """
        WITH lines AS (SELECT user_id, string_agg('  - ' || CASE behavior_type WHEN 'VIEW' THEN '浏览'
              WHEN 'CLICK' THEN '点击' WHEN 'ADD_TO_CART' THEN '加购' WHEN 'PURCHASE' THEN '购买' ELSE '评分' END
              || '：' || total_count || ' 次' || chr(10), '' ORDER BY total_count DESC, behavior_type) AS rows
            FROM summary_7d GROUP BY 1)
        SELECT user_id, '你正在和一位用户对话。以下是该用户的画像：' || chr(10)
          || CASE WHEN p.nickname IS NULL THEN '- 用户基础信息：未注册，新访客' || chr(10) ELSE
            '- 昵称：' || p.nickname || chr(10)
            || '- 性别：' || CASE gender WHEN 'MALE' THEN '男' WHEN 'FEMALE' THEN '女' ELSE '未知' END || chr(10)
            || '- 年龄段：' || coalesce(age_range, '未知') || chr(10) || '- 地域：' || coalesce(region, '未知') || chr(10)
            || coalesce('- 自选偏好：' || preference_tags || chr(10), '') END
          || CASE WHEN l.rows IS NULL THEN '- 行为记录：暂无（新用户）' || chr(10) ELSE
            '- 近 7 天行为分布：' || chr(10) || l.rows || '- 行为模式：' || CASE t.pattern
              WHEN 'COMPARER' THEN '比价型（浏览多购买少，建议强调性价比和对比）'
              WHEN 'DECISIVE' THEN '目标明确型（决策快，建议直接推荐 Top 选项）'
              ELSE '探索型（行为均匀，建议多样化推荐）' END || chr(10) END
          || chr(10) || '请基于以上画像，以专业但亲和的语气与用户对话。' || chr(10)
          || coalesce('当用户询问推荐时，优先推荐与偏好标签（' || preference_tags || '）相关的产品。' || chr(10), '')
          || '如果用户是新访客，主动询问偏好以建立画像。' || chr(10) AS portrait
        FROM user_profiles p FULL JOIN lines l USING (user_id) LEFT JOIN patterns t USING (user_id)""",
    "profile_tags": """
        WITH c AS (SELECT user_id, category, count(*) AS n FROM behavior_events JOIN item_catalog USING (item_id)
            GROUP BY 1, 2),
          h AS (SELECT user_id, hour(event_time) AS hour, count(*) AS n FROM behavior_events GROUP BY 1, 2),
          pp AS (SELECT user_id, CAST(sum(price) AS DOUBLE) / count(*) AS mean FROM behavior_events
            JOIN item_catalog USING (item_id) WHERE behavior_type = 'PURCHASE' GROUP BY 1),
          rr AS (SELECT user_id, avg(rating) AS mean FROM behavior_events WHERE rating IS NOT NULL GROUP BY 1),
          ct AS (SELECT user_id, 'category_pref' AS tag_category, category AS tag_value,
              CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY user_id) AS confidence,
              row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category) AS r FROM c),
          ht AS (SELECT user_id, 'active_hours' AS tag_category, CAST(hour AS VARCHAR) AS tag_value,
              CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY user_id) AS confidence,
              row_number() OVER (PARTITION BY user_id ORDER BY n DESC, hour) AS r FROM h)
        SELECT user_id, tag_category, tag_value, confidence FROM ct WHERE r <= 5
        UNION ALL SELECT user_id, tag_category, tag_value, confidence FROM ht WHERE r <= 3
        UNION ALL SELECT user_id, 'purchase_power', CASE WHEN mean < 904 THEN 'LOW' WHEN mean > 906 THEN 'HIGH'
          ELSE 'MEDIUM' END, CAST(1 AS DOUBLE) FROM pp
        UNION ALL SELECT user_id, 'behavior_pattern', pattern, CAST(1 AS DOUBLE) FROM patterns
        UNION ALL SELECT user_id, 'rating_tendency', CASE WHEN mean < 3 THEN 'STRICT' WHEN mean > 4 THEN 'LENIENT'
          ELSE 'NEUTRAL' END, CAST(1 AS DOUBLE) FROM rr""",
    "profile_merge": """
        WITH f AS (SELECT user_id, event_time >= TIMESTAMP '2024-01-29' AS live, behavior_type, count(*) AS n
            FROM behavior_events GROUP BY 1, 2, 3
            QUALIFY row_number() OVER (PARTITION BY user_id, live ORDER BY count(*) DESC, behavior_type) = 1),
          s AS (SELECT user_id, behavior_type AS tag_value, CASE WHEN live THEN 0 ELSE 1 END AS p FROM f
            UNION ALL SELECT user_id, gender, 2 FROM user_profiles)
        SELECT user_id, 'favorite' AS tag_category, tag_value,
          CASE p WHEN 0 THEN 'REALTIME' WHEN 1 THEN 'OFFLINE' ELSE 'STATIC' END AS source
        FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY p) = 1""",
    "ingest_filter_project": """
        SELECT o_orderkey, o_totalprice AS price, o_orderstatus AS status FROM orders
        WHERE o_orderpriority ILIKE '1-urg%' AND o_totalprice > 250000
          OR o_orderstatus IN ('F', 'P') AND o_orderdate < TIMESTAMP '1996-01-01' AND o_custkey IS NOT NULL""",
    "ingest_transforms": f"""
        WITH p AS (SELECT *, CAST(p_retailprice AS DECIMAL(18,2)) * 100 AS cents FROM part),
          q AS (SELECT *, CAST((CAST(cents AS HUGEINT) * 100000000 * 2 + 7) // 14 AS DECIMAL(28,0)) / 100000000.0 AS d,
            CAST((CAST(cents AS HUGEINT) * 100000000 * 2 + 7) // 14 AS HUGEINT) AS units FROM p)
        SELECT p_partkey AS id, {_number("cents")} AS price_cents, 'P:' || upper(p_name) AS name,
          {_number("p_size + 0.5")} AS size, lower(p_brand) || '!' AS brand,
          regexp_replace(CAST(units // 100000000 AS VARCHAR) || '.'
            || lpad(CAST(units % 100000000 AS VARCHAR), 8, '0'), '\\.?0+$', '') AS seventh,
          regexp_replace(CAST((units + 500000) // 1000000 // 100 AS VARCHAR) || '.'
            || lpad(CAST((units + 500000) // 1000000 % 100 AS VARCHAR), 2, '0'), '\\.?0+$', '') AS rounded,
          {_number("p_size - 25.5")} AS shifted, 'none' AS note FROM q""",
    "ingest_upsert_dedup": """
        SELECT o_custkey AS customer, o_orderkey AS order_no, lower(o_orderstatus) AS status FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey DESC) = 1""",
    "ingest_custom_query": """
        SELECT c_custkey AS id, lower(c_mktsegment) AS segment, CAST(NULL AS VARCHAR) AS missing FROM customer
        WHERE c_acctbal > 0""",
    "ingest_summary": f"""
        SELECT (SELECT count(*) FROM customer) AS total_records, 'c_custkey,c_name,c_nationkey,c_mktsegment' AS columns,
          string_agg(row, chr(10) ORDER BY c_custkey) AS sample_rows, 'RULE_BUILDER' AS mode
        FROM (SELECT c_custkey, {_SUMMARY_ROW} AS row FROM customer ORDER BY c_custkey LIMIT 20)""",
    "kv_dump_scan": """
        WITH k AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'user:' ELSE 'cart:' END || c_custkey AS key, *,
            c_custkey % 6 AS t FROM customer)
        SELECT key, CASE t WHEN 0 THEN 'string' WHEN 1 THEN 'hash' WHEN 2 THEN 'list' WHEN 3 THEN 'set' WHEN 4
            THEN 'zset' ELSE 'stream' END AS type,
          CASE WHEN t = 0 THEN c_name
            WHEN t = 1 THEN '{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}'
            WHEN t = 5 THEN '(unsupported type: stream)'
            ELSE '[' || array_to_string(list_transform(range(1, 2 + c_custkey % 150), lambda i: '"i' || i || '"'), ',') || ']' END AS value
        FROM k WHERE key LIKE 'user:%'""",
    "sheet_scan": """
        SELECT c_custkey + 2 AS line_no, CAST(c_custkey AS VARCHAR) AS id,
          CASE WHEN c_custkey % 10 = 4 THEN 'x' ELSE c_name END AS name,
          CASE WHEN c_custkey % 10 = 4 THEN '' ELSE c_mktsegment END AS column_2, '' AS note
        FROM customer WHERE c_custkey % 10 <> 3""",
    "normalize_kingdee": "SELECT * FROM kingdee",
    "normalize_yonyou": "SELECT * FROM yonyou",
    "normalize_generic": "SELECT * FROM generic",
    "supplier_dlq": """
        SELECT seq, supplier_id, supplier_code, erp_type, raw_payload[1:512] AS raw_snippet,
          'TRANSFORM_ERROR' AS error_type, error AS error_message, TIMESTAMP '2024-01-31' AS failed_at
        FROM bad_payloads""",
    "newer_wins_upsert": """
        SELECT supplier_id, erp_type, source_record_id, supplier_name, supplier_status, pulled_at,
          TIMESTAMP '2024-01-31' AS created_at, TIMESTAMP '2024-01-31' AS updated_at FROM supplier_records
        QUALIFY row_number() OVER (PARTITION BY supplier_id, erp_type, source_record_id
          ORDER BY pulled_at DESC, seq DESC) = 1""",
    "upsert_outcomes": """
        SELECT erp_type, count(*) FILTER (outcome = 'UPSERTED') AS upserted_count,
          count(*) FILTER (outcome = 'STALE_SKIPPED') AS stale_skipped_count FROM record_fates GROUP BY 1""",
    "payload_results": """
        SELECT seq, supplier_id, true AS success, CAST(1 AS BIGINT) AS parsed_count,
          CAST(outcome = 'UPSERTED' AS BIGINT) AS upserted_count,
          CAST(outcome = 'STALE_SKIPPED' AS BIGINT) AS stale_skipped_count, CAST(NULL AS VARCHAR) AS error_message
        FROM record_fates
        UNION ALL SELECT seq, supplier_id, false, 0, 0, 0, error FROM bad_payloads""",
    "supplier_codes": """
        SELECT supplier_id, CASE k % 3 WHEN 0 THEN 'KINGDEE' WHEN 1 THEN 'YONYOU' ELSE 'GENERIC' END AS erp_type,
          '2024-01-01' AS cursor_date, CAST(greatest(1, k % 50) AS INTEGER) AS cursor_page,
          '2024-01-01|' || (k % 50 + 1) AS next_cursor, CAST(least(1200, 30 * pow(2, retry_count)) AS BIGINT) AS backoff,
          '******' AS masked, supplier_code[1:4] AS head FROM connections""",
    "due_connections": """
        SELECT supplier_id, supplier_code, next_pull_at, retry_count FROM connections
        WHERE status = 'ACTIVE' AND next_pull_at <= TIMESTAMP '2024-01-31'
          AND (lease_until IS NULL OR lease_until <= TIMESTAMP '2024-01-31')
        ORDER BY CASE WHEN retry_count >= 5 THEN 1 ELSE 0 END, next_pull_at, supplier_id LIMIT 50""",
    "apply_pull_outcomes": """
        WITH j AS (SELECT c.*, o.outcome, o.finished_at, o.next_cursor, o.retry_after,
            c.version = o.version AND c.status = 'ACTIVE' AND o.outcome = 'SUCCESS' AS ok,
            c.version = o.version AND c.status <> 'SUSPENDED' AND o.outcome = 'AUTH_FAILURE' AS suspend,
            c.version = o.version AND c.status = 'ACTIVE' AND o.outcome NOT IN ('SUCCESS', 'AUTH_FAILURE') AS failed,
            o.finished_at + CAST(least(3600, 30 * pow(2, c.retry_count)) AS INTEGER) * INTERVAL 1 SECOND AS delayed
          FROM connections c JOIN pull_outcomes o USING (supplier_id))
        SELECT supplier_id, CASE WHEN suspend THEN 'SUSPENDED' ELSE status END AS status, pull_interval_seconds,
          CASE WHEN ok THEN finished_at + pull_interval_seconds * INTERVAL 1 SECOND
            WHEN failed AND outcome = 'RATE_LIMITED' THEN coalesce(retry_after, delayed)
            WHEN failed THEN delayed ELSE next_pull_at END AS next_pull_at,
          CASE WHEN ok THEN finished_at END AS last_success_at,
          CASE WHEN failed OR suspend THEN finished_at END AS last_error_at,
          CASE WHEN ok THEN next_cursor ELSE last_cursor END AS last_cursor,
          CASE WHEN ok THEN 0 WHEN failed THEN retry_count + 1 ELSE retry_count END AS retry_count,
          CASE WHEN NOT (ok OR failed OR suspend) THEN lease_until END AS lease_until,
          version + CASE WHEN ok OR failed OR suspend THEN 1 ELSE 0 END AS version,
          CASE WHEN ok OR failed OR suspend THEN finished_at ELSE TIMESTAMP '2024-01-31' END AS updated_at FROM j""",
    "pull_report": """
        SELECT count(*) AS executed, count(*) FILTER (outcome = 'SUCCESS') AS success_count,
          count(*) FILTER (outcome = 'FAILURE') AS failure_count,
          count(*) FILTER (outcome = 'SKIPPED_DUPLICATE') AS skipped_count,
          floor(CAST(sum(duration_ms) AS DOUBLE) / count(*) * CAST(10 AS DOUBLE) + CAST(0.5 AS DOUBLE))
            / CAST(10 AS DOUBLE) AS avg_latency_ms, max(duration_ms) AS max_latency_ms,
          list_sort(list(duration_ms))[CAST(floor(count(*) * CAST(0.99 AS DOUBLE)) AS BIGINT) + 1] AS p99_latency_ms,
          floor(count(*) * CAST(1000 AS DOUBLE) / 60000 * CAST(10 AS DOUBLE) + CAST(0.5 AS DOUBLE))
            / CAST(10 AS DOUBLE) AS throughput_per_second FROM pull_audit""",
    "pull_task_dedup": """
        SELECT audit_id, supplier_id, supplier_id || '_' || strftime(executed_at, '%Y%m%d%H%M') AS idempotency_key
        FROM pull_audit QUALIFY row_number() OVER (PARTITION BY supplier_id, strftime(executed_at, '%Y%m%d%H%M')
          ORDER BY audit_id) = 1""",
    "connection_status": """
        SELECT count(*) AS total, count(*) FILTER (status = 'ACTIVE') AS active,
          count(*) FILTER (status = 'SUSPENDED') AS suspended FROM connections""",
    "latest_audit": """
        SELECT supplier_id, audit_id, outcome, executed_at FROM pull_audit
        QUALIFY row_number() OVER (PARTITION BY supplier_id ORDER BY executed_at DESC, audit_id DESC) = 1""",
    "recent_audits": """
        SELECT audit_id, supplier_id, outcome FROM pull_audit ORDER BY executed_at DESC, audit_id DESC LIMIT 100""",
    "recent_audits_per_supplier": """
        SELECT audit_id, supplier_id, outcome FROM pull_audit
        QUALIFY row_number() OVER (PARTITION BY supplier_id ORDER BY executed_at DESC, audit_id DESC) <= 5""",
    "order_etl": """
        SELECT order_id, user_id, status, CAST(round(amount * CAST(rate AS DECIMAL(8,3)), 2) AS DOUBLE) AS amount_cny,
          CAST(amount AS DOUBLE) AS amount, currency, occurred_at, seq
        FROM order_fates WHERE outcome = 'PROCESSED'
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) = 1""",
    "order_dlq": """
        SELECT seq, 'etl.order.events' AS original_topic, error_reason FROM order_fates WHERE outcome = 'DEAD_LETTER'""",
    "order_outcomes": "SELECT outcome, count(*) AS events FROM order_fates GROUP BY 1",
    "order_classification": "SELECT seq, event_id, outcome FROM order_fates",
    "payment_first_create": """
        WITH f AS (SELECT *, first_value(idempotency_key) OVER (PARTITION BY order_no ORDER BY seq) AS first_key,
            row_number() OVER (PARTITION BY order_no ORDER BY seq) AS n FROM payment_requests)
        SELECT order_no, any_value(first_key) AS idempotency_key, min(seq) AS seq, any_value(user_id) AS user_id,
          any_value(amount_fen) AS amount_fen, count(*) FILTER (n > 1 AND idempotency_key = first_key) AS returned,
          count(*) FILTER (idempotency_key <> first_key) AS refused FROM f GROUP BY 1""",
    "payment_replay": """
        WITH RECURSIVE walk AS (
            SELECT order_no, CAST(0 AS BIGINT) AS n, 'UNPAID' AS state, '' AS verdict
            FROM (SELECT DISTINCT order_no FROM payment_log)
            UNION ALL
            SELECT w.order_no, l.n,
              CASE WHEN state = 'UNPAID' AND action = 'START' THEN 'PAYING'
                WHEN state = 'PAYING' AND action = 'SUCCESS' THEN 'SUCCESS'
                WHEN state IN ('UNPAID', 'PAYING') AND action = 'CLOSE' THEN 'CLOSED' ELSE state END,
              CASE WHEN state = 'UNPAID' AND action IN ('START', 'CLOSE') THEN 'A'
                WHEN state = 'PAYING' AND action IN ('SUCCESS', 'CLOSE') THEN 'A'
                WHEN state = 'PAYING' AND action = 'START' THEN 'N'
                WHEN state = 'SUCCESS' AND action IN ('START', 'SUCCESS') THEN 'N'
                WHEN state = 'CLOSED' AND action = 'CLOSE' THEN 'N' ELSE 'R' END
            FROM walk w JOIN payment_log l ON l.order_no = w.order_no AND l.n = w.n + 1)
        SELECT order_no, arg_max(state, n) AS final_state, count(*) FILTER (verdict = 'A') AS applied,
          count(*) FILTER (verdict = 'N') AS repeated, count(*) FILTER (verdict = 'R') AS rejected
        FROM walk GROUP BY 1""",
    "reservation_replay": """
        WITH RECURSIVE walk AS (
            SELECT order_no, CAST(0 AS BIGINT) AS n, 'RESERVED' AS state, true AS applied
            FROM (SELECT DISTINCT order_no FROM payment_log)
            UNION ALL
            SELECT w.order_no, l.n, coalesce(CASE
                WHEN step = 'ORDER' AND state = 'RESERVED' THEN 'ORDER_CREATED'
                WHEN step = 'PAY' AND state = 'ORDER_CREATED' THEN 'PAID'
                WHEN step = 'CANCEL' AND state IN ('RESERVED', 'ORDER_CREATED') THEN 'CANCELLED'
                WHEN step = 'EXPIRE' AND state IN ('RESERVED', 'ORDER_CREATED') THEN 'EXPIRED'
                WHEN step = 'RELEASE' AND state NOT IN ('PAID', 'RELEASED') THEN 'RELEASED' END, state),
              (step = 'ORDER' AND state = 'RESERVED') OR (step = 'PAY' AND state = 'ORDER_CREATED')
                OR (step IN ('CANCEL', 'EXPIRE') AND state IN ('RESERVED', 'ORDER_CREATED'))
                OR (step = 'RELEASE' AND state NOT IN ('PAID', 'RELEASED'))
            FROM walk w JOIN payment_log l ON l.order_no = w.order_no AND l.n = w.n + 1)
        SELECT order_no AS reservation_id, arg_max(state, n) AS final_state,
          count(*) FILTER (n > 0 AND applied) AS applied, CAST(0 AS BIGINT) AS repeated,
          count(*) FILTER (NOT applied) AS rejected FROM walk GROUP BY 1""",
    "release_moves": """
        WITH RECURSIVE walk AS (
            SELECT order_no, CAST(0 AS BIGINT) AS n, 'RESERVED' AS state, true AS applied
            FROM (SELECT DISTINCT order_no FROM payment_log)
            UNION ALL
            SELECT w.order_no, l.n, coalesce(CASE
                WHEN step = 'ORDER' AND state = 'RESERVED' THEN 'ORDER_CREATED'
                WHEN step = 'PAY' AND state = 'ORDER_CREATED' THEN 'PAID'
                WHEN step = 'CANCEL' AND state IN ('RESERVED', 'ORDER_CREATED') THEN 'CANCELLED'
                WHEN step = 'EXPIRE' AND state IN ('RESERVED', 'ORDER_CREATED') THEN 'EXPIRED'
                WHEN step = 'RELEASE' AND state NOT IN ('PAID', 'RELEASED') THEN 'RELEASED' END, state),
              (step = 'ORDER' AND state = 'RESERVED') OR (step = 'PAY' AND state = 'ORDER_CREATED')
                OR (step IN ('CANCEL', 'EXPIRE') AND state IN ('RESERVED', 'ORDER_CREATED'))
                OR (step = 'RELEASE' AND state NOT IN ('PAID', 'RELEASED'))
            FROM walk w JOIN payment_log l ON l.order_no = w.order_no AND l.n = w.n + 1),
          finals AS (SELECT order_no, arg_max(state, n) AS state FROM walk GROUP BY 1),
          skus AS (
            SELECT o_custkey % 40 AS sku_id, count(*) AS n, count(*) FILTER (state = 'PAID') AS paid,
              count(*) FILTER (state = 'RELEASED') AS released
            FROM orders LEFT JOIN finals ON o_orderkey = order_no GROUP BY 1)
        SELECT sku_id, n + 5 AS total_stock, 5 + released AS available_stock, n - paid - released AS reserved_stock,
          paid AS sold_stock, paid + released AS version, CAST(0 AS BIGINT) AS refused, true AS identity_holds
        FROM skus""",
    "payment_transition": """
        SELECT p.order_no, CASE WHEN m THEN 'CLOSED' ELSE status END AS status,
          CASE WHEN m THEN TIMESTAMP '2024-01-31' ELSE paying_started_at END AS updated_at
        FROM (SELECT *, status = 'UNPAID' AND order_no IN
          (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW') AS m FROM payment_orders) p""",
    "stock_replay": """
        WITH RECURSIVE walk AS (
            SELECT sku_id, CAST(0 AS BIGINT) AS n, 25 AS a, 0 AS r, 0 AS s, 0 AS v, 0 AS refused
            FROM (SELECT DISTINCT sku_id FROM stock_moves)
            UNION ALL
            SELECT w.sku_id, m.n,
              a + CASE WHEN event_type IN ('view', 'click') AND a > 0 THEN -1 WHEN event_type = 'signup' AND r > 0 THEN 1
                ELSE 0 END,
              r + CASE WHEN event_type IN ('view', 'click') THEN CAST(a > 0 AS INTEGER) ELSE -CAST(r > 0 AS INTEGER) END,
              s + CASE WHEN event_type IN ('purchase', 'error') THEN CAST(r > 0 AS INTEGER) ELSE 0 END,
              v + CASE WHEN event_type IN ('view', 'click') THEN CAST(a > 0 AS INTEGER) ELSE CAST(r > 0 AS INTEGER) END,
              refused + CASE WHEN event_type IN ('view', 'click') THEN CAST(a <= 0 AS INTEGER)
                ELSE CAST(r <= 0 AS INTEGER) END
            FROM walk w JOIN stock_moves m ON m.sku_id = w.sku_id AND m.n = w.n + 1)
        SELECT sku_id, CAST(25 AS BIGINT) AS total_stock, CAST(a AS BIGINT) AS available_stock,
          CAST(r AS BIGINT) AS reserved_stock, CAST(s AS BIGINT) AS sold_stock, CAST(v AS BIGINT) AS version,
          CAST(refused AS BIGINT) AS refused
        FROM walk QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY n DESC) = 1""",
    "flash_sale_admission": """
        WITH firsts AS (SELECT sku_id, user_id, min(seq) AS seq FROM reserve_requests GROUP BY 1, 2),
          ranked AS (SELECT *, row_number() OVER (PARTITION BY sku_id ORDER BY seq) AS p FROM firsts)
        SELECT q.seq, q.sku_id, q.user_id, CASE WHEN q.sku_id = 19 THEN 'ACTIVITY_CLOSED' WHEN f.p > 25 THEN 'SOLD_OUT'
          WHEN q.seq = f.seq THEN 'RESERVED' ELSE 'DUPLICATE_USER' END AS outcome
        FROM reserve_requests q JOIN ranked f USING (sku_id, user_id)""",
    "stuck_payments": """
        SELECT order_no, paying_started_at FROM payment_orders
        WHERE status = 'PAYING' AND paying_started_at < TIMESTAMP '1996-01-01'
        ORDER BY paying_started_at, order_no LIMIT 50""",
    "quality_audit": """
        WITH v AS (SELECT order_no, status, concat_ws('; ',
            CASE WHEN idempotency_key = ' ' THEN 'idempotency_key missing' END,
            CASE WHEN status = 'PAYING' AND paying_started_at IS NULL THEN 'PAYING requires paying_started_at' END,
            CASE WHEN status = 'SUCCESS' AND paying_started_at IS NULL THEN 'SUCCESS requires paying_started_at' END,
            CASE WHEN status = 'SUCCESS' AND channel_trade_no IS NULL THEN 'SUCCESS requires channel_trade_no' END,
            CASE WHEN status = 'SUCCESS' AND paid_at IS NULL THEN 'SUCCESS requires paid_at' END,
            CASE WHEN status = 'CLOSED' AND closed_at IS NULL THEN 'CLOSED requires closed_at' END,
            CASE WHEN status IN ('UNPAID', 'PAYING') AND channel_trade_no IS NOT NULL
              THEN status || ' forbids channel_trade_no' END,
            CASE WHEN status IN ('UNPAID', 'PAYING') AND paid_at IS NOT NULL THEN status || ' forbids paid_at' END,
            CASE WHEN status IN ('UNPAID', 'PAYING', 'SUCCESS') AND closed_at IS NOT NULL
              THEN status || ' forbids closed_at' END,
            CASE WHEN status = 'CLOSED' AND channel_trade_no IS NOT NULL THEN 'CLOSED forbids channel_trade_no' END,
            CASE WHEN status = 'CLOSED' AND paid_at IS NOT NULL THEN 'CLOSED forbids paid_at' END) AS violations
          FROM payment_orders)
        SELECT * FROM v WHERE violations <> ''""",
    "reservation_audit": """
        WITH r AS (SELECT o_orderkey AS reservation_id, o_orderkey % 6 AS s, o_orderkey % 5 = 0 AS no_order,
            o_orderkey % 7 = 0 AS no_release FROM orders)
        SELECT reservation_id, CASE s WHEN 1 THEN 'ORDER_CREATED' WHEN 2 THEN 'PAID' ELSE 'RELEASED' END AS status,
          CASE s WHEN 1 THEN 'ORDER_CREATED requires payment_order_no' WHEN 2 THEN 'PAID requires payment_order_no'
            ELSE 'RELEASED requires released_at' END AS violations
        FROM r WHERE (s IN (1, 2) AND no_order) OR (s = 5 AND no_release)""",
    "stock_audit": """
        SELECT DISTINCT sku_id, 'total mismatch' AS violations FROM stock_moves WHERE sku_id % 3 = 0""",
    "lease_audit": """
        SELECT supplier_id, status, lease_until FROM connections WHERE status <> 'ACTIVE' AND lease_until IS NOT NULL""",
    "idempotency_conflicts": """
        SELECT order_no, count(DISTINCT idempotency_key) AS key_count FROM payment_requests GROUP BY 1
        HAVING count(DISTINCT idempotency_key) > 1""",
    "target_guard": """
        WITH a AS (SELECT *, CASE WHEN address NOT LIKE '%:%' THEN CAST(split_part(address, '.', 3) AS INTEGER) END AS third FROM access_log)
        SELECT seq, host, address, CASE
          WHEN host = 'db21.local' OR host LIKE '%3.example.org'
            OR (address LIKE '192.168.%' AND third BETWEEN 4 AND 7) THEN 'ALLOWED'
          WHEN host = 'LOCALHOST' OR host LIKE '%.local' THEN 'LOCAL_HOST'
          WHEN address = '169.254.169.254' THEN 'METADATA_ADDRESS'
          WHEN address IS NULL OR address IN ('2001:::::1', '2002:7f00:1::', '::ffff:10.0.0.1', '::1', 'fe80::1') THEN 'NON_PUBLIC'
          WHEN regexp_matches(address, '^(10|127|169\\.254|172\\.20|192\\.168)\\.') THEN 'NON_PUBLIC'
          ELSE 'ALLOWED' END AS verdict FROM a""",
    "target_networks": """
        WITH a AS (SELECT *, regexp_extract(address, '^(::ffff:)?([0-9]+)\\.([0-9]+)\\.([0-9]+)\\.([0-9]+)$',
              ['m', 'o1', 'o2', 'o3', 'o4']) AS o FROM access_log),
          n AS (SELECT seq, address, CASE WHEN o.o1 <> '' THEN ((TRY_CAST(o.o1 AS BIGINT) * 256 + TRY_CAST(o.o2 AS BIGINT)) * 256 + TRY_CAST(o.o3 AS BIGINT)) * 256
              + TRY_CAST(o.o4 AS BIGINT) END AS num FROM a),
          b AS (SELECT '8.8.' || n_nationkey || '.0/26' AS cidr, n_name AS owner, 26 AS bits, (8 * 256 + 8) * 65536 + n_nationkey * 256 AS low
                FROM nation WHERE n_nationkey <> 3
                UNION ALL SELECT '8.0.0.0/8', r_name, 8, 8 * 16777216 FROM region WHERE r_regionkey = 0
                UNION ALL SELECT '192.168.0.0/22', r_name, 22, CAST(192 * 256 + 168 AS BIGINT) * 65536 FROM region WHERE r_regionkey = 1
                UNION ALL SELECT '203.0.0.0/13', r_name, 13, CAST(203 AS BIGINT) * 16777216 FROM region WHERE r_regionkey = 3
                UNION ALL SELECT '::ffff:10.0.0.0/119', r_name, 23, 10 * 16777216 FROM region WHERE r_regionkey = 4),
          m AS (SELECT n.seq, b.cidr, b.owner FROM n JOIN b ON n.num >= b.low AND n.num < b.low + CAST(2 ** (32 - b.bits) AS BIGINT)
                QUALIFY row_number() OVER (PARTITION BY n.seq ORDER BY b.bits DESC) = 1
                UNION ALL SELECT n.seq, '2001:4860::/31', r_name FROM n, region WHERE r_regionkey = 2 AND address LIKE '2001:4860:%')
        SELECT n.seq, n.address, m.cidr, m.owner FROM n LEFT JOIN m USING (seq)""",
    "request_cap": """
        WITH RECURSIVE numbered AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY client ORDER BY asked_at, seq) AS n FROM access_log),
          walk AS (
            SELECT client, seq, n, [asked_at] AS taken, true AS accepted FROM numbered WHERE n = 1
            UNION ALL
            SELECT e.client, e.seq, e.n,
              CASE WHEN len(list_filter(w.taken, lambda x: x >= e.asked_at - INTERVAL 2 DAY)) >= 20 THEN w.taken
                ELSE list_append(list_filter(w.taken, lambda x: x >= e.asked_at - INTERVAL 2 DAY), e.asked_at) END,
              len(list_filter(w.taken, lambda x: x >= e.asked_at - INTERVAL 2 DAY)) < 20
            FROM walk w JOIN numbered e ON e.client = w.client AND e.n = w.n + 1)
        SELECT seq, client, accepted FROM walk""",
    "delta_log_merge": """
        WITH b AS (SELECT *, least(9, (day(window_start) + 2) // 3) AS k FROM deltas_day WHERE day(window_start) <= 30)
        SELECT CAST(window_start AS TIMESTAMP) AS window_start, CAST(window_end AS TIMESTAMP) AS window_end, user_id,
          item_id, score_delta, interaction_delta + 1000 * k AS interaction_delta FROM b WHERE NOT (k = 9 AND item_id % 10 = 3)""",
    "marks_ttl": """
        WITH RECURSIVE m AS (
            SELECT CASE event_type WHEN 'view' THEN 'views' WHEN 'click' THEN 'clicks' WHEN 'purchase' THEN 'purchases' END AS topic,
              CASE WHEN event_id % 53 <> 0 THEN 'm' || (user_id * 7 + event_id % 3) % 97 END AS event_id,
              ts AS arrived, CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS seq FROM events),
          numbered AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY topic, event_id ORDER BY arrived, partition, seq) AS n,
              arrived + CASE topic WHEN 'views' THEN INTERVAL 2 DAY WHEN 'purchases' THEN INTERVAL 14 DAY ELSE INTERVAL 7 DAY END AS until
            FROM m WHERE event_id IS NOT NULL),
          walk AS (
            SELECT *, until AS alive, true AS first FROM numbered WHERE n = 1
            UNION ALL
            SELECT e.*, CASE WHEN e.arrived < w.alive THEN w.alive ELSE e.until END, e.arrived >= w.alive
            FROM walk w JOIN numbered e ON e.topic IS NOT DISTINCT FROM w.topic AND e.event_id = w.event_id AND e.n = w.n + 1)
        SELECT topic, event_id, arrived, partition, seq, CASE WHEN first THEN 'FIRST' ELSE 'DUPLICATE' END AS outcome FROM walk
        UNION ALL SELECT topic, event_id, arrived, partition, seq, 'UNUSABLE' FROM m WHERE event_id IS NULL""",
    "top_items_per_user": """
        SELECT p.user_id, CAST(row_number() OVER w AS INTEGER) AS rank, p.item_id, preference_score, interaction_count,
          name, category
        FROM preference p JOIN item_catalog USING (item_id)
        WINDOW w AS (PARTITION BY p.user_id ORDER BY preference_score DESC, item_id)
        QUALIFY row_number() OVER w <= 10""",
}

ORACLES = {name: _with_inputs(sql) for name, sql in SQL.items()}
