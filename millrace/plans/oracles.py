"""The result of each query, as SQL for DuckDB on the same tables."""

from __future__ import annotations

# Platforms in the order of their names, with their regions.
_PLATFORMS = """
    (0, 'br1', 'americas'), (1, 'eun1', 'europe'), (2, 'euw1', 'europe'), (3, 'jp1', 'asia'),
    (4, 'kr', 'asia'), (5, 'la1', 'americas'), (6, 'la2', 'americas'), (7, 'me1', 'europe'),
    (8, 'na1', 'americas'), (9, 'oc1', 'sea'), (10, 'ph2', 'sea'), (11, 'ru', 'europe'),
    (12, 'sg2', 'sea'), (13, 'th2', 'sea'), (14, 'tr1', 'europe'), (15, 'tw2', 'sea'), (16, 'vn2', 'sea')
"""

_LINES = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM lineitem
"""

_RESPONSES = """
    SELECT event_id, ts,
           CASE event_type WHEN 'error' THEN 429 WHEN 'signup' THEN 404 WHEN 'view' THEN 500
                ELSE 200 END AS status,
           CASE WHEN value < 20 THEN 'application' WHEN value < 40 THEN 'method' END AS kind,
           CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 50
                THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS retry_after
    FROM events
"""

_ACTIONS = f"""
    SELECT event_id, ts, status,
           CASE WHEN status = 429 AND kind IN ('application', 'method') THEN 'retry_after'
                WHEN status = 429 THEN 'retry_service'
                WHEN status = 404 THEN 'not_found'
                WHEN status >= 400 THEN 'fail' ELSE 'parse' END AS action,
           CASE WHEN status = 429 AND kind IN ('application', 'method')
                THEN coalesce(retry_after, 1)
                WHEN status = 429 THEN 2 END AS wait_s
    FROM ({_RESPONSES})
"""

_DAMAGED = """
    SELECT event_id, event_type,
           CASE event_type WHEN 'error' THEN props[1:length(props) - 1]
                WHEN 'signup' THEN '[1, 2]' ELSE props END AS body
    FROM events
"""

ORACLES = {
    "anti_pending": """
        SELECT DISTINCT o_orderkey AS order_key FROM orders
        ANTI JOIN lineitem ON o_orderkey = l_orderkey
    """,
    "anti_pending_filtered": """
        SELECT DISTINCT a.o_custkey FROM orders a
        WHERE a.o_orderstatus = 'O' AND NOT EXISTS (
            SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey
            AND b.o_orderstatus = 'F' AND b.o_orderdate < TIMESTAMP '1998-01-01')
    """,
    "anti_null_keys": """
        SELECT DISTINCT key FROM (
            SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS key FROM orders) a
        WHERE NOT EXISTS (
            SELECT 1 FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey = a.key)
    """,
    "distinct_keys_filtered": """
        SELECT DISTINCT o_custkey FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    """,
    "merge_single_key": """
        SELECT event_id, user_id, event_type,
               CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value ELSE value + 1000 END AS value
        FROM events
    """,
    "merge_two_key": f"""
        WITH lines AS ({_LINES}),
        landed AS (SELECT * FROM lines WHERE l_shipdate < TIMESTAMP '1998-01-01')
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM landed
        UNION ALL
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity + 1000 FROM lines
        ANTI JOIN landed USING (l_orderkey, l_linenumber)
    """,
    "merge_two_key_deduped": f"""
        WITH lines AS ({_LINES}),
        landed AS (SELECT * FROM lines WHERE l_shipdate < TIMESTAMP '1998-01-01'),
        firsts AS (
            SELECT * FROM lines
            QUALIFY row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) = 1)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity + 1000 AS l_quantity
        FROM firsts ANTI JOIN landed USING (l_orderkey, l_linenumber)
    """,
    "merge_three_key": """
        WITH source AS (
            SELECT event_id, user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, value
            FROM events)
        SELECT source.* FROM source
        ANTI JOIN (SELECT * FROM source WHERE value < 50) landed USING (user_id, event_type, day)
    """,
    "merge_metrics": """
        SELECT count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16') AS first_run,
               CAST(0 AS BIGINT) AS re_run
        FROM events
    """,
    "land_paged_array": """
        SELECT event_id // 100 AS page, event_id, user_id, event_type, value, props,
               row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS _pos
        FROM events
    """,
    "land_id_array": "SELECT user_id, CAST(event_id AS VARCHAR) AS id FROM events",
    "land_document": """
        SELECT event_id,
               CASE WHEN event_type = 'error' THEN 'req_' || event_id
                    ELSE CAST(event_id AS VARCHAR) END AS doc_key,
               CASE WHEN event_type <> 'signup' THEN event_type END AS kind,
               CASE WHEN event_type <> 'signup' THEN epoch_us(ts) // 1000 END AS created
        FROM events
    """,
    "land_opaque_document": """
        SELECT 'doc_' || doc_id AS doc_key, CAST(length(text) AS INTEGER) AS chars,
               md5(text) AS digest
        FROM documents WHERE regexp_matches(text, '\\S')
    """,
    "reject_documents": f"""
        SELECT event_id, body FROM ({_DAMAGED}) WHERE event_type IN ('error', 'signup')
    """,
    "reject_arrays": f"""
        SELECT event_id, body FROM ({_DAMAGED}) WHERE event_type <> 'signup'
    """,
    "json_extract": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
    """,
    "json_default": """
        SELECT event_id, json_extract_string(props, '$.k') AS found,
               CAST(user_id AS VARCHAR) AS fallback
        FROM events
    """,
    "paged_until_empty": """
        WITH pages AS (
            SELECT user_id, CAST(date_diff('day', DATE '2023-12-31', CAST(ts AS DATE)) AS INTEGER) AS page,
                   count(*) FILTER (WHERE event_type = 'purchase') AS n_items
            FROM events GROUP BY ALL),
        stops AS (SELECT user_id, min(page) AS stop FROM pages WHERE n_items = 0 GROUP BY user_id)
        SELECT pages.* FROM pages LEFT JOIN stops USING (user_id)
        WHERE stop IS NULL OR page < stop
    """,
    "plan_next_pages": """
        WITH pages AS (
            SELECT user_id, CAST(date_diff('day', DATE '2023-12-31', CAST(ts AS DATE)) AS INTEGER) AS page,
                   count(*) FILTER (WHERE event_type = 'purchase') AS n_items
            FROM events GROUP BY ALL)
        SELECT user_id, page % 16 AS half, max(page) + 1 AS page FROM pages
        GROUP BY user_id, page % 16 HAVING min(n_items) > 0
    """,
    "reject_elements": """
        SELECT event_id // 100 AS page,
               row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS _pos,
               CASE event_type WHEN 'error' THEN CAST(event_id AS VARCHAR)
                    WHEN 'view' THEN 'v' || event_id END AS _raw_json
        FROM events
        QUALIFY event_type IN ('error', 'view', 'signup')
    """,
    "reject_log_lines": """
        SELECT '{"dataset":"d","key":"' || event_id AS line FROM events WHERE event_type = 'error'
    """,
    "audit_columns": """
        SELECT o_orderkey, 'KR' AS _region, 'CHALLENGER' AS _tier, CAST(1 AS INTEGER) AS _page,
               'batch-0001' AS _batch_id, TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at
        FROM orders
    """,
    "source_url": """
        SELECT o_orderkey,
               'https://asia.api.example.com/lol/match/v5/matches/by-puuid/' || o_custkey
                   || '/ids?queue=420&start=0&count=20' AS list_url,
               'https://asia.api.example.com/lol/match/v5/matches/' || o_orderkey AS document_url
        FROM orders
    """,
    "routing_join": """
        SELECT c_custkey, lower(n_name) || '.api.example.com' AS platform_host,
               lower(r_name) || '.api.example.com' AS region_host
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
    """,
    "routing_lookup": f"""
        SELECT c_custkey,
               coalesce(code, 'xx' || c_nationkey) || '.api.example.com' AS platform_host,
               coalesce(region || '.api.example.com', 'unknown') AS region_host
        FROM customer LEFT JOIN (VALUES {_PLATFORMS}) AS p(place, code, region)
        ON c_nationkey = place
    """,
    "routing_rejects": f"""
        SELECT 'XX' || c_nationkey AS platform, count(*) AS customers
        FROM customer ANTI JOIN (VALUES {_PLATFORMS}) AS p(place, code, region)
        ON c_nationkey = place GROUP BY ALL
    """,
    "routing_invalid": """
        SELECT DISTINCT upper(event_type) AS event_type FROM events
        WHERE event_type NOT IN ('click', 'view')
    """,
    "known_keys_text": """
        SELECT string_agg(key, ', ' ORDER BY key) AS known
        FROM (SELECT DISTINCT upper(c_mktsegment) AS key FROM customer)
    """,
    "required_missing": """
        SELECT DISTINCT o_custkey AS key FROM orders
        ANTI JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
    """,
    "topk_latest": """
        SELECT user_id, event_id, event_type, ts FROM events WHERE event_type = 'purchase'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 20
    """,
    "topk_latest_offset": """
        SELECT user_id, event_id, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)
            BETWEEN 11 AND 30
    """,
    "response_actions": f"SELECT event_id, status, action, wait_s FROM ({_ACTIONS})",
    "retry_plan": f"""
        WITH r AS (
            SELECT user_id, a.*, action LIKE 'retry%' AS again,
                   row_number() OVER (PARTITION BY user_id ORDER BY a.ts, event_id) AS i
            FROM ({_ACTIONS}) a JOIN (SELECT event_id, user_id FROM events) USING (event_id)),
        ends AS (SELECT user_id, coalesce(max(i) FILTER (NOT again), 0) AS ended, max(i) AS last FROM r GROUP BY user_id),
        since AS (
            SELECT user_id, count(*) AS attempts, min(ts) AS first_at FROM r JOIN ends USING (user_id)
            WHERE i > ended GROUP BY user_id)
        SELECT user_id,
               CASE WHEN again THEN CASE WHEN attempts < 2 THEN 'waiting' ELSE 'given_up' END
                    WHEN action = 'parse' THEN 'done' WHEN action = 'fail' THEN 'failed' ELSE action END AS state,
               coalesce(attempts, 0) AS attempts, first_at, ts AS last_at,
               CASE WHEN again AND attempts < 2 THEN ts + to_seconds(wait_s) END AS next_due
        FROM r JOIN ends USING (user_id) LEFT JOIN since USING (user_id) WHERE i = last
    """,
    "retry_runs": f"""
        WITH r AS (
            SELECT user_id, a.*, coalesce(sum(CASE WHEN action LIKE 'retry%' THEN 0 ELSE 1 END) OVER (
                       PARTITION BY user_id ORDER BY a.ts, event_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run
            FROM ({_ACTIONS}) a JOIN (SELECT event_id, user_id FROM events) USING (event_id))
        SELECT user_id, CAST(run AS BIGINT) AS run, count(*) AS attempts, min(ts) AS started, max(ts) AS ended,
               CAST(coalesce(sum(wait_s), 0) AS BIGINT) AS waited_s,
               max(action) FILTER (action NOT LIKE 'retry%') AS outcome
        FROM r GROUP BY user_id, run
    """,
    "player_gaps": """
        WITH RECURSIVE edges(dataset, parent) AS (VALUES
            ('match_ids', 'league_entries'), ('match_raw', 'match_ids'), ('match_timeline_raw', 'match_raw'),
            ('summoner_raw', 'league_entries'), ('account_raw', 'league_entries')),
        below(dataset, descendant, depth) AS (
            SELECT parent, dataset, 1 FROM edges
            UNION ALL SELECT b.dataset, e.dataset, b.depth + 1 FROM below b JOIN edges e ON e.parent = b.descendant),
        places AS (
            SELECT dataset, (SELECT max(depth) FROM below WHERE descendant = e.dataset) AS depth,
                   (SELECT count(DISTINCT descendant) FROM below WHERE dataset = e.dataset) AS n_below
            FROM edges e),
        listed AS (
            SELECT CAST(o_custkey AS VARCHAR) AS root, o_orderkey AS k FROM orders
            WHERE o_custkey % 10 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer)),
        missing AS (
            SELECT CAST(c_custkey AS VARCHAR) AS root, 'match_ids' AS dataset FROM customer
            WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 10 <> 0)
            UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'summoner_raw' FROM customer WHERE c_custkey % 4 = 0
            UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'account_raw' FROM customer WHERE c_acctbal < 0
            UNION ALL SELECT root, 'match_raw' FROM listed WHERE k % 3 = 0
            UNION ALL SELECT root, 'match_timeline_raw' FROM listed WHERE k % 3 <> 0 AND k % 5 = 0),
        counts AS (SELECT root, dataset, count(*) AS n FROM missing GROUP BY root, dataset)
        SELECT root, first(dataset ORDER BY depth, dataset) AS first_stage, first(n ORDER BY depth, dataset) AS n_first,
               CAST(sum(n) AS BIGINT) AS n_missing, CAST(sum(n * n_below) AS BIGINT) AS n_waiting
        FROM counts JOIN places USING (dataset) GROUP BY root
    """,
    "request_batches": """
        SELECT key, n, n // 100 * 5 + n % 100 // 20 AS batch, n // 100 * 120 + n % 100 // 20 AS earliest_s
        FROM (SELECT o_orderkey AS key, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders)
    """,
    "response_source": """
        WITH asked AS (
            SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey AS k, CAST(o_orderdate AS TIMESTAMP) AS ts,
                   '{"metadata":{"matchId":"' || o_orderkey || '"},"info":{"platformId":' AS start,
                   ',"gameCreation":' || CAST(trunc(CAST(o_totalprice AS DECIMAL(30, 6))) AS BIGINT) || '}}' AS rest
            FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey % 7 <> 0)
        SELECT 'match_raw' AS dataset, 'fetch-2' AS batch_id, 'KR' AS region, key, ts, CAST(200 AS INTEGER) AS status, body
        FROM (
            SELECT key, ts, start || '"KR"' || rest AS body FROM asked
            UNION ALL SELECT key, ts + INTERVAL 1 HOUR, start || '"late"' || rest FROM asked WHERE k % 3 = 0
            UNION ALL SELECT key, ts, start || '"KR"' || rest FROM asked WHERE k % 5 = 0)
    """,
    "rate_audit": """
        SELECT *, in_3600s > 1 AS over_3600s, in_86400s > 5 AS over_86400s FROM (
            SELECT event_id, user_id, ts,
                   count(*) OVER (PARTITION BY user_id ORDER BY ts
                       RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS in_3600s,
                   count(*) OVER (PARTITION BY user_id ORDER BY ts
                       RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS in_86400s
            FROM events)
    """,
    "run_log": f"""
        SELECT *, CAST(0 AS BIGINT) AS rejected,
               CASE WHEN failures + unanswered = 0 THEN 'SUCCESS' WHEN requests_made = 0 THEN 'FAILED'
                    ELSE 'PARTIAL' END AS status
        FROM (
            SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id, min(ts) AS run_start,
                   max(ts) AS run_end,
                   count(*) FILTER (WHERE action = 'parse') AS requests_made,
                   count(*) FILTER (WHERE status = 429) AS count_429,
                   count(*) FILTER (WHERE action IN ('not_found', 'fail')) AS failures,
                   count(*) FILTER (WHERE status = 429) AS unanswered
            FROM ({_ACTIONS}) GROUP BY 1)
    """,
    "table_roundtrip": "SELECT count(*) AS cnt FROM orders",
    "catalog_check": """
        SELECT layer, true AS listed,
               CASE layer WHEN 'bronze' THEN (SELECT count(*) FROM orders) ELSE 1 END AS cnt
        FROM (VALUES ('bronze'), ('silver'), ('gold')) AS l(layer)
    """,
    "run_overlaps": """
        WITH runs AS (
            SELECT event_id, event_type AS dataset, ts AS a,
                   greatest(ts + to_seconds(CAST(floor(value) AS BIGINT)), ts + INTERVAL 1 MICROSECOND) AS b
            FROM events)
        SELECT r.event_id, r.dataset,
               count(o.event_id) FILTER (WHERE (o.a, o.b, o.event_id) < (r.a, r.b, r.event_id)) AS n_running,
               count(o.event_id) AS n_overlaps
        FROM runs r LEFT JOIN runs o
          ON o.dataset = r.dataset AND o.event_id <> r.event_id AND o.a < r.b AND o.b > r.a
        GROUP BY r.event_id, r.dataset
    """,
    "schema_drift": r"""
        WITH bodies AS (
            SELECT CASE event_type
                WHEN 'signup' THEN json_object('metadata', m)
                WHEN 'view' THEN json_object('metadata', m,
                    'info', json_object('created', event_id, 'value', CAST(value AS VARCHAR)))
                WHEN 'purchase' THEN json_object('metadata', m, 'info', i,
                    'lines', json_array(json_object('user_id', user_id, 'a.b', event_type),
                                        json_object('user_id', user_id)))
                ELSE json_object('metadata', m, 'info', i) END AS j
            FROM (SELECT *, json_object('id', CAST(event_id AS VARCHAR)) AS m,
                         json_object('created', event_id, 'value', value) AS i
                  FROM events WHERE event_type <> 'error')),
        tree AS (
            SELECT regexp_replace(t.fullkey, '\[\d+\]', '[]', 'g') AS path,
                   CASE WHEN t.type IN ('OBJECT', 'ARRAY', 'BOOLEAN', 'NULL') THEN lower(t.type)
                        WHEN t.type = 'VARCHAR' THEN 'string'
                        WHEN CAST(t.atom AS DOUBLE) = trunc(CAST(t.atom AS DOUBLE)) THEN 'integer'
                        ELSE 'number' END AS kind
            FROM bodies, json_tree(bodies.j) AS t),
        counts AS (
            SELECT path, kind, count(*) AS n FROM tree GROUP BY path, kind
            UNION ALL SELECT '$', 'malformed', count(*) FROM events WHERE event_type = 'error' HAVING count(*) > 0),
        declared(path, declared) AS (
            VALUES ('$', 'object'), ('$.metadata', 'object'), ('$.metadata.id', 'string'),
                   ('$.metadata.region', 'string'), ('$.info', 'object'), ('$.info.created', 'integer'),
                   ('$.info.value', 'number')),
        named AS (
            SELECT *, regexp_replace(path, '(\[\]|\."[^"]*"|\.\w+)$', '') AS parent
            FROM counts FULL JOIN declared USING (path)),
        held AS (SELECT path AS parent, n AS holders FROM counts WHERE kind = 'object'),
        present AS (SELECT path, sum(n) AS there FROM counts WHERE kind <> 'malformed' GROUP BY path)
        SELECT path, CASE WHEN kind = 'malformed' THEN 'malformed' WHEN kind IS NULL THEN 'missing'
                          WHEN declared IS NULL THEN 'new'
                          WHEN kind IN ('null', declared) OR (kind = 'integer' AND declared = 'number') THEN 'declared'
                          ELSE 'retyped' END AS status,
               declared, kind, CAST(coalesce(n, 0) AS BIGINT) AS n_values,
               CASE WHEN path <> '$' AND NOT ends_with(path, '[]')
                    THEN CAST(coalesce(holders, 0) - coalesce(there, 0) AS BIGINT) END AS n_absent
        FROM named LEFT JOIN held USING (parent) LEFT JOIN present USING (path)
    """,
    "ingest_rerun": """
        WITH ids AS (
            SELECT o_custkey, o_orderkey FROM orders
            QUALIFY row_number() OVER (
                PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 20),
        wanted AS (SELECT * FROM ids SEMI JOIN customer ON o_custkey = c_custkey),
        n AS (
            SELECT (SELECT count(*) FROM customer) AS players, (SELECT count(*) FROM wanted) AS ids,
                   (SELECT count(DISTINCT o_orderkey) FROM wanted) AS matches)
        SELECT dataset, CAST(first_run AS BIGINT) AS first_run, CAST(0 AS BIGINT) AS second_run
        FROM (
            SELECT 'league_entries' AS dataset, players AS first_run FROM n
            UNION ALL SELECT 'match_ids', ids FROM n
            UNION ALL SELECT 'match_raw', matches FROM n
            UNION ALL SELECT 'match_timeline_raw', matches FROM n
            UNION ALL SELECT 'summoner_raw', players FROM n
            UNION ALL SELECT 'account_raw', players FROM n)
    """,
    "ingest_match_raw": """
        WITH asked AS (
            SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(30, 6)) AS price FROM orders
            WHERE (o_orderstatus = 'F' OR o_orderkey % 100 = 0)
              AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0)
        SELECT CAST(k AS VARCHAR) AS match_id,
               '{"metadata":{"matchId":"' || k || '"},"info":{"platformId":"KR","gameCreation":'
                   || CAST(trunc(price) AS BIGINT) || '}}' AS raw_json,
               'KR' AS platform_id, CAST(trunc(price) AS BIGINT) AS game_creation,
               'batch-0001' AS _batch_id, TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at,
               'https://asia.api.example.com/lol/match/v5/matches/' || k AS _source_url
        FROM asked
    """,
    "ingest_league_entries": """
        SELECT CAST(c_custkey AS VARCHAR) AS puuid,
               CAST(c_nationkey + CASE WHEN c_acctbal >= 0 THEN 0 ELSE 1000 END AS BIGINT) AS leaguePoints,
               'KR' AS _region, 'CHALLENGER' AS _tier, c_custkey // 100 + 1 AS _page,
               'batch-0001' AS _batch_id, TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at,
               'https://kr.api.example.com/lol/league-exp/v4/entries/RANKED_SOLO_5x5/CHALLENGER/I?page='
                   || (c_custkey // 100 + 1) AS _source_url
        FROM customer
    """,
    "ingest_run_log": """
        WITH asked AS (
            SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'fetch-3' WHEN c_nationkey % 3 = 0 THEN 'fetch-0'
                        ELSE 'fetch-1+fetch-2' END AS batch_id, c_mktsegment AS s
            FROM customer),
        counted AS (
            SELECT batch_id, count(*) FILTER (WHERE s NOT IN ('MACHINERY', 'BUILDING')) AS requests_made,
                   count(*) FILTER (WHERE s IN ('MACHINERY', 'FURNITURE')) AS count_429,
                   count(*) FILTER (WHERE s NOT IN ('MACHINERY', 'BUILDING', 'HOUSEHOLD')) AS new_rows,
                   count(*) FILTER (WHERE s = 'HOUSEHOLD') AS rejected,
                   count(*) FILTER (WHERE s IN ('BUILDING', 'MACHINERY')) AS lost
            FROM asked GROUP BY batch_id)
        SELECT batch_id, 'summoner_raw' AS dataset, requests_made, count_429, new_rows, rejected,
               CASE WHEN rejected + lost = 0 THEN 'SUCCESS' WHEN new_rows = 0 THEN 'FAILED'
                    ELSE 'PARTIAL' END AS status
        FROM counted
    """,
}
