"""DuckDB text of the derived fixture views (FIXTURES.md section 2).

Prepended as CTEs to every oracle query; the driver pre-registers the base
tables (``orders``, ``events``, ``lineitem`` ...) as views.  Timestamps stay
zone-less (UTC wall clock) so results compare with Spark's UTC session.
"""

FIXTURE_CTES = """
fx_base AS (
    SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority,
           DATE '2019-06-03' + CAST((o_orderkey * 37) % 112 AS INTEGER) AS sd,
           CASE WHEN o_orderkey % 5 = 0 THEN 1000000 + o_orderkey ELSE o_custkey END AS cu
    FROM orders
),
fx_base2 AS (
    SELECT *, CAST(sd AS TIMESTAMP) + INTERVAL 17 HOUR - INTERVAL 3 DAY
              - to_hours(CAST(24 + (k * 53) % 557 AS BIGINT)) - to_minutes(CAST(k % 59 AS BIGINT)) AS created_at
    FROM fx_base
),
weekly_orders AS (
    SELECT k AS id, cu AS subscription_id, cu AS user_id, o_orderstatus AS status,
           CAST(date_trunc('week', sd) AS DATE) AS start_date, created_at
    FROM fx_base2
),
deliveries AS (
    SELECT 1000000 + k AS id, k AS weekly_order_id, sd AS ship_date,
           CAST(CASE WHEN k % 89 = 0 THEN 4 ELSE 1 + k % 3 END AS INTEGER) AS facility_id,
           CAST(1 + (k // 3) % 2 AS INTEGER) AS freight_id,
           CAST(CASE WHEN k % 97 = 0 THEN 3 ELSE 1 + cu % 2 END AS INTEGER) AS plan_id,
           CAST([4, 6, 9, 12][CAST((k // 5) % 4 AS INTEGER) + 1] AS INTEGER) AS number_of_meals,
           row_number() OVER (PARTITION BY cu ORDER BY created_at, k) = 1 AS is_first_for_subscription,
           created_at
    FROM fx_base2
),
event_logs AS (
    SELECT 'deliveries' AS object_type, 1000000 + k AS object_id,
           created_at + to_hours(CAST(1 + (k * 29) % 199 AS BIGINT)) AS created_at,
           '{"status":["open","skipped_open"]}' AS change_set
    FROM fx_base2 WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
    UNION ALL
    SELECT 'deliveries', 1000000 + k, created_at + to_hours(CAST(30 + (k * 29) % 199 AS BIGINT)),
           '{"status":["skipped_open","open"]}'
    FROM fx_base2 WHERE o_orderpriority = '1-URGENT' AND (k // 7) % 2 = 0
    UNION ALL
    SELECT 'deliveries', 1000000 + k, created_at + INTERVAL 2 HOUR, '{"note":["a","b"]}'
    FROM fx_base2 WHERE o_orderpriority = '5-LOW'
    UNION ALL
    SELECT 'deliveries', 1000000 + k, created_at, '{"status":["open","admin_canceled_open"]}'
    FROM fx_base2 WHERE k % 83 = 0
    UNION ALL
    SELECT 'leads', 1000000 + k, created_at + INTERVAL 2 HOUR, '{"status":["open","not_paid"]}'
    FROM fx_base2 WHERE o_orderpriority = '4-NOT SPECIFIED'
),
plans AS (
    SELECT DISTINCT plan_id AS id, 'plan ' || plan_id AS name,
           CASE WHEN plan_id = 3 THEN NULL ELSE TIMESTAMP '2015-01-01 00:00:00' END AS created_at
    FROM deliveries
),
freights AS (
    SELECT DISTINCT freight_id AS id, 'freight ' || freight_id AS name,
           TIMESTAMP '2015-01-01 00:00:00' AS created_at
    FROM deliveries
),
facilities AS (
    SELECT DISTINCT facility_id AS id, 'facility ' || facility_id AS display_name,
           TIMESTAMP '2015-01-01 00:00:00' AS created_at
    FROM deliveries
),
timezones AS (
    SELECT * FROM (VALUES (1, 'US/Arizona'), (2, 'US/Eastern'), (3, 'US/Eastern'))
        AS t(facility_id, facility_timezone)
),
sync_times AS (
    SELECT max(ts) AS synced FROM events
    UNION ALL SELECT max(o_orderdate) FROM orders
    UNION ALL SELECT max(l_shipdate) FROM lineitem
    UNION ALL SELECT max(ts) FROM events WHERE event_type = 'signup'
)"""


def with_fixtures(*ctes: str, body: str) -> str:
    """Build ``WITH <fixtures>, <ctes...> <body>``."""
    parts = [FIXTURE_CTES.strip()] + [c.strip() for c in ctes if c and c.strip()]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
