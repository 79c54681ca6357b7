"""The relations of `inputs.py` and the shared views in SQL, for the oracles."""

from __future__ import annotations

PROFILE_COLS = ("email", "first_name", "last_name", "created_at", "lifecycle_stage", "is_active")
_LATEST = ", ".join(f"arg_max({c}, source_seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in PROFILE_COLS)
_MONEY = "CAST(SUM(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"


def money(column: str) -> str:
    return _MONEY.format(column)


ORDER_EVENTS = """
order_events AS (
  SELECT o_orderkey * 2 + 1 AS source_seq, CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         (CAST(ROUND(o_totalprice * 100) AS BIGINT) // {scale}) / CAST(100 AS DOUBLE) AS order_total,
         'USD' AS currency, NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS channel,
         (epoch_us(o_orderdate) // 1000) + (o_orderkey * 1237) % 86400000 AS placed_at,
         'SKU-' || CAST(o_orderkey % 6 AS VARCHAR) AS sku
  FROM orders)"""
NEWEST_ORDERS = """
newest_orders AS (
  SELECT order_id, customer_id, order_total, placed_at FROM order_events WHERE CAST(order_id AS BIGINT) % 7 <> 0
  UNION ALL
  SELECT order_id, CAST(CAST(customer_id AS BIGINT) + 1 AS VARCHAR), order_total + 1.0, placed_at - 864000000
  FROM order_events WHERE CAST(order_id AS BIGINT) % 7 = 0)"""
RESENT_ORDERS = """
resent_orders AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_suppkey AS VARCHAR) AS customer_id,
         (CAST(ROUND(l_extendedprice * 100) AS BIGINT) // {scale}) / CAST(100 AS DOUBLE) AS order_total,
         epoch_us(l_shipdate) // 1000 AS placed_at
  FROM lineitem)"""
ACTIVATION_EVENTS = """
activation_events AS (
  SELECT event_id * 3 + 2 AS source_seq, CAST(event_id AS VARCHAR) AS activation_id,
         'ENG-' || CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
         event_type AS channel,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'delivered' ELSE 'failed' END AS status,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN epoch_us(ts) // 1000 END AS delivered_at,
         CAST(CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 3 + 1 AS INTEGER) AS attempts
  FROM events)"""
PROFILE_EVENTS = """
first_profiles AS (
  SELECT c_custkey * 21 + 1 AS source_seq, CAST(c_custkey AS VARCHAR) AS customer_id,
         CASE WHEN c_custkey % 5 <> 0 THEN lower(c_name) || '@example.com' END AS email,
         CASE WHEN c_custkey % 10 = 0 THEN '' ELSE 'Customer' END AS first_name,
         split_part(c_name, '#', 2) AS last_name, 1577836800000 + c_custkey * 60001 AS created_at,
         CASE WHEN c_custkey % 7 <> 0 THEN lower(c_mktsegment) END AS lifecycle_stage, c_acctbal >= 0 AS is_active
  FROM customer
  UNION ALL
  SELECT s_suppkey * 21 + 1, 'S-' || CAST(s_suppkey AS VARCHAR), 's' || CAST(s_suppkey AS VARCHAR) || '@example.com',
         'Supplier', split_part(s_name, '#', 2), 1577836800000 + s_suppkey * 60001, 'prospect', FALSE
  FROM supplier),
profile_updates AS (
  SELECT event_id * 3 AS source_seq, CAST(user_id AS VARCHAR) AS customer_id,
         CASE WHEN event_id % 3 <> 0 THEN 'u' || CAST(event_id AS VARCHAR) || '@mail.example.com' END AS email,
         CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name, epoch_us(ts) // 1000 AS created_at,
         CASE WHEN event_id % 5 <> 0 THEN event_type END AS lifecycle_stage, event_type <> 'error' AS is_active
  FROM events),
profile_events AS (SELECT * FROM first_profiles UNION ALL SELECT * FROM profile_updates)"""
PROFILES = f"profiles AS (SELECT customer_id, {_LATEST} FROM profile_events GROUP BY customer_id)"
SILVER_CUSTOMERS = """
silver_customers AS (
  SELECT * FROM profile_events QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY source_seq DESC) = 1)"""
ORDER_SUMMARY = f"""
order_summary AS (
  SELECT customer_id, {money('order_total')} AS lifetime_value, COUNT(*) AS order_count, MAX(placed_at) AS last_order_ts
  FROM order_events GROUP BY customer_id)"""
ACTIVATION_SUMMARY = """
activation_summary AS (
  SELECT customer_id, COUNT(CASE WHEN status = 'delivered' THEN 1 END) AS delivered_messages,
         COUNT(CASE WHEN status <> 'delivered' THEN 1 END) AS failed_messages, MAX(delivered_at) AS last_engagement_ts
  FROM activation_events GROUP BY customer_id)"""
CONSOLIDATED = """
consolidated AS (
  SELECT s.customer_id, s.order_count, s.lifetime_value, s.last_order_ts, p.first_name, p.last_name, p.email,
         p.lifecycle_stage, p.is_active, COALESCE(a.delivered_messages, 0) AS delivered_messages,
         COALESCE(a.failed_messages, 0) AS failed_messages, a.last_engagement_ts
  FROM order_summary s LEFT JOIN profiles p ON s.customer_id = p.customer_id
  LEFT JOIN activation_summary a ON s.customer_id = a.customer_id)"""
SERVING = """
serving AS (
  SELECT COALESCE(c.customer_id, p.customer_id) AS customer_id, COALESCE(c.email, p.email) AS email,
         COALESCE(c.first_name, p.first_name) AS first_name, COALESCE(c.last_name, p.last_name) AS last_name,
         COALESCE(c.lifecycle_stage, p.lifecycle_stage) AS lifecycle_stage, COALESCE(c.is_active, p.is_active) AS is_active,
         COALESCE(c.lifetime_value, 0.0) AS lifetime_value, COALESCE(c.order_count, 0) AS order_count,
         COALESCE(c.delivered_messages, 0) AS delivered_messages, COALESCE(c.failed_messages, 0) AS failed_messages,
         c.last_order_ts
  FROM consolidated c FULL OUTER JOIN profiles p ON c.customer_id = p.customer_id)"""

_STEPS = {
    "order_events": (ORDER_EVENTS, ()),
    "newest_orders": (NEWEST_ORDERS, ("order_events",)),
    "resent_orders": (RESENT_ORDERS, ()),
    "activation_events": (ACTIVATION_EVENTS, ()),
    "profile_events": (PROFILE_EVENTS, ()),
    "profiles": (PROFILES, ("profile_events",)),
    "silver_customers": (SILVER_CUSTOMERS, ("profile_events",)),
    "order_summary": (ORDER_SUMMARY, ("order_events",)),
    "activation_summary": (ACTIVATION_SUMMARY, ("activation_events",)),
    "consolidated": (CONSOLIDATED, ("order_summary", "profiles", "activation_summary")),
    "serving": (SERVING, ("consolidated",)),
}


def given(*names: str, scale: int = 1) -> str:
    """WITH clause defining the named relations and what they are built from."""
    order: list[str] = []

    def add(name: str) -> None:
        text, needs = _STEPS[name]
        for need in needs:
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(_STEPS[n][0].strip().replace("{scale}", str(scale)) for n in order)
