"""Independent SQL for the queries of the catalog, in DuckDB's dialect.

The statements restate each result from the given tables, without the library.
"""

# Shared table expressions.
_PARTS = {
    "raw_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(o_custkey AS VARCHAR) AS customer_id,
               CAST(o_orderdate AS TIMESTAMP) AS order_purchase_ts,
               CAST(o_orderdate AS TIMESTAMP) AS order_approved_ts,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS TIMESTAMP) END
                   AS order_delivered_customer_ts,
               CAST(o_orderdate + INTERVAL 30 DAY AS TIMESTAMP)
                   AS order_estimated_delivery_ts,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                    ELSE 'unknown' END AS order_status_normalized,
               CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS is_delivered,
               CASE WHEN o_orderstatus IN ('F', 'O') THEN 1 ELSE 0 END
                   AS is_status_valid,
               CAST(o_orderdate AS DATE) AS event_date
        FROM orders
        WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL
          AND o_orderdate IS NOT NULL""",
    "stg_orders": """
        SELECT * FROM raw_orders
        QUALIFY row_number() OVER (
            PARTITION BY order_id
            ORDER BY customer_id, order_purchase_ts, order_approved_ts,
                     order_delivered_customer_ts NULLS LAST,
                     order_estimated_delivery_ts, order_status_normalized) = 1""",
    "stg_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_linenumber AS order_item_id_int,
               CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_ts,
               l_extendedprice AS price_amount,
               l_tax AS freight_value_amount,
               round(l_extendedprice + l_tax, 2) AS item_total_amount
        FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
          AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL
          AND l_extendedprice >= 0 AND l_tax >= 0
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                     l_shipdate NULLS LAST, l_extendedprice, l_tax) = 1""",
    "stg_payments": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               l_linenumber AS payment_sequential_int,
               min(CAST(l_quantity AS INTEGER)) AS payment_installments_int,
               l_extendedprice - 1000 AS payment_value_amount,
               CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'boleto'
                    ELSE 'unknown' END AS payment_type_normalized,
               CASE WHEN l_returnflag IN ('R', 'A') THEN 1 ELSE 0 END
                   AS is_payment_type_valid,
               CASE WHEN l_extendedprice - 1000 >= 500 THEN 1 ELSE 0 END
                   AS is_high_value_payment
        FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_extendedprice - 1000 >= 0
        GROUP BY ALL""",
    "stg_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               c_name AS customer_unique_id,
               CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
               CASE WHEN c_acctbal >= 0 THEN lower(n_name) END AS customer_city,
               upper(r_name) AS customer_state,
               CASE WHEN c_acctbal >= 0 AND n_name <> '' THEN 1 ELSE 0 END
                   AS is_customer_city_valid,
               CASE WHEN r_name <> '' THEN 1 ELSE 0 END AS is_customer_state_valid
        FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey
        WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL
        QUALIFY row_number() OVER (
            PARTITION BY c_custkey
            ORDER BY c_name, c_nationkey, 4 NULLS LAST, 5 NULLS LAST) = 1""",
    "typed_events": """
        SELECT event_id, ts, user_id, value,
               CASE event_type WHEN 'signup' THEN 'order_created'
                    WHEN 'purchase' THEN 'payment_confirmed'
                    ELSE event_type END AS event_type
        FROM events""",
    "archived": """
        SELECT 'ecom.order_created.v1' AS topic,
               CAST(event_id % 4 AS BIGINT) AS "partition",
               CAST(event_id // 4 AS BIGINT) AS "offset",
               CAST(user_id AS VARCHAR) AS message_key,
               CAST(event_id AS VARCHAR) AS order_id,
               CAST(user_id AS VARCHAR) AS customer_id,
               event_type,
               CAST(ts AS VARCHAR) AS event_time,
               ts AS event_ts,
               CAST(ts AS DATE) AS event_date
        FROM typed_events
        WHERE event_id IS NOT NULL AND event_type IS NOT NULL AND ts IS NOT NULL""",
    "archived_by_key": """
        SELECT * FROM archived
        QUALIFY row_number() OVER (
            PARTITION BY message_key, "offset" ORDER BY "partition") = 1""",
    "per_order": """
        SELECT order_id,
               count(*) AS payment_record_count,
               CAST(sum(CAST(round(payment_value_amount * 100) AS BIGINT)) AS BIGINT)
                   AS cents,
               count(DISTINCT payment_sequential_int) AS payment_count,
               max(is_high_value_payment) AS has_high_value_payment,
               max(CASE WHEN payment_value_amount > 0 THEN 1 ELSE 0 END) AS paid
        FROM stg_payments
        GROUP BY order_id""",
    "enriched": """
        SELECT o.*,
               coalesce(p.payment_record_count, 0) AS payment_record_count,
               coalesce(p.cents, 0) AS cents,
               coalesce(p.payment_count, 0) AS payment_count,
               coalesce(p.has_high_value_payment, 0) AS has_high_value_payment,
               coalesce(p.paid, 0) AS paid
        FROM stg_orders o LEFT JOIN per_order p ON o.order_id = p.order_id""",
    "order_events": """
        SELECT DISTINCT event_id, user_id, ts FROM typed_events
        WHERE event_type = 'order_created' AND event_id IS NOT NULL
          AND user_id IS NOT NULL AND ts IS NOT NULL""",
    "payment_events": """
        SELECT DISTINCT event_id, user_id, ts, value FROM typed_events
        WHERE event_type = 'payment_confirmed' AND event_id IS NOT NULL
          AND value >= 0 AND ts IS NOT NULL""",
    "closed_orders": """
        SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, count(*) AS n
        FROM order_events GROUP BY 1
        HAVING time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes'
               <= (SELECT max(ts) - INTERVAL '20 minutes' FROM order_events)""",
    "closed_payments": """
        SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
               count(*) AS n,
               CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM payment_events GROUP BY 1
        HAVING time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes'
               <= (SELECT max(ts) - INTERVAL '20 minutes' FROM payment_events)""",
}

_NEEDS = {
    "stg_orders": ["raw_orders"],
    "archived": ["typed_events"],
    "archived_by_key": ["archived"],
    "per_order": ["stg_payments"],
    "enriched": ["stg_orders", "per_order"],
    "order_events": ["typed_events"],
    "payment_events": ["typed_events"],
    "closed_orders": ["order_events"],
    "closed_payments": ["payment_events"],
}


def _with(parts: str, select: str) -> str:
    """Put the named table expressions, and those they read, before a SELECT."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for part in parts.split():
        add(part)
    if not ordered:
        return select.strip()
    expressions = ",".join(f"\n    {name} AS ({_PARTS[name]})" for name in ordered)
    return f"WITH{expressions}\n{select.strip()}"


def _currency(cents: str) -> str:
    return f"CAST({cents} AS BIGINT) / CAST(100 AS DOUBLE)"


def _half_up(numerator: str, denominator: str, scale: int) -> str:
    """Half-up quotient on integers, as a double with the decimals of ``scale``."""
    n, d = f"CAST({numerator} AS BIGINT)", f"CAST({denominator} AS BIGINT)"
    return (
        f"(CASE WHEN {d} > 0 THEN ((2 * {n} + {d}) // (2 * {d}))"
        f" / CAST({scale} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"
    )


def _ratio(part: str, whole: str) -> str:
    return _half_up(f"(10000 * CAST({part} AS BIGINT))", whole, 10_000)


_MONTH = """CAST(year(event_date) AS INTEGER) AS summary_year,
       CAST(month(event_date) AS INTEGER) AS summary_month"""

_DAILY_SALES = f"""
SELECT event_date,
       count(DISTINCT order_id) AS order_count,
       count(DISTINCT customer_id) AS unique_customer_count,
       TRUE AS estimate_is_close,
       {_currency("sum(cents)")} AS total_revenue,
       {_half_up("sum(cents)", "count(*)", 100)} AS avg_revenue_per_order,
       CAST(sum(paid) AS BIGINT) AS orders_with_payment,
       CAST(sum(is_delivered) AS BIGINT) AS delivered_order_count,
       {_ratio("sum(paid)", "count(DISTINCT order_id)")} AS payment_coverage_ratio,
       {_ratio("sum(is_delivered)", "count(DISTINCT order_id)")}
           AS delivered_order_ratio,
       {_MONTH}
FROM enriched
GROUP BY event_date
"""

_STAGED_EVENTS = """
SELECT topic, "partition", "offset", message_key, order_id, customer_id, event_type,
       event_ts, event_date,
       CASE WHEN event_type = 'order_created' THEN 1 ELSE 0 END
           AS is_order_created_event
FROM archived
"""

_CURATED_ORDERS = """
SELECT order_id, customer_id, order_purchase_ts, order_approved_ts,
       order_delivered_customer_ts, order_estimated_delivery_ts,
       order_status_normalized, event_date AS order_date, is_delivered,
       is_status_valid,
       CAST(year(order_purchase_ts) AS INTEGER) AS order_year,
       CAST(month(order_purchase_ts) AS INTEGER) AS order_month
FROM stg_orders
"""

_ORDER_JSON = """'{"order_id":"' || event_id || '","customer_id":"' || user_id
       || '","event_type":"' || event_type || '","event_time":"' || ts || '"}'"""
_PAYMENT_JSON = """'{"order_id":"' || event_id || '","payment_id":"P' || event_id
       || '","event_type":"' || event_type || '","event_time":"' || ts
       || '","payment_value":' || value || '}'"""


def _wire_columns(topic: str, raw_json: str) -> str:
    return f"""'{topic}' AS topic, CAST(0 AS INTEGER) AS "partition",
       event_id AS "offset", ts AS kafka_ingest_ts,
       CAST(user_id AS VARCHAR) AS message_key,
       {raw_json} AS raw_json"""


_ORDER_WIRE = _wire_columns("ecom.order_created.v1", _ORDER_JSON)
_PAYMENT_WIRE = _wire_columns("ecom.payment_confirmed.v1", _PAYMENT_JSON)

_ORDERS_10M = """
SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start,
       time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' AS window_end,
       count(*) AS order_created_count
FROM order_events
GROUP BY 1, 2
HAVING window_end <= (SELECT max(ts) - INTERVAL '20 minutes' FROM order_events)
"""


_BATCH = """greatest(0, least(5, CAST(floor(date_diff('day', DATE '2024-01-01',
       CAST(ts AS DATE)) / 5.0) AS BIGINT) + CASE WHEN event_id % 20 = 0 THEN 2 ELSE 0 END))"""
_JUDGED_PAYMENTS = f"""
SELECT event_id, {_BATCH} AS batch, CASE
    WHEN event_id % 50 = 9 THEN 'no_text'
    WHEN event_id % 50 IN (1, 2) THEN 'malformed'
    WHEN event_id % 50 = 3 THEN 'wrong_type'
    WHEN event_id % 50 = 8 OR event_type IS NULL THEN 'no_event_type'
    WHEN event_type <> 'purchase' THEN 'other_event'
    WHEN event_id % 50 = 7 THEN 'no_id'
    WHEN event_id % 50 IN (4, 5) OR value IS NULL OR NOT value BETWEEN 0 AND 1e12 THEN 'unusable_amount'
    WHEN event_id % 50 = 6 OR ts IS NULL THEN 'unusable_time'
    ELSE 'kept' END AS reason
FROM events
"""


def _late_orders(figure: str) -> str:
    """Ten-minute counts over the arriving batches. A row is late when it is behind the
    watermark that the batch before the last one has left."""
    return _with(
        "order_events",
        f"""
, arriving AS (SELECT event_id, ts, {_BATCH} AS batch FROM order_events),
marks AS (SELECT b AS batch, (SELECT max(ts) FROM arriving WHERE batch <= b - 2)
          - INTERVAL '20 minutes' AS watermark FROM range(6) AS t(b)),
in_time AS (SELECT ts FROM arriving JOIN marks USING (batch)
            WHERE watermark IS NULL OR ts > watermark)
SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start,
       time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' AS window_end,
       count(*) AS order_created_count, {figure}
FROM in_time
GROUP BY 1, 2
HAVING window_end <= (SELECT max(ts) - INTERVAL '20 minutes' FROM arriving)
""",
    )


def _mart(orders: str, payments: str) -> str:
    """Daily mart over two expressions with window_start, n and, for money, cents."""
    return f"""
SELECT o.sales_date, o.n AS order_count, coalesce(p.n, 0) AS payment_confirmed_count,
       {_currency("coalesce(p.cents, 0)")} AS total_revenue,
       {_half_up("coalesce(p.cents, 0)", "o.n", 100)} AS avg_order_value
FROM (SELECT CAST(window_start AS DATE) AS sales_date, CAST(sum(n) AS BIGINT) AS n
      FROM {orders} GROUP BY 1) o
LEFT JOIN (SELECT CAST(window_start AS DATE) AS sales_date,
                  CAST(sum(n) AS BIGINT) AS n, CAST(sum(cents) AS BIGINT) AS cents
           FROM {payments} GROUP BY 1) p ON o.sales_date = p.sales_date
"""


_ORDERS_BY_MINUTE = "(SELECT ts AS window_start, 1 AS n FROM order_events)"
_PAYMENTS_BY_MINUTE = """(SELECT ts AS window_start, 1 AS n,
      CAST(round(value * 100) AS BIGINT) AS cents FROM payment_events)"""

_GOLD_RULES = (
    ("daily event_date is null", "event_date IS NULL"),
    ("daily order_count is not positive", "order_count <= 0"),
    ("daily total_revenue is negative", "total_revenue < 0"),
    ("orders_with_payment exceeds order_count", "orders_with_payment > order_count"),
    (
        "delivered_order_count exceeds order_count",
        "delivered_order_count > order_count",
    ),
)


def _gold_report() -> str:
    """Counts over ``daily`` and over ``compared``, one row per rule."""
    rules = [
        f"SELECT '{name}' AS check_name, count(*) AS failed_rows"
        f" FROM daily WHERE {bad}"
        for name, bad in _GOLD_RULES
    ]
    rules.append(
        "SELECT 'daily table is empty', CAST(count(*) = 0 AS BIGINT) FROM daily"
    )
    rules.append(
        "SELECT 'daily and hourly order counts differ', count(*)"
        " FROM compared WHERE coalesce(order_count, 0) <> coalesce(hourly_order_count, 0)"
    )
    return "\nUNION ALL\n".join(rules)


_ODD_PAYMENTS = """SELECT *, l_extendedprice - 1000 AS v, l_partkey % 100 AS part
FROM lineitem"""

_STATEMENTS: dict[str, str] = {
    "preview_orders": """
SELECT CAST(o_orderkey AS BIGINT) AS order_id, o_custkey AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN ' Shipped '
            ELSE o_orderstatus END AS order_status,
       CAST(o_orderdate AS TIMESTAMP) AS order_purchase_ts
FROM orders WHERE o_orderkey IS NOT NULL
""",
    "clean_orders_basic": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN ' Shipped '
            ELSE o_orderstatus END AS order_status,
       CAST(o_orderdate AS TIMESTAMP) AS order_purchase_ts,
       CAST(o_orderdate AS DATE) AS order_date
FROM orders
WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
""",
    "curate_orders": _with("stg_orders", _CURATED_ORDERS),
    "csv_orders_scan": _with("stg_orders", _CURATED_ORDERS),
    "partitioned_orders_scan": _with("stg_orders", _CURATED_ORDERS),
    "stage_orders": _with("stg_orders", "SELECT * FROM stg_orders"),
    "curate_order_items": _with(
        "stg_items",
        """
SELECT order_id, product_id, seller_id, order_item_id_int AS order_item_id,
       shipping_limit_ts, price_amount, freight_value_amount,
       item_total_amount AS line_total_amount
FROM stg_items
""",
    ),
    "stage_order_items": _with(
        "stg_items",
        """
SELECT *, CAST(1 AS INTEGER) AS is_valid_price, CAST(1 AS INTEGER) AS is_valid_freight
FROM stg_items
""",
    ),
    "stage_payments": _with("stg_payments", "SELECT * FROM stg_payments"),
    "stage_customers": _with("stg_customers", "SELECT * FROM stg_customers"),
    "curate_order_events": _with(
        "archived",
        """
SELECT *, CAST(year(event_ts) AS INTEGER) AS event_year,
       CAST(month(event_ts) AS INTEGER) AS event_month
FROM archived
""",
    ),
    "stage_order_events": _with("archived", _STAGED_EVENTS),
    "jsonl_events_scan": _with("archived", _STAGED_EVENTS),
    "stage_order_events_by_key": _with(
        "archived_by_key", _STAGED_EVENTS.replace("archived", "archived_by_key")
    ),
    "payments_by_order": _with(
        "per_order",
        f"""
SELECT order_id, payment_record_count, {_currency("cents")} AS payment_total_value,
       has_high_value_payment
FROM per_order
""",
    ),
    "payment_facts_by_order": _with(
        "per_order",
        f"""
SELECT order_id, {_currency("cents")} AS payment_total_value, payment_count,
       paid AS has_payment
FROM per_order
""",
    ),
    "orders_with_payments": _with(
        "enriched",
        f"""
SELECT * EXCLUDE (cents, payment_count, paid),
       {_currency("cents")} AS payment_total_value,
       CASE WHEN payment_record_count > 0 THEN 1 ELSE 0 END AS has_payment
FROM enriched
""",
    ),
    "daily_orders_payments_summary": _with(
        "enriched",
        f"""
SELECT event_date,
       count(DISTINCT order_id) AS order_count,
       count(DISTINCT customer_id) AS unique_customer_count,
       count(*) FILTER (WHERE payment_record_count > 0) AS orders_with_payment,
       {_currency("sum(cents)")} AS total_payment_value,
       CAST(sum(is_delivered) AS BIGINT) AS delivered_order_count,
       CAST(sum(has_high_value_payment) AS BIGINT) AS high_value_payment_order_count,
       {_ratio("count(*) FILTER (WHERE payment_record_count > 0)",
               "count(DISTINCT order_id)")} AS payment_coverage_ratio
FROM enriched
GROUP BY event_date
""",
    ),
    "daily_sales_summary": _with("enriched", _DAILY_SALES),
    "daily_sales_head": _with(
        "enriched", f"{_DAILY_SALES.strip()} ORDER BY event_date LIMIT 30"
    ),
    "best_sales_days": _with(
        "enriched",
        f"{_DAILY_SALES.strip()} ORDER BY total_revenue DESC, event_date LIMIT 30",
    ),
    "hourly_order_summary": f"""
WITH hours AS (
    SELECT date_trunc('hour', ts) AS order_hour_ts,
           CAST(ts AS DATE) AS event_date,
           count(DISTINCT event_id) AS order_count,
           count(DISTINCT user_id) AS unique_customer_count
    FROM events
    WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND ts IS NOT NULL
    GROUP BY 1, 2)
SELECT order_hour_ts, event_date,
       CAST(hour(order_hour_ts) AS INTEGER) AS order_hour,
       order_count, unique_customer_count, TRUE AS estimate_is_close,
       {_MONTH}
FROM hours
""",
    "orders_by_city_day": _with(
        "stg_orders stg_customers",
        f"""
SELECT event_date,
       coalesce(c.customer_city, 'unknown') AS customer_city,
       coalesce(c.customer_state, 'unknown') AS customer_state,
       count(DISTINCT o.order_id) AS order_count,
       count(DISTINCT o.customer_id) AS unique_customer_count,
       {_MONTH}
FROM stg_orders o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id
GROUP BY event_date, coalesce(c.customer_city, 'unknown'),
         coalesce(c.customer_state, 'unknown')
""",
    ),
    "payment_ratio_by_day": _with(
        "enriched",
        f"""
SELECT event_date,
       count(DISTINCT order_id) AS order_count,
       count(DISTINCT CASE WHEN payment_count > 0 THEN order_id END)
           AS orders_with_payment,
       {_ratio("count(DISTINCT CASE WHEN payment_count > 0 THEN order_id END)",
               "count(DISTINCT order_id)")} AS payment_coverage_ratio,
       {_MONTH}
FROM enriched
GROUP BY event_date
""",
    ),
    "top_products_by_day": _with(
        "stg_orders stg_items",
        f"""
SELECT event_date, product_id, order_count, product_revenue,
       CAST(row_number() OVER (
           PARTITION BY event_date ORDER BY product_revenue DESC, product_id)
           AS INTEGER) AS rank_in_day,
       {_MONTH}
FROM (SELECT o.event_date, i.product_id,
             count(DISTINCT i.order_id) AS order_count,
             {_currency("sum(CAST(round(i.price_amount * 100) AS BIGINT))")}
                 AS product_revenue
      FROM stg_items i JOIN stg_orders o ON i.order_id = o.order_id
      GROUP BY o.event_date, i.product_id)
QUALIFY rank_in_day <= 10
""",
    ),
    "all_products_by_day": "",
    "payment_ratio_by_day_of_copies": "",
    "daily_vs_hourly": """
SELECT CAST(ts AS DATE) AS event_date,
       count(DISTINCT event_id) AS order_count,
       count(DISTINCT event_id) AS hourly_order_count,
       CAST(0 AS BIGINT) AS order_count_diff
FROM events
WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND ts IS NOT NULL
GROUP BY 1
""",
    "validate_gold": f"""
WITH daily AS (
    SELECT CAST(ts AS DATE) AS event_date,
           count(DISTINCT event_id) AS order_count,
           sum(value) AS total_revenue,
           count(DISTINCT CASE WHEN value > 0 THEN event_id END)
               AS orders_with_payment,
           count(DISTINCT CASE WHEN event_type = 'signup' THEN event_id END)
               AS delivered_order_count
    FROM events WHERE ts IS NOT NULL GROUP BY 1),
hourly AS (
    SELECT date_trunc('hour', ts) AS h, count(DISTINCT event_id) AS n
    FROM events WHERE ts IS NOT NULL GROUP BY 1),
compared AS (
    SELECT order_count, hourly_order_count
    FROM daily FULL JOIN (SELECT CAST(h AS DATE) AS event_date, sum(n) AS hourly_order_count
                     FROM hourly GROUP BY 1) USING (event_date))
{_gold_report()}
""",
    "validate_unchecked_daily": f"""
WITH daily AS (
    SELECT CAST(o_orderdate AS DATE) AS event_date,
           CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS order_count,
           o_totalprice - 50000 AS total_revenue,
           CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 0 END AS orders_with_payment,
           CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS delivered_order_count
    FROM orders),
compared AS (
    SELECT order_count, hourly_order_count
    FROM daily FULL JOIN (SELECT event_date, count(*) AS hourly_order_count
                     FROM daily GROUP BY 1) USING (event_date))
{_gold_report()}
""",
    "validate_gold_missing_days": f"""
WITH daily AS (
    SELECT CAST(ts AS DATE) AS event_date, count(DISTINCT event_id) AS order_count,
           0 AS total_revenue, 0 AS orders_with_payment, 0 AS delivered_order_count
    FROM events WHERE ts IS NOT NULL AND day(ts) <> 5 GROUP BY 1),
compared AS (
    SELECT order_count, hourly_order_count
    FROM daily FULL JOIN (
        SELECT CAST(ts AS DATE) AS event_date, count(DISTINCT event_id)
                   AS hourly_order_count
        FROM events WHERE ts IS NOT NULL AND day(ts) <> 7 GROUP BY 1)
        USING (event_date))
{_gold_report()}
UNION ALL SELECT 'order_id is not unique', count(DISTINCT event_id) FROM events
WHERE ts IS NOT NULL AND event_id % 3 = 0
""",
    "rejected_amounts": f"""
WITH odd AS ({_ODD_PAYMENTS})
SELECT 'payment_value is no number' AS check_name, count(*) AS failed_rows
FROM odd WHERE part = 4
UNION ALL SELECT 'payment_value is not finite or too large', count(*)
FROM odd WHERE part IN (1, 2, 3, 5)
UNION ALL SELECT 'payment_value is negative', count(*)
FROM odd WHERE part NOT IN (1, 2, 3, 4, 5) AND v < 0
""",
    "stage_payments_odd_amounts": f"""
WITH odd AS ({_ODD_PAYMENTS})
SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
       l_linenumber AS payment_sequential_int,
       min(CAST(l_quantity AS INTEGER)) AS payment_installments_int,
       v AS payment_value_amount,
       CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'boleto'
            ELSE 'unknown' END AS payment_type_normalized,
       CASE WHEN l_returnflag IN ('R', 'A') THEN 1 ELSE 0 END AS is_payment_type_valid,
       CASE WHEN v >= 500 THEN 1 ELSE 0 END AS is_high_value_payment
FROM odd
WHERE l_orderkey IS NOT NULL AND v >= 0 AND part NOT IN (1, 2, 3, 4, 5)
GROUP BY ALL
""",
    "check_serving": _with(
        "order_events payment_events",
        f"""
, mart AS ({_mart(_ORDERS_BY_MINUTE, _PAYMENTS_BY_MINUTE)})
SELECT 'mart is empty' AS check_name,
       CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS failed_rows
FROM mart
UNION ALL SELECT 'sales_date is null', count(*) FROM mart WHERE sales_date IS NULL
UNION ALL SELECT 'total_revenue is negative', count(*) FROM mart
          WHERE total_revenue < 0
UNION ALL SELECT 'sales_date is duplicated', count(*)
          FROM (SELECT sales_date FROM mart GROUP BY 1 HAVING count(*) > 1)
""",
    ),
    "table_profiles": _with(
        "stg_orders stg_items stg_payments stg_customers",
        """
SELECT 'stg_orders' AS table_name, count(*) AS row_count FROM stg_orders
UNION ALL SELECT 'stg_order_items', count(*) FROM stg_items
UNION ALL SELECT 'stg_payments', count(*) FROM stg_payments
UNION ALL SELECT 'stg_customers', count(*) FROM stg_customers
""",
    ),
    "partition_layouts": """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
              WHERE o_orderdate IS NOT NULL)
SELECT 'by_event_date' AS layout, count(*) AS folder_count, count(*) AS file_count
FROM days
UNION ALL
SELECT 'by_year_month',
       count(DISTINCT year(d)) + count(DISTINCT date_trunc('month', d)),
       count(DISTINCT date_trunc('month', d))
FROM days
""",
    "order_created_events": """
SELECT CAST(o_orderkey AS VARCHAR) AS "key",
       '{"order_id":"' || o_orderkey || '","customer_id":"' || o_custkey
       || '","event_type":"order_created","event_time":"'
       || CAST(o_orderdate AS TIMESTAMP) || '"}' AS "value"
FROM orders
WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
""",
    "payment_confirmed_events": """
SELECT CAST(l_orderkey AS VARCHAR) AS "key",
       '{"order_id":"' || l_orderkey || '","payment_id":"' || l_orderkey || '_'
       || l_linenumber || '","event_type":"payment_confirmed",'
       || '"event_time":"2018-01-01 00:00:00","payment_value":'
       || CAST(l_extendedprice - 1000 AS VARCHAR) || '}' AS "value"
FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
  AND l_extendedprice IS NOT NULL
""",
    "first_order_created_events": """
SELECT CAST(o_orderkey AS VARCHAR) AS "key",
       '{"order_id":"' || o_orderkey || '","customer_id":"' || o_custkey
       || '","event_type":"order_created","event_time":"'
       || CAST(o_orderdate AS TIMESTAMP) || '"}' AS "value"
FROM orders
WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
ORDER BY CAST(o_orderkey AS VARCHAR), CAST(o_orderdate AS TIMESTAMP),
         CAST(o_custkey AS VARCHAR)
LIMIT 100
""",
    "timed_payment_events": """
SELECT CAST(l_orderkey AS VARCHAR) AS "key",
       '{"order_id":"' || l_orderkey || '","payment_id":"' || l_orderkey || '_'
       || l_linenumber || '","event_type":"payment_confirmed",'
       || '"event_time":"' || CAST(l_shipdate AS TIMESTAMP) || '","payment_value":'
       || CAST(l_extendedprice - 1000 AS VARCHAR) || '}' AS "value"
FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
  AND l_extendedprice IS NOT NULL AND l_partkey % 10 <> 0 AND l_shipdate IS NOT NULL
""",
    "stream_parse_order_created": _with(
        "typed_events",
        f"""
SELECT {_ORDER_WIRE},
       CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
       event_type, CAST(ts AS VARCHAR) AS event_time, ts AS event_ts
FROM typed_events
WHERE event_type = 'order_created' AND event_id IS NOT NULL
  AND user_id IS NOT NULL AND ts IS NOT NULL
""",
    ),
    "stream_parse_payment_confirmed": _with(
        "typed_events",
        f"""
SELECT {_PAYMENT_WIRE},
       CAST(event_id AS VARCHAR) AS order_id, 'P' || event_id AS payment_id,
       event_type, CAST(ts AS VARCHAR) AS event_time, value AS payment_value,
       ts AS event_ts
FROM typed_events
WHERE event_type = 'payment_confirmed' AND event_id IS NOT NULL
  AND value >= 0 AND ts IS NOT NULL
""",
    ),
    "stream_order_count_10m": _with("order_events", _ORDERS_10M),
    "stream_order_count_10m_redelivered": _with("order_events", _ORDERS_10M),
    "stream_payment_revenue_5m": _with(
        "closed_payments",
        f"""
SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end,
       n AS payment_confirmed_count, {_currency("cents")} AS payment_revenue
FROM closed_payments
""",
    ),
    "stream_fact_orders_5m": _with(
        "closed_orders",
        """
SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end,
       n AS order_created_count, TRUE AS estimate_is_close
FROM closed_orders
""",
    ),
    "stream_fact_payments_5m": _with(
        "closed_payments",
        f"""
SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end,
       n AS payment_confirmed_count, {_currency("cents")} AS payment_revenue,
       round({_currency("cents")} / n, 6) AS avg_payment_value
FROM closed_payments
""",
    ),
    "stream_order_metrics": _with(
        "order_events closed_payments",
        f"""
SELECT 'orders' AS metric, window_start, window_end,
       order_created_count AS event_count, CAST(0 AS DOUBLE) AS revenue
FROM ({_ORDERS_10M.strip()})
UNION ALL
SELECT 'payments', window_start, window_start + INTERVAL '5 minutes', n,
       {_currency("cents")}
FROM closed_payments
""",
    ),
    "stream_raw_landing": _with(
        "typed_events",
        f"""
SELECT {_ORDER_WIRE} FROM typed_events
UNION ALL
SELECT {_PAYMENT_WIRE} FROM typed_events
""",
    ),
    "landing_by_hour": """
SELECT CAST(ts AS DATE) AS landing_date, CAST(hour(ts) AS INTEGER) AS landing_hour,
       count(*) AS record_count
FROM events
GROUP BY 1, 2
""",
    "landing_compacted": """
SELECT CAST(ts AS DATE) AS landing_date, count(*) AS record_count,
       TRUE AS rows_are_equal, TRUE AS files_are_fewer
FROM events
GROUP BY 1
""",
    "stream_late_orders": _late_orders(
        """(SELECT count(*) FROM arriving) - (SELECT count(*) FROM in_time) AS late_rows"""
    ),
    "stream_late_orders_resumed": _late_orders("TRUE AS was_stopped_underway"),
    "stream_rejected_payments": f"""
WITH judged AS ({_JUDGED_PAYMENTS})
SELECT batch, reason, count(judged.event_id) AS record_count, TRUE AS adds_up
FROM (SELECT b AS batch, r AS reason
      FROM range(6) AS t(b), unnest(['kept', 'no_text', 'malformed', 'wrong_type', 'no_event_type',
           'other_event', 'no_id', 'unusable_amount', 'unusable_time']) AS u(r))
LEFT JOIN judged USING (batch, reason)
GROUP BY ALL
""",
    "rejected_payments_by_reason": f"""
SELECT reason, count(*) AS record_count
FROM ({_JUDGED_PAYMENTS}) WHERE reason <> 'kept' GROUP BY 1
""",
    "mart_daily_sales_from_archive": _with(
        "order_events payment_events", _mart(_ORDERS_BY_MINUTE, _PAYMENTS_BY_MINUTE)
    ),
    "mart_daily_sales_from_streams": _with(
        "closed_orders closed_payments",
        f"""
SELECT *, TRUE AS unique_customer_count_is_close, TRUE AS sketched_customer_count_is_close
FROM ({_mart("closed_orders", "closed_payments").strip()})
""",
    ),
    "mart_published_twice": _with(
        "order_events payment_events", _mart(_ORDERS_BY_MINUTE, _PAYMENTS_BY_MINUTE)
    ),
    "mart_of_flat_replay": _with(
        "closed_orders",
        _mart("closed_orders", "(SELECT window_start, n, 0 AS cents FROM closed_orders WHERE FALSE)"),
    ),
    "mart_customer_estimates": _with(
        "order_events",
        """
SELECT CAST(ts AS DATE) AS sales_date,
       count(DISTINCT (time_bucket(INTERVAL '5 minutes', ts), user_id))
           AS window_customers,
       count(DISTINCT user_id) AS day_customers,
       TRUE AS added_is_close, TRUE AS merged_is_close
FROM order_events
GROUP BY 1
""",
    ),
}

_STATEMENTS["all_products_by_day"] = _STATEMENTS["top_products_by_day"].replace(
    "rank_in_day <= 10", "rank_in_day <= 2000"
)
_STATEMENTS["payment_ratio_by_day_of_copies"] = _STATEMENTS["payment_ratio_by_day"]

# The catalog returns dates as timestamps at midnight.
_DATES = {
    "event_date": """
        curate_order_events stage_order_events jsonl_events_scan stage_orders
        stage_order_events_by_key
        orders_with_payments daily_orders_payments_summary daily_sales_summary
        daily_sales_head hourly_order_summary orders_by_city_day
        payment_ratio_by_day top_products_by_day daily_vs_hourly
        payment_ratio_by_day_of_copies all_products_by_day best_sales_days""",
    "order_date": """
        clean_orders_basic curate_orders csv_orders_scan partitioned_orders_scan""",
    "sales_date": """
        mart_daily_sales_from_archive mart_daily_sales_from_streams
        mart_published_twice mart_of_flat_replay mart_customer_estimates""",
    "landing_date": "landing_by_hour landing_compacted",
}
_DATE_OF = {
    query: date for date, queries in _DATES.items() for query in queries.split()
}


def _finished(name: str) -> str:
    statement = _STATEMENTS[name].strip()
    if name not in _DATE_OF:
        return statement
    date = _DATE_OF[name]
    return (
        f"SELECT * REPLACE (CAST({date} AS TIMESTAMP) AS {date})\n"
        f"FROM (\n{statement}\n)"
    )


ORACLES: dict[str, str] = {name: _finished(name) for name in _STATEMENTS}
