"""Named SQL fragments from which the comparison queries are put together."""

from __future__ import annotations

import re

# Fixed values repeated from the published rules, on purpose not shared with the Spark code.
_NOTES = (
    "Quebec (QC) - Requires adherence to Bill 101 (Language Charter) and PIPEDA privacy "
    "regulations. All communications must support French. Ensure GDPR-like privacy controls."
)

FRAGMENTS: dict[str, str] = {
    "raw_users": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id,
               split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               'user' || CAST(CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR)
                   || '@example.com' AS email,
               TIMESTAMP '2023-01-01 00:00:00' + to_hours(CAST(c_custkey % 17520 AS INTEGER)) AS created_at,
               'L' || CAST(c_custkey AS VARCHAR) AS location_id
        FROM customer""",
    "raw_locations": """
        SELECT 'L' || CAST(c_custkey AS VARCHAR) AS location_id,
               CASE WHEN n_regionkey <= 2 THEN 'US' WHEN n_regionkey = 3 THEN 'CA' ELSE 'MX' END AS country_code,
               CASE WHEN n_regionkey <= 2 THEN 'United States' WHEN n_regionkey = 3 THEN 'Canada' ELSE 'Mexico' END
                   AS country_full_name,
               'City ' || CAST(n_nationkey AS VARCHAR) AS city,
               CAST(c_custkey AS VARCHAR) || ' Main Street' AS address,
               CASE WHEN n_nationkey = 1 THEN '009' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0')
                    ELSE CAST(10000 + c_custkey % 90000 AS VARCHAR) END AS zip_code,
               CASE n_nationkey WHEN 0 THEN 'AK' WHEN 1 THEN 'PR' WHEN 3 THEN 'QC' WHEN 5 THEN 'HI' WHEN 8 THEN 'ON'
                    WHEN 10 THEN 'CA' WHEN 13 THEN 'BC' WHEN 15 THEN 'NY' WHEN 18 THEN 'QC' WHEN 20 THEN 'TX'
                    WHEN 23 THEN 'AB' ELSE 'WA' END AS state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_products": """
        SELECT p_name AS name,
               CASE p_size % 3 WHEN 0 THEN 'Living Room' WHEN 1 THEN 'Bedroom' ELSE 'Kitchen' END AS category,
               CAST(NULL AS VARCHAR) AS description, p_retailprice AS price, CAST(NULL AS VARCHAR) AS dimensions,
               p_brand AS material, p_size AS stock, CAST(p_partkey AS VARCHAR) AS id
        FROM part""",
    "raw_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
               o_orderdate AS order_date,
               CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
                    WHEN o_orderpriority = '1-URGENT' THEN 'cancelled'
                    WHEN o_orderpriority = '2-HIGH' THEN 'pending_refund' ELSE 'pending' END AS order_status,
               CASE o_orderkey % 3 WHEN 0 THEN 'credit card' WHEN 1 THEN 'paypal' ELSE 'bank transfer' END
                   AS payment_method,
               o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS updated_at
        FROM orders""",
    "raw_order_items": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
                   || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-'
                   || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) || '-'
                   || CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS VARCHAR) AS order_item_id,
               CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS unit_price, l_discount AS discount,
               CAST(round(CAST(l_quantity AS DECIMAL(10,0)) * CAST(l_extendedprice AS DECIMAL(12,2))
                          * (1 - CAST(l_discount AS DECIMAL(5,4))), 2)
                    + CASE WHEN l_orderkey % 1000 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS line_total
        FROM lineitem""",
    "raw_user_events": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
               CASE event_type WHEN 'signup' THEN 'user_sign_up' WHEN 'view' THEN 'page_view'
                    WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_type,
               ts AS event_timestamp,
               CASE WHEN event_type = 'signup' THEN '/signup' WHEN event_type = 'click' THEN '/product/add_to_cart'
                    WHEN event_type = 'purchase' THEN '/checkout'
                    WHEN event_type = 'view' AND event_id % 2 = 1 THEN '/product'
                    WHEN event_type = 'view' THEN '/catalog' ELSE '/error' END AS page_url,
               CASE WHEN event_type = 'click' OR (event_type = 'view' AND event_id % 2 = 1)
                    THEN CAST(event_id % 200 AS VARCHAR) END AS product_id,
               props AS additional_details
        FROM events""",
    "raw_rates": """
        SELECT * FROM (VALUES ('USD', CAST(1.0 AS DOUBLE)), ('CAD', CAST(0.74 AS DOUBLE)))
            AS t(currency_code, exchange_rate_to_usd)""",
    "stg_users": """
        SELECT user_id, first_name, last_name, email, created_at, location_id,
               row_number() OVER (PARTITION BY email ORDER BY created_at NULLS LAST, user_id NULLS LAST) > 1
                   AS is_duplicate_email
        FROM raw_users""",
    "stg_locations": f"""
        SELECT l.*, coalesce(r.exchange_rate_to_usd, 1.0) AS exchange_rate_to_usd,
               (country_code = 'US' AND (state IN ('AK', 'HI') OR zip_code LIKE '009%')) AS is_excluded_supply_chain,
               CASE WHEN country_code <> 'US' THEN NULL
                    WHEN state = 'AK' THEN 'Alaska - Excluded due to supply chain complexity'
                    WHEN state = 'HI' THEN 'Hawaii - Excluded due to supply chain complexity'
                    WHEN zip_code LIKE '009%' THEN 'Puerto Rico - Excluded due to supply chain complexity'
               END AS supply_chain_exclusion_reason,
               (country_code = 'CA' AND state = 'QC') AS is_quebec_compliant_required,
               CASE WHEN country_code = 'CA' AND state = 'QC' THEN '{_NOTES}' END AS quebec_compliance_notes,
               CASE WHEN country_code = 'CA' AND state = 'QC' THEN 'EN,FR' ELSE 'EN' END
                   AS marketing_language_requirement
        FROM (SELECT *, CASE country_code WHEN 'US' THEN 'USD' WHEN 'CA' THEN 'CAD' ELSE 'UNKNOWN' END AS currency_code
              FROM raw_locations) l
        LEFT JOIN raw_rates r USING (currency_code)""",
    "stg_orders": "SELECT * FROM raw_orders",
    "stg_order_items": "SELECT * FROM raw_order_items",
    "stg_products": """
        SELECT id AS product_id, name AS product_name, category, description, price, dimensions, material, stock
        FROM raw_products""",
    "user_flags": """
        SELECT u.user_id, l.country_code, l.state, l.zip_code, l.currency_code, l.exchange_rate_to_usd,
               l.is_quebec_compliant_required, l.is_excluded_supply_chain, l.supply_chain_exclusion_reason,
               l.marketing_language_requirement
        FROM stg_users u LEFT JOIN stg_locations l ON u.location_id = l.location_id""",
    "stg_user_events": """
        SELECT e.*, coalesce(f.is_quebec_compliant_required, false) AS is_quebec_event
        FROM raw_user_events e LEFT JOIN user_flags f ON e.user_id = f.user_id""",
    "orders_incr": """
        SELECT o.*, CASE WHEN f.is_quebec_compliant_required THEN 'QC' WHEN f.is_excluded_supply_chain THEN 'EXCLUDED'
                         ELSE 'STANDARD' END AS fulfillment_region_type
        FROM raw_orders o LEFT JOIN user_flags f ON o.user_id = f.user_id""",
    "fct_orders": """
        SELECT o.*, t.total_amount, t.total_items, t.num_line_items
        FROM stg_orders o LEFT JOIN (
            SELECT order_id, CAST(sum(CAST(line_total AS DECIMAL(15,2))) AS DOUBLE) AS total_amount,
                   CAST(sum(quantity) AS BIGINT) AS total_items, count(*) AS num_line_items
            FROM stg_order_items GROUP BY order_id) t ON o.order_id = t.order_id""",
    "order_lines": """
        SELECT o.*, i.order_item_id, i.product_id, i.quantity, i.unit_price, i.discount,
               CAST(i.line_total AS DECIMAL(15,2)) AS amount
        FROM raw_orders o JOIN raw_order_items i ON o.order_id = i.order_id""",
    "months": """
        SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(DISTINCT order_id) AS orders,
               sum(amount) AS amount
        FROM order_lines GROUP BY 1""",
    "rolling_months": """
        SELECT month, orders, CAST(amount AS DOUBLE) AS revenue,
               CAST(sum(amount) OVER w AS DOUBLE) / count(*) OVER w AS rolling
        FROM months WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "kept_months": "SELECT * FROM rolling_months WHERE month < (SELECT max(month) FROM rolling_months)",
    "statuses": """
        SELECT order_status, count(DISTINCT order_id) AS orders, sum(amount) AS amount
        FROM order_lines GROUP BY 1""",
    "customers": """
        SELECT user_id, count(DISTINCT order_id) AS order_count, sum(amount) AS amount
        FROM order_lines GROUP BY 1""",
    "pareto": """
        SELECT user_id, order_count, CAST(amount AS DOUBLE) AS ltv, CAST(sum(amount) OVER w AS DOUBLE) AS cumrev,
               CAST(CAST(100 * sum(amount) OVER w AS BIGINT) AS DOUBLE)
                   / CAST(CAST(100 * sum(amount) OVER () AS BIGINT) AS DOUBLE) * 100 AS cumrev_pct,
               CAST(row_number() OVER w AS DOUBLE) / count(*) OVER () * 100 AS cust_pct
        FROM customers
        WINDOW w AS (ORDER BY amount DESC NULLS LAST, user_id NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "order_values": """
        SELECT order_id, payment_method, sum(amount) AS amount, CAST(100 * sum(amount) AS BIGINT) AS cents
        FROM order_lines GROUP BY 1, 2""",
    "state_lines": """
        SELECT l.state, o.order_id, o.amount
        FROM order_lines o JOIN raw_users u ON o.user_id = u.user_id
             JOIN raw_locations l ON u.location_id = l.location_id""",
    "states": """
        SELECT state, state IN ('AK', 'HI') AS excluded, count(DISTINCT order_id) AS orders,
               CAST(sum(amount) AS DOUBLE) AS revenue
        FROM state_lines GROUP BY 1, 2""",
    "linked_steps": """
        SELECT page_url AS from_step,
               coalesce(lead(page_url) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id), 'EXIT') AS to_step
        FROM raw_user_events""",
}

_WORD = re.compile(r"\b[a-z_]+\b")


def with_fragments(body: str) -> str:
    """Prefix a query with the fragments it names, directly or through others."""
    order: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for word in _WORD.findall(text):
            if word in FRAGMENTS and word != own and word not in order:
                visit(FRAGMENTS[word], word)
                order.append(word)

    visit(body)
    if not order:
        return body
    body = body.strip()
    joined = ",\n" + body.removeprefix("WITH ") if body.startswith("WITH ") else "\n" + body
    return "WITH " + ",\n".join(f"{name} AS ({FRAGMENTS[name]})" for name in order) + joined
