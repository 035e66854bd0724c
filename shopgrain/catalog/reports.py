"""Reports, consumer queries and behaviour statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopgrain.catalog.registry import add
from shopgrain.catalog.relations import _MEANS, _SEGMENTS
from shopgrain.plans import behaviour, consumers, reports
from shopgrain.sources.raw import RawTables

_CENTS = "CAST(CAST({0} * 100 AS BIGINT) AS DOUBLE)"


def _share(part: str, whole: str) -> str:
    return f"{_CENTS.format(part)} / {_CENTS.format(whole)} * 100"


add("r1_monthly_revenue", reports.monthly_revenue, "SELECT month, orders, revenue, rolling FROM kept_months")
add(
    "r1_revenue_summary",
    reports.revenue_summary,
    "SELECT CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, count(*) AS months,"
    " (SELECT month FROM kept_months ORDER BY revenue DESC, month LIMIT 1) AS peak_month,"
    " max(revenue) AS peak_revenue FROM kept_months",
)
add(
    "r2_status_impact",
    reports.status_impact,
    "SELECT order_status, orders, CAST(amount AS DOUBLE) AS revenue,"
    f" {_share('amount', 'sum(amount) OVER ()')} AS pct FROM statuses",
)
_OF = "sum(amount) FILTER (order_status = '{0}')"
add(
    "r2_status_callout",
    reports.status_callout,
    "SELECT CAST(sum(amount) AS DOUBLE) AS gross,"
    f" CAST({_OF.format('cancelled')} AS DOUBLE) AS cancelled,"
    f" {_share(_OF.format('cancelled'), 'sum(amount)')} AS cancelled_pct,"
    f" CAST({_OF.format('delivered')} AS DOUBLE) AS confirmed,"
    f" {_share(_OF.format('delivered'), 'sum(amount)')} AS confirmed_pct,"
    " CAST(sum(amount) FILTER (order_status NOT IN ('cancelled', 'delivered')) AS DOUBLE) AS at_risk FROM statuses",
)
add("r3_customer_ltv", reports.customer_ltv, "SELECT * FROM pareto")
add("r3_pareto_cut", reports.pareto_cut, "SELECT min(cust_pct) AS cust_pct FROM pareto WHERE cumrev_pct >= 80")
add(
    "r4_frequency_segments",
    reports.frequency_segments,
    "SELECT segment, count(user_id) AS customers, coalesce(CAST(sum(amount) AS DOUBLE), 0) AS revenue,"
    f" {_share('coalesce(sum(amount), 0)', '(SELECT sum(amount) FROM customers)')} AS pct"
    f" FROM {_SEGMENTS} LEFT JOIN customers ON order_count BETWEEN lo AND hi GROUP BY 1",
)
add(
    "r5_category_performance",
    reports.category_performance,
    "SELECT category, count(order_item_id) AS items_sold,"
    f" CAST(sum(CAST(line_total AS DECIMAL(15,2))) AS DOUBLE) AS revenue, {_MEANS}"
    " FROM raw_order_items i JOIN raw_products p ON i.product_id = p.id GROUP BY 1",
)
add("r6_top_states", reports.top_states, "SELECT * FROM states ORDER BY revenue DESC, state LIMIT 15")
add(
    "r7_order_values",
    reports.order_value_list,
    "SELECT order_id, payment_method, CAST(amount AS DOUBLE) AS order_value FROM order_values",
)
add(
    "r7_order_value_statistics",
    reports.order_value_statistics,
    "SELECT count(*) AS orders, median(CAST(cents AS DOUBLE)) / 100 AS median_order_value,"
    " CAST(sum(amount) AS DOUBLE) / count(*) AS mean_order_value FROM order_values",
)
add(
    "r8_order_value_histogram",
    reports.order_value_histogram,
    "WITH span AS (SELECT min(cents) AS lo, max(cents) AS hi FROM order_values),"
    " binned AS (SELECT least((cents - lo) * 40 // (hi - lo), 39) AS bin, count(*) AS n"
    " FROM order_values, span GROUP BY 1)"
    " SELECT b.bin, (CAST(lo AS DOUBLE) + b.bin * CAST(hi - lo AS DOUBLE) / 40) / 100 AS lower,"
    " (CAST(lo AS DOUBLE) + (b.bin + 1) * CAST(hi - lo AS DOUBLE) / 40) / 100 AS upper,"
    " coalesce(n, 0) AS orders FROM range(40) b(bin) CROSS JOIN span LEFT JOIN binned ON binned.bin = b.bin",
)
add(
    "r9_payment_breakdown",
    reports.payment_breakdown,
    "SELECT payment_method, count(*) AS orders, CAST(sum(amount) AS DOUBLE) AS revenue,"
    " CAST(sum(amount) AS DOUBLE) / count(*) AS avg_order,"
    f" {_share('sum(amount)', '(SELECT sum(amount) FROM order_values)')} AS share FROM order_values GROUP BY 1",
)
add(
    "r10_key_figures",
    reports.key_figures,
    "SELECT 'users' AS metric, CAST(count(*) AS DOUBLE) AS value FROM raw_users"
    " UNION ALL SELECT 'orders', count(*) FROM raw_orders"
    " UNION ALL SELECT 'cancellation_rate_pct', CAST(count(*) FILTER (order_status = 'cancelled') AS DOUBLE)"
    " / count(*) * 100 FROM raw_orders"
    " UNION ALL SELECT 'purchasers', count(*) FROM customers"
    " UNION ALL SELECT 'repeat_purchasers', count(*) FROM customers WHERE order_count >= 2"
    " UNION ALL SELECT 'avg_customer_ltv', CAST(sum(amount) AS DOUBLE) / count(*) FROM customers"
    " UNION ALL SELECT 'avg_order_value', CAST(sum(amount) AS DOUBLE) / count(*) FROM order_values"
    " UNION ALL SELECT 'gross_gmv', CAST(sum(amount) AS DOUBLE) FROM order_values"
    " UNION ALL SELECT 'confirmed_revenue', CAST(sum(amount) AS DOUBLE) FROM statuses"
    " WHERE order_status = 'delivered'",
)

# -- documented consumer queries ------------------------------------------------------

add(
    "c1_confirmed_and_gross",
    consumers.confirmed_and_gross,
    "SELECT CAST(sum(amount) AS DOUBLE) AS gmv, CAST(sum(amount) FILTER (order_status = 'delivered') AS DOUBLE)"
    " AS confirmed, CAST(sum(amount) FILTER (order_status = 'pending_refund') AS DOUBLE) AS pending_refund"
    " FROM statuses",
)
add(
    "c2_order_revenue_in_usd",
    consumers.order_revenue_in_usd,
    "SELECT v.order_id, o.user_id, f.currency_code, f.exchange_rate_to_usd, CAST(v.amount AS DOUBLE) AS revenue,"
    " CAST(round(v.amount * CAST(f.exchange_rate_to_usd AS DECIMAL(10,6)), 2) AS DOUBLE) AS revenue_usd"
    " FROM order_values v JOIN raw_orders o ON v.order_id = o.order_id LEFT JOIN user_flags f ON o.user_id = f.user_id",
)
add(
    "c3_unique_users",
    consumers.unique_users,
    "SELECT * FROM stg_users WHERE NOT is_duplicate_email",
)
add(
    "c4_specialist_fulfilment",
    consumers.specialist_fulfilment,
    "SELECT o.order_id, o.user_id, o.order_date, o.order_status, f.state, f.zip_code,"
    " f.supply_chain_exclusion_reason FROM raw_orders o JOIN user_flags f ON o.user_id = f.user_id"
    " WHERE f.is_excluded_supply_chain",
)
add(
    "c5_reengagement_audience",
    # every buyer of the test data orders more than once, so the cut is moved up
    lambda raw: consumers.reengagement_audience(raw, at_most_orders=8),
    "SELECT c.user_id, c.order_count, CAST(c.amount AS DOUBLE) AS ltv, f.marketing_language_requirement"
    " FROM customers c LEFT JOIN user_flags f ON c.user_id = f.user_id WHERE c.order_count <= 8",
)


def _with_single_buyers(raw: RawTables) -> RawTables:
    """Every buyer of the test data orders more than once, so each user with an id that ends in 1
    has a twin beside them who made just the user's smallest order."""
    own = F.col("user_id").endswith("1")
    first = raw.orders.where(own).groupBy("user_id").agg(F.min("order_id").alias("order_id"))
    orders = raw.orders.join(first, ["user_id", "order_id"], "left_semi").select(*raw.orders.columns)
    items = raw.order_items.join(first.select("order_id"), "order_id", "left_semi").select(*raw.order_items.columns)
    users = raw.users.where(own)

    def twin(df, *names):
        return df.withColumns({c: F.concat(F.lit("twin-"), F.col(c)) for c in names})

    return raw.replace(
        users=raw.users.unionByName(twin(users, "user_id")),
        orders=raw.orders.unionByName(twin(orders, "user_id", "order_id")),
        order_items=raw.order_items.unionByName(twin(items, "order_item_id", "order_id")),
    )


add(
    "c5_single_purchase_audience",
    lambda raw: consumers.reengagement_audience(_with_single_buyers(raw)),
    "WITH firsts AS (SELECT user_id, min(order_id) AS order_id FROM raw_orders WHERE user_id LIKE '%1' GROUP BY 1)"
    " SELECT 'twin-' || d.user_id AS user_id, CAST(1 AS BIGINT) AS order_count, CAST(v.amount AS DOUBLE) AS ltv,"
    " f.marketing_language_requirement FROM firsts d JOIN order_values v ON v.order_id = d.order_id"
    " LEFT JOIN user_flags f ON d.user_id = f.user_id UNION ALL"
    " SELECT c.user_id, c.order_count, CAST(c.amount AS DOUBLE), f.marketing_language_requirement"
    " FROM customers c LEFT JOIN user_flags f ON c.user_id = f.user_id WHERE c.order_count = 1",
)
add(
    "c6_subject_access_extract",
    consumers.subject_access_extract,
    "SELECT r.* FROM (SELECT user_id, 'event' AS record_type, event_id AS record_id, event_timestamp AS recorded_at,"
    " event_type AS detail FROM raw_user_events UNION ALL SELECT user_id, 'order', order_id, order_date, order_status"
    " FROM raw_orders) r JOIN user_flags f ON r.user_id = f.user_id WHERE f.is_quebec_compliant_required",
)
add(
    "c7_quebec_exposure",
    consumers.quebec_exposure,
    "SELECT coalesce(f.is_quebec_compliant_required, false) AS is_quebec, count(DISTINCT order_id) AS orders,"
    " CAST(sum(amount) AS DOUBLE) AS revenue,"
    " count(DISTINCT order_id) FILTER (order_status = 'cancelled') AS cancelled_orders,"
    " CAST(coalesce(sum(amount) FILTER (order_status = 'cancelled'), 0) AS DOUBLE) AS cancelled_revenue"
    " FROM order_lines o LEFT JOIN user_flags f ON o.user_id = f.user_id GROUP BY 1",
)
add(
    "c8_price_paid_audit",
    consumers.price_paid_audit,
    "SELECT order_item_id, order_id, product_id, unit_price, price AS list_price,"
    " CAST(CAST(unit_price AS DECIMAL(12,2)) - CAST(price AS DECIMAL(12,2)) AS DOUBLE) AS difference"
    " FROM raw_order_items i JOIN raw_products p ON i.product_id = p.id"
    " WHERE CAST(unit_price AS DECIMAL(12,2)) <> CAST(price AS DECIMAL(12,2))",
)

# -- behaviour ----------------------------------------------------------------------------

add(
    "g1_transition_matrix",
    behaviour.transition_matrix,
    "SELECT from_step, to_step, count(*) AS transitions, CAST(count(*) AS DOUBLE)"
    " / sum(count(*)) OVER (PARTITION BY from_step) AS probability FROM linked_steps GROUP BY 1, 2",
)
add(
    "g2_funnel",
    behaviour.funnel,
    "WITH n AS (SELECT 1 AS step_no, 'catalog' AS step, count(DISTINCT user_id) AS users FROM raw_user_events"
    " WHERE page_url = '/catalog' UNION ALL SELECT 2, 'product', count(DISTINCT user_id) FROM raw_user_events"
    " WHERE page_url = '/product' UNION ALL SELECT 3, 'cart', count(DISTINCT user_id) FROM raw_user_events"
    " WHERE page_url = '/product/add_to_cart' UNION ALL SELECT 4, 'checkout', count(DISTINCT user_id)"
    " FROM raw_user_events WHERE page_url = '/checkout' UNION ALL SELECT 5, 'order', count(DISTINCT user_id)"
    " FROM raw_orders) SELECT step_no, step, users, CAST(users AS DOUBLE)"
    " / coalesce(lag(users) OVER (ORDER BY step_no), users) * 100 AS step_rate_pct FROM n",
)
