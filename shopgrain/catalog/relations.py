"""Joins, aggregates, windows, filters over periods, and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.catalog.registry import add
from shopgrain.functions import money
from shopgrain.operators import quality, ranked
from shopgrain.plans import mart, reports, staging
from shopgrain.plans.checks import orphan_items
from shopgrain.sources.raw import RawTables

# -- joins ------------------------------------------------------------------------

add(
    "j1_left_rate_lookup",
    lambda raw: staging.with_currency(raw.locations, raw.exchange_rates),
    "SELECT location_id, country_code, country_full_name, city, address, zip_code, state, currency_code,"
    " exchange_rate_to_usd FROM stg_locations",
)
add(
    "j2_left_user_place",
    lambda raw: staging.user_places(raw.users, raw.locations),
    "SELECT user_id, country_code, state, zip_code FROM user_flags",
)
add(
    "j3_left_event_region",
    lambda raw: staging.flag_quebec_events(
        raw.user_events.select("event_id", "user_id"), raw.users, raw.locations
    ),
    "SELECT event_id, user_id, is_quebec_event FROM stg_user_events",
)


def _items_of_orders_and_products(raw: RawTables) -> DataFrame:
    facts = mart.fct_order_items(
        staging.stg_order_items(raw.order_items), staging.stg_orders(raw.orders), staging.stg_products(raw.products)
    )
    return facts.select("order_item_id", "user_id", "order_status", "category")


add(
    "j4_left_item_order_product",
    _items_of_orders_and_products,
    "SELECT i.order_item_id, o.user_id, o.order_status, p.category FROM raw_order_items i"
    " LEFT JOIN raw_orders o ON i.order_id = o.order_id LEFT JOIN raw_products p ON i.product_id = p.id",
)


def _event_products(raw: RawTables) -> DataFrame:
    facts = mart.fct_user_events(staging.typed_user_events(raw.user_events), staging.stg_products(raw.products))
    return facts.select("event_id", "product_id", "product_name")


add(
    "j5_left_nullable_product",
    _event_products,
    "SELECT e.event_id, e.product_id, p.name AS product_name FROM raw_user_events e"
    " LEFT JOIN raw_products p ON e.product_id = p.id",
)
add(
    "j6_left_preaggregate",
    lambda raw: mart.fct_orders(
        staging.stg_orders(raw.orders), staging.stg_order_items(raw.order_items)
    ).select("order_id", "total_items", "num_line_items"),
    "SELECT order_id, total_items, num_line_items FROM fct_orders",
)
add(
    "j7_inner_orders_items",
    lambda raw: reports.order_values(raw).select("order_id", money.from_units(F.col("units")).alias("order_value")),
    "SELECT order_id, CAST(sum(amount) AS DOUBLE) AS order_value FROM order_lines GROUP BY 1",
)
add(
    "j8_inner_items_products",
    lambda raw: raw.order_items.join(raw.products, raw.order_items.product_id == raw.products.id).select(
        "order_item_id", "category", "price"
    ),
    "SELECT order_item_id, category, price FROM raw_order_items i JOIN raw_products p ON i.product_id = p.id",
)
add(
    "j9_inner_four_way",
    lambda raw: reports.orders_with_state(raw).select("order_id", "state", money.from_units(F.col("units")).alias("value")),
    "SELECT order_id, state, CAST(sum(amount) AS DOUBLE) AS value FROM state_lines GROUP BY 1, 2",
)


def _orders_without_items(raw: RawTables) -> DataFrame:
    # distinct first: an order with very many items is one row per task before the shuffle
    filled = raw.order_items.select("order_id").distinct()
    return raw.orders.join(filled, "order_id", "left_anti").select("order_id", "user_id")


add(
    "j10_left_anti",
    _orders_without_items,
    "SELECT order_id, user_id FROM raw_orders o WHERE NOT EXISTS"
    " (SELECT 1 FROM raw_order_items i WHERE i.order_id = o.order_id)",
)


ITEMS_WITH_ORPHANS = (
    "SELECT order_item_id, order_id FROM raw_order_items UNION ALL"
    " SELECT 'gone-' || order_item_id, 'gone-' || order_id FROM raw_order_items"
)


def with_orphans(child: DataFrame, key: str, reference: str) -> DataFrame:
    """The test tables have no orphans: every row comes once more under an unknown reference."""
    lost = {c: F.concat(F.lit("gone-"), F.col(c)) for c in (key, reference)}
    return child.unionByName(child.withColumns(lost))


add(
    "j11_referential",
    lambda raw: quality.orphan_rows(
        with_orphans(raw.order_items, "order_item_id", "order_id"), "order_id", raw.orders, "order_id"
    ).select("order_item_id", "order_id"),
    f"SELECT order_item_id, order_id FROM ({ITEMS_WITH_ORPHANS}) WHERE order_id IS NOT NULL AND order_id NOT IN"
    " (SELECT order_id FROM raw_orders)",
)
add(
    "f8_not_exists",
    lambda raw: orphan_items(with_orphans(raw.order_items, "order_item_id", "order_id"), raw.orders),
    f"SELECT order_item_id, order_id FROM ({ITEMS_WITH_ORPHANS}) i WHERE NOT EXISTS"
    " (SELECT 1 FROM raw_orders o WHERE o.order_id = i.order_id)",
)

# -- aggregates -------------------------------------------------------------------------

add(
    "a1_sum_count_by_key",
    lambda raw: mart.order_totals(staging.stg_order_items(raw.order_items)).select(
        "order_id", money.from_units(F.col("total_units")).alias("total_amount"), "total_items", "num_line_items"
    ),
    "SELECT order_id, total_amount, total_items, num_line_items FROM fct_orders WHERE num_line_items IS NOT NULL",
)
add(
    "a2_count_distinct",
    lambda raw: reports.monthly_totals(raw).select("month", "orders", money.from_cents(F.col("cents")).alias("revenue")),
    "SELECT month, orders, CAST(amount AS DOUBLE) AS revenue FROM months",
)
add(
    "a3_count_non_null",
    lambda raw: raw.user_events.groupBy("event_type").agg(
        F.count("product_id").alias("with_product"), F.count("*").alias("events")
    ),
    "SELECT event_type, count(product_id) AS with_product, count(*) AS events FROM raw_user_events GROUP BY 1",
)


def _rounded_means(raw: RawTables) -> DataFrame:
    cents = money.divide_half_up(F.col("units"), F.col("n") * money.UNITS_PER_CENT)
    tenths = money.divide_half_up(F.col("discounts"), F.col("n") * 10)
    return (
        raw.order_items.groupBy("product_id")
        .agg(
            money.total_units(F.col("unit_price")).alias("units"),
            money.total_units(F.col("discount")).alias("discounts"),
            F.count("*").alias("n"),
        )
        .select(
            "product_id",
            money.from_cents(cents).alias("avg_unit_price"),
            (tenths.cast("double") / 10.0).alias("avg_discount_pct"),
        )
    )


_MEANS = (
    "CAST((2 * CAST(sum(CAST(unit_price AS DECIMAL(12,2))) * 100 AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE)"
    " / 100 AS avg_unit_price,"
    " CAST((2 * CAST(sum(CAST(discount AS DECIMAL(5,4))) * 10000 AS BIGINT) + 10 * count(*)) // (20 * count(*))"
    " AS DOUBLE) / 10 AS avg_discount_pct"
)

add("a4_rounded_means", _rounded_means, f"SELECT product_id, {_MEANS} FROM raw_order_items GROUP BY 1")
add(
    "a5_high_water_mark",
    lambda raw: raw.orders.agg(F.max("updated_at").alias("newest")),
    "SELECT max(updated_at) AS newest FROM raw_orders",
)
add(
    "a6_two_level",
    lambda raw: reports.payment_breakdown(raw).select("payment_method", "orders", "revenue"),
    "SELECT payment_method, count(*) AS orders, CAST(sum(amount) AS DOUBLE) AS revenue FROM order_values GROUP BY 1",
)
add(
    "a7_median",
    reports.order_value_median,
    "SELECT median(CAST(cents AS DOUBLE)) / 100 AS median_order_value, count(*) AS orders FROM order_values",
)
add(
    "a7_mean",
    reports.order_value_mean,
    "SELECT CAST(sum(amount) AS DOUBLE) / count(*) AS mean_order_value FROM order_values",
)


def _quantity_histogram(raw: RawTables) -> DataFrame:
    found = ranked.histogram(raw.order_items, "quantity", bins=10)
    return found.select("bin", "n")


add(
    "a8_histogram",
    _quantity_histogram,
    "SELECT b.bin, count(v.q) AS n FROM range(10) b(bin) LEFT JOIN (SELECT quantity AS q,"
    " least((quantity - min(quantity) OVER ()) * 10 // (max(quantity) OVER () - min(quantity) OVER ()), 9) AS bin"
    " FROM raw_order_items) v ON v.bin = b.bin GROUP BY 1",
)


def _by_order_count(raw: RawTables) -> DataFrame:
    return reports.frequency_segments(raw).select("segment", "revenue")


_SEGMENTS = (
    "(VALUES ('1 order', 1, 1), ('2 orders', 2, 2), ('3+ orders', 3, 9223372036854775807)) s(segment, lo, hi)"
)
add(
    "a9_conditional_sums",
    _by_order_count,
    f"SELECT segment, coalesce(CAST(sum(amount) AS DOUBLE), 0) AS revenue FROM {_SEGMENTS}"
    " LEFT JOIN customers ON order_count BETWEEN lo AND hi GROUP BY 1",
)
add(
    "a10_scalar_picks",
    lambda raw: reports.status_callout(raw).select("cancelled", "confirmed", "at_risk"),
    "SELECT CAST(sum(amount) FILTER (order_status = 'cancelled') AS DOUBLE) AS cancelled,"
    " CAST(sum(amount) FILTER (order_status = 'delivered') AS DOUBLE) AS confirmed,"
    " CAST(sum(amount) FILTER (order_status NOT IN ('cancelled', 'delivered')) AS DOUBLE) AS at_risk FROM statuses",
)
add(
    "a11_share_of_total",
    lambda raw: reports.status_impact(raw).select("order_status", "pct"),
    "SELECT order_status, CAST(CAST(amount * 100 AS BIGINT) AS DOUBLE)"
    " / CAST(CAST(sum(amount) OVER () * 100 AS BIGINT) AS DOUBLE) * 100 AS pct FROM statuses",
)
add(
    "a12_peak_month",
    reports.peak_month,
    "SELECT month, revenue FROM kept_months ORDER BY revenue DESC, month LIMIT 1",
)
add(
    "a13_repeated_values",
    lambda raw: quality.repeated_values(raw.users, "email"),
    "SELECT email, count(*) AS n_records FROM raw_users WHERE email IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
)

# -- windows -------------------------------------------------------------------------------

add(
    "w1_first_per_email",
    lambda raw: staging.stg_users(raw.users).select("user_id", "email", "is_duplicate_email"),
    "SELECT user_id, email, is_duplicate_email FROM stg_users",
)
add(
    "w2_trailing_mean",
    lambda raw: reports.monthly_rolling(raw).select("month", "rolling"),
    "SELECT month, rolling FROM rolling_months",
)
add(
    "w3_cumulative_sum",
    lambda raw: reports.customer_ltv(raw).select("user_id", "cumrev"),
    "SELECT user_id, cumrev FROM pareto",
)
add(
    "w4_cumulative_share",
    lambda raw: reports.customer_ltv(raw).select("user_id", "cumrev_pct"),
    "SELECT user_id, cumrev_pct FROM pareto",
)
add(
    "w5_positional_percentile",
    lambda raw: reports.customer_ltv(raw).select("user_id", "cust_pct"),
    "SELECT user_id, cust_pct FROM pareto",
)
add(
    "w6_first_at_share",
    reports.pareto_cut,
    "SELECT min(cust_pct) AS cust_pct FROM pareto WHERE cumrev_pct >= 80",
)
add(
    "w7_grand_total",
    lambda raw: reports.customer_ranking(raw).select(
        "user_id", money.from_cents(F.col("cents_total")).alias("total"), F.col("rows_total").alias("customers")
    ),
    "SELECT user_id, CAST(sum(amount) OVER () AS DOUBLE) AS total, count(*) OVER () AS customers FROM customers",
)
add(
    "f9_drop_last_period",
    lambda raw: reports.drop_last_period(reports.monthly_totals(raw), "month").select("month", "orders"),
    "SELECT month, orders FROM kept_months",
)

# -- sort and limit ----------------------------------------------------------------------------

add("l1_order_by_month", lambda raw: reports.monthly_totals(raw).select("month", "orders").orderBy(F.asc_nulls_last("month")),
    "SELECT month, orders FROM months ORDER BY 1")
add(
    "l2_order_by_revenue",
    lambda raw: reports.status_impact(raw).select("order_status", "revenue"),
    "SELECT order_status, CAST(amount AS DOUBLE) AS revenue FROM statuses ORDER BY 2 DESC",
)
add(
    "l3_top_k",
    lambda raw: reports.top_states(raw, limit=5),
    "SELECT * FROM states ORDER BY revenue DESC, state LIMIT 5",
)
