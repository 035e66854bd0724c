"""Data checks: failing rows of single checks, and the whole suite."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopgrain.catalog import changes
from shopgrain.catalog.models import RUN_TIME
from shopgrain.catalog.registry import add
from shopgrain.catalog.relations import ITEMS_WITH_ORPHANS, with_orphans
from shopgrain.operators import quality
from shopgrain.plans import checks, staging
from shopgrain.sources.raw import RawTables

add(
    "q1_not_null",
    lambda raw: quality.null_rows(raw.user_events, "product_id").select("event_id", "event_type"),
    "SELECT event_id, event_type FROM raw_user_events WHERE product_id IS NULL",
)
add(
    "q2_unique",
    lambda raw: quality.repeated_values(raw.users, "email"),
    "SELECT email, count(*) AS n_records FROM raw_users WHERE email IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
)
add(
    "q3_accepted_values",
    lambda raw: quality.unaccepted_rows(raw.user_events, "event_type", checks.EVENT_TYPES).select("event_id", "event_type"),
    "SELECT event_id, event_type FROM raw_user_events"
    " WHERE event_type NOT IN ('user_sign_up', 'page_view', 'add_to_cart')",
)
add(
    "q4_relationships",
    lambda raw: quality.orphan_rows(
        with_orphans(raw.user_events, "event_id", "user_id"), "user_id", raw.users, "user_id"
    ).select("event_id", "user_id"),
    "SELECT event_id, user_id FROM (SELECT event_id, user_id FROM raw_user_events UNION ALL"
    " SELECT 'gone-' || event_id, 'gone-' || user_id FROM raw_user_events) WHERE user_id IS NOT NULL"
    " AND user_id NOT IN (SELECT user_id FROM raw_users)",
)


def _damaged_places(raw: RawTables):
    """Locations with faults in both Quebec columns, so the rules have rows to return."""
    places = staging.stg_locations(raw.locations, raw.exchange_rates)
    odd = F.col("city") == "City 3"
    return places.withColumns(
        {
            "quebec_compliance_notes": F.when(odd, F.lit(None)).otherwise(F.col("quebec_compliance_notes")),
            "currency_code": F.when(odd, "USD").otherwise(F.col("currency_code")),
        }
    )


add(
    "q5_quebec_language",
    lambda raw: checks.quebec_language_gaps(_damaged_places(raw)),
    "SELECT location_id, country_code, state, CAST(NULL AS VARCHAR) AS quebec_compliance_notes FROM stg_locations"
    " WHERE is_quebec_compliant_required AND city = 'City 3'",
)
add(
    "q6_quebec_pricing",
    lambda raw: checks.quebec_pricing_gaps(_damaged_places(raw)),
    "SELECT location_id, country_code, state, 'USD' AS currency_code, exchange_rate_to_usd FROM stg_locations"
    " WHERE is_quebec_compliant_required AND city = 'City 3'",
)
_TOTAL = (
    "SELECT order_item_id, order_id, quantity, unit_price, discount, line_total, CAST(e AS DOUBLE)"
    " AS expected_line_total, CAST(abs(CAST(line_total AS DECIMAL(15,2)) - e) AS DOUBLE) AS variance FROM"
    " (SELECT *, round(CAST(quantity AS DECIMAL(10,0)) * CAST(unit_price AS DECIMAL(12,2))"
    " * (1 - CAST(discount AS DECIMAL(5,4))), 2) AS e FROM raw_order_items)"
    " WHERE abs(CAST(line_total AS DECIMAL(15,2)) - e) > 0.01"
)
add("q7_line_total_integrity", lambda raw: checks.line_total_gaps(raw.order_items), _TOTAL)
add(
    "q8_financial_bounds",
    lambda raw: checks.financial_bound_gaps(
        # a copy of the items with shifted values, as the source has no impossible ones
        raw.order_items.withColumns(
            {"quantity": F.col("quantity") - 1, "discount": F.col("discount") * 10, "line_total": F.col("line_total") - 2000}
        )
    ),
    "SELECT * FROM (SELECT order_item_id, order_id, quantity - 1 AS quantity, unit_price, discount * 10 AS discount,"
    " line_total - 2000 AS line_total FROM raw_order_items)"
    " WHERE quantity <= 0 OR unit_price <= 0 OR discount < 0 OR discount >= 1 OR line_total < 0",
)
add(
    "q9_orphan_order_items",
    lambda raw: checks.orphan_items(with_orphans(raw.order_items, "order_item_id", "order_id"), raw.orders),
    f"SELECT order_item_id, order_id FROM ({ITEMS_WITH_ORPHANS}) i WHERE NOT EXISTS"
    " (SELECT 1 FROM raw_orders o WHERE o.order_id = i.order_id)",
)


# -- suite -------------------------------------------------------------------------------
# The comparison states the published checks again, on its own and by table, so that one that
# the library's list lacks, or has beside them, turns the comparison red.

_INCR_ITEMS = "(SELECT *, TIMESTAMP '2024-06-01 12:00:00' AS loaded_at FROM raw_order_items)"
_STATUSES = "'pending', 'shipped', 'delivered', 'cancelled', 'pending_refund'"
_METHODS, _EVENTS = "'credit card', 'paypal', 'bank transfer'", "'user_sign_up', 'page_view', 'add_to_cart'"

# Fixed values: (layer, table) -> columns that are not null, unique, within values, and referring.
_PUBLISHED = {
    ("source", "users"): (
        "user_id first_name last_name email created_at location_id", "user_id email", {},
        {"location_id": ("source", "locations", "location_id")},
    ),
    ("source", "locations"): (
        "location_id country_code country_full_name city state address zip_code", "location_id",
        {"country_code": "'US', 'CA'"}, {},
    ),
    ("source", "products"): (
        "id name category price stock", "id", {"category": "'Living Room', 'Bedroom', 'Kitchen'"}, {},
    ),
    ("source", "orders"): (
        "order_id user_id order_date order_status payment_method updated_at", "order_id",
        {"order_status": _STATUSES, "payment_method": _METHODS}, {"user_id": ("source", "users", "user_id")},
    ),
    ("source", "order_items"): (
        "order_item_id order_id product_id quantity unit_price discount line_total", "order_item_id", {},
        {"order_id": ("source", "orders", "order_id"), "product_id": ("source", "products", "id")},
    ),
    ("source", "user_events"): (
        "event_id user_id event_type event_timestamp page_url", "event_id", {"event_type": _EVENTS},
        {"user_id": ("source", "users", "user_id"), "product_id": ("source", "products", "id")},
    ),
    ("staging", "stg_users"): (
        "user_id first_name last_name email created_at location_id is_duplicate_email", "user_id", {},
        {"location_id": ("staging", "stg_locations", "location_id")},
    ),
    ("staging", "stg_locations"): (
        "location_id country_code country_full_name city state zip_code address currency_code exchange_rate_to_usd"
        " is_excluded_supply_chain is_quebec_compliant_required marketing_language_requirement", "location_id",
        {"country_code": "'US', 'CA'", "currency_code": "'USD', 'CAD'", "marketing_language_requirement": "'EN', 'EN,FR'"}, {},
    ),
    ("staging", "stg_orders"): (
        "order_id user_id order_date order_status payment_method updated_at", "order_id",
        {"order_status": _STATUSES, "payment_method": _METHODS}, {"user_id": ("staging", "stg_users", "user_id")},
    ),
    ("staging", "stg_order_items"): (
        "order_item_id order_id product_id quantity unit_price discount line_total", "order_item_id", {},
        {"order_id": ("staging", "stg_orders", "order_id"), "product_id": ("staging", "stg_products", "product_id")},
    ),
    ("staging", "stg_products"): ("product_id product_name category price stock", "product_id", {}, {}),
    ("staging", "stg_user_events"): (
        "event_id user_id event_type event_timestamp page_url is_quebec_event", "event_id", {"event_type": _EVENTS},
        {"user_id": ("staging", "stg_users", "user_id"), "product_id": ("staging", "stg_products", "product_id")},
    ),
    ("staging_incremental", "stg_orders_incr"): (
        "order_id user_id order_date order_status payment_method updated_at fulfillment_region_type", "order_id",
        {"order_status": _STATUSES, "payment_method": _METHODS, "fulfillment_region_type": "'QC', 'EXCLUDED', 'STANDARD'"},
        {"user_id": ("staging", "stg_users", "user_id")},
    ),
    ("staging_incremental", "stg_order_items_incr"): (
        "order_item_id order_id product_id quantity unit_price discount line_total loaded_at", "order_item_id", {},
        {"order_id": ("staging_incremental", "stg_orders_incr", "order_id"), "product_id": ("staging", "stg_products", "product_id")},
    ),
    ("staging_incremental", "stg_user_events_incr"): (
        "event_id user_id event_type event_timestamp page_url is_quebec_event", "event_id", {"event_type": _EVENTS},
        {"user_id": ("staging", "stg_users", "user_id"), "product_id": ("staging", "stg_products", "product_id")},
    ),
}
_RULES = (
    (
        "staging", "stg_locations", "quebec_language_requirements",
        "SELECT count(*) FROM stg_locations WHERE is_quebec_compliant_required AND (quebec_compliance_notes IS NULL OR"
        " lower(quebec_compliance_notes) NOT LIKE '%french%' OR lower(quebec_compliance_notes) NOT LIKE '%bill 101%')",
    ),
    (
        "staging", "stg_locations", "quebec_transparent_pricing",
        "SELECT count(*) FROM stg_locations WHERE is_quebec_compliant_required AND (currency_code <> 'CAD'"
        " OR exchange_rate_to_usd IS NULL OR exchange_rate_to_usd <= 0)",
    ),
    ("source", "order_items", "line_total_integrity", f"SELECT count(*) FROM ({_TOTAL})"),
    (
        "source", "order_items", "no_negative_financials",
        "SELECT count(*) FROM raw_order_items WHERE quantity <= 0 OR unit_price <= 0 OR discount < 0"
        " OR discount >= 1 OR line_total < 0",
    ),
    (
        "source", "order_items", "no_orphan_order_items",
        "SELECT count(*) FROM raw_order_items i WHERE NOT EXISTS"
        " (SELECT 1 FROM raw_orders o WHERE o.order_id = i.order_id)",
    ),
)


def _suite_sql(tables: tuple[str, ...] | None = None, layer: str | None = None, stored: dict[str, str] | None = None) -> str:
    """The report of the published checks: all, of some tables or of a layer. ``stored`` has SQL
    for tables that aren't as after a first run."""
    sql_of = {
        "stg_orders_incr": "orders_incr", "stg_order_items_incr": _INCR_ITEMS, "stg_user_events_incr": "stg_user_events",
        **{table: f"raw_{table}" for of, table in _PUBLISHED if of == "source"}, **(stored or {}),
    }
    rows = []

    def add_row(of: str, table: str, column: str, test: str, failures: str) -> None:
        if layer in (None, of) and (tables is None or table in tables):
            rows.append(f"SELECT '{of}' AS layer, '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test, ({failures}) AS failures")

    for (of, table), (required, unique, accepted, refers) in _PUBLISHED.items():
        source = sql_of.get(table, table)
        for column in required.split():
            add_row(of, table, column, "not_null", f"SELECT count(*) FROM {source} WHERE {column} IS NULL")
        for column in unique.split():
            repeated = f"SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
            add_row(of, table, column, "unique", f"SELECT count(*) FROM ({repeated})")
        for column, values in accepted.items():
            add_row(of, table, column, "accepted_values", f"SELECT count(*) FROM {source} WHERE {column} NOT IN ({values})")
        for column, (_, parent, key) in refers.items():
            held = f"SELECT 1 FROM {sql_of.get(parent, parent)} p WHERE p.{key} = c.{column}"
            add_row(of, table, column, "relationships", f"SELECT count(*) FROM {source} c WHERE c.{column} IS NOT NULL AND NOT EXISTS ({held})")
    for of, table, name, failures in _RULES:
        add_row(of, table, name, "rule", failures)
    return (
        "SELECT layer, table_name, column_name, test, CAST(failures AS BIGINT) AS failures,"
        " CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (" + " UNION ALL ".join(rows) + ")"
    )


def _suite(raw: RawTables, **picked):
    return quality.kept_report(checks.run_suite(raw.spark, raw, RUN_TIME, **picked), checks.checked_rows(raw))


add("q10_check_suite", _suite, _suite_sql())
add(
    "q11_staging_checks",
    lambda raw: _suite(raw, layer=checks.STAGING),
    _suite_sql(layer=checks.STAGING),
)
add(
    "q11_checks_by_tag",
    lambda raw: _suite(raw, select="tag:fact"),
    _suite_sql(("stg_orders_incr", "stg_order_items_incr", "stg_user_events_incr")),
)
add(
    "q11_checks_downstream",
    lambda raw: _suite(raw, select="stg_users+"),
    _suite_sql(("stg_users", "stg_user_events", "stg_user_events_incr")),
)


def _stored_checks(raw: RawTables):
    """The checks of the incremental layer on its stored tables, after two runs of each model."""
    stored = changes.stored_models(raw)
    return _suite(raw, tables={(checks.INCREMENTAL, n): df for n, df in stored.items()}, layer=checks.INCREMENTAL)


add(
    "q10_stored_increments",
    _stored_checks,
    _suite_sql(layer=checks.INCREMENTAL, stored={n: f"({sql})" for n, sql in changes.STORED_SQL.items()}),
)
