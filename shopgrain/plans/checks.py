"""The check list: 148 declared checks and 5 business rules over three layers."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain import schemas
from shopgrain.operators.quality import ACCEPTED, NOT_NULL, RELATIONSHIP, RULE, UNIQUE, Check, run_checks
from shopgrain.plans import selection
from shopgrain.plans.increments import build_increments
from shopgrain.plans.staging import build_staging
from shopgrain.sources.raw import RawTables

SOURCE, STAGING, INCREMENTAL = "source", "staging", "staging_incremental"

# The value lists the checks accept.
ORDER_STATUSES = ("pending", "shipped", "delivered", "cancelled", "pending_refund")
PAYMENT_METHODS = ("credit card", "paypal", "bank transfer")
EVENT_TYPES = ("user_sign_up", "page_view", "add_to_cart")
CATEGORIES = ("Living Room", "Bedroom", "Kitchen")
COUNTRIES = ("US", "CA")
CURRENCIES = ("USD", "CAD")
LANGUAGES = ("EN", "EN,FR")
REGION_TYPES = ("QC", "EXCLUDED", "STANDARD")


def _table(
    layer: str,
    name: str,
    required: str,
    unique: str = "",
    accepted: Mapping[str, tuple[str, ...]] | None = None,
    refers: Mapping[str, tuple[str, str, str]] | None = None,
) -> list[Check]:
    return [
        *[Check(layer, name, c, NOT_NULL) for c in required.split()],
        *[Check(layer, name, c, UNIQUE) for c in unique.split()],
        *[Check(layer, name, c, ACCEPTED, values=v) for c, v in (accepted or {}).items()],
        *[Check(layer, name, c, RELATIONSHIP, parent=p) for c, p in (refers or {}).items()],
    ]


# Which column is checked for what.
CHECKS: tuple[Check, ...] = (
    *_table(
        SOURCE, "users",
        required="user_id first_name last_name email created_at location_id",
        unique="user_id email",
        refers={"location_id": (SOURCE, "locations", "location_id")},
    ),
    *_table(
        SOURCE, "locations",
        required="location_id country_code country_full_name city state address zip_code",
        unique="location_id",
        accepted={"country_code": COUNTRIES},
    ),
    *_table(
        SOURCE, "products",
        required="id name category price stock",
        unique="id",
        accepted={"category": CATEGORIES},
    ),
    *_table(
        SOURCE, "orders",
        required="order_id user_id order_date order_status payment_method updated_at",
        unique="order_id",
        accepted={"order_status": ORDER_STATUSES, "payment_method": PAYMENT_METHODS},
        refers={"user_id": (SOURCE, "users", "user_id")},
    ),
    *_table(
        SOURCE, "order_items",
        required="order_item_id order_id product_id quantity unit_price discount line_total",
        unique="order_item_id",
        refers={
            "order_id": (SOURCE, "orders", "order_id"),
            "product_id": (SOURCE, "products", "id"),
        },
    ),
    *_table(
        SOURCE, "user_events",
        required="event_id user_id event_type event_timestamp page_url",
        unique="event_id",
        accepted={"event_type": EVENT_TYPES},
        refers={
            "user_id": (SOURCE, "users", "user_id"),
            "product_id": (SOURCE, "products", "id"),
        },
    ),
    *_table(
        STAGING, "stg_users",
        required="user_id first_name last_name email created_at location_id is_duplicate_email",
        unique="user_id",
        refers={"location_id": (STAGING, "stg_locations", "location_id")},
    ),
    *_table(
        STAGING, "stg_locations",
        required=(
            "location_id country_code country_full_name city state zip_code address currency_code "
            "exchange_rate_to_usd is_excluded_supply_chain is_quebec_compliant_required "
            "marketing_language_requirement"
        ),
        unique="location_id",
        accepted={
            "country_code": COUNTRIES,
            "currency_code": CURRENCIES,
            "marketing_language_requirement": LANGUAGES,
        },
    ),
    *_table(
        STAGING, "stg_orders",
        required="order_id user_id order_date order_status payment_method updated_at",
        unique="order_id",
        accepted={"order_status": ORDER_STATUSES, "payment_method": PAYMENT_METHODS},
        refers={"user_id": (STAGING, "stg_users", "user_id")},
    ),
    *_table(
        STAGING, "stg_order_items",
        required="order_item_id order_id product_id quantity unit_price discount line_total",
        unique="order_item_id",
        refers={
            "order_id": (STAGING, "stg_orders", "order_id"),
            "product_id": (STAGING, "stg_products", "product_id"),
        },
    ),
    *_table(
        STAGING, "stg_products",
        required="product_id product_name category price stock",
        unique="product_id",
    ),
    *_table(
        STAGING, "stg_user_events",
        required="event_id user_id event_type event_timestamp page_url is_quebec_event",
        unique="event_id",
        accepted={"event_type": EVENT_TYPES},
        refers={
            "user_id": (STAGING, "stg_users", "user_id"),
            "product_id": (STAGING, "stg_products", "product_id"),
        },
    ),
    *_table(
        INCREMENTAL, "stg_orders_incr",
        required="order_id user_id order_date order_status payment_method updated_at fulfillment_region_type",
        unique="order_id",
        accepted={
            "order_status": ORDER_STATUSES,
            "payment_method": PAYMENT_METHODS,
            "fulfillment_region_type": REGION_TYPES,
        },
        refers={"user_id": (STAGING, "stg_users", "user_id")},
    ),
    *_table(
        INCREMENTAL, "stg_order_items_incr",
        required="order_item_id order_id product_id quantity unit_price discount line_total loaded_at",
        unique="order_item_id",
        refers={
            "order_id": (INCREMENTAL, "stg_orders_incr", "order_id"),
            "product_id": (STAGING, "stg_products", "product_id"),
        },
    ),
    *_table(
        INCREMENTAL, "stg_user_events_incr",
        required="event_id user_id event_type event_timestamp page_url is_quebec_event",
        unique="event_id",
        accepted={"event_type": EVENT_TYPES},
        refers={
            "user_id": (STAGING, "stg_users", "user_id"),
            "product_id": (STAGING, "stg_products", "product_id"),
        },
    ),
)


# -- business rules: each returns the failing rows ---------------------------------


def misses_quebec_language() -> Column:
    """A Quebec place whose notes do not mention both French and Bill 101."""
    notes = F.lower("quebec_compliance_notes")
    complete = notes.contains("french") & notes.contains("bill 101")
    return F.col("is_quebec_compliant_required") & ~F.coalesce(complete, F.lit(False))


def quebec_language_gaps(stg_locations: DataFrame) -> DataFrame:
    return stg_locations.where(misses_quebec_language()).select(
        "location_id", "country_code", "state", "quebec_compliance_notes"
    )


def misses_quebec_pricing() -> Column:
    """A Quebec place that is not priced in CAD at a positive rate."""
    rate = F.col("exchange_rate_to_usd")
    wrong = (F.col("currency_code") != "CAD") | rate.isNull() | (rate <= 0)
    return F.col("is_quebec_compliant_required") & wrong


def quebec_pricing_gaps(stg_locations: DataFrame) -> DataFrame:
    return stg_locations.where(misses_quebec_pricing()).select(
        "location_id", "country_code", "state", "currency_code", "exchange_rate_to_usd"
    )


def expected_line_total() -> Column:
    """quantity x unit_price x (1 - discount) to the cent, in decimal; in double
    where a value is too large for the decimal, so that no row escapes."""
    quantity, price, discount = F.col("quantity"), F.col("unit_price"), F.col("discount")
    kept = F.lit(1).cast("decimal(1,0)") - discount.try_cast("decimal(16,14)")
    exact = F.round(quantity.try_cast("decimal(10,0)") * price.try_cast("decimal(16,8)") * kept, 2)
    return F.coalesce(exact.cast("double"), F.round(quantity * price * (F.lit(1.0) - discount), 2))


def line_total_variance() -> Column:
    """Rounded to 1/10000, so that exactly one cent never lands above the tolerance."""
    return F.round(F.abs(F.col("line_total") - expected_line_total()), 4)


def misses_line_total() -> Column:
    return line_total_variance() > 0.01


def line_total_gaps(order_items: DataFrame) -> DataFrame:
    """Items whose total is more than a cent off the formula."""
    checked = order_items.select(
        "order_item_id", "order_id", "quantity", "unit_price", "discount", "line_total",
        expected_line_total().alias("expected_line_total"), line_total_variance().alias("variance"),
    )
    return checked.where(F.col("variance") > 0.01)


def breaks_financial_bounds() -> Column:
    """An impossible quantity, price, discount or total; NULLs pass."""
    discount = F.col("discount")
    return (
        (F.col("quantity") <= 0)
        | (F.col("unit_price") <= 0)
        | (discount < 0)
        | (discount >= 1)
        | (F.col("line_total") < 0)
    )


def financial_bound_gaps(order_items: DataFrame) -> DataFrame:
    return order_items.where(breaks_financial_bounds()).select(
        "order_item_id", "order_id", "quantity", "unit_price", "discount", "line_total"
    )


def orphan_items(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items without a parent order. Unlike the referential check, an item with
    a NULL order_id is returned too."""
    items = order_items.select("order_item_id", "order_id")
    return items.join(orders.select("order_id"), "order_id", "left_anti").select("order_item_id", "order_id")


RULES: tuple[Check, ...] = (
    Check(STAGING, "stg_locations", "quebec_language_requirements", RULE, predicate=misses_quebec_language),
    Check(STAGING, "stg_locations", "quebec_transparent_pricing", RULE, predicate=misses_quebec_pricing),
    Check(SOURCE, "order_items", "line_total_integrity", RULE, predicate=misses_line_total),
    Check(SOURCE, "order_items", "no_negative_financials", RULE, predicate=breaks_financial_bounds),
    Check(SOURCE, "order_items", "no_orphan_order_items", RULE, key="order_id", parent=(SOURCE, "orders", "order_id")),
)


def layer_tables(
    raw: RawTables, run_time: datetime, layers: Collection[str] = (SOURCE, STAGING, INCREMENTAL)
) -> dict[tuple[str, str], DataFrame]:
    """Every checked table; the incremental ones with their first-run content."""
    tables: dict[tuple[str, str], DataFrame] = {}
    if SOURCE in layers:
        tables |= {(SOURCE, name): raw[name] for name in schemas.RAW}
    if STAGING in layers:
        tables |= {(STAGING, name): df for name, df in build_staging(raw).items()}
    if INCREMENTAL in layers:
        tables |= {(INCREMENTAL, name): df for name, df in build_increments(raw, run_time).items()}
    return tables


def run_suite(
    spark: SparkSession,
    raw: RawTables,
    run_time: datetime,
    tables: Mapping[tuple[str, str], DataFrame] | None = None,
    layer: str | None = None,
    select: str | None = None,
) -> DataFrame:
    """The report of all 153 checks, or of those of one layer, or of the models that ``select``
    picks (``selection.pick``: by name, layer or tag, with ancestors or descendants); only
    these are run.

    ``tables`` replaces frames by (layer, name), for example the incremental
    models by their stored tables.
    """
    checks = [c for c in (*CHECKS, *RULES) if layer in (None, c.layer)]
    if select is not None:
        picked = selection.pick(select)
        checks = [c for c in checks if c.table in picked]
    needed = {c.layer for c in checks} | {c.parent[0] for c in checks if c.parent}
    found = {**layer_tables(raw, run_time, needed), **(tables or {})}
    return run_checks(spark, found, checks)


def checked_rows(raw: RawTables) -> int:
    """About how many rows the tables of all layers hold, from the source tables, whose rows are
    cheap to count in files; a table has about as many rows in each layer."""
    return 3 * sum(raw[name].count() for name in schemas.RAW)
