"""Star schema: two dimensions and three facts over the staging models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import money
from shopgrain.operators.keyed import lookup
from shopgrain.plans.staging import build_staging
from shopgrain.sources.raw import RawTables


def dim_products(stg_products: DataFrame) -> DataFrame:
    return stg_products.select(
        "product_id", "product_name", "category", "description", "price", "dimensions", "material", "stock"
    )


def dim_users(stg_users: DataFrame, stg_locations: DataFrame) -> DataFrame:
    """Users with their place. ``location_id`` comes from the place: NULL when it is unknown."""
    u, l = stg_users.alias("u"), stg_locations.alias("l")
    return u.join(l, F.col("u.location_id") == F.col("l.location_id"), "left").select(
        "u.user_id",
        "u.first_name",
        "u.last_name",
        "u.email",
        "u.created_at",
        "l.location_id",
        "l.city",
        "l.state",
        "l.country_code",
        "l.country_full_name",
        "l.address",
        "l.zip_code",
    )


def order_totals(stg_order_items: DataFrame) -> DataFrame:
    """Per order: amount in money units, pieces and lines."""
    return stg_order_items.groupBy("order_id").agg(
        money.total_units(F.col("line_total")).alias("total_units"),
        F.sum(F.col("quantity").cast("bigint")).alias("total_items"),
        F.count("*").alias("num_line_items"),
    )


def fct_orders(stg_orders: DataFrame, stg_order_items: DataFrame) -> DataFrame:
    """Orders with totals summed before the join; NULL totals where there are no items."""
    return stg_orders.join(order_totals(stg_order_items), "order_id", "left").select(
        "order_id",
        "user_id",
        "order_date",
        "order_status",
        "payment_method",
        "updated_at",
        money.from_units(F.col("total_units")).alias("total_amount"),
        "total_items",
        "num_line_items",
    )


def fct_order_items(stg_order_items: DataFrame, stg_orders: DataFrame, stg_products: DataFrame) -> DataFrame:
    items = stg_order_items
    return (
        items.join(stg_orders.drop("updated_at"), "order_id", "left")
        .join(stg_products.select("product_id", "product_name", "category"), "product_id", "left")
        .select(
            *items.columns, "user_id", "order_date", "order_status", "payment_method", "product_name", "category"
        )
    )


def fct_user_events(user_events: DataFrame, stg_products: DataFrame) -> DataFrame:
    """Events with their product; most events have none and keep NULLs.

    They come from the staged events, whose join with users decides how many rows there are.
    """
    named = stg_products.select("product_id", "product_name", "category")
    return lookup(user_events, named, "product_id", "product_id", spread_by="event_id").select(
        "event_id",
        "user_id",
        "event_type",
        "event_timestamp",
        "page_url",
        "product_id",
        "product_name",
        "category",
        "additional_details",
    )


def build_mart(raw: RawTables, staging: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All mart models, lazy. They read the staging views, not the incremental tables."""
    staging = staging or build_staging(raw)
    return {
        "dim_products": dim_products(staging["stg_products"]),
        "dim_users": dim_users(staging["stg_users"], staging["stg_locations"]),
        "fct_orders": fct_orders(staging["stg_orders"], staging["stg_order_items"]),
        "fct_order_items": fct_order_items(
            staging["stg_order_items"], staging["stg_orders"], staging["stg_products"]
        ),
        "fct_user_events": fct_user_events(staging["stg_user_events"], staging["stg_products"]),
    }
