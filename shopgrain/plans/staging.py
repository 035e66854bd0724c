"""Staging models: typed raw tables plus region, currency and compliance columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import region
from shopgrain.functions.numeric import half_even_int
from shopgrain.operators.keyed import flag_repeats
from shopgrain.sources.raw import RawTables


def stg_users(users: DataFrame) -> DataFrame:
    """All users; ``is_duplicate_email`` marks every registration of an email but
    the first. Ties in time go to the smaller user_id."""
    typed = users.select(
        "user_id",
        "first_name",
        "last_name",
        "email",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        "location_id",
    )
    order = [F.asc_nulls_last("created_at"), F.asc_nulls_last("user_id")]
    return flag_repeats(typed, "email", order, ["user_id", "created_at"], "is_duplicate_email")


def with_currency(locations: DataFrame, exchange_rates: DataFrame) -> DataFrame:
    """The seven raw columns, the currency and its rate (1.0 where none is known).

    The seed has one row per currency. Spark sees its size and broadcasts it by
    itself; no hint forces that.
    """
    rates = exchange_rates.select("currency_code", F.col("exchange_rate_to_usd").alias("__rate"))
    return (
        locations.select(
            "location_id",
            "country_code",
            "country_full_name",
            "city",
            "address",
            F.col("zip_code").cast("string").alias("zip_code"),
            "state",
            region.currency_code(F.col("country_code")).alias("currency_code"),
        )
        .join(rates, "currency_code", "left")
        .select(
            "location_id",
            "country_code",
            "country_full_name",
            "city",
            "address",
            "zip_code",
            "state",
            "currency_code",
            region.rate_or_one(F.col("__rate")).alias("exchange_rate_to_usd"),
        )
    )


def stg_locations(locations: DataFrame, exchange_rates: DataFrame) -> DataFrame:
    country, state, zip_code = F.col("country_code"), F.col("state"), F.col("zip_code")
    return with_currency(locations, exchange_rates).select(
        "*",
        region.is_excluded_supply_chain(country, state, zip_code).alias("is_excluded_supply_chain"),
        region.supply_chain_exclusion_reason(country, state, zip_code).alias("supply_chain_exclusion_reason"),
        region.is_quebec(country, state).alias("is_quebec_compliant_required"),
        region.quebec_compliance_notes(country, state).alias("quebec_compliance_notes"),
        region.marketing_language_requirement(country, state).alias("marketing_language_requirement"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "user_id",
        F.col("order_date").cast("timestamp_ntz").alias("order_date"),
        "order_status",
        "payment_method",
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        "order_item_id",
        "order_id",
        "product_id",
        half_even_int(order_items, "quantity").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("discount").cast("double").alias("discount"),
        F.col("line_total").cast("double").alias("line_total"),
    )


def stg_products(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        "category",
        "description",
        "price",
        "dimensions",
        "material",
        "stock",
    )


def user_places(users: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per user with the raw place columns the region rules need."""
    places = locations.select("location_id", "country_code", "state", F.col("zip_code").cast("string").alias("zip_code"))
    return users.select("user_id", "location_id").join(places, "location_id", "left").drop("location_id")


def user_quebec_flags(users: DataFrame, locations: DataFrame) -> DataFrame:
    """user_id and the Quebec flag. The flag rests on the raw place alone, so the
    email window and the currency lookup of the staging models are not needed."""
    flag = region.is_quebec(F.col("country_code"), F.col("state"))
    return user_places(users, locations).select("user_id", flag.alias("__quebec"))


def flag_quebec_events(events: DataFrame, users: DataFrame, locations: DataFrame) -> DataFrame:
    """Left join on the user; an unknown user or place means not Quebec."""
    return (
        events.join(user_quebec_flags(users, locations), "user_id", "left")
        .withColumn("is_quebec_event", F.coalesce("__quebec", F.lit(False)))
        .select(*events.columns, "is_quebec_event")
    )


def typed_user_events(user_events: DataFrame) -> DataFrame:
    """Events with their time cast, before the Quebec flag."""
    return user_events.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        "page_url",
        "product_id",
        "additional_details",
    )


def stg_user_events(raw: RawTables) -> DataFrame:
    return flag_quebec_events(typed_user_events(raw.user_events), raw.users, raw.locations)


def build_staging(raw: RawTables) -> dict[str, DataFrame]:
    """All staging models, lazy."""
    return {
        "stg_users": stg_users(raw.users),
        "stg_locations": stg_locations(raw.locations, raw.exchange_rates),
        "stg_orders": stg_orders(raw.orders),
        "stg_order_items": stg_order_items(raw.order_items),
        "stg_products": stg_products(raw.products),
        "stg_user_events": stg_user_events(raw),
    }
