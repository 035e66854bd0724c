"""Queries the published documentation describes for consumers of the models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions import money, region
from shopgrain.plans.reports import customer_values, order_values
from shopgrain.plans.staging import stg_locations, stg_users, user_places, user_quebec_flags
from shopgrain.sources.raw import RawTables


def confirmed_and_gross(raw: RawTables) -> DataFrame:
    """One row: GMV counts pending refunds, confirmed revenue is delivered orders only."""
    status, units = F.col("order_status"), F.col("units")

    def of(name: str):
        return F.coalesce(F.sum(F.when(status == name, units)), F.lit(0))

    totals = order_values(raw).agg(
        F.coalesce(F.sum(units), F.lit(0)).alias("gmv"),
        of("delivered").alias("confirmed"),
        of("pending_refund").alias("pending_refund"),
    )
    return totals.select(*[money.rounded(F.col(c)).alias(c) for c in totals.columns])


def order_revenue_in_usd(raw: RawTables, amounts_in: str = "local") -> DataFrame:
    """Order value with the rate of the buyer's place.

    The source does not say which currency an amount is in, so the caller does:
    ``local`` converts to USD, ``usd`` converts to the local currency.
    """
    places = stg_locations(raw.locations, raw.exchange_rates)
    buyers = (
        raw.users.select("user_id", "location_id")
        .join(places.select("location_id", "currency_code", "exchange_rate_to_usd"), "location_id", "left")
        .drop("location_id")
    )
    amount = F.col("units").cast("decimal(28,0)")
    rate = F.col("exchange_rate_to_usd").cast("decimal(10,6)")
    if amounts_in == "local":
        converted, name = amount * rate, "revenue_usd"
    elif amounts_in == "usd":
        converted, name = F.try_divide(amount, rate), "revenue_local"
    else:
        raise ValueError(f"unknown currency side {amounts_in!r}")
    return order_values(raw).join(buyers, "user_id", "left").select(
        "order_id",
        "user_id",
        "currency_code",
        "exchange_rate_to_usd",
        money.rounded(F.col("units")).alias("revenue"),
        money.rounded(converted).alias(name),
    )


def unique_users(raw: RawTables) -> DataFrame:
    """The first registration of every email."""
    return stg_users(raw.users).where(~F.col("is_duplicate_email"))


def specialist_fulfilment(raw: RawTables) -> DataFrame:
    """Orders to excluded places, with the reason."""
    country, state, zip_code = F.col("country_code"), F.col("state"), F.col("zip_code")
    places = user_places(raw.users, raw.locations)
    excluded = places.where(region.is_excluded_supply_chain(country, state, zip_code)).select(
        "user_id",
        "state",
        "zip_code",
        region.supply_chain_exclusion_reason(country, state, zip_code).alias("supply_chain_exclusion_reason"),
    )
    return raw.orders.join(excluded, "user_id").select(
        "order_id", "user_id", "order_date", "order_status", "state", "zip_code", "supply_chain_exclusion_reason"
    )


def reengagement_audience(raw: RawTables, at_most_orders: int = 1) -> DataFrame:
    """Buyers with few orders (one, by default) and the language to write to them in."""
    language = region.marketing_language_requirement(F.col("country_code"), F.col("state"))
    buyers = customer_values(raw).where(F.col("order_count") <= at_most_orders)
    return buyers.join(user_places(raw.users, raw.locations), "user_id", "left").select(
        "user_id",
        "order_count",
        money.from_cents(F.col("cents")).alias("ltv"),
        language.alias("marketing_language_requirement"),
    )


def subject_access_extract(raw: RawTables) -> DataFrame:
    """Everything recorded on Quebec users: one row per event and per order."""
    quebec = user_quebec_flags(raw.users, raw.locations).where("__quebec").select("user_id")
    events = raw.user_events.select(
        "user_id",
        F.lit("event").alias("record_type"),
        F.col("event_id").alias("record_id"),
        F.col("event_timestamp").alias("recorded_at"),
        F.col("event_type").alias("detail"),
    )
    orders = raw.orders.select(
        "user_id",
        F.lit("order").alias("record_type"),
        F.col("order_id").alias("record_id"),
        F.col("order_date").alias("recorded_at"),
        F.col("order_status").alias("detail"),
    )
    return events.unionByName(orders).join(quebec, "user_id")


def quebec_exposure(raw: RawTables) -> DataFrame:
    """Revenue and cancelled revenue, Quebec buyers against all others."""
    flags = user_quebec_flags(raw.users, raw.locations)
    return (
        order_values(raw)
        .join(flags, "user_id", "left")
        .groupBy(F.coalesce("__quebec", F.lit(False)).alias("is_quebec"))
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("units").alias("units"),
            F.count_distinct(F.when(F.col("order_status") == "cancelled", F.col("order_id"))).alias("cancelled_orders"),
            F.coalesce(F.sum(F.when(F.col("order_status") == "cancelled", F.col("units"))), F.lit(0)).alias("lost"),
        )
        .select(
            "is_quebec",
            "orders",
            money.rounded(F.col("units")).alias("revenue"),
            "cancelled_orders",
            money.rounded(F.col("lost")).alias("cancelled_revenue"),
        )
    )


def price_paid_audit(raw: RawTables) -> DataFrame:
    """Items sold at a price other than today's list price."""
    listed = raw.products.select(F.col("id").alias("product_id"), F.col("price").alias("list_price"))
    paid, asked = money.to_units(F.col("unit_price")), money.to_units(F.col("list_price"))
    return (
        raw.order_items.select("order_item_id", "order_id", "product_id", "unit_price")
        .join(listed, "product_id")
        .where(paid != asked)
        .select(
            "order_item_id",
            "order_id",
            "product_id",
            "unit_price",
            "list_price",
            money.from_units(paid - asked).alias("difference"),
        )
    )
