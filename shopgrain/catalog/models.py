"""Sources, sinks, models and column expressions."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain import schemas
from shopgrain.catalog.registry import add, add_on_folder
from shopgrain.functions import money, region
from shopgrain.functions.numeric import half_even_int
from shopgrain.plans import mart, staging
from shopgrain.plans.checks import expected_line_total, quebec_language_gaps
from shopgrain.session import fresh_folder
from shopgrain.sources import warehouse
from shopgrain.sources.ingest import ingest_folder
from shopgrain.sources.raw import RawTables, read_csv, write_csv
from shopgrain.sources.tables import create_views, refresh_table

RUN_TIME = datetime(2024, 6, 1, 12, 0, 0)


def _locations(raw: RawTables) -> DataFrame:
    return staging.stg_locations(raw.locations, raw.exchange_rates)


def _users(raw: RawTables) -> DataFrame:
    return staging.stg_users(raw.users)


def _place(build):
    """A query of location_id and one derived column of the raw place."""

    def query(raw: RawTables) -> DataFrame:
        derived = build(F.col("country_code"), F.col("state"), F.col("zip_code"))
        return raw.locations.select("location_id", derived)

    return query


# -- sources and sinks ----------------------------------------------------------


def _csv_round_trip(table: str):
    def build(raw: RawTables) -> DataFrame:
        df = raw[table]
        path = fresh_folder(df.sparkSession, f"csv-{table}")
        write_csv(df, path)
        return read_csv(df.sparkSession, path, schemas.RAW[table])

    return build


for _table in schemas.RAW:
    # S1 and S4: the table goes out through the CSV sink and comes back through the scan
    add(f"s1_csv_{_table}", _csv_round_trip(_table), f"SELECT * FROM raw_{_table}")


def _seed_rates(raw: RawTables) -> DataFrame:
    return (
        staging.with_currency(raw.locations, raw.exchange_rates)
        .groupBy("currency_code", "exchange_rate_to_usd")
        .agg(F.count("*").alias("locations"))
    )


add(
    "s2_seed_rates",
    _seed_rates,
    "SELECT currency_code, exchange_rate_to_usd, count(*) AS locations FROM stg_locations GROUP BY 1, 2",
)


def _ingest(spark, folder: str) -> DataFrame:
    """The six raw tables plus one broken file; then a second pass over the same folder."""
    raw = warehouse.raw_tables(spark, folder)
    landing = fresh_folder(spark, "landing")
    database = f"landing_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{fresh_folder(spark, 'ingested')}'")
    for name in schemas.RAW:
        write_csv(raw[name], f"{landing}/{name}")
    write_csv(raw.users.select("user_id"), f"{landing}/exchange_rates")  # lacks the seed's columns
    first = ingest_folder(spark, landing, database).withColumn("pass_no", F.lit(1))
    again = ingest_folder(spark, landing, database).withColumn("pass_no", F.lit(2))
    report = first.unionAll(again).select("pass_no", "table_name", "status")
    sizes = None
    for name in schemas.RAW:
        size = spark.table(f"{database}.{name}").agg(F.count("*").alias("n_rows")).withColumn("table_name", F.lit(name))
        sizes = size if sizes is None else sizes.unionByName(size)
    return report.join(sizes, "table_name", "left").select("pass_no", "table_name", "status", "n_rows")


add_on_folder(
    "s3_ingest_folder",
    _ingest,
    "SELECT pass_no, table_name, CASE WHEN n_rows IS NULL THEN 'failed' WHEN pass_no = 1 THEN 'created' ELSE 'exists' END"
    " AS status, n_rows FROM (VALUES (1), (2)) p(pass_no), ("
    + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM raw_{t}" for t in schemas.RAW)
    + " UNION ALL SELECT 'exchange_rates', NULL) t",
)


def _views(raw: RawTables) -> DataFrame:
    spark = raw.spark
    create_views(staging.build_staging(raw))
    return spark.sql(
        "SELECT u.is_duplicate_email, l.marketing_language_requirement, count(*) AS users"
        " FROM stg_users u LEFT JOIN stg_locations l ON u.location_id = l.location_id GROUP BY 1, 2"
    )


add(
    "s5_views",
    _views,
    "SELECT u.is_duplicate_email, l.marketing_language_requirement, count(*) AS users"
    " FROM stg_users u LEFT JOIN stg_locations l ON u.location_id = l.location_id GROUP BY 1, 2",
)


def _full_refresh(raw: RawTables) -> DataFrame:
    """Two refreshes of one table; the second replaces the first."""
    spark = raw.spark
    path = fresh_folder(spark, "fct-orders")
    pending = mart.fct_orders(staging.stg_orders(raw.orders), staging.stg_order_items(raw.order_items))
    refresh_table(spark, pending.where("order_status = 'pending'"), path)
    return refresh_table(spark, pending, path)


add("s6_full_refresh", _full_refresh, "SELECT * FROM fct_orders")

# -- models ------------------------------------------------------------------------

add("m1_stg_users", _users, "SELECT * FROM stg_users")
add("m2_stg_locations", _locations, "SELECT * FROM stg_locations")
add("m3_stg_orders", lambda raw: staging.stg_orders(raw.orders), "SELECT * FROM stg_orders")
add("m4_stg_order_items", lambda raw: staging.stg_order_items(raw.order_items), "SELECT * FROM stg_order_items")
add("m5_stg_products", lambda raw: staging.stg_products(raw.products), "SELECT * FROM stg_products")
add("m6_stg_user_events", staging.stg_user_events, "SELECT * FROM stg_user_events")
add("m10_dim_products", lambda raw: mart.dim_products(staging.stg_products(raw.products)), "SELECT * FROM stg_products")
add(
    "m11_dim_users",
    lambda raw: mart.dim_users(_users(raw), _locations(raw)),
    "SELECT u.user_id, u.first_name, u.last_name, u.email, u.created_at, l.location_id, l.city, l.state,"
    " l.country_code, l.country_full_name, l.address, l.zip_code"
    " FROM stg_users u LEFT JOIN stg_locations l ON u.location_id = l.location_id",
)
add(
    "m12_fct_orders",
    lambda raw: mart.fct_orders(staging.stg_orders(raw.orders), staging.stg_order_items(raw.order_items)),
    "SELECT * FROM fct_orders",
)
add(
    "m13_fct_order_items",
    lambda raw: mart.fct_order_items(
        staging.stg_order_items(raw.order_items), staging.stg_orders(raw.orders), staging.stg_products(raw.products)
    ),
    "SELECT i.*, o.user_id, o.order_date, o.order_status, o.payment_method, p.product_name, p.category"
    " FROM stg_order_items i LEFT JOIN stg_orders o ON i.order_id = o.order_id"
    " LEFT JOIN stg_products p ON i.product_id = p.product_id",
)
add(
    "m14_fct_user_events",
    lambda raw: mart.fct_user_events(staging.stg_user_events(raw), staging.stg_products(raw.products)),
    "SELECT e.event_id, e.user_id, e.event_type, e.event_timestamp, e.page_url, e.product_id, p.product_name,"
    " p.category, e.additional_details"
    " FROM stg_user_events e LEFT JOIN stg_products p ON e.product_id = p.product_id",
)

# -- derived columns -----------------------------------------------------------------

add(
    "e1_currency_code",
    _place(lambda c, s, z: region.currency_code(c).alias("currency_code")),
    "SELECT location_id, currency_code FROM stg_locations",
)
add(
    "e2_exchange_rate",
    lambda raw: staging.with_currency(raw.locations, raw.exchange_rates).select("location_id", "exchange_rate_to_usd"),
    "SELECT location_id, exchange_rate_to_usd FROM stg_locations",
)
add(
    "e3_excluded_supply_chain",
    _place(lambda c, s, z: region.is_excluded_supply_chain(c, s, z).alias("is_excluded_supply_chain")),
    "SELECT location_id, is_excluded_supply_chain FROM stg_locations",
)
add(
    "e4_exclusion_reason",
    _place(lambda c, s, z: region.supply_chain_exclusion_reason(c, s, z).alias("supply_chain_exclusion_reason")),
    "SELECT location_id, supply_chain_exclusion_reason FROM stg_locations",
)
add(
    "e5_quebec_flag",
    _place(lambda c, s, z: region.is_quebec(c, s).alias("is_quebec_compliant_required")),
    "SELECT location_id, is_quebec_compliant_required FROM stg_locations",
)
add(
    "e6_quebec_notes",
    _place(lambda c, s, z: region.quebec_compliance_notes(c, s).alias("quebec_compliance_notes")),
    "SELECT location_id, quebec_compliance_notes FROM stg_locations",
)
add(
    "e7_marketing_language",
    _place(lambda c, s, z: region.marketing_language_requirement(c, s).alias("marketing_language_requirement")),
    "SELECT location_id, marketing_language_requirement FROM stg_locations",
)
add(
    "e8_quebec_event",
    lambda raw: staging.stg_user_events(raw).select("event_id", "is_quebec_event"),
    "SELECT event_id, is_quebec_event FROM stg_user_events",
)
add(
    "e9_region_type",
    _place(lambda c, s, z: region.region_type(c, s, z).alias("region_type")),
    "SELECT location_id, CASE WHEN is_quebec_compliant_required THEN 'QC' WHEN is_excluded_supply_chain"
    " THEN 'EXCLUDED' ELSE 'STANDARD' END AS region_type FROM stg_locations",
)
add(
    "e10_requires_french_support",
    _place(lambda c, s, z: region.requires_french_support(c, s).alias("requires_french_support")),
    "SELECT location_id, (country_code = 'CA' AND state = 'QC') AS requires_french_support FROM raw_locations",
)
add(
    "e11_requires_compliance_flag",
    _place(lambda c, s, z: region.requires_compliance_flag(c, s).alias("requires_compliance_flag")),
    "SELECT location_id, (country_code = 'CA' AND state = 'QC') AS requires_compliance_flag FROM raw_locations",
)
add(
    "e12_is_fulfillable",
    _place(lambda c, s, z: region.is_fulfillable(c, s, z).alias("is_fulfillable")),
    "SELECT location_id, (country_code <> 'US' OR (state NOT IN ('AK', 'HI') AND zip_code NOT LIKE '009%'))"
    " AS is_fulfillable FROM raw_locations",
)
add(
    "e13_product_names",
    lambda raw: staging.stg_products(raw.products).select("product_id", "product_name"),
    "SELECT id AS product_id, name AS product_name FROM raw_products",
)
add(
    "e14_all_location_columns",
    lambda raw: _locations(raw).select("*"),
    "SELECT * FROM stg_locations",
)


def _expected_totals(raw: RawTables) -> DataFrame:
    expected = expected_line_total()
    return raw.order_items.select(
        "order_item_id",
        expected.alias("expected_line_total"),
        F.round(F.abs(F.col("line_total") - expected), 4).alias("variance"),
    )


add(
    "e15_expected_line_total",
    _expected_totals,
    "SELECT order_item_id, CAST(e AS DOUBLE) AS expected_line_total,"
    " CAST(abs(CAST(line_total AS DECIMAL(15,2)) - e) AS DOUBLE) AS variance FROM ("
    " SELECT *, round(CAST(quantity AS DECIMAL(10,0)) * CAST(unit_price AS DECIMAL(12,2))"
    " * (1 - CAST(discount AS DECIMAL(5,4))), 2) AS e FROM raw_order_items)",
)
add(
    "e16_report_exclusion",
    _place(lambda c, s, z: region.excluded_state(s).alias("excluded")),
    "SELECT location_id, state IN ('AK', 'HI') AS excluded FROM raw_locations",
)

# -- filters and scalar functions --------------------------------------------------------

add(
    "f1_boolean_equality",
    lambda raw: _locations(raw).where(F.col("is_quebec_compliant_required")).select("location_id", "state"),
    "SELECT location_id, state FROM stg_locations WHERE is_quebec_compliant_required = true",
)
add(
    "f4_zip_prefix",
    lambda raw: raw.locations.where(F.col("zip_code").startswith("009")).select("location_id", "zip_code"),
    "SELECT location_id, zip_code FROM raw_locations WHERE zip_code LIKE '009%'",
)
add(
    "f5_not_like_lower",
    lambda raw: quebec_language_gaps(
        _locations(raw).withColumn(
            "quebec_compliance_notes",
            F.when(F.col("city") == "City 3", F.lit("French only")).otherwise(F.col("quebec_compliance_notes")),
        )
    ),
    "SELECT location_id, country_code, state, 'French only' AS quebec_compliance_notes FROM stg_locations"
    " WHERE is_quebec_compliant_required AND city = 'City 3'",
)
add(
    "f6_in_and_not_in",
    lambda raw: raw.locations.groupBy(
        F.col("state").isin("AK", "HI").alias("listed"), (~F.col("state").isin("AK", "HI", "PR")).alias("unlisted")
    ).agg(F.count("*").alias("locations")),
    "SELECT state IN ('AK', 'HI') AS listed, state NOT IN ('AK', 'HI', 'PR') AS unlisted, count(*) AS locations"
    " FROM raw_locations GROUP BY 1, 2",
)


def _scalar_functions(raw: RawTables) -> DataFrame:
    halves = raw.order_items.withColumn("half_quantity", F.col("quantity") / 2.0)
    return halves.select(
        "order_item_id",
        half_even_int(halves, "half_quantity").alias("half_even"),
        F.abs(F.col("discount") - 0.05).alias("distance"),
        F.lower("order_item_id").alias("lowered"),
        money.rounded(money.to_units(F.col("unit_price") / 4.0).cast("decimal(18,0)")).alias("quarter"),
        F.coalesce(F.when(F.col("discount") > 0, F.col("discount")), F.lit(1.0)).alias("discount_or_one"),
    )


add(
    "fn_scalar_functions",
    _scalar_functions,
    "SELECT order_item_id, CAST(quantity / 2.0 AS DOUBLE)::INTEGER AS half_even, abs(discount - 0.05::DOUBLE) AS distance,"
    " lower(order_item_id) AS lowered,"
    " CAST(round(CAST(unit_price / 4.0::DOUBLE AS DECIMAL(18,4)), 2) AS DOUBLE) AS quarter,"
    " coalesce(CASE WHEN discount > 0 THEN discount END, 1.0::DOUBLE) AS discount_or_one FROM raw_order_items",
)
add(
    "fn_month_of_order",
    lambda raw: raw.orders.select("order_id", F.trunc("order_date", "MM").alias("month")),
    "SELECT order_id, CAST(date_trunc('month', order_date) AS DATE) AS month FROM raw_orders",
)
