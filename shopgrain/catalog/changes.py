"""Increments, history and streams: each query runs a table through several loads.

The first load sees the data as of a cut-off, the next one all of it. The SQL
states the outcome in closed form.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.catalog.models import RUN_TIME
from shopgrain.catalog.registry import add, add_on_folder
from shopgrain.operators import incremental
from shopgrain.operators.history import as_of, as_of_join
from shopgrain.plans import increments, location_history
from shopgrain.session import TASK_ROWS, fresh_folder, partitions_for, shuffles_freed
from shopgrain.sources import warehouse
from shopgrain.sources.raw import RawTables
from shopgrain.sources.partitioned import RUN, SLICE, month_number
from shopgrain.streaming.events import deduplicated, file_stream, stream_user_events, write_stream
from shopgrain.streaming.orders import stream_orders

ORDERS_CUT = datetime(1999, 1, 1)
EVENTS_CUT = datetime(2024, 1, 16)
SECOND_RUN = datetime(2024, 7, 1, 12, 0, 0)


def _before(column: str, cut: datetime):
    return F.col(column) < F.lit(cut).cast("timestamp_ntz")


def _early_orders(raw: RawTables) -> DataFrame:
    """Orders as they looked at the cut-off: just placed, all pending."""
    return raw.orders.where(_before("order_date", ORDERS_CUT)).withColumns(
        {"order_status": F.lit("pending"), "updated_at": F.col("order_date")}
    )


_EARLY_ORDERS = (
    "early AS (SELECT order_id, user_id, order_date, 'pending' AS order_status, payment_method,"
    " order_date AS updated_at, fulfillment_region_type FROM orders_incr WHERE order_date < TIMESTAMP '1999-01-01'),"
    " fresh AS (SELECT * FROM orders_incr WHERE updated_at > (SELECT max(updated_at) FROM early))"
)
_ORDERS_AFTER = (
    f"WITH {_EARLY_ORDERS} SELECT * FROM fresh UNION ALL"
    " SELECT * FROM early WHERE order_id NOT IN (SELECT order_id FROM fresh)"
)
_EVENTS_AFTER = "SELECT * FROM stg_user_events"


# -- increment operators -------------------------------------------------------------


def _newer_orders(raw: RawTables) -> DataFrame:
    return incremental.newer_than_target(raw.orders, _early_orders(raw), "updated_at")


_NEWER_ORDERS = (
    "SELECT * FROM raw_orders WHERE updated_at >"
    " (SELECT max(order_date) FROM raw_orders WHERE order_date < TIMESTAMP '1999-01-01')"
)
add("i1_high_water_mark", _newer_orders, _NEWER_ORDERS)
add("f7_scalar_subquery", lambda raw: _newer_orders(raw).select("order_id"),
    f"SELECT order_id FROM ({_NEWER_ORDERS})")
add(
    "i1_empty_target",
    lambda raw: incremental.newer_than_target(raw.orders, raw.orders.where("order_status = 'none'"), "updated_at"),
    "SELECT * FROM raw_orders WHERE updated_at > (SELECT max(updated_at) FROM raw_orders WHERE order_status = 'none')",
)


def _delivered_first(raw: RawTables) -> DataFrame:
    """Items of delivered orders: what the first load of the items saw."""
    return raw.order_items.join(raw.orders.where("order_status = 'delivered'").select("order_id"), "order_id", "left_semi")


add(
    "i2_anti_join_increment",
    lambda raw: incremental.absent_from_target(raw.order_items, _delivered_first(raw), "order_item_id"),
    "SELECT * FROM raw_order_items WHERE order_id NOT IN"
    " (SELECT order_id FROM raw_orders WHERE order_status = 'delivered')",
)
add(
    "i3_keyed_upsert",
    lambda raw: incremental.upsert(_early_orders(raw), _newer_orders(raw), "order_id"),
    f"WITH {_EARLY_ORDERS} SELECT * EXCLUDE (fulfillment_region_type) FROM fresh UNION ALL"
    " SELECT * EXCLUDE (fulfillment_region_type) FROM early WHERE order_id NOT IN (SELECT order_id FROM fresh)",
)


def _drift(raw: RawTables) -> DataFrame:
    """Schema differences of a changed batch, with the number of rows it would have broken."""
    changed = raw.orders.drop("payment_method").withColumns(
        {"order_date": F.col("order_date").cast("date"), "coupon": F.lit("none")}
    )
    rows = incremental.schema_drift(raw.orders.schema, changed.schema)
    spark = raw.spark
    held = changed.agg(F.count("*").alias("batch_rows"))
    return spark.createDataFrame(rows, incremental.DRIFT).withColumn("batch_rows", held.scalar())


add(
    "i4_schema_guard",
    _drift,
    "SELECT column_name, kind, expected, actual, (SELECT count(*) FROM raw_orders) AS batch_rows FROM (VALUES"
    " ('coupon', 'added', NULL, 'string'), ('order_date', 'type', 'timestamp_ntz', 'date'),"
    " ('payment_method', 'missing', 'string', NULL)) t(column_name, kind, expected, actual)",
)
add(
    "i7_loaded_at",
    lambda raw: increments.order_items_batch(raw.order_items, RUN_TIME),
    "SELECT *, TIMESTAMP '2024-06-01 12:00:00' AS loaded_at FROM raw_order_items",
)


def _rebuild_orders(raw: RawTables) -> DataFrame:
    """A full refresh after increments: the table is as after a first run."""
    spark = raw.spark
    table = increments.orders_table(spark, fresh_folder(spark, "orders"))
    increments.run_orders(table, raw.replace(orders=_early_orders(raw)), "first")
    increments.run_orders(table, raw, "refresh", full_refresh=True)
    return table.read().drop(SLICE, RUN)


add("i8_full_refresh", _rebuild_orders, "SELECT * FROM orders_incr")


# -- incremental models ------------------------------------------------------------------


def _orders_model(raw: RawTables) -> DataFrame:
    table = increments.orders_table(raw.spark, fresh_folder(raw.spark, "orders"))
    increments.run_orders(table, raw.replace(orders=_early_orders(raw)), "first")
    increments.run_orders(table, raw, "second")
    increments.run_orders(table, raw, "second")  # a repeated run changes nothing
    return table.read().drop(SLICE, RUN)


add("m7_stg_orders_incr", _orders_model, _ORDERS_AFTER)


def _guarded_orders(raw: RawTables) -> DataFrame:
    """A batch that lost a column is refused and leaves no trace; the next good run arrives."""
    table = increments.orders_table(raw.spark, fresh_folder(raw.spark, "orders"))
    increments.run_orders(table, raw.replace(orders=_early_orders(raw)), "first")
    batch = increments.orders_batch(raw.orders, raw.users, raw.locations)
    drifted = batch.drop("payment_method").withColumn(SLICE, month_number("order_date"))
    try:
        incremental.upsert_into(table, drifted, "order_id", "second")
    except incremental.SchemaDrift:
        increments.run_orders(table, raw, "second")
        return table.read().drop(SLICE, RUN)
    raise AssertionError("a drifted batch has been stored")


add("i4_guarded_increment", _guarded_orders, _ORDERS_AFTER)


def _items_model(raw: RawTables) -> DataFrame:
    spark = raw.spark
    table = increments.order_items_table(spark, fresh_folder(spark, "items"))
    rows = raw.order_items.count()
    increments.run_order_items(table, raw.replace(order_items=_delivered_first(raw)), "first", RUN_TIME, rows=rows)
    increments.run_order_items(table, raw, "second", SECOND_RUN, rows=rows)
    increments.run_order_items(table, raw, "second", SECOND_RUN, rows=rows)  # a repeated run writes the same
    return table.read().drop(RUN)


_ITEMS_AFTER = (
    "SELECT i.*, CASE WHEN o.order_id IS NULL THEN TIMESTAMP '2024-07-01 12:00:00'"
    " ELSE TIMESTAMP '2024-06-01 12:00:00' END AS loaded_at FROM raw_order_items i LEFT JOIN"
    " (SELECT order_id FROM raw_orders WHERE order_status = 'delivered') o ON i.order_id = o.order_id"
)
add("m8_stg_order_items_incr", _items_model, _ITEMS_AFTER)


def _events_model(raw: RawTables) -> DataFrame:
    spark = raw.spark
    table = increments.user_events_table(spark, fresh_folder(spark, "events"))
    early = raw.user_events.where(_before("event_timestamp", EVENTS_CUT))
    increments.run_user_events(table, raw.replace(user_events=early), "first")
    increments.run_user_events(table, raw, "second")
    return table.read().drop(SLICE, RUN)


add("m9_stg_user_events_incr", _events_model, _EVENTS_AFTER)


def stored_models(raw: RawTables) -> dict[str, DataFrame]:
    """The stored tables of the three incremental models, each after its two runs."""
    return {"stg_orders_incr": _orders_model(raw), "stg_order_items_incr": _items_model(raw), "stg_user_events_incr": _events_model(raw)}


STORED_SQL = {
    "stg_orders_incr": _ORDERS_AFTER,
    "stg_order_items_incr": _ITEMS_AFTER,
    "stg_user_events_incr": _EVENTS_AFTER,
}


# -- history ---------------------------------------------------------------------------------


def _moved(raw: RawTables) -> DataFrame:
    """The places a month later: Alaska moved to Texas, Hawaii left the source."""
    alaska = F.col("state") == "AK"
    return raw.locations.where("state <> 'HI'").withColumns(
        {"state": F.when(alaska, "TX").otherwise(F.col("state")), "city": F.when(alaska, "Austin").otherwise(F.col("city"))}
    )


def _history(strategy: str):
    def build(raw: RawTables) -> DataFrame:
        spark = raw.spark
        table = location_history.history_table(spark, fresh_folder(spark, "location-history"))
        location_history.run_snapshot(table, raw.locations, raw.exchange_rates, RUN_TIME, "first", strategy)
        location_history.run_snapshot(table, _moved(raw), raw.exchange_rates, SECOND_RUN, "second", strategy)
        return location_history.read_history(table)

    return build


_SNAP = (
    "location_id, country_code, country_full_name, city, address, zip_code, state, currency_code,"
    " exchange_rate_to_usd, is_excluded_supply_chain, is_quebec_compliant_required"
)
_FIRST, _SECOND = "TIMESTAMP '2024-06-01 12:00:00'", "TIMESTAMP '2024-07-01 12:00:00'"
_OPEN = "CAST(NULL AS TIMESTAMP)"
_SNAP_MOVED = (
    "SELECT location_id, country_code, country_full_name, CASE WHEN state = 'AK' THEN 'Austin' ELSE city END AS city,"
    " address, zip_code, CASE WHEN state = 'AK' THEN 'TX' ELSE state END AS state, currency_code,"
    " exchange_rate_to_usd, is_excluded_supply_chain AND state <> 'AK' AS is_excluded_supply_chain,"
    " is_quebec_compliant_required FROM stg_locations WHERE state <> 'HI'"
)


def _history_sql(strategy: str) -> str:
    renewed = "state <> 'HI'" if strategy == "timestamp" else "state = 'AK'"
    added = "true" if strategy == "timestamp" else "city = 'Austin'"
    return (
        f"SELECT {_SNAP}, {_FIRST} AS snapshot_timestamp, {_FIRST} AS valid_from,"
        f" CASE WHEN {renewed} THEN {_SECOND} ELSE {_OPEN} END AS valid_to, NOT ({renewed}) AS is_current"
        f" FROM stg_locations UNION ALL SELECT {_SNAP}, {_SECOND}, {_SECOND}, {_OPEN}, true FROM ({_SNAP_MOVED})"
        f" WHERE {added}"
    )


add("m15_snap_locations", _history("timestamp"), _history_sql("timestamp"))
add(
    "i5_snapshot_timestamp",
    lambda raw: _history("timestamp")(raw).select("location_id", "state", "valid_from", "valid_to", "is_current"),
    f"SELECT location_id, state, valid_from, valid_to, is_current FROM ({_history_sql('timestamp')})",
)
add("i5_snapshot_check", _history("check"), _history_sql("check"))
add(
    "i6_as_of",
    lambda raw: as_of(_history("check")(raw), datetime(2024, 6, 15)),
    f"SELECT * FROM ({_history_sql('check')}) WHERE valid_from <= TIMESTAMP '2024-06-15' AND"
    " (valid_to IS NULL OR valid_to > TIMESTAMP '2024-06-15')",
)


FIRST_SEEN, SEEN_AGAIN = datetime(1993, 6, 1), datetime(1997, 3, 15, 12)  # within the orders' dates


def _orders_with_place_then(raw: RawTables) -> DataFrame:
    """Every order with the place that was valid for its buyer at the time of the order."""
    first = location_history.snap_locations(None, raw.locations, raw.exchange_rates, FIRST_SEEN)
    history = location_history.snap_locations(first, _moved(raw), raw.exchange_rates, SEEN_AGAIN, "check")
    buyers = raw.users.select("user_id", "location_id")
    placed = raw.orders.select("order_id", "user_id", "order_date").join(buyers, "user_id", "left")
    return as_of_join(
        placed, history, "location_id", "order_date", ["state", "city", "is_excluded_supply_chain", "valid_from"], "order_id"
    )


add(
    "i6_orders_with_place_then",
    _orders_with_place_then,
    "WITH history AS (" + _history_sql("check").replace(_FIRST, "TIMESTAMP '1993-06-01'").replace(_SECOND, "TIMESTAMP '1997-03-15 12:00:00'")
    + ") SELECT o.order_id, o.user_id, o.order_date, u.location_id, h.state, h.city, h.is_excluded_supply_chain, h.valid_from"
    " FROM raw_orders o LEFT JOIN raw_users u ON o.user_id = u.user_id LEFT JOIN history h ON h.location_id = u.location_id"
    " AND h.valid_from <= o.order_date AND (h.valid_to IS NULL OR o.order_date < h.valid_to)",
)


# -- streams ------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    files = file_stream(spark, f"{folder}/events.parque[t]", warehouse.file_schema("events"))
    return warehouse.user_events(files)


def _streamed_events(spark: SparkSession, folder: str) -> DataFrame:
    """A batch first load up to the cut-off, then the whole table as a stream."""
    raw = warehouse.raw_tables(spark, folder)
    work = fresh_folder(spark, "event-stream")
    table = increments.user_events_table(spark, f"{work}/table")
    early = raw.user_events.where(_before("event_timestamp", EVENTS_CUT))
    increments.run_user_events(table, raw.replace(user_events=early), "first")
    query = stream_user_events(
        _event_stream(spark, folder), raw.users, raw.locations, table, f"{work}/checkpoint", "stream"
    )
    query.awaitTermination()
    return table.read().drop(SLICE, RUN)


add_on_folder("t1_stream_user_events", _streamed_events, _EVENTS_AFTER)


def _deduplicated_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives twice; one copy of each comes out."""
    work = fresh_folder(spark, "deduplicated")
    twice = _event_stream(spark, folder).unionByName(_event_stream(spark, folder))
    write_stream(deduplicated(twice), f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return spark.read.schema(twice.schema).parquet(f"{work}/out")


add_on_folder("t2_stream_deduplicated", _deduplicated_events, "SELECT * FROM raw_user_events")


def _streamed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Each order arrives as placed and as last updated; the newest version stays."""
    raw = warehouse.raw_tables(spark, folder)
    work = fresh_folder(spark, "order-stream")
    table = increments.order_versions_table(spark, f"{work}/table")
    files = file_stream(spark, f"{folder}/orders.parque[t]", warehouse.file_schema("orders"))
    updated = warehouse.orders(files)
    placed = updated.withColumns({"order_status": F.lit("pending"), "updated_at": F.col("order_date") - F.expr("INTERVAL 1 DAY")})
    query = stream_orders(
        placed.unionByName(updated), raw.users, raw.locations, table, f"{work}/checkpoint", "stream",
        partitions=partitions_for(spark, 2 * raw.orders.count()),
    )
    query.awaitTermination()
    return increments.current_orders(table)


add_on_folder("t3_stream_orders", _streamed_orders, "SELECT * FROM orders_incr")


BATCHES = 4  # micro-batches of the queries below


def _shuffled_files(df: DataFrame, path: str, rows: int, *keys: str) -> DataFrame:
    """A stream of all ``rows`` in ``BATCHES`` micro-batches by a hash, so that times are spread
    over all of them. A file, which one task writes, holds no more rows as the table grows."""
    spark = df.sparkSession
    number = BATCHES * -(-max(rows, 1) // (BATCHES * TASK_ROWS))
    with shuffles_freed(spark):
        df.repartition(number, *keys).write.parquet(path)
    files = len(spark.read.schema(df.schema).parquet(path).inputFiles())
    return file_stream(spark, path, df.schema, files_per_batch=-(-files // BATCHES))


def _out_of_order_events(spark: SparkSession, folder: str) -> DataFrame:
    """All events, each twice, over several micro-batches in no order of time."""
    raw = warehouse.raw_tables(spark, folder)
    work = fresh_folder(spark, "event-stream")
    table = increments.user_events_table(spark, f"{work}/table")
    twice = raw.user_events.withColumn("__copy", F.explode(F.array(F.lit(0), F.lit(1))))
    files = _shuffled_files(twice, f"{work}/in", 2 * raw.user_events.count(), "event_id", "__copy").drop("__copy")
    stream_user_events(files, raw.users, raw.locations, table, f"{work}/checkpoint", "stream").awaitTermination()
    return table.read().drop(SLICE, RUN)


add_on_folder("t1_stream_out_of_order", _out_of_order_events, _EVENTS_AFTER)


def _out_of_order_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Both versions of every order over several micro-batches, often the newer one first."""
    raw = warehouse.raw_tables(spark, folder)
    work = fresh_folder(spark, "order-stream")
    table = increments.order_versions_table(spark, f"{work}/table")
    placed = raw.orders.withColumns(
        {"order_status": F.lit("pending"), "updated_at": F.col("order_date") - F.expr("INTERVAL 1 DAY")}
    )
    versions = 2 * raw.orders.count()
    files = _shuffled_files(placed.unionByName(raw.orders), f"{work}/in", versions, "order_id", "updated_at")
    stream_orders(
        files, raw.users, raw.locations, table, f"{work}/checkpoint", "stream", partitions=partitions_for(spark, versions)
    ).awaitTermination()
    return increments.current_orders(table)


add_on_folder("t3_stream_out_of_order", _out_of_order_orders, "SELECT * FROM orders_incr")
