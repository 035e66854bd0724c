"""Incremental models: the batch each run adds, and the run itself."""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.functions import region
from shopgrain.operators.incremental import (
    absent_from_target,
    newer_than_target,
    require_same_schema,
    slices_of,
    stamp_loaded_at,
    upsert,
    upsert_into,
)
from shopgrain.plans.staging import flag_quebec_events, stg_order_items, user_places
from shopgrain.session import partitions_for, shuffle_partitions, written
from shopgrain.sources.raw import RawTables
from shopgrain.sources.bucketed import BucketedTable
from shopgrain.sources.partitioned import RUN, SLICE, PartitionedTable, month_number

ORDERS_KEY, ITEMS_KEY, EVENTS_KEY = "order_id", "order_item_id", "event_id"


def orders_batch(
    orders: DataFrame, users: DataFrame, locations: DataFrame, target: DataFrame | None = None
) -> DataFrame:
    """Orders updated after the target's newest update, with the region of the
    user as of now; it is not restated when the user moves later."""
    new = newer_than_target(orders, target, "updated_at")
    kind = region.region_type(F.col("country_code"), F.col("state"), F.col("zip_code"))
    return new.join(user_places(users, locations), "user_id", "left").select(
        "order_id", "user_id", "order_date", "order_status", "payment_method", "updated_at",
        kind.alias("fulfillment_region_type"),
    )


def order_items_batch(order_items: DataFrame, run_time: datetime, target: DataFrame | None = None) -> DataFrame:
    """Items whose key the target lacks; stored items are never updated."""
    new = absent_from_target(order_items, target, ITEMS_KEY)
    return stamp_loaded_at(stg_order_items(new), run_time)


def user_events_batch(
    user_events: DataFrame, users: DataFrame, locations: DataFrame, target: DataFrame | None = None
) -> DataFrame:
    """Events after the target's newest event, flagged for Quebec."""
    new = newer_than_target(user_events, target, "event_timestamp")
    columns = ("event_id", "user_id", "event_type", "event_timestamp", "page_url", "product_id", "additional_details")
    return flag_quebec_events(new.select(*columns), users, locations)


def orders_table(spark, path: str) -> PartitionedTable:
    """By the month of the order, with the newest update noted beside it."""
    return PartitionedTable(spark, path, [SLICE], mark="updated_at")


def order_items_table(spark, path: str) -> BucketedTable:
    """Bucketed by the item's key, so that stored keys aren't shuffled to find what is new."""
    return BucketedTable(spark, path, ITEMS_KEY)


def user_events_table(spark, path: str) -> PartitionedTable:
    """By month and by the run that added the rows, so runs append and can be repeated."""
    return PartitionedTable(spark, path, [SLICE, RUN], mark="event_timestamp")


def order_versions_table(spark, path: str) -> PartitionedTable:
    """Every version of an order that a stream has let through, by month and micro-batch."""
    return PartitionedTable(spark, path, [SLICE, RUN])


def current_orders(versions: PartitionedTable, slices: Collection[int] | None = None) -> DataFrame | None:
    """The newest version of each order. One that came again keeps the region of its first load.

    The rows are dealt by order once, over partitions that grow with them, and sorted once."""
    rows = versions.read(slices)
    if rows is None:
        return None
    region_of = "fulfillment_region_type"
    rest = [c for c in rows.columns if c not in (ORDERS_KEY, "updated_at", region_of, RUN)]
    names = [c for c in rows.columns if c not in (region_of, RUN, SLICE)] + [region_of]
    keyed = rows.where(F.col(ORDERS_KEY).isNotNull())
    keyed = keyed.repartition(partitions_for(versions.spark, rows.count()), ORDERS_KEY)
    newest = [F.desc("updated_at"), *[F.desc(c) for c in rest], F.asc(RUN), F.asc(region_of)]
    place = F.row_number().over(Window.partitionBy(ORDERS_KEY).orderBy(*newest))
    once = keyed.withColumn("__place", place).where("__place = 1")
    return once.select(*names).unionByName(rows.where(F.col(ORDERS_KEY).isNull()).select(*names))


def run_orders(
    table: PartitionedTable, raw: RawTables, run_id: str, full_refresh: bool = False, refuse_moved: bool = False
) -> bool:
    """One run of the orders increment. False when this run was done before.

    The newest stored update comes from the table's note, and only the months of the batch are read.
    ``full_refresh`` makes the table anew from all source rows, here as in the other runs."""
    if table.ran(run_id):
        return False
    batch = orders_batch(raw.orders, raw.users, raw.locations, None if full_refresh else table.newest(run_id))
    batch = batch.withColumn(SLICE, month_number("order_date"))
    if full_refresh:
        table.refresh(batch)
        table.finished(run_id)
        return True
    return upsert_into(table, batch, ORDERS_KEY, run_id, refuse_moved)


def run_order_items(
    table: BucketedTable, raw: RawTables, run_id: str, run_time: datetime, full_refresh: bool = False, rows: int = 0
) -> None:
    """One run of the items increment: the keys are new, so it only appends. A run that is
    repeated works out its own partition again, from what the other runs hold. The shuffles of
    the run and the buckets of a new table grow with ``rows``, about what the source holds, so
    that no task sorts more than it can keep in memory."""
    with shuffle_partitions(table.spark, partitions_for(table.spark, rows)):
        _run_order_items(table, raw, run_id, run_time, full_refresh)


def _run_order_items(table: BucketedTable, raw: RawTables, run_id: str, run_time: datetime, full_refresh: bool) -> None:
    if full_refresh:
        return table.refresh(order_items_batch(raw.order_items, run_time), run_id)
    stored = table.read()
    if stored is not None:
        stored = stored.where(F.col(RUN) != run_id)
    batch = order_items_batch(raw.order_items, run_time, stored)
    if table.schema() is not None:
        require_same_schema(table.schema(), batch.schema)
    table.append(batch, run_id)


def run_user_events(table: PartitionedTable, raw: RawTables, run_id: str, full_refresh: bool = False) -> bool:
    if full_refresh:
        whole = user_events_batch(raw.user_events, raw.users, raw.locations)
        table.refresh(whole.withColumns({SLICE: month_number("event_timestamp"), RUN: F.lit(run_id)}))
        table.finished(run_id)
        return True
    return add_user_events(table, raw.user_events, raw.users, raw.locations, run_id)


def add_user_events(
    table: PartitionedTable, user_events: DataFrame, users: DataFrame, locations: DataFrame, run_id: str
) -> bool:
    """One run of the events increment: events after the newest mark are appended.

    An event whose id is stored in a month of the batch replaces that row, in the partition
    where it is; this is rare, and only then anything stored is written again."""
    if table.ran(run_id):
        return False
    table.finish_replacing()
    batch = user_events_batch(user_events, users, locations, table.newest(run_id))
    batch = batch.withColumn(SLICE, month_number("event_timestamp"))
    schema = table.schema()
    if schema is not None:
        require_same_schema(schema, batch.withColumn(RUN, F.lit(run_id)).schema)
        batch = written(batch, "batch")
        stored = table.read(slices_of(batch, SLICE)).where(F.col(RUN) != run_id)
        keys = batch.select(EVENTS_KEY, SLICE).distinct()
        hit = written(stored.join(keys, [EVENTS_KEY, SLICE], "left_semi").select(EVENTS_KEY, SLICE, RUN).distinct(), "hit")
        if not hit.isEmpty():
            renewed = batch.join(hit, [EVENTS_KEY, SLICE]).select(*schema.fieldNames())
            parts = stored.join(hit.select(SLICE, RUN).distinct(), [SLICE, RUN], "left_semi").select(*schema.fieldNames())
            table.replace(upsert(parts, renewed, EVENTS_KEY))
            batch = batch.join(hit, [EVENTS_KEY, SLICE], "left_anti").select(*batch.columns)
    table.append(batch, run_id)
    table.finished(run_id)
    return True


def build_increments(raw: RawTables, run_time: datetime) -> dict[str, DataFrame]:
    """First-run content of the three models, lazy."""
    return {
        "stg_orders_incr": orders_batch(raw.orders, raw.users, raw.locations),
        "stg_order_items_incr": order_items_batch(raw.order_items, run_time),
        "stg_user_events_incr": user_events_batch(raw.user_events, raw.users, raw.locations),
    }
