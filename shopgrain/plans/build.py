"""One run of the whole project: views, incremental tables and mart tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from shopgrain.plans import increments
from shopgrain.plans.mart import build_mart
from shopgrain.plans.staging import build_staging
from shopgrain.sources.raw import RawTables
from shopgrain.sources.tables import create_views, refresh_table
from shopgrain.sources.partitioned import RUN, month_number

# Facts with a date are laid out by its month, so that a period reads its months only.
MART_DATES = {
    "fct_orders": "order_date",
    "fct_order_items": "order_date",
    "fct_user_events": "event_timestamp",
}


def build(raw: RawTables, folder: str, run_id: str, run_time: datetime) -> dict[str, DataFrame]:
    """Build every model under ``folder`` and return them by name.

    Staging models become views, incremental models take in what is new, mart
    models are written anew. A repeated run id leaves the same rows.
    """
    spark = raw.spark
    models = build_staging(raw)
    create_views(models)

    stored = {
        "stg_orders_incr": increments.orders_table(spark, f"{folder}/stg_orders_incr"),
        "stg_order_items_incr": increments.order_items_table(spark, f"{folder}/stg_order_items_incr"),
        "stg_user_events_incr": increments.user_events_table(spark, f"{folder}/stg_user_events_incr"),
    }
    increments.run_orders(stored["stg_orders_incr"], raw, run_id)
    increments.run_order_items(stored["stg_order_items_incr"], raw, run_id, run_time, rows=raw.order_items.count())
    increments.run_user_events(stored["stg_user_events_incr"], raw, run_id)
    tables = {name: table.read().drop(RUN) for name, table in stored.items()}

    for name, df in build_mart(raw, models).items():
        slice_column = None
        if name in MART_DATES:
            slice_column = increments.SLICE
            df = df.withColumn(slice_column, month_number(MART_DATES[name]))
        tables[name] = refresh_table(spark, df, f"{folder}/{name}", slice_column)
    return models | tables
