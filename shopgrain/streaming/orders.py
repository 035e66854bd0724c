"""Streaming upsert of order status changes."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopgrain.plans.increments import ORDERS_KEY, orders_batch
from shopgrain.session import ADAPTIVE_CONF, PARTITIONS_CONF, setting, shuffle_partitions, shuffles_freed, state_on_disk
from shopgrain.sources.partitioned import SLICE, PartitionedTable, month_number
from shopgrain.streaming.events import AVAILABLE_NOW, run_of


def newest_versions(changes: DataFrame) -> DataFrame:
    """A stream of the newest version of each order that a micro-batch touched.

    The state store holds one version an order. Of versions with the same update the greatest
    by all columns is the newest, so the outcome doesn't depend on the batches. Orders without
    a key match nothing and pass as they are. Rows are dealt by key as the state is before
    versions are compared, or the task that reads a large file would sort all of it."""
    names = changes.columns
    rest = [c for c in names if c not in (ORDERS_KEY, "updated_at")]
    number = int(changes.sparkSession.conf.get(PARTITIONS_CONF))
    keyed = changes.where(F.col(ORDERS_KEY).isNotNull()).repartition(number, ORDERS_KEY).groupBy(ORDERS_KEY)
    newest = keyed.agg(F.max(F.struct("updated_at", *rest)).alias("__newest")).select(ORDERS_KEY, "__newest.*")
    return newest.select(*names).unionByName(changes.where(F.col(ORDERS_KEY).isNull()))


def stream_orders(
    changes: DataFrame,
    users: DataFrame,
    locations: DataFrame,
    versions: PartitionedTable,
    checkpoint: str,
    run_name: str,
    trigger: Mapping[str, Any] = AVAILABLE_NOW,
    partitions: int | None = None,
) -> StreamingQuery:
    """Apply a stream of order versions: the newest version per order wins.

    A micro-batch appends the orders it touched, each in its newest version, and reads nothing
    that is stored: what an order was before is in the state store. What it writes is in
    proportion to the batch, and a batch that is replayed overwrites its own partitions.
    ``current_orders`` reads the newest version of each order back.

    The state has as many ``partitions`` as the first start of the stream gave it, by default the
    session's shuffle partitions; a task holds the changes of one of them. The state is on disk
    (``state_on_disk``), as the versions of all orders would fill the executors' heaps.
    """
    spark = changes.sparkSession
    adaptive = spark.conf.get(ADAPTIVE_CONF)

    def write(batch: DataFrame, batch_id: int) -> None:
        # A stream with state runs without adaptive execution, and then Spark ignores the hint that
        # brings the rows of a month together: each task would write a file a month. What the
        # state gave out is fixed by now, so this part may be adaptive.
        with setting(batch.sparkSession, ADAPTIVE_CONF, adaptive):
            rows = orders_batch(batch, users, locations).withColumn(SLICE, month_number("order_date"))
            versions.append(rows, run_of(run_name, batch_id))

    number = partitions or int(spark.conf.get(PARTITIONS_CONF))
    with shuffle_partitions(spark, number), state_on_disk(spark), shuffles_freed(spark):  # the query keeps them
        return (
            newest_versions(changes)
            .writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )
