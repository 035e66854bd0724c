"""Streaming form of the user-event increment, and de-duplication of late copies."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shopgrain.operators.incremental import absent_from_target, require_same_schema, slices_of
from shopgrain.plans.increments import EVENTS_KEY, add_user_events, user_events_batch
from shopgrain.session import partitions_for, shuffle_partitions, written
from shopgrain.sources.partitioned import RUN, SLICE, PartitionedTable, month_number

AVAILABLE_NOW = {"availableNow": True}  # or, for a stream that stays up, {"processingTime": "1 minute"}


def file_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A stream over parquet files, oldest first. ``path`` is a folder or a glob; a glob
    such as ``events.parque[t]`` takes exactly that name, be it a file or a folder of parts."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_of(run_name: str, batch_id: int) -> str:
    """The run a micro-batch is stored under; in order of the batches."""
    return f"{run_name}-{batch_id:012d}"


def stream_user_events(
    events: DataFrame,
    users: DataFrame,
    locations: DataFrame,
    table: PartitionedTable,
    checkpoint: str,
    run_name: str,
    trigger: Mapping[str, Any] = AVAILABLE_NOW,
    admit: str = "absent",
) -> StreamingQuery:
    """Keep the incremental event table up to date from a stream of raw events.

    An event is taken if its id is not stored yet, however late it is; only the months of
    the batch are looked at, and rows are appended, so nothing stored is written again.
    The event's time is part of what it is: the same id with another month is another event.
    Each micro-batch has partitions of its own, so one that is replayed after a failure
    overwrites what it has added, and no list of batches is kept. ``admit="newer"`` makes each micro-batch a run of the batch
    model instead: only events after the table's newest one come in, so late ones are lost.
    """
    if admit not in ("absent", "newer"):
        raise ValueError(f"unknown admission {admit!r}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with shuffle_partitions(spark, partitions_for(spark, batch.count())):
            add(batch, run_of(run_name, batch_id))

    def add(batch: DataFrame, run_id: str) -> None:
        if admit == "newer":
            add_user_events(table, batch, users, locations, run_id)
            return
        # By key first: whole rows are compared in the tasks after the shuffle, whose number grows
        # with the batch, and not in the one task that reads a large file.
        once = batch.where(F.col(EVENTS_KEY).isNotNull()).repartition(EVENTS_KEY).dropDuplicates([EVENTS_KEY])
        once = once.unionByName(batch.where(F.col(EVENTS_KEY).isNull()))  # a NULL id never matches
        new = written(once.withColumn(SLICE, month_number("event_timestamp")), "micro-batch")
        stored = table.read(slices_of(new, SLICE))
        if stored is not None:
            stored = stored.where(F.col(RUN) != run_id)
        new = absent_from_target(new, stored, EVENTS_KEY).drop(SLICE)
        rows = user_events_batch(new, users, locations).withColumn(SLICE, month_number("event_timestamp"))
        if stored is not None:
            require_same_schema(table.schema(), rows.withColumn(RUN, F.lit(run_id)).schema)
        table.append(rows, run_id)

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def deduplicated(events: DataFrame, lateness: str = "1 hour", salts: int = 1) -> DataFrame:
    """One row per event_id among copies that arrive within ``lateness``.

    With ``salts`` above one a first step drops copies within (event_id, salt), so an
    event that is sent over and over is spread over that many tasks and at most that
    many copies reach the second step. It costs a second state store, so it is off by
    default. The salt only spreads work; which copy survives may differ, and copies
    are equal.

    The watermark needs a zoned timestamp, so the event time is cast under the
    session zone (UTC) for the watermark and given back unchanged.
    """
    marked = events.withColumn("__event_time", F.col("event_timestamp").cast("timestamp")).withWatermark(
        "__event_time", lateness
    )
    if salts > 1:
        marked = (
            marked.withColumn("__salt", F.floor(F.rand() * salts))
            .dropDuplicatesWithinWatermark([EVENTS_KEY, "__salt"])
            .drop("__salt")
        )
    return marked.dropDuplicatesWithinWatermark([EVENTS_KEY]).drop("__event_time")


def write_stream(
    df: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, Any] = AVAILABLE_NOW
) -> StreamingQuery:
    """Append a stream to a parquet folder; the file log makes each batch count once."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
