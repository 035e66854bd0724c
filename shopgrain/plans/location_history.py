"""Type-2 history of locations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.functions import region
from shopgrain.operators.history import next_versions, require_unique
from shopgrain.plans.staging import with_currency
from shopgrain.sources.partitioned import PartitionedTable

KEY, MOMENT = "location_id", "snapshot_timestamp"
SLICE, OPEN = "closed_by", "open"


def location_snapshot(locations: DataFrame, exchange_rates: DataFrame, run_time: datetime) -> DataFrame:
    """The state of every location at ``run_time``."""
    country, state, zip_code = F.col("country_code"), F.col("state"), F.col("zip_code")
    return with_currency(locations, exchange_rates).select(
        "*",
        region.is_excluded_supply_chain(country, state, zip_code).alias("is_excluded_supply_chain"),
        region.is_quebec(country, state).alias("is_quebec_compliant_required"),
        F.lit(run_time).cast("timestamp_ntz").alias(MOMENT),
    )


def snap_locations(
    history: DataFrame | None,
    locations: DataFrame,
    exchange_rates: DataFrame,
    run_time: datetime,
    strategy: str = "timestamp",
) -> DataFrame:
    """History after one more snapshot run.

    With ``timestamp`` the run time itself is the row's change time, so every
    run adds a version of every location. ``check`` adds one only on a change.
    """
    return next_versions(history, location_snapshot(locations, exchange_rates, run_time), KEY, MOMENT, strategy)


def history_table(spark: SparkSession, path: str) -> PartitionedTable:
    """Open versions share one partition; the versions a run closes get one of
    their own, which no later run reads or rewrites."""
    return PartitionedTable(spark, path, [SLICE])


def run_snapshot(
    table: PartitionedTable,
    locations: DataFrame,
    exchange_rates: DataFrame,
    run_time: datetime,
    run_id: str,
    strategy: str = "timestamp",
) -> bool:
    """One snapshot run. False when this run was done before."""
    if table.ran(run_id):
        return False
    require_unique(locations, KEY)
    schema = table.schema()
    if schema is None:
        first = snap_locations(None, locations, exchange_rates, run_time, strategy)
        table.refresh(first.withColumn(SLICE, F.lit(OPEN)))
    else:
        table.finish_replacing()
        # What this run has closed before it died is open again to it.
        own = F.lit(f"run {run_id}")
        reopened = table.read([OPEN]).drop(SLICE)
        after = snap_locations(reopened, locations, exchange_rates, run_time, strategy)
        sliced = after.withColumn(SLICE, F.when(F.col("is_current"), OPEN).otherwise(own))
        table.replace(sliced)
    table.finished(run_id)
    return True


def read_history(table: PartitionedTable) -> DataFrame | None:
    history = table.read()
    return None if history is None else history.drop(SLICE)
