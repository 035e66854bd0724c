"""Increment selection, keyed upsert and schema guard."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.session import written
from shopgrain.sources.partitioned import PartitionedTable

DRIFT = T.StructType(
    [
        T.StructField("column_name", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("expected", T.StringType(), True),
        T.StructField("actual", T.StringType(), True),
    ]
)


class SchemaDrift(ValueError):
    """The increment does not have the columns of its target."""


def newer_than_target(
    source: DataFrame, target: DataFrame | None, moment: str, on_empty: str = "none"
) -> DataFrame:
    """Rows strictly after the target's newest ``moment``; all rows on the first run.

    Ties with the newest row and rows that arrive late are left out for good.
    An empty target has no newest row, so nothing passes; ``on_empty="all"``
    lets everything pass instead.
    """
    if target is None:
        return source
    newest = target.select(F.max(moment)).scalar()
    newer = F.col(moment) > newest
    return source.where(newer | newest.isNull() if on_empty == "all" else newer)


def absent_from_target(source: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """Rows whose key the target lacks. A NULL key never matches, so it always passes."""
    if target is None:
        return source
    return source.join(target.select(key), key, "left_anti")


def upsert(target: DataFrame | None, batch: DataFrame, key: str, batch_keys: DataFrame | None = None) -> DataFrame:
    """The batch replaces target rows of the same key; repeats inside the batch stay."""
    if target is None:
        return batch
    keys = batch.select(key) if batch_keys is None else batch_keys
    return target.join(keys, key, "left_anti").unionByName(batch)


def distinct_keys(batch: DataFrame, key: str) -> DataFrame:
    """The keys of a stored batch; Spark picks the join by their size."""
    return batch.select(key).where(F.col(key).isNotNull()).distinct()


def latest_per_key(df: DataFrame, key: str, moment: str) -> DataFrame:
    """One row per key: the one of the newest ``moment``. A NULL key never matches, so all
    its rows pass.

    Of several rows of the newest moment the greatest by all columns stays. Rows that are
    partitioned by the key already aren't shuffled again."""
    rest = [c for c in df.columns if c not in (key, moment)]
    newest = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(moment, *rest)).alias("__row"))
    return newest.select(key, "__row.*").select(*df.columns).unionByName(df.where(F.col(key).isNull()))


def newer_than_stored(batch: DataFrame, stored: DataFrame | None, key: str, moment: str) -> DataFrame:
    """Batch rows whose key is not stored, or stored with an older ``moment``."""
    if stored is None:
        return batch
    held = stored.groupBy(F.col(key).alias("__key")).agg(F.max(moment).alias("__held"))
    joined = batch.join(held, F.col(key) == F.col("__key"), "left")
    return joined.where(F.col("__key").isNull() | (F.col(moment) > F.col("__held"))).select(*batch.columns)


def stamp_loaded_at(df: DataFrame, run_time: datetime) -> DataFrame:
    """Audit column: when the row entered the table. One value for the whole run."""
    return df.withColumn("loaded_at", F.lit(run_time).cast("timestamp_ntz"))


def schema_drift(expected: T.StructType, actual: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """Differences as (column, kind, expected type, actual type); order does not matter."""
    want = {f.name: f.dataType.simpleString() for f in expected}
    have = {f.name: f.dataType.simpleString() for f in actual}
    drift = [(c, "missing", t, None) for c, t in want.items() if c not in have]
    drift += [(c, "added", None, t) for c, t in have.items() if c not in want]
    drift += [(c, "type", t, have[c]) for c, t in want.items() if c in have and have[c] != t]
    return sorted(drift)


def require_same_schema(expected: T.StructType, actual: T.StructType) -> None:
    drift = schema_drift(expected, actual)
    if drift:
        raise SchemaDrift("; ".join(f"{c}: {kind} (expected {e}, got {a})" for c, kind, e, a in drift))


class MovedKey(ValueError):
    """A key of the batch is stored in another slice, so an upsert by slice would leave it twice."""


def moved_keys(table: PartitionedTable, batch: DataFrame, key: str) -> DataFrame:
    """Keys of the batch that the table holds in another slice only: a scan of all stored keys."""
    slice_of = table.by[0]
    held = table.read().select(F.col(key).alias("__held"), F.col(slice_of).alias("__slice"))
    pairs = batch.select(key, slice_of).join(held, F.col(key) == F.col("__held"))
    return pairs.where(F.col(slice_of) != F.col("__slice")).select(key).distinct()


def upsert_into(
    table: PartitionedTable, batch: DataFrame, key: str, run_id: str, refuse_moved: bool = False
) -> bool:
    """Upsert a batch into a table by slice. False when this run was done before.

    Only the slices of the batch are read and written. So a key's slice must be part of what
    it is, as an order's month is; ``refuse_moved`` looks through all stored keys for ones
    that moved and raises ``MovedKey`` (a full refresh then puts them right).
    """
    if table.ran(run_id):
        return False
    schema = table.schema()
    if schema is None:
        table.refresh(batch)
    else:
        require_same_schema(schema, batch.schema)
        table.finish_replacing()
        batch = written(batch, "batch")  # read several times below; the increment is the small side
        if refuse_moved:
            found = [row[0] for row in moved_keys(table, batch, key).limit(5).collect()]
            if found:
                raise MovedKey(f"{key} is stored in another slice, for example {found}")
        stored = table.read(slices_of(batch, table.by[0]))
        table.replace(upsert(stored, batch, key, distinct_keys(batch, key)))
    table.finished(run_id)
    return True


def slices_of(batch: DataFrame, column: str) -> list[int]:
    """The slices a stored batch touches: months, few whatever its rows."""
    return [row[0] for row in batch.select(column).distinct().collect()]
