"""Append-only tables bucketed by key, so that a join on the key doesn't shuffle what is stored."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.sources.partitioned import RUN, Notes

CODEC = "zstd"  # keys that are sorted by hash take a third less than by the session's codec


class BucketedTable:
    """A catalogue table over ``path``, bucketed and sorted by ``key``, with a partition a run.

    A run is written into its own partition, and a repeated run overwrites that one alone. A
    session whose catalogue doesn't know the table yet registers it from its files. The number
    of buckets stays as the table was made with: by default the shuffle partitions of that
    session, which a cluster sets to what a join of whole tables needs."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int | None = None):
        self.spark, self.path, self.key, self._wanted = spark, path.rstrip("/"), key, buckets
        self.name = "bucketed_" + hashlib.md5(self.path.encode()).hexdigest()
        self.notes = Notes(spark, f"{self.path}/notes")
        self._layout: tuple[T.StructType, int] | None = None

    def _known(self) -> tuple[T.StructType, int] | None:
        if self._layout is None:
            noted = self.notes["layout"]
            if noted:
                found = json.loads(noted)
                self._layout = T.StructType.fromJson(found["schema"]), found["buckets"]
        return self._layout

    def schema(self) -> T.StructType | None:
        """The columns, without the run's; None before the first run."""
        known = self._known()
        return known[0] if known else None

    def _buckets(self) -> int:
        known = self._known()
        return known[1] if known else self._wanted or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def read(self) -> DataFrame | None:
        """The rows with the run that added them, or None before the first run."""
        schema = self.schema()
        if schema is None:
            return None
        if not self.spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(
                f"CREATE TABLE {self.name} ({columns}, {RUN} string) USING parquet PARTITIONED BY ({RUN}) CLUSTERED BY"
                f" (`{self.key}`) SORTED BY (`{self.key}`) INTO {self._buckets()} BUCKETS LOCATION '{self.path}/data'"
                f" TBLPROPERTIES ('compression' = '{CODEC}')"
            )
            self.spark.catalog.recoverPartitions(self.name)
        return self.spark.table(self.name)

    def append(self, df: DataFrame, run_id: str) -> None:
        """Add rows as the run's partition, one file a bucket."""
        if self.read() is None:
            return self.refresh(df, run_id)
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            self._in_buckets(df, run_id).write.option("compression", CODEC).mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set(mode, before)

    def refresh(self, df: DataFrame, run_id: str) -> None:
        """Make ``df``, which mustn't read the table, the whole content."""
        buckets = self._buckets()
        writer = self._in_buckets(df, run_id).write.mode("overwrite").format("parquet").option("path", f"{self.path}/data")
        writer.option("compression", CODEC)
        writer.partitionBy(RUN).bucketBy(buckets, self.key).sortBy(self.key).saveAsTable(self.name)
        self.notes["layout"] = json.dumps({"schema": df.schema.jsonValue(), "buckets": buckets})
        self._layout = df.schema, buckets

    def _in_buckets(self, df: DataFrame, run_id: str) -> DataFrame:
        """By bucket before the write, or each task would write a file for every bucket."""
        return df.withColumn(RUN, F.lit(run_id)).repartition(self._buckets(), self.key)
