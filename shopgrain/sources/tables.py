"""View and full-refresh table materialisation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_views(models: Mapping[str, DataFrame]) -> None:
    """Register each model as a temporary view; nothing runs until it is queried."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)


def refresh_table(spark: SparkSession, df: DataFrame, path: str, slice_column: str | None = None) -> DataFrame:
    """Full refresh: ``df``, which mustn't read the table, becomes its whole content.

    With a slice column the files are laid out by it, and a filter on it skips the others. A
    refresh that died is run again; nothing of the old content is needed for it."""
    schema = df.schema
    if slice_column:
        df = df.hint("rebalance", F.col(slice_column))
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(slice_column) if slice_column else writer).parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
