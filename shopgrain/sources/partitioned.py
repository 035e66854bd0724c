"""Parquet tables by month that runs keep up to date, written through ``DataFrameWriter`` alone.

A run overwrites only the partitions it has rows for (dynamic partition overwrite). A table
whose partitions also name the run that added them is appended to: a run that is repeated
writes its own partitions again, so nothing is doubled and no list of runs is needed.

Replaced months are worked out from what they hold, so they are written beside the table
first. A run that dies while they are moved in is finished by whichever run comes next.
One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE, RUN = "slice_month", "run"


def month_number(column: str) -> F.Column:
    """Slice number of a timestamp: 202401 for January 2024, -1 for NULL."""
    moment = F.col(column)
    return F.coalesce(F.year(moment) * 100 + F.month(moment), F.lit(-1)).cast("int")


def read_or_none(load, path: str) -> DataFrame | None:
    """What ``load`` reads, or None where there is nothing yet."""
    try:
        return load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class Notes:
    """Named one-line notes in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getitem__(self, name: str) -> str | None:
        found = read_or_none(self.spark.read.schema("value string").json, f"{self.path}/{quote(name, safe='')}")
        row = found.first() if found is not None else None
        return row[0] if row else None

    def __setitem__(self, name: str, value: str) -> None:
        row = self.spark.range(0, 1, 1, 1).select(F.lit(value).cast("string").alias("value"))
        row.write.mode("overwrite").json(f"{self.path}/{quote(name, safe='')}")


class PartitionedTable:
    """``by`` are the partition columns, the slice first. ``mark`` names a time of which the
    newest value is noted beside the table when rows are written, so that no run looks for it."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str] = (SLICE,), mark: str | None = None):
        self.spark, self.path, self.by, self.mark = spark, path.rstrip("/"), list(by), mark
        self.notes = Notes(spark, f"{self.path}/notes")
        self._schema: T.StructType | None = None

    def schema(self) -> T.StructType | None:
        """The table's columns, or None before its first run."""
        if self._schema is None:
            known = self.notes["schema"]
            self._schema = T.StructType.fromJson(json.loads(known)) if known else None
        return self._schema

    def _set_schema(self, schema: T.StructType) -> None:
        self.notes["schema"] = schema.json()
        self._schema = schema

    # -- runs ------------------------------------------------------------------------------

    def ran(self, run_id: str) -> bool:
        """Whether the run is done; only its own note is read."""
        return self.notes[f"run {run_id}"] is not None

    def finished(self, run_id: str) -> None:
        self.notes[f"run {run_id}"] = "done"

    def newest(self, run_id: str) -> DataFrame | None:
        """One row with the newest ``mark`` before the run, NULL in an empty table; None before the
        first run. A run that is repeated gets what it got at first."""
        schema = self.schema()
        if schema is None:
            return None
        known = self.notes[f"newest before {run_id}"]
        if known is None:
            known = self.notes["newest"]
            self.notes[f"newest before {run_id}"] = known
        value = F.lit(known or None).cast(schema[self.mark].dataType)
        return self.spark.range(1).select(value.alias(self.mark))

    # -- reading -------------------------------------------------------------------------

    def _load(self, folder: str, schema: T.StructType) -> DataFrame:
        found = read_or_none(self.spark.read.schema(schema).parquet, f"{self.path}/{folder}")
        return self.spark.createDataFrame([], schema) if found is None else found.select(*schema.fieldNames())

    def read(self, slices: Collection[int | str] | None = None) -> DataFrame | None:
        """The rows, or None before the first run; with ``slices`` only these folders are read."""
        schema = self.schema()
        if schema is None:
            return None
        rows = self._load("data", schema)
        return rows if slices is None else rows.where(F.col(self.by[0]).isin(*slices))

    # -- writing -------------------------------------------------------------------------

    def _write(self, df: DataFrame, mode: str) -> None:
        """Overwrite the whole table or the partitions of ``df``."""
        # Rows are brought together by partition, so a task writes few files; a large one is split.
        together = df.hint("rebalance", *[F.col(c) for c in self.by])
        writer = together.write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy(*self.by).parquet(f"{self.path}/data")

    def _note_newest(self, written: DataFrame, known: str | None = None) -> None:
        """Note the newest mark, from that column of what has just been written and what is known."""
        if self.mark:
            seen = written.agg(F.max(self.mark).cast("string")).first()[0]
            self.notes["newest"] = max(seen or "", known or "")

    def refresh(self, df: DataFrame) -> None:
        """Make ``df``, which mustn't read the table, the whole content."""
        self._write(df, "static")
        self._note_newest(self._load("data", df.schema))
        self._set_schema(df.schema)

    def append(self, df: DataFrame, run_id: str) -> None:
        """Add rows as the run's own partitions; a repeated run writes them again."""
        rows = df.withColumn(RUN, F.lit(run_id))
        self._write(rows, "dynamic")
        own = self._load("data", rows.schema).where(F.col(RUN) == run_id)
        self._note_newest(own, self.notes["newest"] if self.mark else None)
        if self.schema() is None:
            self._set_schema(rows.schema)

    def replace(self, df: DataFrame) -> None:
        """Make ``df`` the content of the partitions it has rows for; it may be worked out from them."""
        self.finish_replacing()
        df.write.mode("overwrite").parquet(f"{self.path}/staged")
        self.notes["replacing"] = "yes"
        self.finish_replacing()

    def finish_replacing(self) -> None:
        """Move in what has been written beside the table; also what a run that died left there."""
        if self.notes["replacing"] == "yes":
            staged = self._load("staged", self.schema())
            self._write(staged, "dynamic")
            self._note_newest(staged, self.notes["newest"] if self.mark else None)
            self.notes["replacing"] = "no"
