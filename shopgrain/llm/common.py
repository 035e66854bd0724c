"""Helpers shared by the operators of this package."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import ExitStack

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopgrain.llm.tokens import drop_encoders, give_back, tidy
from shopgrain.session import fresh_folder, setting

#: Rows that one small step of a Python task holds at a time, and bytes unless one row has more.
STEP_ROWS, STEP_BYTES = 512, 4 << 20
#: Rows and bytes that Spark hands to a Python task at a time where a table is written. Both sides
#: keep the memory of their largest batch, and a task cuts what it gets into small steps anyway.
HANDED = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1024, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and no others, matched by exact spelling.

    Extra columns may clash with the wanted ones (``TEXT`` beside ``text``, or one
    name twice); then the first column spelled exactly as asked is taken.
    """
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are not in {df.columns}")
    plain = numbered(df)
    return plain.select(*[plain[f"_{df.columns.index(name)}"].alias(name) for name in names])


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named by their places (``_0``, ``_1``, ...), so that no name clashes
    with another or with an operator's own; ``toDF(*df.columns)`` gives the names back."""
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and never
    again from its lineage when executors are lost."""
    spark = df.sparkSession
    folder = fresh_folder(spark, label)
    with ExitStack() as settings:
        for name, value in HANDED.items():
            settings.enter_context(setting(spark, name, value))
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def bounded_broadcast(df: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """``df`` (a few narrow columns, already written) marked for broadcast if a count
    of its rows shows that it is small. A larger one stays as it is, and Spark joins
    it by shuffling."""
    return F.broadcast(df) if df.count() <= most_rows else df


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; a null id counts as empty text."""
    return (F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus).cast("int")


def crc_mod_of(value: int | None, modulus: int) -> int:
    """The same as ``crc_mod`` for one id inside a Python task."""
    return zlib.crc32(b"" if value is None else str(value).encode()) % modulus


def steps(
    batches: Iterable[pa.RecordBatch], rows: int = STEP_ROWS, encoders: bool = False, most: int = STEP_BYTES
) -> Iterator[pa.RecordBatch]:
    """Record batches cut into small slices, so that long texts don't pile up. The encoders that
    earlier tasks left in the process go, unless the task uses ``encoders``, and what else they left;
    at the end freed memory goes back to the system, for the process waits for other tasks."""
    if not encoders:
        drop_encoders()
    tidy()
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield from _halves(batch.slice(start, rows), most)
    give_back()


def _halves(step: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    if step.num_rows < 2 or step.nbytes <= most:
        yield step
    else:
        middle = step.num_rows // 2
        yield from _halves(step.slice(0, middle), most)
        yield from _halves(step.slice(middle), most)


def map_steps(df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str | StructType) -> DataFrame:
    """Apply ``work`` to small slices; it returns the output columns as lists or arrays."""
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            yield as_batch(work(step), arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str | StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    parsed = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return to_arrow_schema(parsed)


def as_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def by_group(df: DataFrame, keys: list[str], work: Callable, schema: str) -> DataFrame:
    """Stream each group's record batches through ``work(batches)``, which yields batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)

    return df.groupBy(*keys).applyInArrow(run, schema)


def by_group_key(df: DataFrame, keys: list[str], work: Callable, schema: str) -> DataFrame:
    """The same with the key's values: ``work(values, batches)``."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(tuple(x.as_py() for x in key), batches)

    return df.groupBy(*keys).applyInArrow(run, schema)
