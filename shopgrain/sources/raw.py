"""Readers and writers of the raw CSV tables and the seed."""

from __future__ import annotations

import csv
from collections.abc import Callable, Mapping
from datetime import date
from functools import partial
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from shopgrain import schemas

SEED_FOLDER = Path(__file__).resolve().parent.parent / "seeds"


class RawTables:
    """The six raw tables and the exchange-rate seed.

    A table is given as a frame or as a function that makes it; a function runs
    at first use, so a query builds only the tables it reads.
    """

    NAMES = (*schemas.RAW, *schemas.SEEDS)

    def __init__(self, spark: SparkSession, **tables: DataFrame | Callable[[], DataFrame]):
        unknown = set(tables) ^ set(self.NAMES)
        if unknown:
            raise ValueError(f"unknown or missing raw tables: {sorted(unknown)}")
        self.spark = spark
        self._tables = tables

    def __getitem__(self, name: str) -> DataFrame:
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    users = property(lambda self: self["users"])
    locations = property(lambda self: self["locations"])
    products = property(lambda self: self["products"])
    orders = property(lambda self: self["orders"])
    order_items = property(lambda self: self["order_items"])
    user_events = property(lambda self: self["user_events"])
    exchange_rates = property(lambda self: self["exchange_rates"])

    def replace(self, **tables: DataFrame | Callable[[], DataFrame]) -> RawTables:
        """The same tables with some exchanged."""
        return RawTables(self.spark, **{**self._tables, **tables})


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header and RFC-style doubled quotes, read with a fixed schema.

    Columns are read as text and then cast: a whole-number column takes ``2.5`` and rounds
    halves to even, a time column takes a date alone. A value that fits no cast fails the
    query. Set ``multi_line`` only for files with line breaks inside quotes: such a file is
    read by one task.
    """
    text = T.StructType([T.StructField(field.name, T.StringType()) for field in schema])
    lines = (
        spark.read.schema(text)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return lines.select(*[_from_text(F.col(field.name), field.dataType).alias(field.name) for field in schema])


def _from_text(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, T.IntegralType):
        return F.rint(F.trim(column).cast("double")).cast(kind)
    return F.trim(column).cast(kind)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink: header, no index, doubled quotes, one file per task."""
    (
        df.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .mode(mode)
        .csv(path)
    )


def write_raw_csv(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}")


def read_raw_csv(spark: SparkSession, folder: str, suffix: str = "") -> RawTables:
    """Scan the six raw tables; each is a CSV file or a folder of CSV files."""
    tables = {
        name: partial(read_csv, spark, f"{folder}/{name}{suffix}", schema) for name, schema in schemas.RAW.items()
    }
    return RawTables(spark, exchange_rates=partial(exchange_rates, spark), **tables)


def exchange_rates(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The currency seed, one row per currency. Without a path on shared storage the packaged
    text becomes the frame, so no executor needs the package's folder."""
    if path is not None:
        return read_csv(spark, path, schemas.EXCHANGE_RATES)
    with (SEED_FOLDER / "exchange_rates.csv").open(newline="") as file:
        rows = [
            (r["currency_code"], float(r["exchange_rate_to_usd"]), date.fromisoformat(r["rate_date"]), r["notes"] or None)
            for r in csv.DictReader(file)
        ]
    return spark.createDataFrame(rows, schemas.EXCHANGE_RATES)
