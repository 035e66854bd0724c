"""Load everything in a folder of CSVs, one table per file stem."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain import schemas
from shopgrain.sources.raw import read_csv

REPORT = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("error", T.StringType(), True),
    ]
)


def csv_entries(spark: SparkSession, folder: str) -> list[str]:
    """The entries directly under a folder: CSV files, or folders of CSV parts.

    One name per future table, so the list is short; no file content is read.
    """
    root = folder.rstrip("/").split(":", 1)[-1].replace("///", "/")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    entry = F.split(F.substring_index("path", f"{root}/", -1), "/")[0]
    is_csv = F.lower("path").rlike(r"\.csv(\.[a-z0-9]+)?$")
    return sorted(row[0] for row in listing.where(is_csv).select(F.url_decode(entry)).distinct().collect())


def ingest_folder(
    spark: SparkSession,
    folder: str,
    database: str = "default",
    known: Mapping[str, T.StructType] = {**schemas.RAW, **schemas.SEEDS},
) -> DataFrame:
    """Create a table per entry unless it exists; one bad file does not stop the rest.

    Known tables are read with their fixed schema, others as text columns named
    by their header. Returns one report row per entry.
    """
    report = []
    for entry in csv_entries(spark, folder):
        name = entry.split(".")[0]
        try:
            table = f"{database}.{name}"
            if spark.catalog.tableExists(table):
                report.append((name, "exists", None))
                continue
            path = f"{folder.rstrip('/')}/{entry}"
            if name in known:
                df = read_csv(spark, path, known[name])
            else:
                df = spark.read.option("header", True).option("escape", '"').csv(path)
            df.write.mode("ignore").saveAsTable(table)
            report.append((name, "created", None))
        except (PySparkException, Py4JJavaError) as failure:
            report.append((name, "failed", str(failure).strip()))
    return spark.createDataFrame(report, REPORT)
