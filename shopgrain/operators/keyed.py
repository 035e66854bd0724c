"""Joins and windows on keys that may be NULL or heavily repeated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.session import written

NULL_SPREAD = 4096  # tasks over which rows with a NULL key are spread
SALTS = 64  # parts a repeated key is split into before its window


def lookup(
    fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, spread_by: str
) -> DataFrame:
    """Left join on a nullable foreign key, without one task taking every NULL.

    A NULL key can match nothing, so such rows get a throw-away join value that
    spreads them by another column. The extra condition keeps the throw-away
    value from ever matching. Repeated non-NULL keys are left to the adaptive
    skew join, which splits the fact side.
    """
    side = fact.withColumn(
        "__lookup",
        F.coalesce(
            F.col(fact_key).cast("string"),
            F.concat(F.lit("\x00"), F.pmod(F.xxhash64(spread_by), F.lit(NULL_SPREAD)).cast("string")),
        ),
    )
    other = dimension.withColumnRenamed(dimension_key, "__dimension")
    matches = (F.col("__lookup") == F.col("__dimension")) & F.col(fact_key).isNotNull()
    return side.join(other, matches, "left").drop("__lookup", "__dimension")


def flag_repeats(
    df: DataFrame, key: str, order: Sequence[Column], salt_by: Sequence[str], flag: str, salts: int = SALTS
) -> DataFrame:
    """Flag every row of a key but the first in ``order``; NULL keys form one group.

    Two windows keep a huge group off one task. The first ranks within
    (key, salt): a row that is not first there is a repeat for certain. The
    second ranks the at most ``salts`` local firsts of a key, while the
    other rows stay in their salted groups, where their rank no longer matters.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)))
    local = salted.withColumn(
        "__local", F.row_number().over(Window.partitionBy(key, "__salt").orderBy(*order))
    )
    group = F.when(F.col("__local") > 1, F.col("__salt"))
    ranked = local.withColumn("__group", group).withColumn(
        "__final", F.row_number().over(Window.partitionBy(key, "__group").orderBy(*order))
    )
    repeat = (F.col("__local") > 1) | (F.col("__final") > 1)
    return ranked.withColumn(flag, repeat).drop("__salt", "__local", "__group", "__final")


def next_in_group(
    df: DataFrame, key: str, order: Sequence[Column], value: str, output: str, slices: int | None = None
) -> DataFrame:
    """``lead(value)`` per key in ``order``, however many rows a key has.

    Rows are cut into ranges of (key, order), so a busy key is shared among tasks down to
    equal rows. The successor of a range's last row is the first row of the next range that has
    rows: one row a range, which is all that is broadcast. The ranges are a property of one
    execution, so the rows are written once before they are read twice. NULL keys are one group;
    ``value`` must not be NULL.
    """
    ranged = df.repartitionByRange(*([slices] if slices else []), F.asc_nulls_last(key), *order)
    sliced = written(ranged.withColumn("__slice", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("__slice").orderBy(F.asc_nulls_last(key), *order)
    firsts = sliced.withColumn("__place", F.row_number().over(inside)).where("__place = 1")
    # One row a range: bounded by the partition count, whatever the data.
    across = Window.orderBy("__slice")
    after = firsts.select(
        "__slice", F.lead(F.struct(F.col(key).alias("key"), F.col(value).alias("value"))).over(across).alias("__after")
    )
    following = F.lead(F.struct(F.col(key).alias("key"), F.col(value).alias("value"))).over(inside)
    linked = sliced.withColumn("__next", following).join(F.broadcast(after), "__slice")
    found = F.coalesce("__next", "__after")
    same = found["key"].eqNullSafe(F.col(key))
    return linked.withColumn(output, F.when(same, found["value"])).drop("__slice", "__next", "__after")
