"""Running totals, positions, exact medians and histograms over one global order.

A window without a partition would move every row into one task. Instead the
rows are range-partitioned by the order, each slice is summed on its own, and
the slice totals (one row per shuffle partition) become starting offsets.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.session import durable, written

RANGES = 16_384  # ranges that a round of the median counts


def running_totals(
    df: DataFrame, order: Sequence[Column], measures: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Add ``position``, ``rows_total`` and, per measure, ``<m>_running`` and ``<m>_total``.

    ``order`` must be a total order: ties would let the range bounds cut a
    group of equal rows arbitrarily. Measures are whole numbers, so sums are exact.

    The slice number is a property of one execution's range bounds, so the
    sliced rows are written out once before they are used twice.
    """
    ranged = df.repartitionByRange(*([slices] if slices else []), *order)
    sliced = durable(ranged.withColumn("__slice", F.spark_partition_id()))
    per_slice = sliced.groupBy("__slice").agg(
        F.count("*").alias("__rows"), *[F.sum(m).alias(f"__{m}") for m in measures]
    )
    # One row per shuffle partition: bounded by the partition count, whatever the data.
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    starts = per_slice.select(
        "__slice",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
        F.sum("__rows").over(whole).alias("rows_total"),
        *[F.coalesce(F.sum(f"__{m}").over(before), F.lit(0)).alias(f"__{m}_before") for m in measures],
        *[F.sum(f"__{m}").over(whole).alias(f"{m}_total") for m in measures],
    )
    within = Window.partitionBy("__slice").orderBy(*order)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        sliced.join(F.broadcast(starts), "__slice")
        .withColumn("position", F.col("__rows_before") + F.row_number().over(within))
        .withColumns(
            {f"{m}_running": F.col(f"__{m}_before") + F.coalesce(F.sum(m).over(so_far), F.lit(0)) for m in measures}
        )
        .drop("__slice", "__rows_before", *[f"__{m}_before" for m in measures])
    )


def values_at(values: DataFrame, column: str, ranks: Sequence[int], low: int, high: int, ranges: int = RANGES) -> dict[int, int]:
    """The whole numbers at some places (from 1) of the order of ``column``, without sorting it.

    ``low`` and ``high`` bound the values. Each round counts the rows of equal ranges between
    the bounds and goes on in the range that holds the place, until it is one value wide. A
    round scans the column once per different range that is still open (as many as ``ranks``
    at most) and brings back one count a range."""
    number = F.col(column).cast("decimal(38,0)")
    found: dict[int, int] = {}
    open_ranges = {(low, high, 0): list(ranks)}  # (bounds, rows before) -> places inside
    while open_ranges:
        narrower: dict[tuple[int, int, int], list[int]] = {}
        for (start, end, before), places in open_ranges.items():
            if start == end:
                found.update(dict.fromkeys(places, start))
                continue
            width = (end - start) // ranges + 1
            first, last, step = (F.lit(Decimal(x)).cast("decimal(38,0)") for x in (start, end, width))
            part = F.call_function("div", number - first, step)
            counted = values.where(number.between(first, last)).groupBy(part.alias("part")).count().collect()
            so_far, left = before, sorted(places)
            for row in sorted(counted, key=lambda row: row["part"]):
                inside = [place for place in left if place <= so_far + row["count"]]
                if inside:
                    bottom = start + int(row["part"]) * width
                    narrower[bottom, min(bottom + width - 1, end), so_far] = inside
                    left = left[len(inside) :]
                so_far += row["count"]
        open_ranges = narrower
    return found


def middle_of(values: DataFrame, column: str, n: int, low: int, high: int) -> float:
    """The exact median of ``n`` whole numbers between ``low`` and ``high``: the mean of the middle two."""
    ranks = sorted({(n + 1) // 2, (n + 2) // 2})
    found = values_at(values, column, ranks, low, high)
    return (found[ranks[0]] + found[ranks[-1]]) / 2


def median(df: DataFrame, column: str) -> DataFrame:
    """One row: exact ``median`` and count ``n`` of the non-NULL values of an integer column.

    The column is written once and then only counted; nothing is shuffled but counts."""
    values = written(df.where(F.col(column).isNotNull()).select(column), "median")
    n, low, high = values.agg(F.count("*"), F.min(column), F.max(column)).first()
    middle = middle_of(values, column, n, int(low), int(high)) if n else None
    return df.sparkSession.range(1).select(F.lit(middle).cast("double").alias("median"), F.lit(n).cast("bigint").alias("n"))


def histogram(df: DataFrame, column: str, bins: int = 40, half_unit: int = 50) -> DataFrame:
    """Equal-width bins over an integer column: bin, lower, upper, n; empty bins included.

    The last bin is closed on the right. When all values are equal, the range
    is widened by ``half_unit`` on both sides, as the usual plotting rule does.
    """
    # One pass over the source: the value frequencies are kept and read twice.
    values = durable(
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("decimal(28,0)").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    same = F.min("value") == F.max("value")
    span = values.agg(
        (F.min("value") - F.when(same, half_unit).otherwise(0)).alias("low"),
        (F.max("value") + F.when(same, half_unit).otherwise(0)).alias("high"),
    )
    low, high = span.select("low").scalar(), span.select("high").scalar()
    position = F.call_function("div", (F.col("value") - low) * bins, high - low)
    counts = values.groupBy(F.least(position, F.lit(bins - 1)).alias("bin")).agg(F.sum("n").alias("n"))
    edges = (
        df.sparkSession.range(bins)
        .select(F.col("id").alias("bin"))
        .withColumn("lower", low.cast("double") + F.col("bin") * (high - low).cast("double") / F.lit(float(bins)))
        .withColumn("upper", low.cast("double") + (F.col("bin") + 1) * (high - low).cast("double") / F.lit(float(bins)))
    )
    return edges.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
