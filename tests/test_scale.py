"""Operators that must not gather a large group in one task, against plain windows."""

import random
from decimal import Decimal
import re

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopgrain.operators import keyed, ranked
from shopgrain.plans.staging import flag_quebec_events


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows; a third belongs to one key, a sixth has none."""
    random.seed(7)
    data = []
    for i in range(20_000):
        draw = random.random()
        key = "hot" if draw < 0.34 else None if draw < 0.5 else f"k{random.randrange(3000)}"
        data.append((i, key, random.randrange(5000) if random.random() > 0.02 else None, f"s{random.randrange(4)}"))
    df = spark.createDataFrame(data, "id int, key string, t int, step string").repartition(6)
    return df.withColumn("at", F.timestamp_seconds("t").cast("timestamp_ntz")).cache()


@pytest.mark.parametrize("salts", [1, 3, 64])
def test_repeat_flags_equal_a_plain_window(skewed, salts):
    order = [F.asc_nulls_last("t"), F.asc_nulls_last("id")]
    ours = keyed.flag_repeats(skewed, "key", order, ["id"], "again", salts)
    plain = skewed.withColumn("again", F.row_number().over(Window.partitionBy("key").orderBy(*order)) > 1)
    assert rows(ours, "id", "again") == rows(plain, "id", "again")
    assert ours.columns == [*skewed.columns, "again"]


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_successors_equal_a_plain_lead(skewed, slices):
    order = [F.asc_nulls_last("at"), F.asc_nulls_last("id")]
    ours = keyed.next_in_group(skewed, "key", order, "step", "following", slices)
    plain = skewed.withColumn("following", F.lead("step").over(Window.partitionBy("key").orderBy(*order)))
    assert rows(ours, "id", "following") == rows(plain, "id", "following")


def test_one_busy_moment_of_a_key_is_shared_among_tasks(spark):
    """All rows of one user at one time: only the ids tell them apart."""
    busy = spark.range(5000).selectExpr("cast(id AS int) AS id", "'u' AS key", "1 AS at", "concat('s', id) AS step").repartition(6)
    order = [F.asc_nulls_last("at"), F.asc_nulls_last("id")]
    ours = keyed.next_in_group(busy, "key", order, "step", "following", 8)
    assert ours.where("following = concat('s', id + 1)").count() == 4999
    assert rows(ours.where("following IS NULL"), "id") == [(4999,)]
    slices = busy.repartitionByRange(8, F.asc_nulls_last("key"), *order).groupBy(F.spark_partition_id()).count()
    assert slices.count() >= 7 and slices.agg(F.max("count")).first()[0] < 1500


def test_successors_of_nothing(spark):
    empty = spark.createDataFrame([], "id int, key string, at int, step string")
    assert keyed.next_in_group(empty, "key", [F.col("at")], "step", "following").count() == 0


def test_largest_window_group_shrinks(skewed):
    """The hot key's rows are spread over its salts before any window sees them."""
    salted = skewed.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(keyed.SALTS))).groupBy("key", "salt").count()
    hot = skewed.where("key = 'hot'").count()
    assert salted.agg(F.max("count")).first()[0] < hot / 20


@pytest.mark.parametrize("slices", [1, 5, 16])
def test_running_totals_equal_a_plain_window(skewed, slices):
    values = skewed.select("id", F.pmod("id", F.lit(50)).cast("bigint").alias("v"))  # heavy ties
    order = [F.desc("v"), F.asc("id")]
    ours = ranked.running_totals(values, order, ["v"], slices)
    w = Window.orderBy(*order)
    plain = values.select(
        "id",
        F.row_number().over(w).cast("bigint").alias("position"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("v_running"),
        F.sum("v").over(Window.partitionBy()).alias("v_total"),
        F.count("*").over(Window.partitionBy()).alias("rows_total"),
    )
    assert rows(ours, *plain.columns) == rows(plain)


def test_running_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "v bigint")
    assert ranked.running_totals(empty, [F.col("v")], ["v"]).count() == 0


@pytest.mark.parametrize("values", [[5], [1, 2], [3, 1, 2], [7] * 100 + [1, 9], list(range(1001)), [-4, 0, 4, 5]])
def test_median_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x bigint").repartition(3)
    found = ranked.median(df, "x").first()
    assert (found.median, found.n) == (float(np.median(values)), len(values))


def test_places_are_found_by_narrowing_ranges(spark):
    rng = random.Random(4)
    values = [rng.randint(-(10**12), 10**12) for _ in range(300)] + [7] * 50
    df = spark.createDataFrame([(v,) for v in values], "x bigint").repartition(3)
    ranks = [1, 2, 100, 175, 176, 349, 350]
    found = ranked.values_at(df, "x", ranks, min(values), max(values), ranges=10)
    assert found == {r: sorted(values)[r - 1] for r in ranks}


def test_the_median_of_nothing_and_of_wide_decimals(spark):
    empty = ranked.median(spark.createDataFrame([(None,)], "x bigint"), "x").first()
    assert (empty.median, empty.n) == (None, 0)
    wide = spark.createDataFrame([(Decimal(10**30),), (Decimal(-(10**30)),), (Decimal(3),)], "x decimal(38,0)")
    assert ranked.median(wide, "x").first().median == 3.0


@pytest.mark.parametrize("values", [[0, 100], list(range(0, 401, 7)), [5, 5, 5], [0, 10, 20, 390, 400, 400], [-50, 0, 3]])
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x bigint")
    found = ranked.histogram(df, "x", bins=40, half_unit=50).orderBy("bin").collect()
    low, high = (min(values), max(values)) if min(values) < max(values) else (values[0] - 50, values[0] + 50)
    expected = [0] * 40
    for v in values:
        expected[min((v - low) * 40 // (high - low), 39)] += 1
    assert [r.n for r in found] == expected
    edges = np.linspace(low, high, 41)
    assert np.allclose([r.lower for r in found], edges[:-1]) and np.allclose([r.upper for r in found], edges[1:])


def test_null_keys_are_spread_in_the_lookup(spark, skewed):
    dimension = spark.createDataFrame([("hot", "H"), (None, "never"), ("k1", "one")], "k string, name string")
    ours = keyed.lookup(skewed, dimension, "key", "k", "id")
    plain = skewed.join(dimension, skewed.key == dimension.k, "left")
    assert rows(ours, "id", "name") == rows(plain, "id", "name")
    assert ours.columns == [*skewed.columns, "name"]
    by_key = ours.where("key IS NULL").count()
    assert by_key == skewed.where("key IS NULL").count()


def test_a_hot_user_is_split_by_the_skew_join(spark):
    """Event flags: the fact side of the user join is split when one user dominates."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        events = spark.range(200_000, numPartitions=8).select(
            F.col("id").cast("string").alias("event_id"),
            F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 500).cast("string")).alias("user_id"),
        )
        users = spark.range(500).select(
            F.col("id").cast("string").alias("user_id"), F.concat(F.lit("L"), F.col("id")).alias("location_id")
        )
        places = spark.range(500).select(
            F.concat(F.lit("L"), F.col("id")).alias("location_id"),
            F.lit("CA").alias("country_code"),
            F.when(F.col("id") == 7, "QC").otherwise("ON").alias("state"),
            F.lit("K1A").alias("zip_code"),
        )
        out = flag_quebec_events(events, users, places)
        found = out.collect()
        assert len(found) == 200_000
        assert sum(r.is_quebec_event for r in found) == events.where("user_id = '7'").count()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"skew=true|AQEShuffleRead.*skewed", plan), plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
