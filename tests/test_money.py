from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopgrain.functions import money
from shopgrain.functions.numeric import half_even_int

SETTINGS = dict(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(-(10**12), 10**12), st.integers(1, 10**6)), min_size=1, max_size=200))
def test_divide_half_up_agrees_with_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    out = df.select("a", "b", money.divide_half_up(F.col("a"), F.col("b")).alias("q")).collect()
    for r in out:
        assert r.q == int((Decimal(r.a) / Decimal(r.b)).quantize(Decimal(1), ROUND_HALF_UP))


@settings(**SETTINGS)
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=200))
def test_sums_are_exact_and_order_free(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(7)
    units = df.agg(money.total_units(F.col("x")).alias("u"))
    assert units.select(money.rounded(F.col("u"))).first()[0] == sum(cents) / 100


def test_rounding_goes_up_at_the_half_cent(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,)], "x double")
    out = df.select(money.rounded(money.to_units(F.col("x")).cast("decimal(18,0)")).alias("r"))
    assert sorted(r.r for r in out.collect()) == [-1.01, 1.01, 2.68]


def test_share_of_nothing_is_null(spark):
    df = spark.createDataFrame([(0, 0), (1, 4)], "a bigint, b bigint")
    assert rows(df.select(money.share(F.col("a"), F.col("b")))) == [(25.0,), (None,)]


def test_integer_cast_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1.7,), (2.5,), (3.5,), (None,)], "quantity double")
    assert rows(df.select(half_even_int(df, "quantity"))) == [(2,), (2,), (4,), (None,)]
    text = spark.createDataFrame([("1.5",)], "quantity string")
    assert rows(text.select(half_even_int(text, "quantity"))) == [(2,)]


def test_totals_beyond_64_bits(spark):
    df = spark.range(30).select(F.lit(9.0e13).alias("x"))
    total = df.groupBy().agg(money.total_units(F.col("x")).alias("u"))
    assert total.first().u == Decimal(9 * 10**17) * 30
    assert total.select(money.rounded(F.col("u"))).first()[0] == pytest.approx(2.7e15)
