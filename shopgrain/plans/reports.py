"""Revenue, customer, category, region and payment reports.

All reports that mix orders and items start from one row per order: items are
summed per order before the join, so a large order never meets its item rows
again and the join moves one row per order instead of one per item.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.functions import money, region
from shopgrain.operators import ranked
from shopgrain.session import written
from shopgrain.sources.raw import RawTables

TARGET_SHARE = 80.0  # percent of revenue the Pareto cut looks for
HISTOGRAM_BINS = 40
TOP_STATES = 15


def order_values(raw: RawTables) -> DataFrame:
    """Orders that have items, with their value in money units."""
    per_order = raw.order_items.groupBy("order_id").agg(
        money.total_units(F.col("line_total")).alias("units")
    )
    return raw.orders.join(per_order, "order_id")


def _orders_and_units() -> list[Column]:
    return [F.count_distinct("order_id").alias("orders"), F.sum("units").alias("units")]


def _whole(columns: Column) -> Column:
    return F.sum(columns).over(Window.partitionBy())


# -- monthly revenue -------------------------------------------------------


def monthly_totals(raw: RawTables) -> DataFrame:
    """Per month of the order date: distinct orders and revenue in cents."""
    return (
        order_values(raw)
        .groupBy(F.trunc("order_date", "MM").alias("month"))
        .agg(*_orders_and_units())
        .select("month", "orders", money.units_to_cents(F.col("units")).alias("cents"))
    )


def monthly_rolling(raw: RawTables) -> DataFrame:
    """Monthly totals with the mean of the month and the two rows before it.

    The window spans all months, which are few, not all orders.
    """
    trailing = Window.orderBy(F.asc_nulls_last("month")).rowsBetween(-2, Window.currentRow)
    mean = money.from_cents(F.sum("cents").over(trailing)) / F.count("cents").over(trailing)
    return monthly_totals(raw).withColumn("rolling", mean)


def monthly_revenue(raw: RawTables) -> DataFrame:
    """Revenue trend: the rolling mean is taken first, then the last, partial month goes."""
    return (
        drop_last_period(monthly_rolling(raw), "month")
        .select("month", "orders", money.from_cents(F.col("cents")).alias("revenue"), "rolling")
        .orderBy("month")
    )


def drop_last_period(df: DataFrame, period: str) -> DataFrame:
    """Rows before the newest period. ``df`` has one row per period."""
    newest = F.max(period).over(Window.partitionBy())
    return df.withColumn("__newest", newest).where(F.col(period) < F.col("__newest")).drop("__newest")


def peak_month(raw: RawTables) -> DataFrame:
    """The month with most revenue; the earliest one on ties."""
    return monthly_revenue(raw).orderBy(F.desc("revenue"), "month").limit(1).select("month", "revenue")


def revenue_summary(raw: RawTables) -> DataFrame:
    """One row: revenue, number and peak of the months kept by the trend."""
    kept = drop_last_period(monthly_totals(raw), "month")
    best = F.max(F.struct("cents", (-F.unix_date("month")).alias("earlier"), "month"))
    return kept.agg(F.sum("cents").alias("cents"), F.count("*").alias("months"), best.alias("peak")).select(
        money.from_cents(F.col("cents")).alias("total_revenue"),
        "months",
        F.col("peak.month").alias("peak_month"),
        money.from_cents(F.col("peak.cents")).alias("peak_revenue"),
    )


# -- order status ------------------------------------------------------------


def status_totals(raw: RawTables) -> DataFrame:
    return (
        order_values(raw)
        .groupBy("order_status")
        .agg(*_orders_and_units())
        .select("order_status", "orders", money.units_to_cents(F.col("units")).alias("cents"))
    )


def status_impact(raw: RawTables) -> DataFrame:
    """Revenue per order status and its share of the gross."""
    return (
        status_totals(raw)
        .select(
            "order_status",
            "orders",
            money.from_cents(F.col("cents")).alias("revenue"),
            money.share(F.col("cents"), _whole(F.col("cents"))).alias("pct"),
        )
        .orderBy(F.desc("revenue"), "order_status")
    )


def status_callout(raw: RawTables) -> DataFrame:
    """One row: gross, cancelled, confirmed (delivered only) and the rest at risk."""
    cents, status = F.col("cents"), F.col("order_status")

    def of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(status == name, cents)), F.lit(0))

    totals = status_totals(raw).agg(
        F.coalesce(F.sum("cents"), F.lit(0)).alias("gross"),
        of("cancelled").alias("cancelled"),
        of("delivered").alias("confirmed"),
    )
    gross, cancelled, confirmed = F.col("gross"), F.col("cancelled"), F.col("confirmed")
    return totals.select(
        money.from_cents(gross).alias("gross"),
        money.from_cents(cancelled).alias("cancelled"),
        money.share(cancelled, gross).alias("cancelled_pct"),
        money.from_cents(confirmed).alias("confirmed"),
        money.share(confirmed, gross).alias("confirmed_pct"),
        money.from_cents(gross - cancelled - confirmed).alias("at_risk"),
    )


# -- customers ------------------------------------------------------------------


def customer_values(raw: RawTables) -> DataFrame:
    """Per buyer: distinct orders and lifetime value in cents."""
    return (
        order_values(raw)
        .groupBy("user_id")
        .agg(F.count_distinct("order_id").alias("order_count"), F.sum("units").alias("units"))
        .select("user_id", "order_count", money.units_to_cents(F.col("units")).alias("cents"))
    )


def customer_ranking(raw: RawTables) -> DataFrame:
    """Buyers by falling value (user_id on ties), with running and whole totals."""
    order = [F.desc_nulls_last("cents"), F.asc_nulls_last("user_id")]
    return ranked.running_totals(customer_values(raw), order, ["cents"])


def customer_ltv(raw: RawTables) -> DataFrame:
    """Pareto rows. ``cust_pct`` gives each row's place in the order."""
    return customer_ranking(raw).select(
        "user_id",
        "order_count",
        money.from_cents(F.col("cents")).alias("ltv"),
        money.from_cents(F.col("cents_running")).alias("cumrev"),
        money.share(F.col("cents_running"), F.col("cents_total")).alias("cumrev_pct"),
        money.share(F.col("position"), F.col("rows_total")).alias("cust_pct"),
    )


def pareto_cut(raw: RawTables, target: float = TARGET_SHARE) -> DataFrame:
    """One row: the smallest share of customers that reaches ``target`` % of revenue."""
    return customer_ltv(raw).where(F.col("cumrev_pct") >= target).agg(F.min("cust_pct").alias("cust_pct"))


def frequency_segments(raw: RawTables) -> DataFrame:
    """Customers and revenue by number of orders: 1, 2, 3 or more. Always three rows."""
    count, cents = F.col("order_count"), F.col("cents")
    segments = {"1 order": count == 1, "2 orders": count == 2, "3+ orders": count >= 3}
    sums = []
    for i, belongs in enumerate(segments.values()):
        sums += [
            F.count_if(belongs).alias(f"n{i}"),
            F.coalesce(F.sum(F.when(belongs, cents)), F.lit(0)).alias(f"c{i}"),
        ]
    wide = customer_values(raw).agg(*sums)
    total = reduce(Column.__add__, [F.col(f"c{i}") for i in range(len(segments))])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("segment"),
                F.col(f"n{i}").alias("customers"),
                money.from_cents(F.col(f"c{i}")).alias("revenue"),
                money.share(F.col(f"c{i}"), total).alias("pct"),
            )
            for i, name in enumerate(segments)
        ]
    )
    return wide.select(F.inline(rows))


# -- categories and states ---------------------------------------------------------


def category_performance(raw: RawTables) -> DataFrame:
    """Items, revenue, mean price and mean discount per category.

    Items are summed per product before the join, so the join moves one row per
    product and a best-seller is one row per task.
    """
    per_product = raw.order_items.groupBy("product_id").agg(
        F.count("order_item_id").alias("items"),
        money.total_units(F.col("line_total")).alias("units"),
        money.total_units(F.col("unit_price")).alias("price_units"),
        F.count("unit_price").alias("prices"),
        money.total_units(F.col("discount")).alias("discount_units"),
        F.count("discount").alias("discounts"),
    )
    products = raw.products.select(F.col("id").alias("product_id"), "category")
    totals = (
        per_product.join(products, "product_id")
        .groupBy("category")
        .agg(*[F.sum(c).alias(c) for c in per_product.columns if c != "product_id"])
    )
    mean_price_cents = money.divide_half_up(F.col("price_units"), F.col("prices") * money.UNITS_PER_CENT)
    # discount x 100 in tenths of a percent, from units of 1/10000
    mean_discount_tenths = money.divide_half_up(F.col("discount_units"), F.col("discounts") * 10)
    return totals.select(
        "category",
        F.col("items").alias("items_sold"),
        money.rounded(F.col("units")).alias("revenue"),
        F.when(F.col("prices") > 0, money.from_cents(mean_price_cents)).alias("avg_unit_price"),
        F.when(F.col("discounts") > 0, mean_discount_tenths.cast("double") / 10.0).alias("avg_discount_pct"),
    ).orderBy(F.desc("revenue"), "category")


def orders_with_state(raw: RawTables) -> DataFrame:
    """Order values with the buyer's state; orders of unknown users or places drop out."""
    buyers = raw.users.select("user_id", "location_id")
    places = raw.locations.select("location_id", "state")
    return order_values(raw).select("order_id", "user_id", "units").join(
        buyers.join(places, "location_id").select("user_id", "state"), "user_id"
    )


def top_states(raw: RawTables, limit: int = TOP_STATES) -> DataFrame:
    """States by revenue, the excluded ones (by state alone) marked."""
    return (
        orders_with_state(raw)
        .groupBy("state")
        .agg(*_orders_and_units())
        .select(
            "state",
            region.excluded_state(F.col("state")).alias("excluded"),
            "orders",
            money.rounded(F.col("units")).alias("revenue"),
        )
        .orderBy(F.desc("revenue"), F.asc_nulls_last("state"))
        .limit(limit)
    )


# -- order values and payment ---------------------------------------------------------


def order_value_cents(raw: RawTables) -> DataFrame:
    return (
        order_values(raw)
        .groupBy("order_id", "payment_method")
        .agg(money.units_to_cents(F.sum("units")).alias("cents"))
    )


def order_value_list(raw: RawTables) -> DataFrame:
    return order_value_cents(raw).select(
        "order_id", "payment_method", money.from_cents(F.col("cents")).alias("order_value")
    )


def order_value_median(raw: RawTables) -> DataFrame:
    found = ranked.median(order_value_cents(raw), "cents")
    return found.select((F.col("median") / 100.0).alias("median_order_value"), F.col("n").alias("orders"))


def order_value_mean(raw: RawTables) -> DataFrame:
    return order_value_cents(raw).agg(
        F.try_divide(money.from_cents(F.sum("cents")), F.count("cents").cast("double")).alias("mean_order_value")
    )


def order_value_statistics(raw: RawTables) -> DataFrame:
    """One row: number, mean and exact median of order values, from one column that is written once."""
    cents = written(order_value_cents(raw).where(F.col("cents").isNotNull()).select("cents"), "order-values")
    found = cents.agg(
        F.count("*").alias("orders"), F.sum("cents").alias("total"), F.min("cents").alias("low"), F.max("cents").alias("high")
    ).first()
    n = found["orders"]
    middle = ranked.middle_of(cents, "cents", n, int(found["low"]), int(found["high"])) if n else None
    orders = F.lit(n).cast("bigint")
    return raw.spark.range(1).select(
        orders.alias("orders"),
        (F.lit(middle).cast("double") / 100.0).alias("median_order_value"),
        F.try_divide(money.from_cents(F.lit(found["total"]).cast("decimal(38,0)")), orders.cast("double")).alias("mean_order_value"),
    )


def order_value_histogram(raw: RawTables, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins of the order value, empty bins included."""
    return ranked.histogram(order_value_cents(raw), "cents", bins).select(
        "bin", (F.col("lower") / 100.0).alias("lower"), (F.col("upper") / 100.0).alias("upper"), F.col("n").alias("orders")
    )


def payment_breakdown(raw: RawTables) -> DataFrame:
    """Orders, revenue, mean order and share per payment method; an unknown method drops out."""
    per_method = (
        order_value_cents(raw)
        .where(F.col("payment_method").isNotNull())
        .groupBy("payment_method")
        .agg(F.count("order_id").alias("orders"), F.count("cents").alias("valued"), F.sum("cents").alias("cents"))
    )
    revenue = money.from_cents(F.col("cents"))
    return per_method.select(
        "payment_method",
        "orders",
        revenue.alias("revenue"),
        F.try_divide(revenue, F.col("valued").cast("double")).alias("avg_order"),
        money.share(F.col("cents"), _whole(F.col("cents"))).alias("share"),
    ).orderBy("payment_method")


# -- key figures --------------------------------------------------------------------


def _tall(df: DataFrame, figures: dict[str, Column]) -> DataFrame:
    rows = [F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in figures.items()]
    return df.select(F.inline(F.array(*rows)))


def key_figures(raw: RawTables) -> DataFrame:
    """The metric map as (metric, value) rows, every figure computed."""
    users = _tall(raw.users.agg(F.count("*").alias("n")), {"users": F.col("n")})
    placed = raw.orders.agg(
        F.count("*").alias("n"), F.count_if(F.col("order_status") == "cancelled").alias("cancelled")
    )
    placed = _tall(
        placed,
        {"orders": F.col("n"), "cancellation_rate_pct": money.share(F.col("cancelled"), F.col("n"))},
    )
    buyers = customer_values(raw).where(F.col("user_id").isNotNull()).agg(
        F.count("*").alias("n"),
        F.count("cents").alias("valued"),
        F.count_if(F.col("order_count") >= 2).alias("repeat"),
        F.sum("cents").alias("cents"),
    )
    buyers = _tall(
        buyers,
        {
            "purchasers": F.col("n"),
            "repeat_purchasers": F.col("repeat"),
            "avg_customer_ltv": F.try_divide(money.from_cents(F.col("cents")), F.col("valued").cast("double")),
        },
    )
    values = order_values(raw).groupBy("order_id", "order_status").agg(
        money.units_to_cents(F.sum("units")).alias("cents")
    )
    values = values.agg(
        F.count("cents").alias("n"),
        F.sum("cents").alias("cents"),
        F.coalesce(F.sum(F.when(F.col("order_status") == "delivered", F.col("cents"))), F.lit(0)).alias("delivered"),
    )
    values = _tall(
        values,
        {
            "avg_order_value": F.try_divide(money.from_cents(F.col("cents")), F.col("n").cast("double")),
            "gross_gmv": money.from_cents(F.col("cents")),
            "confirmed_revenue": money.from_cents(F.col("delivered")),
        },
    )
    return reduce(DataFrame.unionAll, [users, placed, buyers, values])
