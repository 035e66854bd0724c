"""Event step statistics: transition matrix and purchase funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.functions import money
from shopgrain.operators.keyed import next_in_group
from shopgrain.sources.raw import RawTables

EXIT = "EXIT"
NO_STEP = "NONE"

# The pages of the purchase path, in order.
FUNNEL = (
    ("catalog", "/catalog"),
    ("product", "/product"),
    ("cart", "/product/add_to_cart"),
    ("checkout", "/checkout"),
)
ORDER_STEP = "order"


def steps_with_next(raw: RawTables, slices: int | None = None) -> DataFrame:
    """Each event's page and the page of the same user's next event (EXIT after the last).

    No session gap is applied: a user's sessions can overlap in time.
    """
    steps = raw.user_events.select(
        "user_id", "event_timestamp", "event_id", F.coalesce("page_url", F.lit(NO_STEP)).alias("from_step")
    )
    order = [F.asc_nulls_last("event_timestamp"), F.asc_nulls_last("event_id")]
    linked = next_in_group(steps, "user_id", order, "from_step", "to_step", slices)
    return linked.withColumn("to_step", F.coalesce("to_step", F.lit(EXIT)))


def transition_matrix(raw: RawTables, slices: int | None = None) -> DataFrame:
    """from_step, to_step, transitions and their share of all moves out of from_step."""
    counts = steps_with_next(raw, slices).groupBy("from_step", "to_step").agg(F.count("*").alias("transitions"))
    # A row per pair of pages: small, whatever the number of events.
    out = F.sum("transitions").over(Window.partitionBy("from_step"))
    return counts.withColumn("probability", F.col("transitions").cast("double") / out.cast("double"))


def funnel(raw: RawTables) -> DataFrame:
    """Distinct users per step of the purchase path and the rate against the step before.

    There is no order event; that step counts users with an order.
    """
    pages = [page for _, page in FUNNEL]
    events = raw.user_events.where(F.col("page_url").isin(*pages)).select(
        "user_id", F.array_position(F.array(*map(F.lit, pages)), F.col("page_url")).cast("int").alias("step_no")
    )
    buyers = raw.orders.select("user_id", F.lit(len(pages) + 1).alias("step_no"))
    seen = events.unionAll(buyers).where(F.col("user_id").isNotNull()).distinct()
    names = [name for name, _ in FUNNEL] + [ORDER_STEP]
    wide = seen.agg(*[F.count_if(F.col("step_no") == i).alias(f"u{i}") for i in range(1, len(names) + 1)])
    rows = []
    for i, name in enumerate(names, start=1):
        before = F.col(f"u{i - 1}") if i > 1 else F.col(f"u{i}")
        rows.append(
            F.struct(
                F.lit(i).alias("step_no"),
                F.lit(name).alias("step"),
                F.col(f"u{i}").alias("users"),
                money.share(F.col(f"u{i}"), before).alias("step_rate_pct"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))
