from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopgrain.plans import behaviour, consumers, reports
from shopgrain.sources.raw import RawTables


@pytest.fixture
def shop(spark, frame, rates):
    """Orders as (id, user, date, status, method, item totals)."""

    def build(*orders, events=(), users=(), places=()):
        return RawTables(
            spark,
            users=frame("users", *[dict(user_id=u, location_id=l) for u, l in users]),
            locations=frame("locations", *[dict(location_id=l, country_code=c, state=s) for l, c, s in places]),
            products=frame("products", dict(id="p", category="Kitchen"), dict(id="q", category="Bedroom")),
            orders=frame(
                "orders",
                *[dict(order_id=i, user_id=u, order_date=d, order_status=s, payment_method=m) for i, u, d, s, m, _ in orders],
            ),
            order_items=frame(
                "order_items",
                *[
                    dict(order_item_id=f"{o[0]}-{n}", order_id=o[0], product_id="p", quantity=1, unit_price=t, discount=0.1, line_total=t)
                    for o in orders
                    for n, t in enumerate(o[5])
                ],
            ),
            user_events=frame(
                "user_events",
                *[dict(event_id=str(n), user_id=u, event_timestamp=t, page_url=p) for n, (u, t, p) in enumerate(events)],
            ),
            exchange_rates=rates,
        )

    return build


def month(m):
    return datetime(2024, m, 15)


def test_monthly_trend_rolls_over_rows_and_drops_the_last_month(shop):
    raw = shop(
        ("1", "u", month(1), "x", "m", [10.0]),
        ("2", "u", month(2), "x", "m", [20.0, 10.0]),
        ("3", "u", month(5), "x", "m", [30.0]),  # a gap: the window counts rows, not months
        ("4", "u", month(6), "x", "m", [1000.0]),
        ("5", "u", month(7), "x", "m", []),  # no items, so no month of its own
    )
    out = [tuple(r) for r in reports.monthly_revenue(raw).collect()]
    assert out == [
        (date(2024, 1, 1), 1, 10.0, 10.0),
        (date(2024, 2, 1), 1, 30.0, 20.0),
        (date(2024, 5, 1), 1, 30.0, 70.0 / 3),
    ]
    assert rows(reports.peak_month(raw)) == [(date(2024, 2, 1), 30.0)]  # the earlier of two equal months
    assert rows(reports.revenue_summary(raw)) == [(70.0, 3, date(2024, 2, 1), 30.0)]


def test_orders_without_a_date_do_not_disturb_the_trend(shop):
    raw = shop(
        ("0", "u", None, "x", "m", [500.0]), ("1", "u", month(1), "x", "m", [10.0]), ("2", "u", month(2), "x", "m", [20.0]),
        ("3", "u", month(3), "x", "m", [1.0]),
    )
    assert [(r.month.month, r.rolling) for r in reports.monthly_revenue(raw).collect()] == [(1, 10.0), (2, 15.0)]


def test_status_impact(shop):
    raw = shop(
        ("1", "u", month(1), "delivered", "m", [50.0]),
        ("2", "u", month(1), "cancelled", "m", [25.0]),
        ("3", "u", month(1), "pending_refund", "m", [15.0]),
        ("4", "u", month(1), "pending", "m", [10.0]),
    )
    assert [r.order_status for r in reports.status_impact(raw).collect()] == ["delivered", "cancelled", "pending_refund", "pending"]
    assert rows(reports.status_callout(raw)) == [(100.0, 25.0, 25.0, 50.0, 50.0, 25.0)]
    assert rows(consumers.confirmed_and_gross(raw)) == [(100.0, 50.0, 15.0)]


def test_pareto_with_ties(shop):
    raw = shop(*[(str(i), u, month(1), "x", "m", [v]) for i, (u, v) in enumerate([("c", 40.0), ("b", 40.0), ("a", 20.0), ("a", 0.0)])])
    out = reports.customer_ltv(raw).orderBy("cust_pct").collect()
    assert [(r.user_id, r.order_count, r.ltv, r.cumrev, r.cumrev_pct) for r in out] == [
        ("b", 1, 40.0, 40.0, 40.0), ("c", 1, 40.0, 80.0, 80.0), ("a", 2, 20.0, 100.0, 100.0),
    ]
    assert reports.pareto_cut(raw).first()[0] == pytest.approx(200 / 3)
    assert rows(reports.frequency_segments(raw)) == [
        ("1 order", 2, 80.0, 80.0), ("2 orders", 1, 20.0, 20.0), ("3+ orders", 0, 0.0, 0.0),
    ]


def test_repeated_order_rows_count_once_but_sum_per_row(shop):
    """An order listed twice joins its items twice, and is one distinct order."""
    raw = shop(("1", "u", month(1), "x", "m", [10.0]), ("1", "u", month(1), "x", "m", []))
    assert rows(reports.status_impact(raw), "orders", "revenue") == [(1, 20.0)]


def test_categories(shop, frame):
    raw = shop(("1", "u", month(1), "x", "m", [10.0, 0.01]))
    assert rows(reports.category_performance(raw)) == [("Kitchen", 2, 10.01, 5.01, 10.0)]
    partial = raw.replace(order_items=frame("order_items", dict(product_id="q", line_total=3.0), dict(product_id="gone", line_total=9.0)))
    assert rows(reports.category_performance(partial)) == [("Bedroom", 0, 3.0, None, None)]


def test_states(shop):
    raw = shop(
        ("1", "a", month(1), "x", "m", [10.0]), ("2", "b", month(1), "x", "m", [10.0]), ("3", "ghost", month(1), "x", "m", [99.0]),
        users=[("a", "A"), ("b", "B")], places=[("A", "US", "NY"), ("B", "US", "AK")],
    )
    assert [tuple(r) for r in reports.top_states(raw).collect()] == [("AK", True, 1, 10.0), ("NY", False, 1, 10.0)]
    assert reports.top_states(raw, limit=1).count() == 1
    assert [r.order_id for r in consumers.specialist_fulfilment(raw).collect()] == ["2"]


def test_payment_drops_unknown_methods(shop):
    raw = shop(
        ("1", "u", month(1), "x", "paypal", [10.0]), ("2", "u", month(1), "x", "paypal", [20.0]),
        ("3", "u", month(1), "x", None, [99.0]), ("4", "u", month(1), "x", "card", [10.0]),
    )
    assert rows(reports.payment_breakdown(raw)) == [("card", 1, 10.0, 10.0, 25.0), ("paypal", 2, 30.0, 15.0, 75.0)]
    assert reports.order_value_list(raw).count() == 4
    assert rows(reports.order_value_statistics(raw)) == [(4, 15.0, 34.75)]
    assert rows(reports.order_value_median(raw)) == [(15.0, 4)]


def test_orders_of_unknown_value_count_but_do_not_lower_means(shop):
    raw = shop(("1", "u", month(1), "delivered", "card", [100.0]), ("2", "v", month(1), "delivered", "card", [None]))
    method = reports.payment_breakdown(raw).first()
    assert (method.orders, method.revenue, method.avg_order) == (2, 100.0, 100.0)
    figures = {r.metric: r.value for r in reports.key_figures(raw).collect()}
    assert figures["avg_order_value"] == reports.order_value_mean(raw).first()[0] == 100.0
    assert figures["avg_customer_ltv"] == 100.0 and figures["purchasers"] == 2


def test_histogram_closes_the_last_bin(shop):
    raw = shop(*[(str(i), "u", month(1), "x", "m", [v]) for i, v in enumerate([0.0, 40.0, 39.99, 1.0])])
    out = {r.bin: r.orders for r in reports.order_value_histogram(raw).collect()}
    assert len(out) == 40 and out[39] == 2 and out[0] == 1 and out[1] == 1 and sum(out.values()) == 4


def test_key_figures(shop):
    raw = shop(
        ("1", "a", month(1), "delivered", "m", [10.0]), ("2", "a", month(1), "cancelled", "m", [20.0]),
        ("3", "b", month(1), "pending", "m", [30.0]), ("4", "c", month(1), "pending", "m", []),
        users=[("a", "A"), ("b", "B"), ("c", "C"), ("d", "D")],
    )
    assert {r.metric: r.value for r in reports.key_figures(raw).collect()} == {
        "users": 4.0, "orders": 4.0, "cancellation_rate_pct": 25.0, "purchasers": 2.0, "repeat_purchasers": 1.0,
        "avg_customer_ltv": 30.0, "avg_order_value": 20.0, "gross_gmv": 60.0, "confirmed_revenue": 10.0,
    }


def test_reports_of_an_empty_shop(shop):
    raw = shop()
    for report in (reports.monthly_revenue, reports.status_impact, reports.customer_ltv, reports.payment_breakdown, reports.top_states):
        assert report(raw).count() == 0
    assert reports.status_callout(raw).count() == 1 and reports.frequency_segments(raw).count() == 3
    assert reports.order_value_histogram(raw).agg(F.sum("orders")).first()[0] == 0


def test_currency_sides(shop):
    raw = shop(("1", "a", month(1), "x", "m", [100.0]), ("2", "ghost", month(1), "x", "m", [1.0]), users=[("a", "A")], places=[("A", "CA", "QC")])
    assert rows(consumers.order_revenue_in_usd(raw), "order_id", "revenue_usd") == [("1", 74.0), ("2", None)]
    assert rows(consumers.order_revenue_in_usd(raw, "usd"), "order_id", "revenue_local") == [("1", 135.14), ("2", None)]
    with pytest.raises(ValueError):
        consumers.order_revenue_in_usd(raw, "eur")


def test_quebec_consumers(shop):
    raw = shop(
        ("1", "q", month(1), "cancelled", "m", [10.0]), ("2", "n", month(1), "x", "m", [5.0]),
        users=[("q", "Q"), ("n", "N")], places=[("Q", "CA", "QC"), ("N", "US", "NY")],
        events=[("q", month(1), "/catalog"), ("n", month(1), "/catalog")],
    )
    assert rows(consumers.subject_access_extract(raw), "record_type", "record_id") == [("event", "0"), ("order", "1")]
    assert rows(consumers.quebec_exposure(raw)) == [(False, 1, 5.0, 0, 0.0), (True, 1, 10.0, 1, 10.0)]
    assert rows(consumers.reengagement_audience(raw), "user_id", "marketing_language_requirement") == [("n", "EN"), ("q", "EN,FR")]


def test_price_audit(shop, frame):
    raw = shop(("1", "u", month(1), "x", "m", [10.0, 12.5])).replace(products=frame("products", dict(id="p", price=10.0)))
    assert rows(consumers.price_paid_audit(raw), "order_item_id", "difference") == [("1-1", 2.5)]


def test_transitions_and_funnel(shop):
    def t(minute):
        return datetime(2024, 1, 1, 10, minute)

    raw = shop(
        ("1", "a", month(1), "x", "m", [1.0]),
        events=[
            ("a", t(0), "/signup"), ("a", t(1), "/catalog"), ("a", t(2), "/product"), ("a", t(3), "/product/add_to_cart"),
            ("a", t(4), "/checkout"), ("b", t(0), "/catalog"), ("b", t(1), "/catalog"), ("b", t(2), "/product"),
        ],
    )
    found = {(r.from_step, r.to_step): (r.transitions, r.probability) for r in behaviour.transition_matrix(raw).collect()}
    assert found["/catalog", "/product"] == (2, 2 / 3) and found["/catalog", "/catalog"] == (1, 1 / 3)
    assert found["/product", "EXIT"] == (1, 0.5) and found["/checkout", "EXIT"] == (1, 1.0)
    assert rows(behaviour.funnel(raw)) == [
        (1, "catalog", 2, 100.0), (2, "product", 2, 100.0), (3, "cart", 1, 50.0), (4, "checkout", 1, 100.0), (5, "order", 1, 100.0),
    ]
