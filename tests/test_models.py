from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from shopgrain.plans import mart, staging
from shopgrain.sources.raw import RawTables


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def raw(spark, frame, rates, **tables):
    empty = {name: frame(name) for name in RawTables.NAMES if name != "exchange_rates"}
    return RawTables(spark, **{**empty, "exchange_rates": rates, **tables})


def test_first_registration_of_an_email_is_not_a_duplicate(frame):
    users = frame(
        "users",
        dict(user_id="a", email="x", created_at=at(3)),
        dict(user_id="b", email="x", created_at=at(1)),
        dict(user_id="c", email="x", created_at=None),
        dict(user_id="d", email="y", created_at=None),
        dict(user_id="e", email=None, created_at=at(2)),
        dict(user_id="f", email=None, created_at=at(1)),
        dict(user_id="g", email="z", created_at=at(1)),
        dict(user_id="h", email="z", created_at=at(1)),
    )
    out = staging.stg_users(users)
    assert out.columns == ["user_id", "first_name", "last_name", "email", "created_at", "location_id", "is_duplicate_email"]
    flagged = {r.user_id for r in out.collect() if r.is_duplicate_email}
    assert flagged == {"a", "c", "e", "h"}  # NULL times sort last, NULL emails are one group


def test_orders_without_items_keep_null_totals_and_sums_do_not_fan_out(frame):
    orders = frame("orders", dict(order_id="1"), dict(order_id="2"))
    items = frame(
        "order_items",
        dict(order_item_id="a", order_id="1", quantity=2, line_total=10.1),
        dict(order_item_id="b", order_id="1", quantity=3, line_total=0.2),
        dict(order_item_id="c", order_id="9", quantity=1, line_total=5.0),
    )
    out = mart.fct_orders(staging.stg_orders(orders), staging.stg_order_items(items))
    assert rows(out, "order_id", "total_amount", "total_items", "num_line_items") == [
        ("1", 10.3, 5, 2), ("2", None, None, None),
    ]
    assert dict(out.dtypes)["total_items"] == "bigint"


def test_totals_keep_tiny_and_large_amounts(frame):
    orders = frame("orders", dict(order_id="tiny"), dict(order_id="large"))
    items = frame("order_items", *[dict(order_id="tiny", line_total=0.00004)] * 1000, dict(order_id="large", line_total=2e15))
    out = mart.fct_orders(staging.stg_orders(orders), staging.stg_order_items(items))
    assert rows(out, "order_id", "total_amount") == [("large", 2e15), ("tiny", 0.04)]


def test_events_follow_the_staged_rows_of_a_repeated_user(spark, frame, rates):
    raw = RawTables(
        spark,
        **{name: frame(name) for name in ("products", "orders", "order_items", "locations")},
        users=frame("users", dict(user_id="u"), dict(user_id="u")),
        user_events=frame("user_events", dict(event_id="1", user_id="u")),
        exchange_rates=rates,
    )
    staged = staging.build_staging(raw)
    assert staged["stg_user_events"].count() == mart.build_mart(raw, staged)["fct_user_events"].count() == 2


def test_events_of_unknown_users_are_not_quebec(spark, frame, rates):
    tables = raw(
        spark, frame, rates,
        users=frame("users", dict(user_id="q", location_id="Q"), dict(user_id="n", location_id=None)),
        locations=frame("locations", dict(location_id="Q", country_code="CA", state="QC")),
        user_events=frame(
            "user_events",
            *[dict(event_id=str(i), user_id=u, event_timestamp=at(1)) for i, u in enumerate(["q", "n", "ghost", None])],
        ),
    )
    out = staging.stg_user_events(tables)
    assert rows(out, "user_id", "is_quebec_event") == [("ghost", False), ("n", False), ("q", True), (None, False)]
    assert len(out.columns) == 8


def test_dim_users_takes_the_location_id_of_the_location(frame, rates):
    users = frame("users", dict(user_id="a", location_id="L"), dict(user_id="b", location_id="gone"))
    places = frame("locations", dict(location_id="L", city="Here"))
    out = mart.dim_users(staging.stg_users(users), staging.stg_locations(places, rates))
    assert rows(out, "user_id", "location_id", "city") == [("a", "L", "Here"), ("b", None, None)]
    assert len(out.columns) == 12


def test_item_facts_keep_items_without_parents(frame):
    out = mart.fct_order_items(
        staging.stg_order_items(
            frame(
                "order_items",
                dict(order_item_id="a", order_id="1", product_id="p"),
                dict(order_item_id="b", order_id="9", product_id="x"),
                dict(order_item_id="c"),
            )
        ),
        staging.stg_orders(frame("orders", dict(order_id="1", user_id="u"))),
        staging.stg_products(frame("products", dict(id="p", name="Lamp", category="Kitchen"))),
    )
    assert rows(out, "order_item_id", "user_id", "product_name") == [("a", "u", "Lamp"), ("b", None, None), ("c", None, None)]
    assert len(out.columns) == 13


def test_event_facts_keep_events_without_product(spark, frame, rates):
    tables = raw(
        spark, frame, rates,
        user_events=frame("user_events", dict(event_id="1", product_id="p"), dict(event_id="2"), dict(event_id="3", product_id="x")),
        products=frame("products", dict(id="p", name="Lamp"), dict(id=None, name="Nothing")),
    )
    for events in (staging.typed_user_events(tables.user_events), staging.stg_user_events(tables)):
        out = mart.fct_user_events(events, staging.stg_products(tables.products))
        assert rows(out, "event_id", "product_name") == [("1", "Lamp"), ("2", None), ("3", None)]
    assert out.columns == [
        "event_id", "user_id", "event_type", "event_timestamp", "page_url", "product_id", "product_name", "category",
        "additional_details",
    ]


def test_timestamps_stay_without_zone(spark, frame, rates):
    tables = raw(spark, frame, rates)
    for name, df in {**staging.build_staging(tables), **mart.build_mart(tables)}.items():
        assert "timestamp" not in {kind for _, kind in df.dtypes}, name


def test_text_sources_are_cast(spark):
    text = spark.createDataFrame(
        [("i", "o", "p", "2.5", "10.25", "0.1", "18.45")],
        "order_item_id string, order_id string, product_id string, quantity string, unit_price string, discount string, line_total string",
    )
    assert rows(staging.stg_order_items(text)) == [("i", "o", "p", 2, 10.25, 0.1, 18.45)]
    when = spark.createDataFrame(
        [("o", "u", "2024-01-05 10:00:00", "pending", "paypal", "2024-01-06T11:00:00")],
        "order_id string, user_id string, order_date string, order_status string, payment_method string, updated_at string",
    )
    assert staging.stg_orders(when).select(F.max("updated_at")).first()[0] == datetime(2024, 1, 6, 11)
