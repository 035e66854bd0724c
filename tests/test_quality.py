from datetime import datetime

import pytest

from conftest import rows
from pyspark.sql import functions as F

from shopgrain import session
from shopgrain.operators import quality
from shopgrain.operators.quality import Check
from shopgrain.plans import checks, selection
from shopgrain.plans.staging import stg_locations
from shopgrain.sources.raw import RawTables
from shopgrain.sources.warehouse import raw_tables

SMALL = "/root/testdata/sf0.001"


def items(frame, *given):
    return frame("order_items", *[dict(zip(("order_item_id", "quantity", "unit_price", "discount", "line_total"), g)) for g in given])


def test_the_list_has_every_check():
    assert len(checks.CHECKS) == 148 and len(set(checks.CHECKS)) == 148
    by_layer = [sum(c.layer == layer for c in checks.CHECKS) for layer in (checks.SOURCE, checks.STAGING, checks.INCREMENTAL)]
    assert by_layer == [54, 61, 33]
    by_test = {t: sum(c.test == t for c in checks.CHECKS) for t in ("not_null", "unique", "relationships", "accepted_values")}
    assert by_test == {"not_null": 100, "unique": 16, "relationships": 17, "accepted_values": 15}


def test_nulls_in_single_checks(frame):
    users = frame("users", dict(user_id="a", email="x"), dict(user_id="b", email="x"), dict(user_id=None), dict(user_id=None))
    assert quality.null_rows(users, "user_id").count() == 2
    assert rows(quality.repeated_values(users, "email")) == [("x", 2)]
    assert quality.repeated_values(users, "user_id").count() == 0
    events = frame("user_events", dict(event_type="page_view"), dict(event_type="odd"), dict(event_type=None))
    assert rows(quality.unaccepted_rows(events, "event_type", checks.EVENT_TYPES), "event_type") == [("odd",)]


def test_reference_and_orphan_differ_on_null(frame):
    child = frame("order_items", dict(order_item_id="1", order_id="o"), dict(order_item_id="2", order_id="gone"), dict(order_item_id="3"))
    parent = frame("orders", dict(order_id="o"))
    assert rows(quality.orphan_rows(child, "order_id", parent, "order_id"), "order_item_id") == [("2",)]
    assert rows(checks.orphan_items(child, parent), "order_item_id") == [("2",), ("3",)]


def test_line_totals(frame):
    found = checks.line_total_gaps(
        items(
            frame,
            ("ok", 2, 10.0, 0.1, 18.0), ("cent", 2, 10.0, 0.1, 18.01), ("two", 2, 10.0, 0.1, 18.02),
            ("null", 2, 10.0, 0.1, None), ("below", 1, 33.33, 0.15, 28.31), ("huge", 3, 1e13, 0.0, 5.0),
            ("half", 1, 1.005, 0.0, 1.0), ("third", 1, 1000.0, 1 / 3, 666.67), ("fine", 5000, 0.12345, 0.0, 617.25),
        )
    )
    assert [r[0] for r in rows(found, "order_item_id")] == ["below", "huge", "two"]
    assert rows(found.where("order_item_id = 'two'"), "expected_line_total", "variance") == [(18.0, 0.02)]


def test_financial_bounds(frame):
    found = checks.financial_bound_gaps(
        items(
            frame,
            ("ok", 1, 1.0, 0.0, 0.0), ("q", 0, 1.0, 0.0, 1.0), ("p", 1, 0.0, 0.0, 1.0), ("d1", 1, 1.0, 1.0, 1.0),
            ("d2", 1, 1.0, -0.1, 1.0), ("t", 1, 1.0, 0.0, -1.0), ("nulls", None, None, None, None),
        )
    )
    assert {r.order_item_id for r in found.collect()} == {"q", "p", "d1", "d2", "t"}


def test_quebec_rules(frame, rates):
    places = stg_locations(
        frame(
            "locations",
            *[dict(location_id=i, country_code="CA", state=s) for i, s in (("good", "QC"), ("a", "QC"), ("b", "QC"), ("other", "ON"))],
        ),
        rates,
    )
    place = F.col("location_id")
    damaged = places.withColumns(
        {
            "quebec_compliance_notes": F.when(place == "a", "support French").when(place == "b", F.lit(None)).otherwise(F.col("quebec_compliance_notes")),
            "currency_code": F.when(place == "a", "USD").otherwise(F.col("currency_code")),
            "exchange_rate_to_usd": F.when(place == "b", 0.0).otherwise(F.col("exchange_rate_to_usd")),
        }
    )
    assert rows(checks.quebec_language_gaps(places)) == [] == rows(checks.quebec_pricing_gaps(places))
    assert rows(checks.quebec_language_gaps(damaged), "location_id") == [("a",), ("b",)]
    assert rows(checks.quebec_pricing_gaps(damaged), "location_id") == [("a",), ("b",)]


def test_fused_run_equals_the_single_checks(spark, frame):
    tables = {
        ("s", "parent"): frame("users", *[dict(user_id=k) for k in ("a", "a", "b", None, None)]),
        ("s", "child"): frame("orders", *[dict(order_id=str(i % 3), user_id=k, order_status=s) for i, (k, s) in enumerate(
            [("a", "pending"), ("gone", "it's odd"), ("gone", "x"), (None, None), ("b", "shipped")])]),
    }
    listed = [
        Check("s", "parent", "user_id", quality.UNIQUE),
        Check("s", "parent", "user_id", quality.NOT_NULL),
        Check("s", "child", "order_id", quality.UNIQUE),
        Check("s", "child", "user_id", quality.RELATIONSHIP, parent=("s", "parent", "user_id")),
        Check("s", "child", "order_status", quality.ACCEPTED, values=("pending", "shipped", "it's odd")),
    ]
    report = quality.run_checks(spark, tables, listed)
    found = {(r.table_name, r.column_name, r.test): (r.failures, r.status) for r in report.collect()}
    assert found == {
        ("parent", "user_id", "unique"): (1, "fail"),
        ("parent", "user_id", "not_null"): (2, "fail"),
        ("child", "order_id", "unique"): (2, "fail"),
        ("child", "user_id", "relationships"): (2, "fail"),
        ("child", "order_status", "accepted_values"): (1, "fail"),
    }


def test_empty_tables_pass(spark, frame, rates):
    raw = RawTables(spark, **{name: frame(name) for name in RawTables.NAMES if name != "exchange_rates"}, exchange_rates=rates)
    report = checks.run_suite(spark, raw, datetime(2024, 1, 1))
    assert report.count() == 153
    assert report.where("status <> 'pass' OR failures <> 0").count() == 0


def test_stored_tables_can_be_checked_instead(spark, frame):
    raw = raw_tables(spark, SMALL)
    broken = frame("orders", dict(order_id="1")).withColumn("fulfillment_region_type", F.lit("NOWHERE"))
    report = checks.run_suite(
        spark, raw, datetime(2024, 1, 1), {(checks.INCREMENTAL, "stg_orders_incr"): broken}, layer=checks.INCREMENTAL
    )
    assert report.count() == 33
    found = {(r.column_name, r.test): r.failures for r in report.where("table_name = 'stg_orders_incr'").collect()}
    assert found["fulfillment_region_type", "accepted_values"] == 1 and found["user_id", "not_null"] == 1
    assert quality.select_layer(report, checks.SOURCE).count() == 0


def test_models_are_picked_by_name_layer_tag_and_place_in_the_graph():
    assert selection.pick("stg_orders") == {"stg_orders"}
    assert selection.pick("tag:high-volume") == {"stg_user_events_incr"}
    assert len(selection.pick("tag:fact staging")) == 9
    assert selection.pick("stg_users+") == {"stg_users", "stg_user_events", "stg_user_events_incr", "dim_users", "fct_user_events"}
    assert selection.pick("+fct_orders") == {"fct_orders", "stg_orders", "stg_order_items", "orders", "order_items"}
    assert selection.pick("+stg_orders+") == {"orders", "stg_orders", "fct_orders", "fct_order_items"}
    assert selection.pick("locations+,tag:incremental") == {"stg_orders_incr", "stg_user_events_incr"}
    assert selection.descendants("exchange_rates") >= {"stg_locations", "snap_locations", "fct_user_events"}
    for wrong in ("stg_nothing", "tag:none"):
        with pytest.raises(ValueError, match="picks no model"):
            selection.pick(wrong)
    assert {c.table for c in (*checks.CHECKS, *checks.RULES)} <= set(selection.MODELS)


def test_rules_count_their_failing_rows_in_the_fused_run(spark, frame, rates):
    raw = raw_tables(spark, SMALL)
    bad = items(frame, ("total", 2, 10.0, 0.1, 99.0), ("price", 1, -1.0, 0.0, -1.0), ("fine", 1, 1.0, 0.0, 1.0), ("nulls", None, None, None, None))
    report = checks.run_suite(spark, raw.replace(order_items=bad), datetime(2024, 1, 1), layer=checks.SOURCE)
    found = {r["column_name"]: r["failures"] for r in report.where("test = 'rule'").collect()}
    assert found == {"line_total_integrity": 1, "no_negative_financials": 1, "no_orphan_order_items": 4}
    picked = checks.run_suite(spark, raw, datetime(2024, 1, 1), select="tag:high-volume")
    assert picked.count() == 10 and {r["table_name"] for r in picked.collect()} == {"stg_user_events_incr"}


def test_the_suite_scans_each_table_once(spark):
    report = checks.run_suite(spark, raw_tables(spark, SMALL), datetime(2024, 1, 1), layer=checks.SOURCE)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 6


def test_partitions_of_the_checks_grow_with_the_rows(spark, frame, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    before = {name: spark.conf.get(name) for name in (session.PARTITIONS_CONF, session.SPLIT_CONF)}
    seen, inner = [], quality.written
    monkeypatch.setattr(quality, "written", lambda df, label: seen.append([spark.conf.get(n) for n in before]) or inner(df, label))
    users = frame("users", *[dict(user_id=str(i % 90)) for i in range(100)])
    report = quality.run_checks(spark, {("s", "users"): users}, [Check("s", "users", "user_id", quality.UNIQUE)])
    report = quality.kept_report(report, 100)
    assert seen == [["10", session.SPLIT]] and {name: spark.conf.get(name) for name in before} == before
    assert rows(report, "failures") == [(10,)]
