from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopgrain import session
from shopgrain.operators import history, incremental
from shopgrain.operators.history import RepeatedKey
from shopgrain.plans import increments, location_history
from shopgrain.sources.raw import RawTables
from shopgrain.sources.bucketed import BucketedTable
from shopgrain.sources.partitioned import RUN, SLICE, PartitionedTable, month_number


def at(day, month=1):
    return datetime(2024, month, day)


def orders(frame, *given):
    return frame("orders", *[dict(order_id=i, order_date=d, updated_at=u, order_status=s, user_id="u") for i, d, u, s in given])


# -- increment selection -------------------------------------------------------------


def test_high_water_mark_is_strict(frame):
    target = orders(frame, ("1", at(1), at(10), "pending"))
    source = orders(
        frame,
        ("tie", at(1), at(10), "x"), ("late", at(1), at(9), "x"), ("new", at(1), at(11), "x"), ("none", at(1), None, "x"),
    )
    pick = incremental.newer_than_target
    assert rows(pick(source, target, "updated_at"), "order_id") == [("new",)]
    assert pick(source, None, "updated_at").count() == 4


def test_an_empty_target_lets_nothing_pass(frame):
    source, empty = orders(frame, ("1", at(1), at(1), "x")), frame("orders")
    assert incremental.newer_than_target(source, empty, "updated_at").count() == 0
    assert incremental.newer_than_target(source, empty, "updated_at", on_empty="all").count() == 1


def test_the_mark_reaches_the_scan(spark, frame, folder):
    orders(frame, ("1", at(1), at(1), "x"), ("2", at(2), at(2), "x")).write.parquet(folder)
    source = spark.read.parquet(folder)
    out = incremental.newer_than_target(source, source.where("order_id = '1'"), "updated_at")
    plan = out._jdf.queryExecution().toString()
    assert "GreaterThan(updated_at,ScalarSubquery" in plan.replace(" ", "")


def test_anti_join_keeps_null_keys_and_leaves_stored_rows_alone(frame):
    target = frame("order_items", dict(order_item_id="1", quantity=1), dict(order_item_id=None, quantity=1))
    source = frame(
        "order_items", dict(order_item_id="1", quantity=9), dict(order_item_id="2", quantity=2), dict(order_item_id=None, quantity=3)
    )
    out = incremental.absent_from_target(source, target, "order_item_id")
    assert rows(out, "order_item_id", "quantity") == [("2", 2), (None, 3)]


def test_upsert_replaces_and_repeats_harmlessly(frame):
    target = orders(frame, ("1", at(1), at(1), "pending"), ("2", at(1), at(1), "pending"))
    batch = orders(frame, ("2", at(1), at(2), "shipped"), ("3", at(1), at(2), "pending"))
    once = incremental.upsert(target, batch, "order_id")
    assert rows(once, "order_id", "order_status") == [("1", "pending"), ("2", "shipped"), ("3", "pending")]
    assert rows(incremental.upsert(once, batch, "order_id")) == rows(once)
    twice = batch.unionByName(batch)
    assert incremental.upsert(target, twice, "order_id").count() == 5  # repeats inside a batch are kept


def test_latest_per_key(frame):
    versions = orders(frame, ("1", at(1), at(1), "pending"), ("1", at(1), at(3), "delivered"), ("1", at(1), at(2), "shipped"), ("2", at(1), None, "x"), (None, at(1), at(1), "n"), (None, at(1), at(1), "n"))
    out = incremental.latest_per_key(versions, "order_id", "updated_at")
    assert out.columns == versions.columns
    assert rows(out, "order_id", "order_status") == [("1", "delivered"), ("2", "x"), (None, "n"), (None, "n")]


def test_schema_guard_names_the_column(frame):
    base = frame("orders")
    same = base.select(*reversed(base.columns))
    incremental.require_same_schema(base.schema, same.schema)
    for changed, column in (
        (base.withColumn("coupon", F.lit(1)), "coupon: added"),
        (base.drop("user_id"), "user_id: missing"),
        (base.withColumn("order_date", F.col("order_date").cast("date")), "order_date: type"),
    ):
        with pytest.raises(incremental.SchemaDrift, match=column):
            incremental.require_same_schema(base.schema, changed.schema)


# -- stored tables ------------------------------------------------------------------------


def sliced(frame, *given):
    return orders(frame, *given).withColumn(SLICE, month_number("order_date"))


def spoil(folder, *parts):
    """Make files unreadable, so that whoever reads them fails."""
    spoiled = [f for part in parts for f in Path(folder).glob(f"data/{part}/**/*.parquet")]
    assert spoiled
    for file in spoiled:
        file.write_bytes(b"not parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


def test_only_the_months_of_a_batch_are_read_and_written(spark, frame, folder):
    table = increments.orders_table(spark, folder)
    first = sliced(frame, ("1", at(1, 1), at(1), "a"), ("2", at(1, 2), at(1), "a"), ("3", at(1, 2), at(1), "a"))
    assert incremental.upsert_into(table, first, "order_id", "first")
    kept = {f: f.read_bytes() for f in Path(folder).glob(f"data/{SLICE}=202402/*")}
    spoil(folder, f"{SLICE}=202401")
    second = sliced(frame, ("2", at(1, 2), at(2), "changed"), ("5", at(1, 4), at(2), "new"))
    assert incremental.upsert_into(table, second, "order_id", "second")
    assert not incremental.upsert_into(table, second, "order_id", "second")
    assert rows(table.read([202402, 202404]), "order_id", "order_status") == [("2", "changed"), ("3", "a"), ("5", "new")]
    assert not any(f.exists() for f in kept)
    with pytest.raises(incremental.SchemaDrift):
        incremental.upsert_into(table, second.drop("user_id"), "order_id", "third")
    assert incremental.upsert_into(table, second.limit(0), "order_id", "nothing")
    assert table.read([202402, 202404]).count() == 3


def test_a_moved_key_is_refused_on_request(spark, frame, folder):
    table = increments.orders_table(spark, folder)
    incremental.upsert_into(table, sliced(frame, ("1", at(1, 1), at(1), "a"), ("2", at(1, 1), at(1), "a")), "order_id", "first")
    moved = sliced(frame, ("1", at(1, 2), at(2), "moved"), ("2", at(1, 1), at(2), "stays"))
    assert rows(incremental.moved_keys(table, moved, "order_id")) == [("1",)]
    with pytest.raises(incremental.MovedKey, match="'1'"):
        incremental.upsert_into(table, moved, "order_id", "second", refuse_moved=True)
    assert rows(table.read(), "order_id", "order_status") == [("1", "a"), ("2", "a")]


def test_null_dates_have_a_slice(spark, frame, folder):
    table = increments.orders_table(spark, folder)
    incremental.upsert_into(table, sliced(frame, ("1", None, at(1), "a"), ("2", at(1), at(1), "a")), "order_id", "r")
    assert rows(table.read(), "order_id", SLICE) == [("1", -1), ("2", 202401)]


def test_a_run_that_died_while_months_were_moved_in_is_finished(spark, frame, folder, monkeypatch):
    table = increments.orders_table(spark, folder)
    incremental.upsert_into(table, sliced(frame, ("1", at(1), at(1), "a"), ("2", at(1), at(1), "a")), "order_id", "first")
    write = PartitionedTable._write

    def dies(self, df, *args):
        spoil(folder, f"{SLICE}=202401")  # the old month is gone, the new one is not there yet
        raise RuntimeError("lost")

    monkeypatch.setattr(PartitionedTable, "_write", dies)
    batch = sliced(frame, ("2", at(1), at(2), "b"))
    with pytest.raises(RuntimeError):
        incremental.upsert_into(table, batch, "order_id", "second")
    monkeypatch.setattr(PartitionedTable, "_write", write)
    again = increments.orders_table(spark, folder)
    assert incremental.upsert_into(again, batch, "order_id", "second")
    assert rows(again.read(), "order_id", "order_status") == [("1", "a"), ("2", "b")]


def test_appending_again_overwrites_the_own_partitions_only(spark, frame, folder):
    table = increments.user_events_table(spark, folder)
    assert table.read() is None and table.newest("a") is None
    batch = frame("user_events", dict(event_id="1", event_timestamp=at(3)), dict(event_id="2", event_timestamp=at(1, 2)))
    batch = batch.withColumn(SLICE, month_number("event_timestamp"))
    for run in ("2024-01-01", "2024-01-01", "b/c d"):  # a name that looks like a date stays a name
        table.append(batch, run)
    assert rows(table.read(), "event_id", RUN) == [("1", "2024-01-01"), ("1", "b/c d"), ("2", "2024-01-01"), ("2", "b/c d")]
    assert rows(table.newest("x")) == [(at(1, 2),)]
    table.append(batch.where("event_id = '1'").withColumn("event_timestamp", F.lit(at(9)).cast("timestamp_ntz")), "d")
    assert rows(table.newest("x")) == [(at(1, 2),)] and rows(table.newest("y")) == [(at(1, 2),)]


def test_the_newest_time_of_an_empty_table_is_null(spark, frame, folder):
    table = increments.orders_table(spark, folder)
    incremental.upsert_into(table, sliced(frame), "order_id", "first")
    assert table.read().count() == 0 and rows(table.newest("second")) == [(None,)]


# -- bucketed items ------------------------------------------------------------------------


def test_stored_keys_are_not_shuffled(spark, folder):
    table = BucketedTable(spark, folder, "id", 8)
    numbers = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v"))
    for run in ("a", "b", "b"):
        table.append(numbers, run)
    assert table.read().count() == 2000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = spark.range(500, 3000).select(F.col("id").cast("string").alias("id"))
        new = incremental.absent_from_target(source, table.read(), "id")
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert new.count() == 2000
    assert "SelectedBucketsCount: 8 out of 8" in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("FileScan parquet")  # the source's side


def test_a_bucketed_table_is_found_again_by_another_session(spark, folder):
    numbers = spark.range(100).select(F.col("id").cast("string").alias("id"))
    table = BucketedTable(spark, folder, "id", 4)
    assert table.read() is None
    table.append(numbers, "a")
    table.append(numbers, "b")
    spark.sql(f"DROP TABLE {table.name}")  # what a new session's catalogue knows
    again = BucketedTable(spark, folder, "id", 99)
    assert again.read().count() == 200 and again._buckets() == 4
    again.refresh(numbers.limit(3), "c")
    assert rows(again.read(), RUN) == [("c",)] * 3
    again.append(numbers, "d")
    assert again.read().count() == 103


# -- incremental models: first run, rerun, late row, changed row ------------------------------


def raw(spark, frame, rates, **tables):
    empty = {name: frame(name) for name in RawTables.NAMES if name != "exchange_rates"}
    return RawTables(spark, **{**empty, "exchange_rates": rates, **tables})


def test_orders_model_over_several_runs(spark, frame, rates, folder):
    home = dict(
        users=frame("users", dict(user_id="u", location_id="L")),
        locations=frame("locations", dict(location_id="L", country_code="CA", state="QC")),
    )
    table = increments.orders_table(spark, folder)
    first = raw(spark, frame, rates, **home, orders=orders(frame, ("1", at(1), at(5), "pending"), ("2", at(1), at(4), "pending")))
    assert increments.run_orders(table, first, "r1")
    moved = frame("locations", dict(location_id="L", country_code="US", state="AK"))
    second = first.replace(
        locations=moved,
        orders=orders(frame, ("1", at(1), at(6), "shipped"), ("2", at(1), at(4), "lost change"), ("late", at(1), at(3), "x")),
    )
    assert increments.run_orders(table, second, "r2")
    out = table.read()
    assert rows(out, "order_id", "order_status", "fulfillment_region_type") == [
        ("1", "shipped", "EXCLUDED"),
        ("2", "pending", "QC"),  # frozen at load time
    ]
    assert increments.run_orders(table, second, "r3") and rows(table.read()) == rows(out)


def test_items_model_appends_new_keys_only(spark, frame, rates, folder):
    table = increments.order_items_table(spark, folder)
    items = frame("order_items", dict(order_item_id="1", quantity=1), dict(order_item_id=None, quantity=7))
    increments.run_order_items(table, raw(spark, frame, rates, order_items=items), "r1", at(1))
    files = {f: f.read_bytes() for f in Path(folder).glob("data/run=r1/*.parquet")}
    changed = frame("order_items", dict(order_item_id="1", quantity=9), dict(order_item_id="2", quantity=2), dict(order_item_id=None, quantity=7))
    for _ in range(2):  # a repeated run writes the same rows again
        increments.run_order_items(table, raw(spark, frame, rates, order_items=changed), "r2", at(2))
    assert rows(table.read(), "order_item_id", "quantity", "loaded_at") == [
        ("1", 1, at(1)), ("2", 2, at(2)), (None, 7, at(1)), (None, 7, at(2)),
    ]
    assert files == {f: f.read_bytes() for f in Path(folder).glob("data/run=r1/*.parquet")}


def test_events_model_replaces_an_id_of_the_same_month_where_it_is(spark, frame, rates, folder):
    def given(*events):
        found = frame("user_events", *[dict(event_id=i, event_timestamp=t, event_type=k) for i, t, k in events])
        return raw(spark, frame, rates, user_events=found)

    table = increments.user_events_table(spark, folder)
    increments.run_user_events(table, given(("1", at(1), "a"), ("2", at(2), "a"), ("old", at(1, 1), "a")), "r1")
    again = given(("1", at(5), "b"), ("3", at(6), "b"), ("late", at(2), "b"))
    assert increments.run_user_events(table, again, "r2") and not increments.run_user_events(table, again, "r2")
    assert rows(table.read(), "event_id", "event_type", RUN) == [("1", "b", "r1"), ("2", "a", "r1"), ("3", "b", "r2"), ("old", "a", "r1")]
    increments.run_user_events(table, again, "r3", full_refresh=True)
    assert rows(table.read(), "event_id", RUN) == [("1", "r3"), ("3", "r3"), ("late", "r3")]


# -- history ---------------------------------------------------------------------------------------


def places(frame, **state_of):
    return frame("locations", *[dict(location_id=k, country_code="US", state=s) for k, s in state_of.items()])


@pytest.mark.parametrize("strategy, versions", [("timestamp", 2), ("check", 1)])
def test_unchanged_rerun(frame, rates, strategy, versions):
    first = location_history.snap_locations(None, places(frame, a="NY"), rates, at(1))
    second = location_history.snap_locations(first, places(frame, a="NY"), rates, at(2), strategy)
    assert second.count() == versions
    assert second.where("is_current").count() == 1
    same_moment = location_history.snap_locations(first, places(frame, a="NY"), rates, at(1), strategy)
    assert rows(same_moment) == rows(first)


def test_changed_added_and_vanished_rows(frame, rates):
    first = location_history.snap_locations(None, places(frame, a="NY", b="TX", gone="WA"), rates, at(1))
    second = location_history.snap_locations(first, places(frame, a="AK", b="TX", c="HI"), rates, at(2), "check")
    assert rows(second, "location_id", "state", "is_excluded_supply_chain", "valid_from", "valid_to", "is_current") == [
        ("a", "AK", True, at(2), None, True),
        ("a", "NY", False, at(1), at(2), False),
        ("b", "TX", False, at(1), None, True),
        ("c", "HI", True, at(2), None, True),
        ("gone", "WA", False, at(1), None, True),
    ]
    third = location_history.snap_locations(second, places(frame, a="NY"), rates, at(3), "check")
    assert rows(third.where("location_id = 'a'"), "state", "valid_from", "valid_to") == [
        ("AK", at(2), at(3)), ("NY", at(1), at(2)), ("NY", at(3), None),
    ]
    assert third.groupBy("location_id").agg(F.count_if("is_current").alias("n")).where("n <> 1").count() == 0
    assert rows(history.as_of(third, datetime(2024, 1, 2, 12)).where("location_id = 'a'"), "state") == [("AK",)]
    assert rows(history.as_of(third, at(2)).where("location_id = 'a'"), "state") == [("AK",)]


def test_null_to_value_is_a_change_and_null_keys_are_new(frame, rates):
    def odd(state):
        return frame("locations", dict(location_id="a", state=state), dict(location_id=None, state="x"))

    first = location_history.snap_locations(None, odd(None), rates, at(1))
    second = location_history.snap_locations(first, odd("NY"), rates, at(2), "check")
    assert rows(second, "location_id", "state", "is_current") == [
        ("a", "NY", True), ("a", None, False), (None, "x", True), (None, "x", True),
    ]


def test_unknown_strategy(frame, rates):
    first = location_history.snap_locations(None, places(frame, a="NY"), rates, at(1))
    with pytest.raises(ValueError):
        location_history.snap_locations(first, places(frame, a="NY"), rates, at(2), "guess")


def test_stored_snapshot_runs_once_and_leaves_closed_versions_alone(spark, frame, rates, folder):
    table = location_history.history_table(spark, folder)
    assert location_history.read_history(table) is None
    closed = {}
    for run, day in (("r1", 1), ("r2", 2), ("r2", 3), ("r3", 3)):
        location_history.run_snapshot(table, places(frame, a="NY"), rates, at(day), run)
        assert closed.items() <= {f: f.read_bytes() for f in Path(folder).glob("data/*/*.parquet")}.items()
        closed = {f: f.read_bytes() for f in Path(folder).glob(f"data/{location_history.SLICE}=run*/*.parquet")}
    stored = location_history.read_history(table)
    assert rows(stored, "valid_from", "valid_to") == [(at(1), at(2)), (at(2), at(3)), (at(3), None)]
    whole = None
    for day in (1, 2, 3):
        whole = location_history.snap_locations(whole, places(frame, a="NY"), rates, at(day))
    assert rows(stored) == rows(whole)


def test_a_snapshot_refuses_a_repeated_key(spark, frame, rates, folder):
    table = location_history.history_table(spark, f"{folder}/history")
    twice = places(frame, a="NY").unionByName(places(frame, a="TX"))
    with pytest.raises(RepeatedKey, match="location_id"):
        location_history.run_snapshot(table, twice, rates, at(1), "r1")
    assert table.read() is None


def test_facts_get_the_version_of_their_time(spark):
    versions = [("a", "one", at(2), at(4)), ("a", "two", at(4), at(6)), ("a", "three", at(8), None), ("b", "only", at(1), None), (None, "x", at(1), None)]
    history_ = spark.createDataFrame(versions, "place string, city string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    times = {1: None, 2: "one", 3: "one", 4: "two", 5: "two", 6: None, 7: None, 8: "three", 20: "three"}
    facts = [(f"a{d}", "a", at(d)) for d in times] + [("b1", "b", at(1)), ("null", None, at(3)), ("gone", "c", at(3)), ("when", "a", None)]
    facts += [(f"hot{i}", "a", at(3)) for i in range(500)]
    df = spark.createDataFrame(facts, "id string, place string, at timestamp_ntz")
    found = {r["id"]: r["city"] for r in history.as_of_join(df, history_, "place", "at", ["city", "valid_from"], "id").collect()}
    assert found == {f"a{d}": c for d, c in times.items()} | {"b1": "only", "null": None, "gone": None, "when": None} | {f"hot{i}": "one" for i in range(500)}


def test_as_of_join_spreads_a_busy_key_and_makes_no_pairs(spark):
    history_ = spark.range(50).selectExpr("'a' AS place", "cast(id AS string) AS city", "timestampadd(DAY, id, TIMESTAMP_NTZ'2024-01-01') AS valid_from", "timestampadd(DAY, id + 1, TIMESTAMP_NTZ'2024-01-01') AS valid_to")
    facts = spark.range(4000).selectExpr("id", "'a' AS place", "timestampadd(DAY, id % 50, TIMESTAMP_NTZ'2024-01-01 12:00:00') AS at")
    found = history.as_of_join(facts, history_, "place", "at", ["city"], "id")
    assert found.where("city = cast(id % 50 AS string)").count() == found.count() == 4000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" in plan
    parts = facts.selectExpr("pmod(xxhash64(id), 16) AS part").groupBy("part").count()
    assert parts.count() == 16 and parts.agg(F.max("count")).first()[0] < 400


def test_buckets_of_the_items_grow_with_the_rows(spark, frame, folder, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    before = spark.conf.get(session.PARTITIONS_CONF)
    items = frame("order_items", *[dict(order_item_id=str(i), order_id="o", quantity=1) for i in range(100)])
    raw = RawTables(spark, **{**{name: frame(name) for name in RawTables.NAMES}, "order_items": items.where("order_item_id < 40")})
    table = increments.order_items_table(spark, folder)
    increments.run_order_items(table, raw, "first", datetime(2024, 1, 1), rows=100)
    for _ in range(2):
        increments.run_order_items(table, raw.replace(order_items=items), "second", datetime(2024, 1, 2), rows=100)
    assert table._buckets() == 10 and spark.conf.get(session.PARTITIONS_CONF) == before
    assert rows(table.read().groupBy("loaded_at").count(), "count") == [(40,), (60,)]
    assert all(name.endswith(".zstd.parquet") for name in table.read().inputFiles())
