from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from shopgrain import schemas, session
from shopgrain.catalog import changes
from shopgrain.plans import increments
from shopgrain.sources.partitioned import SLICE
from shopgrain.streaming.events import deduplicated, file_stream, stream_user_events, write_stream
from shopgrain.streaming.orders import stream_orders


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def people(frame):
    return (
        frame("users", dict(user_id="q", location_id="Q"), dict(user_id="n", location_id="N")),
        frame("locations", dict(location_id="Q", country_code="CA", state="QC"), dict(location_id="N", country_code="US", state="NY")),
    )


def events(frame, *given):
    return frame("user_events", *[dict(event_id=i, user_id=u, event_timestamp=t, event_type="page_view") for i, u, t in given])


def test_event_stream_with_the_mark_of_the_batch_model(spark, frame, folder):
    users, places = people(frame)
    table = increments.user_events_table(spark, f"{folder}/table")

    def run():
        source = file_stream(spark, f"{folder}/in", schemas.USER_EVENTS, files_per_batch=1)
        stream_user_events(source, users, places, table, f"{folder}/checkpoint", "s", admit="newer").awaitTermination()
        return rows(table.read(), "event_id", "is_quebec_event")

    events(frame, ("1", "q", at(1)), ("2", "n", at(2))).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    assert run() == [("1", True), ("2", False)]
    # a tie with the newest row and a late row are dropped; a later one of an unknown user comes in
    events(frame, ("3", "q", at(2)), ("4", "q", at(1, 5)), ("5", "ghost", at(3))).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    assert run() == [("1", True), ("2", False), ("5", False)]
    assert run() == [("1", True), ("2", False), ("5", False)]


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_event_stream_loses_no_late_event_or_tie(spark, frame, folder, files_per_batch):
    users, places = people(frame)
    table = increments.user_events_table(spark, f"{folder}/table")
    files = [
        [("1", "q", at(9)), ("2", "n", at(20))],
        [("3", "q", at(20)), ("4", "q", at(1)), ("2", "n", at(20)), ("5", "ghost", at(28)), ("5", "ghost", at(28))],
        [("6", "n", datetime(2023, 5, 1)), (None, "q", at(2)), (None, "q", at(2))],
    ]
    for given in files:
        events(frame, *given).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    source = file_stream(spark, f"{folder}/in", schemas.USER_EVENTS, files_per_batch)
    stream_user_events(source, users, places, table, f"{folder}/checkpoint", "s").awaitTermination()
    found = rows(table.read(), "event_id", "is_quebec_event")
    assert found == [("1", True), ("2", False), ("3", True), ("4", True), ("5", False), ("6", False), (None, True), (None, True)]


def test_event_stream_writes_only_new_rows(spark, frame, folder):
    users, places = people(frame)
    table = increments.user_events_table(spark, f"{folder}/table")
    for n in range(6):
        events(frame, (str(n), "q", at(3, n))).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = file_stream(spark, f"{folder}/in", schemas.USER_EVENTS)
        stream_user_events(source, users, places, table, f"{folder}/checkpoint", "s").awaitTermination()
    stored = spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/table/data")
    assert stored.count() == table.read().count() == 6  # one month, six runs, no row written twice
    notes = [f.name for f in Path(f"{folder}/table/notes").iterdir()]
    assert sorted(notes) == ["newest", "schema"]  # nothing a run, so nothing to read through


def test_a_replayed_batch_changes_nothing(spark, frame, folder):
    users, places = people(frame)
    table = increments.user_events_table(spark, f"{folder}/table")
    events(frame, ("1", "q", at(1))).write.parquet(f"{folder}/in")
    for attempt in ("a", "b"):  # the second has lost its checkpoint, so batch 0 runs again
        source = file_stream(spark, f"{folder}/in", schemas.USER_EVENTS)
        stream_user_events(source, users, places, table, f"{folder}/checkpoint-{attempt}", "s").awaitTermination()
    assert rows(table.read(), "event_id") == [("1",)]


@pytest.mark.parametrize("salts", [1, 4])
def test_deduplication_within_the_watermark(spark, frame, folder, salts):
    def run(*given):
        events(frame, *given).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = file_stream(spark, f"{folder}/in", schemas.USER_EVENTS)
        write_stream(deduplicated(source, "1 hour", salts), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
        return rows(spark.read.schema(schemas.USER_EVENTS).parquet(f"{folder}/out"), "event_id", "event_timestamp")

    assert run(("1", "q", at(1)), ("1", "q", at(1)), ("2", "q", at(1, 1))) == [("1", at(1)), ("2", at(1, 1))]
    assert len(run(("2", "q", at(1, 1)), ("3", "q", at(9)))) == 3  # a copy within the lateness is dropped
    assert len(run(("4", "q", at(2)))) == 3  # far behind the watermark: dropped


def test_a_much_repeated_event_comes_out_once(spark, frame, folder):
    one = events(frame, ("1", "q", at(1)))
    many = one.crossJoin(spark.range(5000)).drop("id").unionByName(events(frame, ("2", "q", at(1))))
    many.repartition(4).write.parquet(f"{folder}/in")
    source = file_stream(spark, f"{folder}/in", schemas.USER_EVENTS)
    write_stream(deduplicated(source), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    assert rows(spark.read.schema(schemas.USER_EVENTS).parquet(f"{folder}/out"), "event_id") == [("1",), ("2",)]


def test_order_stream_keeps_the_newest_version(spark, frame, folder):
    users, places = people(frame)
    table = increments.order_versions_table(spark, f"{folder}/table")

    def run(*given):
        batch = frame("orders", *[dict(order_id=i, user_id="q", order_date=at(1), updated_at=u, order_status=s) for i, u, s in given])
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = file_stream(spark, f"{folder}/in", schemas.ORDERS)
        stream_orders(source, users, places, table, f"{folder}/checkpoint", "s").awaitTermination()
        return rows(increments.current_orders(table), "order_id", "order_status", "fulfillment_region_type")

    assert run(("1", at(1), "pending"), ("1", at(3), "shipped"), ("2", at(2), "pending")) == [
        ("1", "shipped", "QC"), ("2", "pending", "QC"),
    ]
    assert run(("2", at(4), "delivered"), ("1", at(2), "stale")) == [("1", "shipped", "QC"), ("2", "delivered", "QC")]


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_order_stream_does_not_depend_on_the_batches(spark, frame, folder, files_per_batch):
    users, places = people(frame)
    table = increments.order_versions_table(spark, f"{folder}/table")
    files = [[("A", at(10), "shipped")], [("B", at(5), "pending"), ("C", at(6), "pending"), ("A", at(4), "stale")]]
    for given in files:
        batch = frame("orders", *[dict(order_id=i, user_id="q", order_date=at(1), updated_at=u, order_status=s) for i, u, s in given])
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    source = file_stream(spark, f"{folder}/in", schemas.ORDERS, files_per_batch)
    stream_orders(source, users, places, table, f"{folder}/checkpoint", "s").awaitTermination()
    assert rows(increments.current_orders(table), "order_id", "order_status") == [("A", "shipped"), ("B", "pending"), ("C", "pending")]


def test_order_stream_passes_orders_without_a_key_and_settles_ties(spark, frame, folder):
    users, places = people(frame)
    table = increments.order_versions_table(spark, f"{folder}/table")
    for given in ([("1", at(2), "b"), (None, at(1), "n"), (None, at(1), "n")], [("1", at(2), "c"), (None, at(1), "m")], [("1", at(2), "a")]):
        batch = frame("orders", *[dict(order_id=i, order_date=at(1), updated_at=u, order_status=s) for i, u, s in given])
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    source = file_stream(spark, f"{folder}/in", schemas.ORDERS, 1)
    stream_orders(source, users, places, table, f"{folder}/checkpoint", "s").awaitTermination()
    assert rows(increments.current_orders(table), "order_id", "order_status") == [("1", "c"), (None, "m"), (None, "n"), (None, "n")]


def test_order_stream_writes_in_proportion_to_the_batch_and_reads_nothing(spark, frame, folder):
    """One large batch, then 20 small ones that all touch the same month."""
    users, places = people(frame)
    table = increments.order_versions_table(spark, f"{folder}/table")
    base = spark.range(20_000).selectExpr("cast(id AS string) AS order_id", "'q' AS user_id")
    whole = base.withColumns({"order_date": F.lit(at(1)), "order_status": F.lit("pending"), "payment_method": F.lit("x"), "updated_at": F.lit(at(1))})
    whole.select(*[F.col(f.name).cast(f.dataType) for f in schemas.ORDERS]).coalesce(1).write.parquet(f"{folder}/in")
    for n in range(20):
        batch = frame("orders", *[dict(order_id=str(n * 10 + i), user_id="q", order_date=at(1), updated_at=at(2), order_status="shipped") for i in range(10)])
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    source = file_stream(spark, f"{folder}/in", schemas.ORDERS, 1)
    stream_orders(source, users, places, table, f"{folder}/checkpoint", "s").awaitTermination()
    size = {}
    for file in Path(f"{folder}/table/data").rglob("*.parquet"):
        size[file.parent.name] = size.get(file.parent.name, 0) + file.stat().st_size
    first, *small = [size[run] for run in sorted(size)]
    assert len(small) == 20 and max(small) < first / 10 and max(small) < 1.2 * min(small)
    found = increments.current_orders(table, [202401]).groupBy("order_status").count()
    assert rows(found) == [("pending", 19_800), ("shipped", 200)]


def test_a_replayed_order_batch_changes_nothing(spark, frame, folder):
    users, places = people(frame)
    table = increments.order_versions_table(spark, f"{folder}/table")
    frame("orders", dict(order_id="1", user_id="q", order_date=at(1), updated_at=at(2))).write.parquet(f"{folder}/in")
    for attempt in ("a", "b"):
        source = file_stream(spark, f"{folder}/in", schemas.ORDERS)
        stream_orders(source, users, places, table, f"{folder}/checkpoint-{attempt}", "s").awaitTermination()
    assert table.read().count() == increments.current_orders(table).count() == 1


def test_a_glob_takes_a_file_or_a_folder(spark, frame, folder):
    events(frame, ("1", "q", at(1))).coalesce(1).write.parquet(f"{folder}/events.parquet")
    file = spark.read.parquet(f"{folder}/events.parquet").inputFiles()[0]
    for n, path in enumerate((f"{folder}/events.parquet*", file.replace(".snappy.parquet", "*"))):
        source = file_stream(spark, path, schemas.USER_EVENTS)
        assert source.isStreaming
        write_stream(source, f"{folder}/out{n}", f"{folder}/checkpoint{n}").awaitTermination()
        assert spark.read.parquet(f"{folder}/out{n}").count() == 1


def test_files_of_a_stream_hold_no_more_rows_as_the_table_grows(spark, folder, monkeypatch):
    monkeypatch.setattr(changes, "TASK_ROWS", 100)
    given = spark.range(2000).withColumn("copy", F.lit(1))
    stream = changes._shuffled_files(given, f"{folder}/in", 2000, "id")
    held = spark.read.parquet(f"{folder}/in").groupBy(F.input_file_name()).count()
    assert held.agg(F.max("count")).first()[0] < 200
    batches = []
    query = stream.writeStream.foreachBatch(lambda batch, _: batches.append(batch.count()))
    query.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert len(batches) <= changes.BATCHES and sum(batches) == 2000 and max(batches) < 1000


def test_order_stream_takes_as_many_partitions_as_asked_for(spark, frame, folder, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 2)
    users, places = people(frame)
    given = [dict(order_id=str(n % 20), user_id="q", order_date=at(1), updated_at=at(1, n // 20), order_status=f"s{n // 20}") for n in range(40)]
    frame("orders", *given).coalesce(1).write.parquet(f"{folder}/in")
    table = increments.order_versions_table(spark, f"{folder}/table")
    source = file_stream(spark, f"{folder}/in", schemas.ORDERS)
    before = spark.conf.get(session.PARTITIONS_CONF)
    partitions = session.partitions_for(spark, len(given))
    stream_orders(source, users, places, table, f"{folder}/checkpoint", "s", partitions=partitions).awaitTermination()
    assert spark.conf.get(session.PARTITIONS_CONF) == before
    assert len([p for p in Path(f"{folder}/checkpoint/state/0").iterdir() if p.name.isdigit()]) == partitions == 20
    current = increments.current_orders(table)
    assert rows(current.groupBy("order_status").count()) == [("s1", 20)]
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan  # one shuffle, of a number that grows


def test_event_stream_compares_rows_in_partitions_that_grow(spark, frame, folder, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 2)
    users, places = people(frame)
    found = []
    inner = increments.user_events_batch
    monkeypatch.setattr(
        "shopgrain.streaming.events.user_events_batch",
        lambda new, *others: found.append(int(new.sparkSession.conf.get(session.PARTITIONS_CONF))) or inner(new, *others),
    )
    events(frame, *[(str(n % 15), "q", at(2)) for n in range(30)]).coalesce(1).write.parquet(f"{folder}/in")
    table = increments.user_events_table(spark, f"{folder}/table")
    stream_user_events(
        file_stream(spark, f"{folder}/in", schemas.USER_EVENTS), users, places, table, f"{folder}/checkpoint", "s"
    ).awaitTermination()
    assert found == [15] and table.read().count() == 15


def order_stream(spark, frame, folder, *files, partitions=None):
    """A stream of these files, a micro-batch each; further files go on from the checkpoint."""
    users, places = people(frame)
    table = increments.order_versions_table(spark, f"{folder}/table")
    for given in files:
        batch = frame("orders", *[dict(order_id=i, user_id="q", order_date=at(1), updated_at=u, order_status=s) for i, u, s in given])
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    source = file_stream(spark, f"{folder}/in", schemas.ORDERS, 1)
    stream_orders(source, users, places, table, f"{folder}/checkpoint", "s", partitions=partitions).awaitTermination()
    return rows(increments.current_orders(table), "order_id", "order_status")


def state_files(folder):
    return {p.suffix for p in Path(f"{folder}/checkpoint/state").rglob("[0-9]*.*")}


NEWER_FIRST = [("A", at(10), "shipped"), ("B", at(2), "pending")], [("A", at(4), "stale"), ("B", at(3), "shipped")]


def test_order_stream_keeps_its_state_on_disk(spark, frame, folder):
    before = {name: spark.conf.get(name, None) for name in (*session.DISK_STORE, session.FREE_CONF)}
    assert spark.conf.get(session.STORE_CONF) == session.DEFAULT_STORE
    assert order_stream(spark, frame, folder, *NEWER_FIRST) == [("A", "shipped"), ("B", "shipped")]
    assert ".zip" in state_files(folder) and ".delta" not in state_files(folder)  # .delta: all of it in the heap
    assert {name: spark.conf.get(name, None) for name in before} == before


def test_order_stream_goes_on_from_a_state_in_the_heap(spark, frame, folder, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(session, "DISK_STORE", {})
        order_stream(spark, frame, folder, NEWER_FIRST[0])
        assert ".delta" in state_files(folder)
    assert order_stream(spark, frame, folder, NEWER_FIRST[1]) == [("A", "shipped"), ("B", "shipped")]
    assert ".zip" not in state_files(folder)


def test_state_on_disk_leaves_what_the_session_asks_for(spark):
    bound = "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB"
    with session.setting(spark, bound, "77"):
        with session.state_on_disk(spark):
            assert spark.conf.get(bound) == "77" and "RocksDB" in spark.conf.get(session.STORE_CONF)
        assert spark.conf.get(bound) == "77"
    assert spark.conf.get(bound, None) is None
    with session.setting(spark, session.STORE_CONF, "of.its.Own"), session.state_on_disk(spark):
        assert spark.conf.get(session.STORE_CONF) == "of.its.Own" and spark.conf.get(bound, None) is None


def test_order_stream_writes_few_files_a_month(spark, frame, folder):
    users, places = people(frame)
    given = [dict(order_id=str(n), user_id=f"u{n}", order_date=datetime(2024, 1 + n % 3, 1), updated_at=at(5)) for n in range(60)]
    frame("orders", *given).coalesce(1).write.parquet(f"{folder}/in")
    table = increments.order_versions_table(spark, f"{folder}/table")
    source = file_stream(spark, f"{folder}/in", schemas.ORDERS)
    stream_orders(source, users, places, table, f"{folder}/checkpoint", "s", partitions=8).awaitTermination()
    assert len(list(Path(f"{folder}/table/data").rglob("*.parquet"))) == 3  # not one a month and task
    assert increments.current_orders(table).count() == 60


def test_current_orders_sorts_once_and_keeps_the_first_region(spark, folder):
    table = increments.order_versions_table(spark, f"{folder}/table")
    columns = f"order_id string, user_id string, order_date timestamp_ntz, order_status string, payment_method string, updated_at timestamp_ntz, fulfillment_region_type string, {SLICE} int"

    def load(run, *given):
        made = [(i, "q", at(1), s, None, u, r, 202401) for i, s, u, r in given]
        table.append(spark.createDataFrame(made, columns), run)

    load("s-2", ("1", "x", at(3), "later"), ("2", "x", at(3), "new"), ("3", "x", at(1), "known"), (None, "x", at(1), "n"))
    load("s-1", ("1", "x", at(3), "first"), ("2", "z", at(2), "old"), ("3", "x", None, "none"), (None, "x", at(1), "n"))
    load("s-3", ("1", "a", at(3), "tie"), ("4", None, at(1), None), ("4", None, at(1), None))
    current = increments.current_orders(table)
    assert rows(current, "order_id", "order_status", "fulfillment_region_type") == [
        ("1", "x", "first"), ("2", "x", "new"), ("3", "x", "known"), ("4", None, None), (None, "x", "n"), (None, "x", "n"),
    ]
    assert SLICE not in current.columns and "SortAggregate" not in current._jdf.queryExecution().executedPlan().toString()
