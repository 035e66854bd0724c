from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows

from shopgrain import schemas, session
from shopgrain.sources import raw, warehouse
from shopgrain.sources.ingest import ingest_folder
from shopgrain.sources.tables import create_views, refresh_table


def test_csv_keeps_zeros_commas_quotes_and_nulls(frame, spark, folder):
    places = frame(
        "locations",
        dict(location_id="1", zip_code="00901", city='Say "hi", town', address="a,b"),
        dict(location_id="2", zip_code="010"),
    )
    raw.write_csv(places, folder)
    assert rows(raw.read_csv(spark, folder, schemas.LOCATIONS)) == rows(places)


def test_csv_keeps_microseconds_and_reads_foreign_times(frame, spark, folder):
    events = frame("user_events", dict(event_id="1", event_timestamp=datetime(2024, 1, 2, 3, 4, 5, 123456)), dict(event_id="2", event_timestamp=datetime(2024, 1, 2)))
    raw.write_csv(events, folder)
    assert rows(raw.read_csv(spark, folder, schemas.USER_EVENTS)) == rows(events)
    path = Path(folder + ".csv")
    path.write_text("order_id,user_id,order_date,order_status,payment_method,updated_at\n1,u,2024-01-02 03:04:05.678901,x,y,2024-01-02T03:04:05\n")
    assert rows(raw.read_csv(spark, str(path), schemas.ORDERS), "order_date", "updated_at") == [
        (datetime(2024, 1, 2, 3, 4, 5, 678901), datetime(2024, 1, 2, 3, 4, 5))
    ]


def test_fractions_and_dates_in_whole_number_and_time_columns(spark, folder):
    path = Path(folder + ".csv")
    path.write_text("order_item_id,order_id,product_id,quantity,unit_price,discount,line_total\n1,o,p,2.5,1,0,1\n2,o,p,3.5,1,0,1\n3,o,p,,1,0,1\n")
    assert rows(raw.read_csv(spark, str(path), schemas.ORDER_ITEMS), "quantity") == [(2,), (4,), (None,)]
    orders = Path(folder + "2.csv")
    orders.write_text("order_id,user_id,order_date,order_status,payment_method,updated_at\n1,u,2024-01-02,x,y,\n")
    assert rows(raw.read_csv(spark, str(orders), schemas.ORDERS), "order_date") == [(datetime(2024, 1, 2),)]


def test_line_breaks_inside_quotes(frame, spark, folder):
    places = frame("locations", dict(location_id="1", address="first\nsecond"))
    raw.write_csv(frame("locations"), folder)
    raw.write_csv(places, folder)  # the sink replaces what was there
    assert rows(raw.read_csv(spark, folder, schemas.LOCATIONS, multi_line=True)) == rows(places)


def test_bad_values_and_headers_fail(spark, folder):
    path = Path(folder + ".csv")
    path.write_text("currency_code,exchange_rate_to_usd,rate_date,notes\nUSD,one,2024-01-01,x\n")
    with pytest.raises(Exception):
        raw.read_csv(spark, str(path), schemas.EXCHANGE_RATES).collect()
    other = Path(folder + "2.csv")
    other.write_text("code,rate\nUSD,1\n")
    with pytest.raises(Exception):
        raw.read_csv(spark, str(other), schemas.EXCHANGE_RATES).collect()


def test_six_tables_from_a_folder(spark, folder):
    small = warehouse.raw_tables(spark, "/root/testdata/sf0.001")
    raw.write_raw_csv({name: small[name] for name in schemas.RAW}, folder)
    back = raw.read_raw_csv(spark, folder)
    for name in schemas.RAW:
        assert back[name].schema == schemas.RAW[name]
        assert back[name].count() == small[name].count(), name


def test_adapter_tables_have_the_raw_schema(spark):
    small = warehouse.raw_tables(spark, "/root/testdata/sf0.001")
    for name, schema in {**schemas.RAW, **schemas.SEEDS}.items():
        assert [(f.name, f.dataType) for f in small[name].schema] == [(f.name, f.dataType) for f in schema], name


def test_raw_tables_are_made_at_first_use(spark, frame):
    made = []

    def make(name):
        made.append(name)
        return frame(name)

    tables = raw.RawTables(spark, **{name: (lambda n=name: make(n)) for name in raw.RawTables.NAMES})
    assert made == []
    assert tables.users is tables.users and made == ["users"]
    with pytest.raises(ValueError):
        raw.RawTables(spark, users=frame("users"))


def test_ingest_report(spark, folder, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "exchange_rates.csv").write_text("currency_code,exchange_rate_to_usd,rate_date,notes\nUSD,1.0,2024-01-01,a\n")
    (landing / "orders.csv").write_text("order_id\n1\n")  # lacks columns
    (landing / "notes.txt").write_text("no table\n")
    (landing / "users.csv").write_text("user_id,first_name,last_name,email,created_at,location_id\n1,a,b,c," + "x" * 900 + "END,l\n")
    (landing / "colours.csv").write_text('name,code\n"red, dark",007\n')
    spark.sql(f"CREATE DATABASE ingest_test LOCATION '{folder}'")
    try:
        first = {r.table_name: r.status for r in ingest_folder(spark, str(landing), "ingest_test").collect()}
        assert first == {"exchange_rates": "created", "orders": "failed", "colours": "created", "users": "failed"}
        errors = {r.table_name: r.error for r in ingest_folder(spark, str(landing), "ingest_test").collect()}
        assert "xEND" in errors["users"]  # the whole error, with the bad value
        again = {r.table_name: (r.status, r.error is None) for r in ingest_folder(spark, str(landing), "ingest_test").collect()}
        assert again["colours"] == ("exists", True) and again["orders"] == ("failed", False)
        assert rows(spark.table("ingest_test.colours")) == [("red, dark", "007")]
    finally:
        spark.sql("DROP DATABASE ingest_test CASCADE")


def test_views_and_full_refresh(spark, folder):
    create_views({"some_numbers": spark.range(4)})
    assert spark.sql("SELECT sum(id) FROM some_numbers").first()[0] == 6
    refresh_table(spark, spark.range(4), folder)
    assert rows(refresh_table(spark, spark.range(2), folder)) == [(0,), (1,)]


def test_durable_root_is_the_one_the_session_names(spark):
    root = session.durable_root(spark)
    named = spark.conf.get(session.CHECKPOINT_CONF, None)
    assert root in (named, spark.sparkContext.getCheckpointDir())
    assert session.fresh_folder(spark, "x") != session.fresh_folder(spark, "x")
    assert rows(session.durable(spark.range(2))) == [(0,), (1,)]
