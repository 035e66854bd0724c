"""Raw tables derived from star-schema parquet files (customer, orders, lineitem, ...).

The mapping keeps every source row and adds a few deliberate faults, so the
quality checks have something to find. Each table is a narrow projection: no
shuffle, and unused columns never leave the parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.sources.raw import RawTables, exchange_rates

_L, _S, _D, _I, _TS = (
    T.LongType(),
    T.StringType(),
    T.DoubleType(),
    T.IntegerType(),
    T.TimestampNTZType(),
)

FILES = {
    "customer": {"c_custkey": _L, "c_name": _S, "c_nationkey": _I, "c_acctbal": _D, "c_mktsegment": _S},
    "nation": {"n_nationkey": _I, "n_name": _S, "n_regionkey": _I},
    "orders": {
        "o_orderkey": _L,
        "o_custkey": _L,
        "o_orderstatus": _S,
        "o_totalprice": _D,
        "o_orderdate": _TS,
        "o_orderpriority": _S,
    },
    "lineitem": {
        "l_orderkey": _L,
        "l_partkey": _L,
        "l_suppkey": _L,
        "l_linenumber": _I,
        "l_quantity": _D,
        "l_extendedprice": _D,
        "l_discount": _D,
        "l_tax": _D,
        "l_returnflag": _S,
        "l_linestatus": _S,
        "l_shipdate": _TS,
    },
    "part": {"p_partkey": _L, "p_name": _S, "p_brand": _S, "p_type": _S, "p_size": _I, "p_retailprice": _D},
    "events": {"event_id": _L, "ts": _TS, "user_id": _L, "event_type": _S, "value": _D, "props": _S},
}

CATEGORIES = ("Living Room", "Bedroom", "Kitchen")
PAYMENT_METHODS = ("credit card", "paypal", "bank transfer")
STATE_BY_NATION = {
    0: "AK", 1: "PR", 3: "QC", 5: "HI", 8: "ON", 10: "CA", 13: "BC", 15: "NY", 18: "QC", 20: "TX", 23: "AB",
}
PUERTO_RICO_NATION = 1


def file_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, kind, True) for c, kind in FILES[name].items()])


def read_file(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(file_schema(name)).parquet(f"{folder}/{name}.parquet")


def _case(subject: str, values: Mapping[int, str], otherwise: str) -> str:
    branches = " ".join(f"WHEN {key} THEN '{value}'" for key, value in values.items())
    return f"CASE {subject} {branches} ELSE '{otherwise}' END"


def users(customer: DataFrame) -> DataFrame:
    """Every tenth user registers with the email of the one before."""
    return customer.selectExpr(
        "CAST(c_custkey AS STRING) AS user_id",
        "substring_index(c_name, '#', 1) AS first_name",
        "substring_index(c_name, '#', -1) AS last_name",
        "concat('user', CAST(IF(c_custkey % 10 = 9, c_custkey - 1, c_custkey) AS STRING), '@example.com') AS email",
        "TIMESTAMP_NTZ'2023-01-01 00:00:00' + make_dt_interval(0, CAST(c_custkey % 17520 AS INT)) AS created_at",
        "concat('L', CAST(c_custkey AS STRING)) AS location_id",
    )


def locations(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, F.expr("c_nationkey = n_nationkey")).selectExpr(
        "concat('L', CAST(c_custkey AS STRING)) AS location_id",
        "CASE WHEN n_regionkey <= 2 THEN 'US' WHEN n_regionkey = 3 THEN 'CA' ELSE 'MX' END AS country_code",
        "CASE WHEN n_regionkey <= 2 THEN 'United States' WHEN n_regionkey = 3 THEN 'Canada' ELSE 'Mexico' END"
        " AS country_full_name",
        "concat('City ', CAST(n_nationkey AS STRING)) AS city",
        "concat(CAST(c_custkey AS STRING), ' Main Street') AS address",
        f"IF(n_nationkey = {PUERTO_RICO_NATION}, concat('009', lpad(CAST(c_custkey % 100 AS STRING), 2, '0')),"
        " CAST(10000 + c_custkey % 90000 AS STRING)) AS zip_code",
        f"{_case('n_nationkey', STATE_BY_NATION, 'WA')} AS state",
    )


def orders(source: DataFrame) -> DataFrame:
    return source.selectExpr(
        "CAST(o_orderkey AS STRING) AS order_id",
        "CAST(o_custkey AS STRING) AS user_id",
        "o_orderdate AS order_date",
        "CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'"
        " WHEN o_orderpriority = '1-URGENT' THEN 'cancelled' WHEN o_orderpriority = '2-HIGH' THEN 'pending_refund'"
        " ELSE 'pending' END AS order_status",
        f"{_case('o_orderkey % 3', dict(enumerate(PAYMENT_METHODS[:-1])), PAYMENT_METHODS[-1])} AS payment_method",
        "o_orderdate + make_dt_interval(CAST(o_orderkey % 30 AS INT)) AS updated_at",
    )


def order_items(lineitem: DataFrame) -> DataFrame:
    """The line number repeats within an order, so the key joins six columns.

    The total is computed in whole cents; every thousandth order is a unit off.
    """
    return (
        lineitem.selectExpr(
            "*",
            "CAST(rint(l_quantity) AS INT) AS quantity",
            "CAST(rint(l_extendedprice * 100) AS BIGINT) AS price_cents",
            "10000 - CAST(rint(l_discount * 10000) AS BIGINT) AS kept",
        )
        .selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, price_cents,"
            " unix_date(CAST(l_shipdate AS DATE))) AS order_item_id",
            "CAST(l_orderkey AS STRING) AS order_id",
            "CAST(l_partkey AS STRING) AS product_id",
            "quantity",
            "l_extendedprice AS unit_price",
            "l_discount AS discount",
            "((quantity * price_cents * kept + 5000) DIV 10000 + IF(l_orderkey % 1000 = 0, 100, 0)) / 100.0D AS line_total",
        )
    )


def products(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_name AS name",
        f"{_case('p_size % 3', dict(enumerate(CATEGORIES[:-1])), CATEGORIES[-1])} AS category",
        "CAST(NULL AS STRING) AS description",
        "p_retailprice AS price",
        "CAST(NULL AS STRING) AS dimensions",
        "p_brand AS material",
        "p_size AS stock",
        "CAST(p_partkey AS STRING) AS id",
    )


def user_events(events: DataFrame) -> DataFrame:
    """Purchases and errors keep their type, which the accepted values do not know."""
    return events.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CAST(user_id AS STRING) AS user_id",
        "CASE event_type WHEN 'signup' THEN 'user_sign_up' WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'"
        " ELSE event_type END AS event_type",
        "ts AS event_timestamp",
        "CASE WHEN event_type = 'signup' THEN '/signup' WHEN event_type = 'click' THEN '/product/add_to_cart'"
        " WHEN event_type = 'purchase' THEN '/checkout' WHEN event_type = 'view' AND event_id % 2 = 1 THEN '/product'"
        " WHEN event_type = 'view' THEN '/catalog' ELSE '/error' END AS page_url",
        "IF(event_type = 'click' OR (event_type = 'view' AND event_id % 2 = 1), CAST(event_id % 200 AS STRING), NULL)"
        " AS product_id",
        "props AS additional_details",
    )


def raw_tables(spark: SparkSession, folder: str) -> RawTables:
    read = partial(read_file, spark, folder)
    return RawTables(
        spark,
        users=lambda: users(read("customer")),
        locations=lambda: locations(read("customer"), read("nation")),
        products=lambda: products(read("part")),
        orders=lambda: orders(read("orders")),
        order_items=lambda: order_items(read("lineitem")),
        user_events=lambda: user_events(read("events")),
        exchange_rates=lambda: exchange_rates(spark),
    )
