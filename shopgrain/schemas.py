"""Explicit schemas of the raw tables.

Never inferred: inference turns zip codes into numbers and ``00901`` into
``901``, after which the Puerto Rico prefix no longer matches.
"""

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _D, _I, _TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()

USERS = _schema(user_id=_S, first_name=_S, last_name=_S, email=_S, created_at=_TS, location_id=_S)

LOCATIONS = _schema(
    location_id=_S, country_code=_S, country_full_name=_S, city=_S, address=_S, zip_code=_S, state=_S
)

PRODUCTS = _schema(
    name=_S, category=_S, description=_S, price=_D, dimensions=_S, material=_S, stock=_I, id=_S
)

ORDERS = _schema(
    order_id=_S, user_id=_S, order_date=_TS, order_status=_S, payment_method=_S, updated_at=_TS
)

ORDER_ITEMS = _schema(
    order_item_id=_S, order_id=_S, product_id=_S, quantity=_I, unit_price=_D, discount=_D, line_total=_D
)

USER_EVENTS = _schema(
    event_id=_S,
    user_id=_S,
    event_type=_S,
    event_timestamp=_TS,
    page_url=_S,
    product_id=_S,
    additional_details=_S,
)

EXCHANGE_RATES = _schema(
    currency_code=_S, exchange_rate_to_usd=_D, rate_date=T.DateType(), notes=_S
)

RAW = {
    "users": USERS,
    "locations": LOCATIONS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "user_events": USER_EVENTS,
}

SEEDS = {"exchange_rates": EXCHANGE_RATES}
