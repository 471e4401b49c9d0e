"""Table schemas, the change-event vocabulary and the captured-table specs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Operation codes of a change event.
UPSERT_OPS = ("c", "u", "r")
DELETE_OP = "d"

# Row kinds of a change feed.
INSERT, DELETE = "insert", "delete"
UPDATE_BEFORE, UPDATE_AFTER = "update_preimage", "update_postimage"

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DateType(), T.BooleanType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# What a Kafka reader delivers; file landings keep the same shape.
KAFKA = _struct(
    key=T.BinaryType(), value=T.BinaryType(), topic=S, partition=I, offset=L,
    timestamp=T.TimestampType(), timestampType=I,
)
BRONZE = _struct(topic=S, k=S, v=S, kafka_ts=T.TimestampType(), kafka_partition=I, kafka_offset=L)
SILVER_CUSTOMERS = _struct(
    customer_id=S, customer_unique_id=S, customer_city=S, customer_state=S, _last_ts_ms=L,
)
# A customer event as quarantined.
REJECTED = _struct(
    op=S, ts_ms=L, customer_id=S, customer_unique_id=S, customer_city=S, customer_state=S, kafka_partition=I, kafka_offset=L,
)
DIM_CUSTOMERS = _struct(
    customer_id=S, customer_unique_id=S, customer_city=S, customer_state=S,
    effective_start_ts_ms=L, effective_end_ts_ms=L, is_current=B,
)
FACT_ORDERS = _struct(order_id=S, customer_id=S, order_status=S, event_ts_ms=L, event_date=D)
# What writers see besides: where a row's last event stands in the stream, and whether it
# was a delete. Such tombstones keep an older upsert from reviving the row.
POSITION = _struct(_partition=I, _offset=L, _deleted=B)
SILVER_STATE = T.StructType(SILVER_CUSTOMERS.fields + POSITION.fields)
FACT_STATE = T.StructType(FACT_ORDERS.fields + POSITION.fields)
HISTORY_STATE = T.StructType(DIM_CUSTOMERS.fields + POSITION.fields + _struct(_opens=B).fields)
FACT_CHANGES = T.StructType(FACT_ORDERS.fields + [T.StructField("_change_type", S, True)])
AGG_ORDERS_DAILY = _struct(event_date=D, order_status=S, order_cnt=L)
MART_DAILY_ORDERS = _struct(event_date=D, customer_state=S, order_status=S, order_count=L)
MART_ORDERS_BY_STATE = _struct(event_date=D, customer_state=S, orders_cnt=L)
ORDERS_ENRICHED = T.StructType(FACT_ORDERS.fields + _struct(customer_city=S, customer_state=S).fields)


@dataclass(frozen=True, eq=False)
class CdcTableSpec:
    """How the rows of one captured table are read out of its change events.

    ``keys`` and ``carried`` come from ``after`` and fall back to ``before``, so a
    delete keeps them; ``attrs`` come from ``after`` only. ``casts`` names the
    columns that are not strings; ``micros`` are epoch microseconds without zone.
    """

    table: str
    keys: tuple[str, ...]
    attrs: tuple[str, ...]
    carried: tuple[str, ...] = ()
    casts: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> tuple[str, ...]:
        return self.keys + self.carried + self.attrs

    def topic(self, prefix: str = "shop") -> str:
        return f"{prefix}.public.{self.table}"


CUSTOMERS = CdcTableSpec(
    "customers", ("customer_id",), ("customer_unique_id", "customer_city", "customer_state"),
)
ORDERS = CdcTableSpec("orders", ("order_id",), ("order_status",), carried=("customer_id",))
PRODUCTS = CdcTableSpec(
    "products", ("product_id",), ("product_category", "product_weight_g"),
    casts={"product_weight_g": "int"},
)
ORDER_ITEMS = CdcTableSpec(
    "order_items", ("order_id", "order_item_id"), ("product_id", "price", "shipping_limit_dt"),
    casts={"order_item_id": "int", "price": "decimal(10,2)", "shipping_limit_dt": "micros"},
)
CAPTURED = (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS)
