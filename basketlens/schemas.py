"""Declared schemas of the nine tables, the change events and the stream records."""

from __future__ import annotations

from pyspark.sql import types as T

INT, BIGINT, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
STRING, BOOLEAN, TIMESTAMP = T.StringType(), T.BooleanType(), T.TimestampType()
PRICE = T.DecimalType(18, 2)


def schema_of(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Table and column names of the shop database.
TABLES: dict[str, T.StructType] = {
    "customers": schema_of(
        customer_id=BIGINT, first_name=STRING, last_name=STRING, email=STRING, password=STRING,
        address=STRING, phone_number=STRING, created_at=TIMESTAMP, updated_at=TIMESTAMP,
    ),
    "categories": schema_of(
        category_id=BIGINT, name=STRING, description=STRING, created_at=TIMESTAMP,
    ),
    "products": schema_of(
        product_id=BIGINT, sku=STRING, name=STRING, description=STRING, price=PRICE, stock=INT,
        category_id=BIGINT, is_active=BOOLEAN, created_at=TIMESTAMP, updated_at=TIMESTAMP,
    ),
    "orders": schema_of(
        order_id=BIGINT, order_date=TIMESTAMP, total_price=PRICE, status=STRING, customer_id=BIGINT,
        payment_id=BIGINT, shipment_id=BIGINT,
    ),
    "order_items": schema_of(
        order_item_id=BIGINT, quantity=INT, price=PRICE, order_id=BIGINT, product_id=BIGINT,
    ),
    "carts": schema_of(
        cart_id=BIGINT, quantity=INT, added_at=TIMESTAMP, customer_id=BIGINT, product_id=BIGINT,
    ),
    "wishlists": schema_of(wishlist_id=BIGINT, added_at=TIMESTAMP, customer_id=BIGINT, product_id=BIGINT),
    "payments": schema_of(
        payment_id=BIGINT, payment_date=TIMESTAMP, payment_method=STRING, amount=PRICE,
        status=STRING, transaction_id=STRING, customer_id=BIGINT,
    ),
    "shipments": schema_of(
        shipment_id=BIGINT, shipment_date=TIMESTAMP, address=STRING, city=STRING, state=STRING,
        country=STRING, zip_code=STRING, status=STRING, tracking_number=STRING, customer_id=BIGINT,
        created_at=TIMESTAMP, updated_at=TIMESTAMP,
    ),
}

# Partition column of orders written by month, as YYYY-MM.
MONTH = "order_month"

# Partition column of tables without partitions of their own; its one folder is replaced as a whole.
SNAPSHOT = "snapshot"

PRIMARY_KEYS: dict[str, str] = {
    "customers": "customer_id",
    "categories": "category_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "carts": "cart_id",
    "wishlists": "wishlist_id",
    "payments": "payment_id",
    "shipments": "shipment_id",
}

# Tables whose changes are captured, and the topic prefix they are published under.
CAPTURED_TABLES = ("customers", "products", "orders", "order_items", "categories", "payments")
TOPIC_PREFIX = "ecommerce-cdc.public"

# Columns each batch job needs. ``status`` is listed because the jobs filter on it.
REQUIRED_COLUMNS: dict[str, dict[str, list[str]]] = {
    "segmentation_customer": {
        "orders": ["customer_id", "order_id", "total_price", "order_date"],
        "customers": ["customer_id", "last_name", "email"],
    },
    "product_analytics": {
        "orders": ["order_id", "total_price", "order_date", "customer_id", "status"],
        "order_items": ["order_item_id", "price", "order_id", "product_id", "quantity"],
        "categories": ["category_id", "name"],
        "products": ["product_id", "name", "category_id"],
    },
    "revenue_statistics": {
        "orders": ["order_id", "total_price", "order_date", "customer_id", "status"],
    },
    "feature_ml": {
        "orders": ["order_id", "total_price", "order_date", "customer_id"],
        "order_items": ["price", "order_id", "product_id", "quantity"],
        "customers": ["customer_id"],
        "products": ["product_id", "category_id", "price", "created_at"],
        "carts": ["customer_id", "product_id", "quantity", "added_at"],
        "wishlists": ["customer_id", "product_id", "added_at"],
    },
}

# Change metadata that the capture connector adds to every flattened record.
CHANGE_FIELDS = schema_of(__op=STRING, __table=STRING, __lsn=BIGINT, __deleted=STRING)

TOP_PRODUCT_RECORD = schema_of(
    metric=STRING, window_start=BIGINT, window_end=BIGINT, product_id=BIGINT,
    total_quantity=BIGINT, rank=INT, window_duration_minutes=DOUBLE,
)


def _as_published(field: T.StructField) -> T.StructField:
    """Change events carry money as numbers and timestamps as ISO text."""
    if isinstance(field.dataType, T.DecimalType):
        return T.StructField(field.name, T.DoubleType())
    if isinstance(field.dataType, T.TimestampType):
        return T.StructField(field.name, T.StringType())
    if isinstance(field.dataType, T.IntegerType):
        return T.StructField(field.name, T.LongType())
    return T.StructField(field.name, field.dataType)


def change_event(table: str) -> T.StructType:
    """Schema of one JSON change event of ``table``."""
    fields = [_as_published(f) for f in TABLES[table].fields] + CHANGE_FIELDS.fields
    return T.StructType([T.StructField("payload", T.StructType(fields))])


def topic(table: str) -> str:
    return f"{TOPIC_PREFIX}.{table}"
