"""Explicit schemas for every entity.

Rule: pipelines never infer a schema, including when reading CSV reports
back. Ids are strings everywhere (the reference's own examples use ids such
as ``p-001`` next to a UUID-typed model).
"""

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TS, DATE = T.TimestampType(), T.DateType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# JSON purchase message as read off the topic. ``price`` is read as text
# and converted with try_cast so "9.5" and 9.5 are both accepted; quantity
# stays integer so 2.5 or "3" decode to NULL.
PURCHASE_MESSAGE = _struct(
    ("purchase_id", S, True),
    ("client_id", S, True),
    ("product_id", S, True),
    ("quantity", I, True),
    ("price", S, True),
    ("timestamp", S, True),
)

# Stage purchases (batch): nullable, time column named ``timestamp``.
PURCHASE = _struct(
    ("purchase_id", S, True),
    ("client_id", S, True),
    ("product_id", S, True),
    ("quantity", I, True),
    ("price", D, True),
    ("timestamp", TS, True),
)

# Real-time purchases: no NULLs, time column named ``ts``.
PURCHASE_RT = _struct(
    ("purchase_id", S, False),
    ("client_id", S, False),
    ("product_id", S, False),
    ("quantity", I, False),
    ("price", D, False),
    ("ts", TS, False),
)

CLIENT = _struct(
    ("client_id", S, False),
    ("first_name", S, False),
    ("last_name", S, False),
    ("email", S, False),
    ("phone", S, True),
    ("address", S, True),
    ("registration_date", TS, False),
    ("status", S, False),
)

SELLER = _struct(
    ("seller_id", S, False),
    ("name", S, False),
    ("contact_email", S, True),
    ("contact_phone", S, True),
    ("rating", T.DecimalType(3, 2), True),
    ("joined_date", TS, False),
)

# Product files (Parquet): updated_at is ISO text with zone.
PRODUCT = _struct(
    ("product_id", S, False),
    ("name", S, True),
    ("category", S, True),
    ("price", D, True),
    ("available_stock", L, True),
    ("updated_at", S, True),
)

PRODUCT_RT = _struct(
    ("product_id", S, False),
    ("name", S, True),
    ("category", S, True),
    ("price", D, True),
    ("description", S, True),
    ("seller_id", S, True),
)

SELLER_RT = _struct(
    ("seller_id", S, False),
    ("name", S, True),
    ("email", S, True),
    ("phone", S, True),
    ("address", S, True),
)

# Topic record, same columns the Kafka source yields (value in bytes).
TOPIC_RECORD = _struct(
    ("key", S, True),
    ("value", T.BinaryType(), True),
    ("topic", S, True),
    ("partition", I, True),
    ("offset", L, True),
    ("timestamp", TS, True),
)

# Stage tables: the entity plus its load date.
STAGE = {n: T.StructType([T.StructField(f.name, f.dataType) for f in s.fields] + [T.StructField("load_date", DATE)])
         for n, s in (("clients", CLIENT), ("sellers", SELLER), ("products", PRODUCT), ("purchases", PURCHASE))}

# Reports as written to CSV, used to read them back without inference.
REPORTS = {
    "revenue_by_category": _struct(
        ("category", S, True), ("total_revenue", D, True), ("total_purchases", L, True)
    ),
    "top_clients": _struct(("client_id", S, True), ("purchase_count", L, True)),
    "avg_check_by_day": _struct(
        ("date", DATE, True), ("avg_check", D, True), ("purchases_per_day", L, True)
    ),
    "top_selling_products": _struct(
        ("product_id", S, True), ("name", S, True), ("total_sales", L, True), ("rank", L, True)
    ),
}

DEAD_LETTER = _struct(
    ("value", S, True),
    ("reason", S, False),
)
