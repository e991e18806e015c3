"""Adapters from the TPC-H-style test tables to the retail entities.

Each adapter is a DataFrame derived from whole tables, so its work grows with
the data. The DuckDB oracle uses the same definitions as CTEs (see
``basketry.plans.oracle``). All ids become strings; ``l_extendedprice`` is the
unit price so amounts stay on whole cents. ``listed_products``, which the
queries that join products use, leaves out the parts of one delisted brand, so
that the unmatched (``N/A`` / ``Unknown``) path is exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapters (shared with the oracle SQL).
PRODUCT_UPDATED_AT = "2024-01-01T00:00:00+00:00"
MASTER_TIME = "2020-01-01 00:00:00"
EMAIL_DOMAIN = "@example.com"
DELISTED_BRAND = "Brand#25"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _utc(c: str):
    # Test parquet timestamps load as timestamp_ntz; read them as UTC instants.
    return F.col(c).cast("timestamp")


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line; purchase = order (lines share id and time)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").cast("string").alias("purchase_id"),
        F.col("o_custkey").cast("string").alias("client_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        _utc("o_orderdate").alias("timestamp"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _products(table(spark, sf_dir, "part"))


def listed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _products(table(spark, sf_dir, "part").where(F.col("p_brand") != DELISTED_BRAND))


def _products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").cast("long").alias("available_stock"),
        F.lit(PRODUCT_UPDATED_AT).alias("updated_at"),
    )


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("client_id"),
        F.lit("Customer").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(EMAIL_DOMAIN)).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.col("n_name").alias("address"),
        F.to_timestamp(F.lit(MASTER_TIME)).alias("registration_date"),
        F.lit("active").alias("status"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return s.select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit(EMAIL_DOMAIN)).alias("contact_email"),
        F.lit(None).cast("string").alias("contact_phone"),
        (F.col("s_suppkey") % 6).cast("decimal(3,2)").alias("rating"),
        F.to_timestamp(F.lit(MASTER_TIME)).alias("joined_date"),
    )


def purchases_rt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events with intraday times."""
    ev = table(spark, sf_dir, "events")
    return ev.where(F.col("event_type") == "purchase").select(
        F.col("event_id").cast("string").alias("purchase_id"),
        F.col("user_id").cast("string").alias("client_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        (F.lit(1) + F.col("event_id") % 5).cast("int").alias("quantity"),
        F.col("value").alias("price"),
        _utc("ts").alias("ts"),
    )


def products_rt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.when(F.col("p_size") >= 10, F.col("p_brand")).alias("description"),
        (F.col("p_partkey") % 10).cast("string").alias("seller_id"),
    )


def sellers_rt(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit(EMAIL_DOMAIN)).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.col("n_name").alias("address"),
    )


# Dead-letter kinds planted on 'error' events, by event_id % 5 (fixed):
# 0 not JSON, 1 price "x", 2 client_id missing, 3 quantity 2.5,
# 4 timestamp "bad".
DEFECTS = ("not_json", "bad_price", "missing_field", "bad_quantity", "bad_timestamp")


def purchase_messages(rt: DataFrame) -> DataFrame:
    """Real-time rows in message form (time field named ``timestamp``)."""
    return rt.select("purchase_id", "client_id", "product_id", "quantity", "price",
                     F.col("ts").alias("timestamp"))


def defective_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 'error' event as a broken purchase message: columns
    purchase_id (the key), kind (0-4) and value (the message text)."""
    from ..operators.decode import encode_json
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    base = ev.select(
        F.col("event_id").cast("string").alias("purchase_id"),
        F.col("user_id").cast("string").alias("client_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        (F.lit(1) + F.col("event_id") % 5).cast("int").alias("quantity"),
        F.col("value").alias("price"),
        _utc("ts").alias("timestamp"),
        (F.col("event_id") % 5).cast("int").alias("kind"),
    )
    js = encode_json(base.drop("kind"))
    kind = F.col("kind")
    value = (F.when(kind == 0, F.concat(F.lit("error event "), F.col("purchase_id")))
              .when(kind == 1, F.regexp_replace(js, r'"price":[^,}]*', '"price":"x"'))
              .when(kind == 2, F.regexp_replace(js, r'"client_id":"[^"]*",', ""))
              .when(kind == 3, F.regexp_replace(js, r'"quantity":[0-9]+', '"quantity":2.5'))
              .otherwise(F.regexp_replace(js, r'"timestamp":"[^"]*"', '"timestamp":"bad"')))
    return base.select("purchase_id", "kind", value.alias("value"))
