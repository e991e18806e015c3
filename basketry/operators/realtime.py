"""Queries over the real-time tables (purchases_rt, products_rt, sellers_rt):
lists, point lookups and aggregates (P6-P9, A5-A9, A11).

Filters are Column expressions built from values (never SQL text), so they
reach the Parquet scan as pushed filters and cannot be injected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import amount, exact_cents_avg, hour_of_day, iso_seconds, money, month_label, month_start
from .ranking import top_n

PRODUCT_COLUMNS = ("product_id", "name", "category", "price", "description", "seller_id")
SELLER_COLUMNS = ("seller_id", "name", "email", "phone", "address")
PURCHASE_COLUMNS = ("purchase_id", "client_id", "product_id", "quantity", "price")


def _given(v) -> bool:
    # Empty text means "no filter", as in the reference's optional parameters.
    return v is not None and v != ""


def _sum_money(c, cents: bool):
    return money(F.sum(c)) if cents else F.sum(c)


def list_products(products: DataFrame, category: str | None = None,
                  seller_id: str | None = None) -> DataFrame:
    """Products, optionally filtered by category and/or seller."""
    df = products
    if _given(category):
        df = df.where(F.col("category") == F.lit(category))
    if _given(seller_id):
        df = df.where(F.col("seller_id") == F.lit(seller_id))
    return df.select(*PRODUCT_COLUMNS)


def list_sellers(sellers: DataFrame) -> DataFrame:
    """All sellers, five columns."""
    return sellers.select(*SELLER_COLUMNS)


def get_seller(sellers: DataFrame, seller_id: str) -> DataFrame:
    """One seller by id; an empty result means not found."""
    return list_sellers(sellers.where(F.col("seller_id") == F.lit(seller_id))).limit(1)


def list_purchases(rt: DataFrame, client_id: str | None = None, product_id: str | None = None,
                   start=None, end=None, ts: str = "ts", day_col: str = "dt") -> DataFrame:
    """Purchases filtered by client, product and an inclusive time range,
    newest first, time rendered as ``yyyy-MM-ddTHH:mm:ssZ``.

    ``start``/``end`` are timestamps or ISO text; a bare date means midnight
    (as the reference compares the text against the timestamp column).
    When the table carries its day partition column ``day_col`` (the
    ingested real-time table's ``dt``), the implied day bounds are added so
    whole day directories are pruned."""
    df = rt
    if _given(client_id):
        df = df.where(F.col("client_id") == F.lit(client_id))
    if _given(product_id):
        df = df.where(F.col("product_id") == F.lit(product_id))
    days = day_col in df.columns
    if _given(start):
        df = df.where(F.col(ts) >= F.lit(start).cast("timestamp"))
        if days:
            df = df.where(F.col(day_col) >= F.to_date(F.lit(start).cast("timestamp")))
    if _given(end):
        df = df.where(F.col(ts) <= F.lit(end).cast("timestamp"))
        if days:
            df = df.where(F.col(day_col) <= F.to_date(F.lit(end).cast("timestamp")))
    return (df.orderBy(F.desc(ts), F.asc("purchase_id"))
              .select(*PURCHASE_COLUMNS, iso_seconds(ts).alias("timestamp")))


def rt_top_products(rt: DataFrame, limit: int = 10, cents: bool = False) -> DataFrame:
    """A5: top products by quantity with their revenue, exactly ``limit`` rows."""
    agg = rt.groupBy("product_id").agg(
        F.sum("quantity").cast("long").alias("total_quantity"),
        _sum_money(amount(), cents).alias("total_revenue"))
    return top_n(agg, "total_quantity", "product_id", limit)


def rt_sales_by_month(rt: DataFrame, ts: str = "ts", descending: bool = True,
                      label: bool = True, cents: bool = False) -> DataFrame:
    """Rows, quantity and revenue per calendar month.

    API form (default): month as ``yyyy-MM`` text, newest first. Dashboard
    form: ``label=False, descending=False`` gives the month-start DATE,
    oldest first."""
    agg = (rt.groupBy(month_start(ts).alias("month"))
             .agg(F.count(F.lit(1)).alias("total_purchases"),
                  F.sum("quantity").cast("long").alias("total_quantity"),
                  _sum_money(amount(), cents).alias("total_revenue")))
    agg = agg.orderBy(F.desc("month") if descending else F.asc("month"))
    if label:
        agg = agg.select(month_label("month").alias("month"), "total_purchases",
                         "total_quantity", "total_revenue")
    return agg


def rt_client_statistics(rt: DataFrame, client_id: str, cents: bool = False) -> DataFrame:
    """Rows, quantity, spend and unweighted average price for one client;
    no row when the client has no purchases."""
    avg_price = exact_cents_avg("price") if cents else F.avg("price")
    return (rt.where(F.col("client_id") == F.lit(client_id))
              .groupBy("client_id")
              .agg(F.count(F.lit(1)).alias("total_purchases"),
                   F.sum("quantity").cast("long").alias("total_quantity"),
                   _sum_money(amount(), cents).alias("total_spent"),
                   avg_price.alias("avg_price")))


def rt_revenue_by_hour(rt: DataFrame, ts: str = "ts", cents: bool = False) -> DataFrame:
    """Revenue per hour of day (0-23), all days pooled; hours without
    sales are absent."""
    return (rt.groupBy(hour_of_day(ts).alias("hour"))
              .agg(_sum_money(amount(), cents).alias("revenue"))
              .orderBy("hour"))


def rt_grand_totals(rt: DataFrame, cents: bool = False) -> DataFrame:
    """Total revenue, quantity and purchase rows (one row)."""
    return rt.agg(_sum_money(amount(), cents).alias("total_revenue"),
                  F.sum("quantity").cast("long").alias("total_quantity"),
                  F.count(F.lit(1)).alias("total_purchases"))


def rt_count(rt: DataFrame) -> DataFrame:
    """Row count of the real-time table (one row)."""
    return rt.agg(F.count(F.lit(1)).alias("rows"))
