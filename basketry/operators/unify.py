"""Unified purchase record (X1, J3): each purchase with its client and
product as nested structs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unified(purchases: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    """client{client_id, first_name, last_name, email},
    purchase{purchase_id, product_id, quantity, price, timestamp},
    product{product_id, name, category, price}.

    Two left joins: every purchase is kept; an unknown client or product
    leaves NULL fields (the ids come from the purchase, so they stay).
    Dimensions are pruned to the columns the structs need before joining;
    the planner broadcasts them when small and AQE splits skewed keys of
    the sort-merge join otherwise."""
    c = clients.select("client_id", "first_name", "last_name", "email")
    p = products.select("product_id", F.col("name").alias("_p_name"),
                        F.col("category").alias("_p_category"), F.col("price").alias("_p_price"))
    joined = (purchases.select("purchase_id", "client_id", "product_id", "quantity", "price", "timestamp")
              .join(c, "client_id", "left").join(p, "product_id", "left"))
    return joined.select(
        F.struct("client_id", "first_name", "last_name", "email").alias("client"),
        F.struct("purchase_id", "product_id", "quantity", "price", "timestamp").alias("purchase"),
        F.struct("product_id", F.col("_p_name").alias("name"), F.col("_p_category").alias("category"),
                 F.col("_p_price").alias("price")).alias("product"),
    )


def flatten_unified(u: DataFrame) -> DataFrame:
    """One flat row per purchase (for CSV output or comparison)."""
    return u.select(
        "purchase.purchase_id", "client.client_id", "purchase.product_id", "purchase.quantity",
        "purchase.price", "purchase.timestamp", "client.first_name", "client.last_name", "client.email",
        F.col("product.name").alias("product_name"), F.col("product.category").alias("category"),
        F.col("product.price").alias("product_price"))
