"""Batch reports over stage tables (A1-A4).

Each returns a DataFrame and runs nothing; the caller writes or collects it
once (the reference ran every plan twice, once to save and once to print).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import amount, exact_cents_avg, money, or_default, to_day
from .ranking import top_n, top_n_with_ties


def _money_sum(c, cents: bool):
    s = F.sum(c)
    return money(s) if cents else s


def with_product(facts: DataFrame, products: DataFrame, *cols: str) -> DataFrame:
    """Left join to the product dimension on product_id.

    The dimension is pruned to the key plus the columns asked for, so the
    fact side's ``price`` is never shadowed (P12). The planner broadcasts the
    dimension when its size estimate is under the broadcast threshold, and
    adaptive execution re-checks with the real size at run time; otherwise it
    is a sort-merge join whose skewed partitions AQE splits. The dimension
    must be unique on product_id (see quality.constraint_report), or the join
    fans out."""
    dim = products.select("product_id", *cols)
    return facts.join(dim, "product_id", "left")


def revenue_by_category(purchases: DataFrame, products: DataFrame,
                        cents: bool = False) -> DataFrame:
    """A1: revenue (sum of quantity*price) and distinct purchases per
    category; unmatched or NULL category reported as ``N/A``; revenue
    descending."""
    facts = purchases.select("purchase_id", "product_id", "quantity", "price")
    return (
        with_product(facts, products, "category")
        .groupBy(or_default("category", "N/A").alias("category"))
        .agg(_money_sum(amount(), cents).alias("total_revenue"),
             F.countDistinct("purchase_id").alias("total_purchases"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def top_clients(purchases: DataFrame, limit: int = 10) -> DataFrame:
    """A2: clients with the most purchase rows (rows, not distinct
    purchases), exactly ``limit`` rows, ties by client_id."""
    counts = purchases.groupBy("client_id").agg(F.count(F.lit(1)).alias("purchase_count"))
    return top_n(counts, "purchase_count", "client_id", limit)


def avg_check_by_day(purchases: DataFrame, exact_cents: bool = False) -> DataFrame:
    """A3: per calendar day, the average purchase total and the number of
    distinct purchases. Purchase total = sum of amounts per (purchase_id,
    timestamp). Unparsable times form one group with a NULL date.

    ``exact_cents`` averages the totals summed exactly in cents (for engine
    comparison); the default is plain ``avg``."""
    totals = (purchases
              .groupBy("purchase_id", "timestamp")
              .agg(F.sum(amount()).alias("purchase_total")))
    avg = exact_cents_avg("purchase_total") if exact_cents else F.avg("purchase_total")
    return (totals
            .groupBy(to_day("timestamp").alias("date"))
            .agg(avg.alias("avg_check"),
                 F.countDistinct("purchase_id").alias("purchases_per_day"))
            .orderBy("date"))


def top_selling_products(purchases: DataFrame, products: DataFrame,
                         limit: int = 10) -> DataFrame:
    """A4: products by total quantity sold, dense-ranked, rank <= limit (ties
    may give more rows), with the product name or ``Unknown``.

    One lazy plan: the rank filter runs before the join, so only the ranked
    rows meet the dimension (same result as ranking after the join when
    products are unique). The ranking reads the totals twice, but both reads
    share one exchange, so purchases are scanned once."""
    totals = purchases.groupBy("product_id").agg(F.sum("quantity").cast("long").alias("total_sales"))
    ranked = top_n_with_ties(totals, "total_sales", limit)
    return (with_product(ranked, products, "name")
            .select("product_id", or_default("name", "Unknown").alias("name"),
                    "total_sales", "rank")
            .orderBy("rank", "product_id"))
