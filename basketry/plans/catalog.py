"""Named queries: each builds the adapters from the given test tables and
runs one library operator over them. ``QUERIES[name](spark, sf_dir)`` returns
a DataFrame; ``oracle.SQL[name]`` is the matching DuckDB SQL when one exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import realtime as rt_ops
from ..operators import reports
from . import fixtures as fx
from . import params as P
from .oracle import oracle

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    """Register ``fn(spark, sf_dir)`` under ``name``. Days, hours and the
    test tables' zone-less timestamps are read in UTC."""
    def register(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return register


# ---------------------------------------------------------------- reports
@query("revenue_by_category")
def q_revenue_by_category(spark, d):
    return reports.revenue_by_category(fx.purchases(spark, d), fx.listed_products(spark, d), cents=True)


oracle("revenue_by_category", "purchases listed_products", """
SELECT COALESCE(pr.category, 'N/A') AS category,
       ROUND(SUM(p.quantity * p.price), 2) AS total_revenue,
       COUNT(DISTINCT p.purchase_id) AS total_purchases
FROM purchases p LEFT JOIN listed_products pr ON p.product_id = pr.product_id
GROUP BY 1 ORDER BY total_revenue DESC, category""")


@query("top_clients")
def q_top_clients(spark, d):
    return reports.top_clients(fx.purchases(spark, d), P.TOP_N)


oracle("top_clients", "purchases", f"""
SELECT client_id, COUNT(*) AS purchase_count FROM purchases
GROUP BY client_id ORDER BY purchase_count DESC, client_id LIMIT {P.TOP_N}""")


@query("avg_check_by_day")
def q_avg_check_by_day(spark, d):
    return reports.avg_check_by_day(fx.purchases(spark, d), exact_cents=True)


oracle("avg_check_by_day", "purchases", """
SELECT CAST("timestamp" AS DATE) AS "date",
       CAST(SUM(CAST(purchase_total AS DECIMAL(18,2))) AS DOUBLE) / COUNT(purchase_total) AS avg_check,
       COUNT(DISTINCT purchase_id) AS purchases_per_day
FROM totals GROUP BY 1 ORDER BY 1""", extra="""totals AS (
  SELECT purchase_id, "timestamp", SUM(quantity * price) AS purchase_total
  FROM purchases GROUP BY purchase_id, "timestamp")""")


@query("top_selling_products")
def q_top_selling_products(spark, d):
    return reports.top_selling_products(fx.purchases(spark, d), fx.listed_products(spark, d), P.TOP_N)


oracle("top_selling_products", "purchases listed_products", f"""
SELECT r.product_id, COALESCE(pr.name, 'Unknown') AS name, r.total_sales, CAST(r."rank" AS BIGINT) AS "rank"
FROM ranked r LEFT JOIN listed_products pr ON r.product_id = pr.product_id
WHERE r."rank" <= {P.TOP_N} ORDER BY "rank", product_id""", extra="""ranked AS (
  SELECT product_id, total_sales, DENSE_RANK() OVER (ORDER BY total_sales DESC) AS "rank"
  FROM (SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS total_sales FROM purchases GROUP BY product_id))""")


# ------------------------------------------------------- real-time queries
@query("rt_top_products")
def q_rt_top_products(spark, d):
    return rt_ops.rt_top_products(fx.purchases_rt(spark, d), P.TOP_N, cents=True)


oracle("rt_top_products", "purchases_rt", f"""
SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       ROUND(SUM(quantity * price), 2) AS total_revenue
FROM purchases_rt GROUP BY product_id ORDER BY total_quantity DESC, product_id LIMIT {P.TOP_N}""")


@query("rt_sales_by_month")
def q_rt_sales_by_month(spark, d):
    # The real-time fixture covers one month, so months come from purchases.
    return rt_ops.rt_sales_by_month(fx.purchases(spark, d), ts="timestamp", cents=True)


oracle("rt_sales_by_month", "purchases", """
SELECT strftime(CAST(date_trunc('month', "timestamp") AS DATE), '%Y-%m') AS "month",
       COUNT(*) AS total_purchases, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       ROUND(SUM(quantity * price), 2) AS total_revenue
FROM purchases GROUP BY 1 ORDER BY 1 DESC""")


@query("rt_sales_by_month_dashboard")
def q_rt_sales_by_month_dashboard(spark, d):
    return rt_ops.rt_sales_by_month(fx.purchases(spark, d), ts="timestamp", descending=False,
                                    label=False, cents=True)


oracle("rt_sales_by_month_dashboard", "purchases", """
SELECT CAST(date_trunc('month', "timestamp") AS DATE) AS "month",
       COUNT(*) AS total_purchases, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       ROUND(SUM(quantity * price), 2) AS total_revenue
FROM purchases GROUP BY 1 ORDER BY 1""")


@query("rt_client_statistics")
def q_rt_client_statistics(spark, d):
    return rt_ops.rt_client_statistics(fx.purchases_rt(spark, d), P.STAT_CLIENT, cents=True)


oracle("rt_client_statistics", "purchases_rt", f"""
SELECT client_id, COUNT(*) AS total_purchases, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       ROUND(SUM(quantity * price), 2) AS total_spent,
       CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / COUNT(price) AS avg_price
FROM purchases_rt WHERE client_id = '{P.STAT_CLIENT}' GROUP BY client_id""")


@query("rt_revenue_by_hour")
def q_rt_revenue_by_hour(spark, d):
    return rt_ops.rt_revenue_by_hour(fx.purchases_rt(spark, d), cents=True)


oracle("rt_revenue_by_hour", "purchases_rt", """
SELECT CAST(hour(ts) AS BIGINT) AS "hour", ROUND(SUM(quantity * price), 2) AS revenue
FROM purchases_rt GROUP BY 1 ORDER BY 1""")


@query("rt_grand_totals")
def q_rt_grand_totals(spark, d):
    return rt_ops.rt_grand_totals(fx.purchases_rt(spark, d), cents=True)


oracle("rt_grand_totals", "purchases_rt", """
SELECT ROUND(SUM(quantity * price), 2) AS total_revenue, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       COUNT(*) AS total_purchases
FROM purchases_rt""")


@query("rt_count")
def q_rt_count(spark, d):
    return rt_ops.rt_count(fx.purchases_rt(spark, d))


oracle("rt_count", "purchases_rt", 'SELECT COUNT(*) AS "rows" FROM purchases_rt')


_PURCHASE_LIST = """SELECT purchase_id, client_id, product_id, quantity, price,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp"
FROM purchases_rt"""


@query("list_purchases_all_filters")
def q_list_purchases_all_filters(spark, d):
    return rt_ops.list_purchases(fx.purchases_rt(spark, d), P.ALL_FILTERS_CLIENT, P.ALL_FILTERS_PRODUCT,
                                 P.ALL_FILTERS_START, P.ALL_FILTERS_END)


oracle("list_purchases_all_filters", "purchases_rt", f"""{_PURCHASE_LIST}
WHERE client_id = '{P.ALL_FILTERS_CLIENT}' AND product_id = '{P.ALL_FILTERS_PRODUCT}'
  AND ts >= TIMESTAMP '{P.ALL_FILTERS_START}' AND ts <= TIMESTAMP '{P.ALL_FILTERS_END}'
ORDER BY ts DESC, purchase_id""")


@query("list_purchases_range")
def q_list_purchases_range(spark, d):
    return rt_ops.list_purchases(fx.purchases_rt(spark, d), start=P.RANGE_START, end=P.RANGE_END)


oracle("list_purchases_range", "purchases_rt", f"""{_PURCHASE_LIST}
WHERE ts >= TIMESTAMP '{P.RANGE_START}' AND ts <= TIMESTAMP '{P.RANGE_END}'
ORDER BY ts DESC, purchase_id""")


@query("list_purchases_none")
def q_list_purchases_none(spark, d):
    return rt_ops.list_purchases(fx.purchases_rt(spark, d), client_id="", product_id=None)


oracle("list_purchases_none", "purchases_rt", f"""{_PURCHASE_LIST}
ORDER BY ts DESC, purchase_id""")


_PRODUCT_LIST = "SELECT product_id, name, category, price, description, seller_id FROM products_rt"


@query("list_products")
def q_list_products(spark, d):
    return rt_ops.list_products(fx.products_rt(spark, d), category="", seller_id="")


oracle("list_products", "products_rt", _PRODUCT_LIST)


@query("list_products_filtered")
def q_list_products_filtered(spark, d):
    return rt_ops.list_products(fx.products_rt(spark, d), P.FILTER_CATEGORY, P.FILTER_SELLER)


oracle("list_products_filtered", "products_rt", f"""{_PRODUCT_LIST}
WHERE category = '{P.FILTER_CATEGORY}' AND seller_id = '{P.FILTER_SELLER}'""")


@query("list_sellers")
def q_list_sellers(spark, d):
    return rt_ops.list_sellers(fx.sellers_rt(spark, d))


oracle("list_sellers", "sellers_rt", "SELECT seller_id, name, email, phone, address FROM sellers_rt")


@query("get_seller")
def q_get_seller(spark, d):
    return rt_ops.get_seller(fx.sellers_rt(spark, d), P.LOOKUP_SELLER)


oracle("get_seller", "sellers_rt", f"""SELECT seller_id, name, email, phone, address FROM sellers_rt
WHERE seller_id = '{P.LOOKUP_SELLER}' LIMIT 1""")
