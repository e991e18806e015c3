from pyspark.sql import functions as F

from basketry.operators import realtime as R
from basketry.operators import reports
from basketry.plans import fixtures as fx


def test_totals_agree(spark, sf_small):
    p = fx.purchases(spark, sf_small)
    months = R.rt_sales_by_month(p, ts="timestamp", label=False)
    grand = R.rt_grand_totals(p).collect()[0]
    m = months.agg(F.sum("total_revenue"), F.sum("total_quantity"), F.sum("total_purchases")).collect()[0]
    assert abs(m[0] - grand.total_revenue) < 1e-3 and m[1] == grand.total_quantity and m[2] == grand.total_purchases
    cats = reports.revenue_by_category(p, fx.products(spark, sf_small)).agg(F.sum("total_revenue")).collect()[0][0]
    assert abs(cats - grand.total_revenue) < 1e-3


def test_products_dimension_unique(spark, sf_small):
    pr = fx.products(spark, sf_small)
    assert pr.groupBy("product_id").count().where("count > 1").count() == 0
