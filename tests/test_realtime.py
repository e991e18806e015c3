import datetime as dt

from basketry.operators import realtime as R
from basketry.schemas import PURCHASE_RT

from conftest import rows


def _rt(spark):
    return spark.createDataFrame([
        ("1", "c1", "p1", 2, 10.0, dt.datetime(2024, 1, 10, 0, 0)),   # exactly at start
        ("2", "c1", "p2", 1, 5.5, dt.datetime(2024, 1, 15, 13, 30)),
        ("3", "c2", "p1", 3, 2.0, dt.datetime(2024, 1, 20, 0, 0)),    # exactly at end
        ("4", "c2", "p1", 1, 1.0, dt.datetime(2024, 1, 20, 0, 0, 1)),  # after the end
        ("5", "c3", "p3", 4, 1.25, dt.datetime(2024, 2, 1, 23, 59)),
    ], PURCHASE_RT)


def test_list_purchases_bounds_inclusive_and_newest_first(spark):
    out = R.list_purchases(_rt(spark), start="2024-01-10", end="2024-01-20").collect()
    assert [r.purchase_id for r in out] == ["3", "2", "1"]
    assert out[0].timestamp == "2024-01-20T00:00:00Z"


def test_list_purchases_empty_text_means_no_filter(spark):
    assert R.list_purchases(_rt(spark), client_id="", product_id="").count() == 5
    assert [r.purchase_id for r in R.list_purchases(_rt(spark), "c2", "p1").collect()] == ["4", "3"]


def test_client_statistics_and_not_found(spark):
    out = R.rt_client_statistics(_rt(spark), "c1").collect()
    assert [tuple(r) for r in out] == [("c1", 2, 3, 25.5, 7.75)]
    assert R.rt_client_statistics(_rt(spark), "nobody").count() == 0


def test_sales_by_month_both_forms(spark):
    api = [tuple(r) for r in R.rt_sales_by_month(_rt(spark)).collect()]
    assert api == [("2024-02", 1, 4, 5.0), ("2024-01", 4, 7, 32.5)]
    dash = [tuple(r) for r in R.rt_sales_by_month(_rt(spark), descending=False, label=False).collect()]
    assert dash[0][0] == dt.date(2024, 1, 1)


def test_revenue_by_hour_and_totals(spark):
    assert rows(R.rt_revenue_by_hour(_rt(spark))) == [(0, 27.0), (13, 5.5), (23, 5.0)]
    assert [tuple(r) for r in R.rt_grand_totals(_rt(spark)).collect()] == [(37.5, 11, 5)]
    assert R.rt_count(_rt(spark)).collect()[0].rows == 5


def test_top_products_exact_n(spark):
    out = [tuple(r) for r in R.rt_top_products(_rt(spark), 2).collect()]
    assert out == [("p1", 6, 27.0), ("p3", 4, 5.0)]


def test_products_and_sellers(spark):
    products = spark.createDataFrame(
        [("p1", "a", "toys", 1.0, None, "s1"), ("p2", "b", "toys", 2.0, "d", "s2"),
         ("p3", "c", "food", 3.0, None, "s1")],
        "product_id string, name string, category string, price double, description string, seller_id string")
    assert R.list_products(products, "", None).count() == 3
    assert [r.product_id for r in R.list_products(products, "toys", "s1").collect()] == ["p1"]
    sellers = spark.createDataFrame([("s1", "n", "e", None, "x")],
                                    "seller_id string, name string, email string, phone string, address string")
    assert R.get_seller(sellers, "s1").count() == 1
    assert R.get_seller(sellers, "zz").count() == 0  # not found: empty, no error
