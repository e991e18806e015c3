import datetime as dt

from basketry.operators import quality, unify
from basketry.operators.stage import profile
from basketry.schemas import PURCHASE

from conftest import rows


def test_unified_keeps_ids_of_unknown_dimensions(spark):
    t = dt.datetime(2024, 1, 1)
    p = spark.createDataFrame([("o1", "c1", "p1", 1, 2.0, t), ("o2", "c9", "p9", 2, 3.0, t)], PURCHASE)
    clients = spark.createDataFrame([("c1", "A", "B", "a@b.c")],
                                    "client_id string, first_name string, last_name string, email string")
    products = spark.createDataFrame([("p1", "n", "cat", 9.0)],
                                     "product_id string, name string, category string, price double")
    u = unify.unified(p, clients, products)
    assert u.columns == ["client", "purchase", "product"]
    flat = {r.purchase_id: r for r in unify.flatten_unified(u).collect()}
    assert flat["o1"].first_name == "A" and flat["o1"].product_price == 9.0 and flat["o1"].price == 2.0
    assert flat["o2"].client_id == "c9" and flat["o2"].first_name is None and flat["o2"].category is None


def test_fill_defaults_sellers(spark):
    df = spark.createDataFrame([("s1", "n", None), (None, "m", None)],
                               "seller_id string, name string, rating decimal(3,2)")
    out = quality.fill_defaults(df, "sellers").collect()
    assert all(r.seller_id for r in out) and out[0].seller_id == "s1"
    assert {float(r.rating) for r in out} == {0.0} and all(r.joined_date for r in out)


def test_profile_counts_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("c", 1)], "x string, y int")
    assert rows(profile(df)) == [("x", "string", 0, 3, 1), ("y", "int", 1, 3, 2)]
