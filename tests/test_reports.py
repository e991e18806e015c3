import datetime as dt

from basketry.operators import ranking, reports
from basketry.schemas import PURCHASE

from conftest import rows

T1 = dt.datetime(2025, 1, 1, 10, 0)
T2 = dt.datetime(2025, 1, 2, 11, 0)


def _purchases(spark, data):
    return spark.createDataFrame(data, PURCHASE)


def _products(spark, data):
    return spark.createDataFrame(data, "product_id string, name string, category string, price double")


def test_revenue_by_category_unknown_and_null_category(spark):
    p = _purchases(spark, [
        ("o1", "c1", "p1", 2, 10.0, T1), ("o1", "c1", "p2", 1, 5.0, T1),  # same purchase, two lines
        ("o2", "c2", "p9", 1, 7.0, T2),  # unknown product
        ("o3", "c2", "p3", 3, 1.0, T2),  # product with NULL category
    ])
    pr = _products(spark, [("p1", "A", "toys", 99.0), ("p2", "B", "toys", 99.0), ("p3", "C", None, 1.0)])
    out = rows(reports.revenue_by_category(p, pr))
    assert out == [("N/A", 10.0, 2), ("toys", 25.0, 1)]  # fact price, not product price


def test_revenue_unchanged_without_products(spark):
    p = _purchases(spark, [("o1", "c1", "p1", 2, 10.0, T1), ("o2", "c2", "p2", 1, 5.0, T2)])
    pr = _products(spark, [("p1", "A", "toys", 1.0)])
    total = sum(r.total_revenue for r in reports.revenue_by_category(p, pr).collect())
    empty = sum(r.total_revenue for r in reports.revenue_by_category(p, pr.limit(0)).collect())
    assert total == empty == 25.0


def test_top_clients_counts_rows_and_breaks_ties(spark):
    p = _purchases(spark, [("o1", "b", "p", 1, 1.0, T1), ("o1", "b", "q", 1, 1.0, T1),
                           ("o2", "a", "p", 1, 1.0, T1), ("o3", "a", "p", 1, 1.0, T1),
                           ("o4", "c", "p", 1, 1.0, T1)])
    out = [tuple(r) for r in reports.top_clients(p, 2).collect()]
    assert out == [("a", 2), ("b", 2)]  # two rows for b's one purchase; tie broken by id


def test_avg_check_by_day_two_levels_and_null_time(spark):
    p = _purchases(spark, [("o1", "c", "p", 2, 10.0, T1), ("o1", "c", "q", 1, 5.0, T1),
                           ("o2", "c", "p", 1, 15.0, T1.replace(hour=20)),
                           ("o3", "c", "p", 1, 4.0, None)])
    out = rows(reports.avg_check_by_day(p))
    assert out == [(None, 4.0, 1), (dt.date(2025, 1, 1), 20.0, 2)]


def test_top_selling_products_keeps_ties(spark):
    p = _purchases(spark, [("o1", "c", "p1", 5, 1.0, T1), ("o2", "c", "p2", 5, 1.0, T1),
                           ("o3", "c", "p3", 3, 1.0, T1), ("o4", "c", "p4", 1, 1.0, T1)])
    pr = _products(spark, [("p1", "one", "x", 1.0), ("p3", "three", "x", 1.0)])
    out = [tuple(r) for r in reports.top_selling_products(p, pr, 2).collect()]
    assert out == [("p1", "one", 5, 1), ("p2", "Unknown", 5, 1), ("p3", "three", 3, 2)]


def test_top_n_with_ties_all_tied_and_nulls(spark):
    df = spark.createDataFrame([(f"k{i}", 7) for i in range(50)] + [("a", 9), ("n", None)], "k string, v long")
    out = ranking.top_n_with_ties(df, "v", 2).collect()
    assert len(out) == 51 and {r.rank for r in out if r.k != "a"} == {2}
    out3 = {r.k: r.rank for r in ranking.top_n_with_ties(df, "v", 3).collect()}
    assert out3["n"] == 3 and len(out3) == 52  # NULL ranks last, as in dense_rank desc


def test_top_n_exact_and_tie_break(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k string, v long")
    assert [r.k for r in ranking.top_n(df, "v", "k", 2).collect()] == ["c", "a"]
    assert sorted(r.k for r in ranking.top_n_with_ties(df, "v", 2).collect()) == ["a", "b", "c"]


def test_constraint_report_rules(spark):
    from basketry.operators import quality
    clients = spark.createDataFrame(
        [("1", "a", "b", "x@y.com", None), ("1", None, "b", "bad-email", "123456789012345678901"),
         ("2", "c", "d", "x@y.com", None)],
        "client_id string, first_name string, last_name string, email string, phone string")
    parent = spark.createDataFrame([("1",)], "client_id string")
    rules = quality.Rules(not_null=["first_name"], unique=["client_id", "email"], max_length={"phone": 20},
                          pattern={"email": quality.EMAIL_PATTERN}, castable={"client_id": "int"},
                          foreign_keys={"client_id": (parent, "client_id")})
    got = {(r.rule, r.column): r.violations for r in quality.constraint_report(clients, "c", rules).collect()}
    assert got == {("not_null", "first_name"): 1, ("max_length", "phone"): 1, ("pattern", "email"): 1,
                   ("type", "client_id"): 0, ("unique", "client_id"): 1, ("unique", "email"): 1,
                   ("foreign_key", "client_id"): 1}


def test_latest_products_keeps_newest(spark):
    from basketry.operators.stage import latest_products
    from basketry.schemas import PRODUCT
    pr = spark.createDataFrame([
        ("p1", "old", "x", 1.0, 1, "2024-01-01T00:00:00+00:00"),
        ("p1", "new", "y", 2.0, 1, "2024-02-01T00:00:00Z"),
        ("p1", "bad", "z", 3.0, 1, "not a time"),
        ("p2", "only", "x", 1.0, 1, None)], PRODUCT)
    got = {r.product_id: (r.name, r.category) for r in latest_products(pr).collect()}
    assert got == {"p1": ("new", "y"), "p2": ("only", "x")}
    assert latest_products(pr).columns == pr.columns
