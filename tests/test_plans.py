"""Plan shape checks: the operators compile to the physical operators the
design relies on."""

from basketry.operators import realtime as R
from basketry.operators import reports
from basketry.plans import fixtures as fx


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rank_with_ties_has_no_full_single_partition_window(spark, sf_small):
    from pyspark.sql import functions as F
    from pyspark.sql import Window

    from basketry.operators.ranking import top_n_with_ties
    totals = fx.purchases(spark, sf_small).groupBy("product_id").agg(F.sum("quantity").alias("total_sales"))
    df = top_n_with_ties(totals, "total_sales", 10)
    rank = F.dense_rank().over(Window.orderBy(F.desc("total_sales"))).cast("long")
    expected = totals.withColumn("rank", rank).where("rank <= 10")
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, expected.select(*df.columns).collect()))
    text = plan(df)
    # the only window is over the top-n distinct values; rows meet them in a broadcast join
    assert "TakeOrderedAndProject" in text and "BroadcastHashJoin" in text


def test_top_products_is_one_lazy_plan_that_scans_purchases_once(spark, sf_small):
    tracker = spark.sparkContext.statusTracker()
    p, pr = fx.purchases(spark, sf_small), fx.listed_products(spark, sf_small)
    spark.sparkContext.setJobGroup("lazy", "")
    df = reports.top_selling_products(p, pr)
    assert not tracker.getJobIdsForGroup("lazy")
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in text and text.count("FileScan parquet [l_") == 1


def test_top_n_is_take_ordered(spark, sf_small):
    df = reports.top_clients(fx.purchases(spark, sf_small))
    df.collect()
    assert "TakeOrderedAndProject" in plan(df)


def test_scan_pruned_and_filters_pushed(spark, sf_small):
    df = R.list_products(fx.products_rt(spark, sf_small), "STANDARD", "3")
    text = plan(df)
    pushed = text.split("PushedFilters: ", 1)[1].split("]", 1)[0]
    assert "EqualTo(p_type,STANDARD)" in pushed
    lineitem_schema = plan(reports.top_clients(fx.purchases(spark, sf_small)))
    assert "ReadSchema: struct<l_orderkey:bigint>" in lineitem_schema  # one column of lineitem


def test_distinct_aggregate_is_two_phase(spark, sf_small):
    df = reports.revenue_by_category(fx.purchases(spark, sf_small), fx.products(spark, sf_small))
    df.collect()
    assert "partial_count(distinct" in plan(df)
