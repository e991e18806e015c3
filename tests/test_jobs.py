import datetime as dt

from pyspark.sql import functions as F

from basketry import jobs
from basketry.operators.stage import with_load_date
from basketry.plans import fixtures as fx
from basketry.plans.topic_files import publish
from basketry.sources.files import read_latest_report, stage
from basketry.streaming.ingest import ensure_realtime, ingest_purchases, publish_days
from basketry.sources.topics import stream_topic


def test_stage_etl_and_report_job(spark, tmp, sf_small):
    fx.products(spark, sf_small).write.parquet(f"{tmp}/product_files")
    publish(fx.purchases(spark, sf_small), "purchases", f"{tmp}/topic", "purchase_id")
    masters = {"clients": fx.clients(spark, sf_small), "sellers": fx.sellers(spark, sf_small)}
    out = jobs.stage_etl(spark, "no_products_table", f"{tmp}/product_files", "purchases", f"{tmp}/stage",
                         masters=masters, topic_path=f"{tmp}/topic", load_date="2024-06-01",
                         prefix="t_stage_")
    assert set(out) == {"clients", "sellers", "products", "purchases"}
    purchases = spark.table("t_stage_purchases")
    assert purchases.count() == fx.purchases(spark, sf_small).count()
    assert purchases.select(F.min("load_date")).first()[0] == dt.date(2024, 6, 1)
    paths = jobs.report_job(purchases, spark.table("t_stage_products"), f"{tmp}/reports")
    for name in paths:
        assert read_latest_report(spark, f"{tmp}/reports", name).count() > 0
    for t in out:
        spark.sql(f"DROP TABLE t_stage_{t}")


def test_ensure_realtime_registers_table(spark, tmp, sf_small):
    publish(fx.purchase_messages(fx.purchases_rt(spark, sf_small)), "purchases", f"{tmp}/topic", "purchase_id")
    assert ensure_realtime(spark, "t_purchases_rt", f"{tmp}/table").count() == 0  # absent: created empty
    ingest_purchases(stream_topic(spark, "purchases", path=f"{tmp}/topic"), f"{tmp}/landing", f"{tmp}/ck",
                     trigger={"availableNow": True}).awaitTermination()
    publish_days(spark, f"{tmp}/landing", f"{tmp}/table")
    t = ensure_realtime(spark, "t_purchases_rt", f"{tmp}/table")
    assert t.count() == fx.purchases_rt(spark, sf_small).count()
    spark.sql("DROP TABLE t_purchases_rt")


def test_command_line_reports_and_ingest(spark, tmp, sf_small):
    from basketry.__main__ import main
    from basketry.sinks.stage import write_stage
    from basketry.streaming.ingest import read_published, read_realtime
    write_stage(with_load_date(fx.purchases(spark, sf_small)), f"{tmp}/stage/stage_purchases")
    write_stage(with_load_date(fx.products(spark, sf_small)), f"{tmp}/stage/stage_products")
    out = main(["reports", "--stage-base", f"{tmp}/stage", "--reports-base", f"{tmp}/reports"], spark=spark)
    assert set(out) == {"revenue_by_category", "top_clients", "avg_check_by_day", "top_selling_products"}
    assert read_latest_report(spark, f"{tmp}/reports", "top_clients").count() == 10
    publish(fx.purchase_messages(fx.purchases_rt(spark, sf_small)), "purchases", f"{tmp}/topic", "purchase_id")
    main(["ingest", "--topic-path", f"{tmp}/topic", "--landing", f"{tmp}/rt", "--checkpoint", f"{tmp}/ck",
          "--trigger", "available-now"], spark=spark)
    n = fx.purchases_rt(spark, sf_small).count()
    assert read_realtime(spark, f"{tmp}/rt").count() == n
    assert main(["publish-days", "--landing", f"{tmp}/rt", "--table", f"{tmp}/days"], spark=spark)["days"]
    assert read_published(spark, f"{tmp}/days").count() == n
    assert not main(["publish-days", "--landing", f"{tmp}/rt", "--table", f"{tmp}/days", "--after",
                     "2999-01-01T00:00:00"], spark=spark)["days"]


def test_command_line_upsert(spark, tmp, sf_small):
    from basketry.__main__ import main
    from basketry.streaming.upsert import read_upserted
    publish(fx.products_rt(spark, sf_small), "products", f"{tmp}/topic", "product_id")
    main(["upsert", "--entity", "products", "--topic", "products", "--topic-path", f"{tmp}/topic", "--log",
          f"{tmp}/log", "--checkpoint", f"{tmp}/ck", "--trigger", "available-now"], spark=spark)
    main(["refresh", "--entity", "products", "--log", f"{tmp}/log", "--table", f"{tmp}/table"], spark=spark)
    n = fx.products_rt(spark, sf_small).count()
    assert read_upserted(spark, f"{tmp}/log", "products", f"{tmp}/table").count() == n
    assert read_upserted(spark, f"{tmp}/log", "products").count() == 0  # the log has been taken in


def test_stage_etl_dedups_products(spark, tmp, sf_small):
    pr = fx.products(spark, sf_small)
    old = pr.withColumn("name", F.lit("stale")).withColumn("updated_at", F.lit("2020-01-01T00:00:00Z"))
    old.write.parquet(f"{tmp}/files/g1")
    pr.write.parquet(f"{tmp}/files/g2")
    publish(fx.purchases(spark, sf_small), "purchases", f"{tmp}/topic", "purchase_id")
    masters = {"clients": fx.clients(spark, sf_small), "sellers": fx.sellers(spark, sf_small)}
    out = jobs.stage_etl(spark, "no_products_table", f"{tmp}/files/g*", "purchases", f"{tmp}/stage",
                         masters=masters, topic_path=f"{tmp}/topic", prefix="d_stage_", dedup_products=True)
    staged = stage(spark, "products", path=out["products"])
    assert staged.count() == pr.count() and staged.where(F.col("name") == "stale").count() == 0
    for t in out:
        spark.sql(f"DROP TABLE d_stage_{t}")
