import datetime as dt

import pytest

from basketry.sinks.reports import write_report
from basketry.sinks.stage import loads, write_stage
from basketry.sources.files import read_latest_report, read_table_or_files, report_dirs, stage


def test_report_latest_stamp_whole_directory(spark, tmp):
    old = spark.createDataFrame([("x", 1)], "client_id string, purchase_count long")
    new = spark.createDataFrame([(f"c{i}", i) for i in range(10)], "client_id string, purchase_count long")
    write_report(old, tmp, "top_clients", dt.datetime(2024, 5, 1, 12, 0, 0))
    write_report(new.repartition(4), tmp, "top_clients", dt.datetime(2024, 5, 2, 9, 30, 0))
    write_report(old, tmp, "top_clients_extra", dt.datetime(2030, 1, 1, 0, 0, 0))  # other name
    assert [s for s, _ in report_dirs(spark, tmp, "top_clients")] == ["20240501_120000", "20240502_093000"]
    back = read_latest_report(spark, tmp, "top_clients")
    assert back.count() == 10 and dict(back.dtypes)["purchase_count"] == "bigint"


def test_report_missing_is_error(spark, tmp):
    with pytest.raises(FileNotFoundError):
        read_latest_report(spark, tmp, "avg_check_by_day")


def test_unfinished_report_is_skipped(spark, tmp):
    old = spark.createDataFrame([("x", 1)], "client_id string, purchase_count long")
    write_report(old, tmp, "top_clients", dt.datetime(2024, 5, 1, 12, 0, 0))
    old.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").csv(f"{tmp}/top_clients_20990101_000000.csv")
    assert read_latest_report(spark, tmp, "top_clients").count() == 1


def test_stage_by_table_and_path_and_fallback(spark, tmp):
    from basketry.operators.stage import with_load_date
    from basketry.schemas import PRODUCT
    df = spark.createDataFrame([("p1", "a", "toys", 1.0, 5, "2024-01-01T00:00:00+00:00")], PRODUCT)
    files = f"{tmp}/files"
    df.write.parquet(files)
    assert read_table_or_files(spark, "no_such_table_xyz", files).count() == 1
    df = with_load_date(df, "2024-06-01")
    write_stage(df, path=f"{tmp}/stage_products", table="stage_products_test")
    write_stage(df.union(df), path=f"{tmp}/stage_products", table="stage_products_test")  # replaced
    assert stage(spark, "products_test").count() == 2
    assert stage(spark, "products", path=f"{tmp}/stage_products").count() == 2
    assert read_table_or_files(spark, "stage_products_test", files).count() == 2  # table wins
    for _ in range(3):
        write_stage(df.select("product_id"), path=f"{tmp}/stage_products", table="stage_products_test")
    assert spark.table("stage_products_test").columns == ["product_id"]  # a new schema replaces the table
    assert len(loads(spark, f"{tmp}/stage_products")) == 2
    spark.sql("DROP TABLE stage_products_test")


def test_failing_refresh_keeps_the_old_rows(spark, tmp):
    from pyspark.sql import functions as F
    one = spark.createDataFrame([("p1",)], "product_id string")
    write_stage(one, path=f"{tmp}/s", table="stage_failing_test")
    bad = one.union(one).withColumn("product_id", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        write_stage(bad, path=f"{tmp}/s", table="stage_failing_test")
    assert spark.table("stage_failing_test").count() == 1
    assert stage(spark, "x", path=f"{tmp}/s", schema=one.schema).count() == 1
    spark.sql("DROP TABLE stage_failing_test")


def test_recorded_topic_round_trip(spark, tmp, sf_small):
    from basketry.operators.decode import decode_purchases
    from basketry.plans import fixtures as fx
    from basketry.plans.topic_files import publish
    from basketry.sources.topics import read_topic
    rt = fx.purchases_rt(spark, sf_small)
    publish(fx.purchase_messages(rt), "purchases", f"{tmp}/topic", "purchase_id")
    recs = read_topic(spark, "purchases", path=f"{tmp}/topic")
    assert set(recs.columns) == {"key", "value", "topic", "partition", "offset", "timestamp"}
    assert dict(recs.dtypes)["value"] == "binary"
    back = decode_purchases(recs, ts_name="ts")
    assert back.exceptAll(rt).count() == 0 and back.count() == rt.count()


def test_shared_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    from basketry.session import checkpoint_root
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(RuntimeError):
        checkpoint_root(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None)))


def test_stage_writes_count_their_rows_in_the_same_pass(spark, tmp):
    from pyspark.sql import functions as F

    from basketry import jobs
    from basketry.operators.stage import profile, stage_counts
    from basketry.sinks.stage import load_profile
    frames = {n: spark.createDataFrame([(f"{n}{i}", None if i % 3 else i) for i in range(9 + k)], "id string, `odd name` int")
              for k, n in enumerate(jobs.STAGE_TABLES)}
    opened = spark.sparkContext.accumulator(0)
    for n, df in frames.items():
        def one(rows):
            for r in rows:
                opened.add(1)
                yield r
        load = write_stage(df.mapInArrow(one, df.schema).coalesce(2), f"{tmp}/{n}", f"c_stage_{n}")
        assert load_profile(spark, load) == {"rows": df.count(), "nulls": {"id": 0, "odd name": df.where("`odd name` is null").count()}}
    written = opened.value
    counts, profiles = jobs.stage_report(spark, "c_stage_")
    scans = {f"c_stage_{n}": spark.table(f"c_stage_{n}") for n in frames}
    assert sorted(counts.collect()) == sorted(stage_counts(scans).collect())
    for n, df in scans.items():
        got = profiles.where(F.col("table") == n).drop("table")
        assert sorted(got.collect()) == sorted(profile(df).collect())
    assert "FileScan" not in profiles._jdf.queryExecution().executedPlan().toString()
    assert opened.value == written  # the reports read no row again
    frames["clients"].write.mode("overwrite").saveAsTable("c_stage_clients")  # another writer: scanned once
    counts, profiles = jobs.stage_report(spark, "c_stage_")
    assert counts.where("table = 'c_stage_clients'").first()["rows"] == 9
    assert profiles._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    for n in frames:
        spark.sql(f"DROP TABLE c_stage_{n}")


def test_load_date_is_the_sessions_date(spark):
    """today where the session is, not where the driver is."""
    import datetime as dt
    from zoneinfo import ZoneInfo

    from basketry.operators.stage import with_load_date
    one = spark.range(1)
    try:
        for zone in ("UTC", "Pacific/Kiritimati", "Pacific/Pago_Pago"):  # never all on one day
            spark.conf.set("spark.sql.session.timeZone", zone)
            before = dt.datetime.now(ZoneInfo(zone)).date()
            got = with_load_date(one).first()["load_date"]
            assert got in (before, dt.datetime.now(ZoneInfo(zone)).date())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
