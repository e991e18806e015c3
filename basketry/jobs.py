"""Batch jobs a scheduler runs (``spark-submit``): stage ETL and reports.

Both are thin: they wire sources, operators and sinks; every step is a
distributed DataFrame write. Nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import reports
from .operators.decode import decode_purchases
from .operators.stage import latest_products, profile, profile_rows, with_load_date
from .sinks.reports import write_report
from .sinks.stage import load_profile, write_stage
from .sources.files import read_table_or_files
from .sources.jdbc import read_masters
from .sources.topics import read_topic


def stage_purchases(raw: DataFrame, load_date=None) -> DataFrame:
    """Topic records -> stage purchases."""
    return with_load_date(decode_purchases(raw), load_date)


def stage_etl(spark: SparkSession, products_table: str, products_path: str, topic: str,
              stage_base: str, jdbc_url: str | None = None, jdbc_props: dict | None = None,
              masters: dict[str, DataFrame] | None = None, servers: str | None = None,
              topic_path: str | None = None, load_date=None, prefix: str = "stage_",
              dedup_products: bool = False, jdbc_partitions: int = 1) -> dict[str, str]:
    """Load clients and sellers (JDBC in ``jdbc_partitions`` parallel reads,
    or ready ``masters`` frames),
    products (table or files; with ``dedup_products`` the newest row per
    product) and purchases (topic, earliest to now) into stage tables, each
    fully replaced. Returns {entity: path}."""
    out = {}
    frames = dict(masters if masters is not None else read_masters(
        spark, jdbc_url, jdbc_props, partitions=jdbc_partitions))
    products = read_table_or_files(spark, products_table, products_path)
    frames["products"] = latest_products(products) if dedup_products else products
    for name, df in frames.items():  # out: base path of each table's loads
        out[name] = f"{stage_base}/{prefix}{name}"
        write_stage(with_load_date(df, load_date), out[name], f"{prefix}{name}")
    raw = read_topic(spark, topic, servers=servers, path=topic_path, starting="earliest")
    out["purchases"] = f"{stage_base}/{prefix}purchases"
    write_stage(stage_purchases(raw, load_date), out["purchases"], f"{prefix}purchases")
    return out


def report_job(purchases: DataFrame, products: DataFrame, reports_base: str,
               top_clients: int = 10, top_products: int = 10,
               at: dt.datetime | None = None) -> dict[str, str]:
    """The four batch reports, each written once as CSV."""
    at = at or dt.datetime.now(dt.timezone.utc)
    built = {
        "revenue_by_category": reports.revenue_by_category(purchases, products),
        "top_clients": reports.top_clients(purchases, top_clients),
        "avg_check_by_day": reports.avg_check_by_day(purchases),
        "top_selling_products": reports.top_selling_products(purchases, products, top_products),
    }
    return {name: write_report(df, reports_base, name, at) for name, df in built.items()}


STAGE_TABLES = ("clients", "sellers", "products", "purchases")


PROFILE = "table string, column string, data_type string, position int, row_count bigint, null_count bigint"


def stage_report(spark: SparkSession, prefix: str = "stage_") -> tuple[DataFrame, DataFrame]:
    """Row counts (A10) and column profiles (A12) of the four stage tables.
    Tables that the stage job wrote were counted by the write itself, so
    nothing is scanned; any other table is scanned once for both."""
    known, scanned = [], []
    for name in (f"{prefix}{n}" for n in STAGE_TABLES):
        df = spark.table(name)
        place = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()
        counts = place and load_profile(spark, place.data_type)
        if counts and set(counts["nulls"]) == set(df.columns):
            known += [(name, *r) for r in profile_rows(df, counts)]
        else:
            scanned.append(profile(df).select(F.lit(name).alias("table"), "*"))
    profiles = reduce(DataFrame.unionByName, [spark.createDataFrame(known, PROFILE), *scanned])
    counts = profiles.where("position = 0").select("table", F.col("row_count").alias("rows"))
    return counts, profiles
