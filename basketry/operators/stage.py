"""Stage-table helpers that are pure DataFrame work: load date (P1),
row counts (A10) and the column profile (A12)."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_load_date(df: DataFrame, date: _dt.date | str | None = None) -> DataFrame:
    """Add ``load_date``; today by default, a fixed date for tests."""
    d = F.current_date() if date is None else F.lit(str(date)).cast("date")
    return df.withColumn("load_date", d)


def latest_products(products: DataFrame, key: str = "product_id", updated: str = "updated_at") -> DataFrame:
    """One row per product: the one with the newest ``updated_at`` (ISO text
    or timestamp; unparsable times rank lowest), so duplicate product files
    cannot fan out the joins of the reports. ``max`` of a struct led by the
    time is a partial aggregate: a product listed a million times costs one
    row per task before the shuffle."""
    rest = [c for c in products.columns if c != key]
    t = F.try_to_timestamp(F.col(updated).cast("string"))
    return (products.groupBy(key).agg(F.max(F.struct(t.alias("__t"), *rest)).alias("__m"))
            .select(key, *[F.col(f"__m.{c}").alias(c) for c in rest]))


def stage_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A10: one row per table: (table, rows). Each count is its own global
    aggregate (partial counts per task, one tiny merge)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def profile(df: DataFrame) -> DataFrame:
    """One row per column: name, Spark type, position, row count and
    NULL count, computed in a single pass over the table and unpivoted."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"__n{i}") for i, f in enumerate(fields)]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.lit(i).alias("position"), F.col("__rows").alias("row_count"),
                     F.col(f"__n{i}").alias("null_count"))
            for i, f in enumerate(fields)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def profile_rows(df: DataFrame, counts: dict) -> list[tuple]:
    """A12 of a table whose write was counted ({"rows": n, "nulls": {column:
    n}}): the rows that ``profile`` would give, without a scan."""
    return [(f.name, f.dataType.simpleString(), i, counts["rows"], counts["nulls"][f.name])
            for i, f in enumerate(df.schema.fields)]


def sample(df: DataFrame, n: int = 20) -> DataFrame:
    """A12 sample rows (the reference shows 20)."""
    return df.limit(n)
