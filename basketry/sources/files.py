"""File and table sources (S3, S4, S7, S8, S9/O6). Every reader takes an
explicit schema; nothing is inferred."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import PRODUCT, REPORTS, STAGE
from ..sinks.stage import loads
from .finished import finished


def read_products(spark: SparkSession, path: str, schema: StructType = PRODUCT) -> DataFrame:
    """S3: product Parquet files (a directory or a glob)."""
    return spark.read.schema(schema).parquet(path)


def read_table_or_files(spark: SparkSession, table: str, path: str,
                        schema: StructType = PRODUCT) -> DataFrame:
    """The catalog table when it exists, else the Parquet files. Only a
    missing table falls back; any other error surfaces."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.read.schema(schema).parquet(path)


def stage(spark: SparkSession, name: str, path: str | None = None, fmt: str = "parquet",
          prefix: str = "stage_", schema: StructType | None = None) -> DataFrame:
    """A stage table by name from the catalog, or its newest finished load
    under ``path``, with the entity's declared schema."""
    if path is None:
        return spark.table(f"{prefix}{name}")
    done = loads(spark, path)
    if not done:
        raise FileNotFoundError(f"no finished load under {path}")
    return spark.read.format(fmt).schema(schema or STAGE[name]).load(done[-1])


def report_dirs(spark: SparkSession, base: str, name: str) -> list[tuple[str, str]]:
    """(stamp, path) of every finished ``<base>/<name>_<yyyyMMdd_HHmmss>.csv``
    report directory. Lists directory names only (a handful per report)."""
    exact = re.compile(rf"^{re.escape(name)}_(\d{{8}}_\d{{6}})(?:\.csv)?$")
    found = ((exact.match(p.rsplit("/", 1)[1]), p) for p in finished(spark, f"{base.rstrip('/')}/{name}_*"))
    return sorted((m.group(1), p) for m, p in found if m)


def read_latest_report(spark: SparkSession, base: str, name: str,
                       schema: StructType | None = None) -> DataFrame:
    """The newest finished report of ``name``, chosen by the stamp in its
    directory name, read whole (every part file) as CSV with header and the
    report's declared schema. No report is an error."""
    dirs = report_dirs(spark, base, name)
    if not dirs:
        raise FileNotFoundError(f"no report named {name!r} under {base}")
    return (spark.read.schema(schema or REPORTS[name]).option("header", True)
            .csv(dirs[-1][1]))
