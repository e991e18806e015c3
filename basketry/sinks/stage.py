"""Stage-table writer (K1): full refresh that never leaves a reader without
the previous content.

Every refresh is written to a directory of its own, ``<path>/load_<stamp>``.
Only when that job has finished does the catalog table point to it, and only
finished directories are seen by readers by path (``sources.files.stage``), so
a failed refresh changes nothing. The ``KEEP`` newest finished loads stay, for
readers that began before the refresh.

The write counts what it writes: rows, and NULLs of every column, as metrics
observed in the same pass, kept with the load (``load_profile``).
"""

from __future__ import annotations

import datetime as dt

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.finished import MARK_SUCCESS, delete, finished, read_lines, write_lines

KEEP = 2
_PROFILE = "_profile.json"  # an underscore: no data file for readers


def loads(spark: SparkSession, path: str) -> list[str]:
    """Finished loads of a stage table, oldest first."""
    return finished(spark, f"{path.rstrip('/')}/load_*")


def _point(spark: SparkSession, table: str, df: DataFrame, fmt: str, location: str) -> None:
    if spark.catalog.tableExists(table):
        if [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")  # its files stay
    spark.catalog.createTable(table, path=location, source=fmt, schema=df.schema)


def write_stage(df: DataFrame, path: str | None = None, table: str | None = None, fmt: str = "parquet") -> str:
    """Refresh a stage table under ``path`` and, if named, the catalog table
    over it (by default stored in the warehouse). Returns the load's
    directory. One refresh of a table at a time."""
    spark = df.sparkSession
    if path is None and table is None:
        raise ValueError("write_stage needs a path or a table name")
    path = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}"
    load = f"{path.rstrip('/')}/load_{dt.datetime.now(dt.timezone.utc):%Y%m%d_%H%M%S_%f}"
    seen = Observation("stage")
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls).write.format(fmt).options(**MARK_SUCCESS).save(load)
    counts = seen.get
    write_lines(spark, f"{load}/{_PROFILE}", [json.dumps(
        {"rows": counts["rows"], "nulls": {c: counts[f"n{i}"] for i, c in enumerate(df.columns)}})])
    if table is not None:
        _point(spark, table, df, fmt, load)
    for old in loads(spark, path)[:-KEEP]:
        delete(spark, old)
    return load


def load_profile(spark: SparkSession, load: str) -> dict | None:
    """{"rows": n, "nulls": {column: n}} of a load as it was written; None if
    another writer made it."""
    lines = read_lines(spark, f"{load.rstrip('/')}/{_PROFILE}")
    return json.loads(lines[0]) if lines else None
