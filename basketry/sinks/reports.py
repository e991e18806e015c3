"""CSV report writer (K2): ``<base>/<name>_<yyyyMMdd_HHmmss>.csv`` as a
directory of part files with header, replaced if it exists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ..functions import REPORT_STAMP
from ..sources.finished import MARK_SUCCESS


def report_path(base: str, name: str, at: dt.datetime | None = None) -> str:
    at = at or dt.datetime.now(dt.timezone.utc)
    return f"{base.rstrip('/')}/{name}_{at.strftime(REPORT_STAMP)}.csv"


def write_report(df: DataFrame, base: str, name: str, at: dt.datetime | None = None) -> str:
    path = report_path(base, name, at)
    df.write.mode("overwrite").options(**MARK_SUCCESS).option("header", True).csv(path)
    return path
