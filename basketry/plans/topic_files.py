"""Scaffolding for queries and tests: topic records in Parquet files, for
``sources.topics`` to read where there is no broker. A plain write: no
routing, no shuffle; partition and offset only tell records apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.topics import messages


def publish(df: DataFrame, topic: str, path: str, key: str | Column | None = None, at=None,
            value: Column | None = None) -> None:
    """Append the rows to the topic's files; ``at`` fixes the publish time."""
    ts = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    messages(df, key, value).select(
        "key", "value", F.lit(topic).alias("topic"), F.spark_partition_id().alias("partition"),
        F.monotonically_increasing_id().alias("offset"), ts.alias("timestamp")).write.mode("append").parquet(path)
