"""Publish rows as JSON messages to a Kafka topic (K6, F4). The broker routes
each record by its key; without a key it spreads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.decode import encode_json


def messages(df: DataFrame, key: str | Column | None = None, value: Column | None = None) -> DataFrame:
    """Rows -> (key, value): key as text (NULL without one), value the row as
    JSON, in bytes."""
    k = (F.col(key) if isinstance(key, str) else key) if key is not None else F.lit(None)
    v = encode_json(df) if value is None else value
    return df.select(k.cast("string").alias("key"), v.cast("binary").alias("value"))


def kafka_options(topic: str, servers: str, options: dict | None = None) -> dict[str, str]:
    """Writer options; ``options`` win."""
    return {"kafka.bootstrap.servers": servers, "topic": topic} | {k: str(v) for k, v in (options or {}).items()}


def publish_json(df: DataFrame, topic: str, servers: str, key: str | Column | None = None,
                 options: dict | None = None) -> None:
    messages(df, key).write.format("kafka").options(**kafka_options(topic, servers, options)).save()
