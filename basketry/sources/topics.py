"""Topic sources (S5, S6): Kafka when a bootstrap address is given, else
Parquet files of records with the same columns (key, value, topic, partition,
offset, timestamp), value in bytes as Kafka delivers it, so that the same
decode and ingest code runs on recorded topics.

Start positions (T2) are ``earliest``, ``latest`` or an ISO time (records
published at it or later). They count on a query's first run only. Kafka keeps
what they come to in the query's checkpoint; for a recorded topic ``latest`` is
the files present when the stream is first built, and that is written beside the
checkpoint's own files, so a restart goes on from the same place.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TOPIC_RECORD
from .finished import exists, read_lines, write_lines

EARLIEST, LATEST = "earliest", "latest"


def _time(starting: str) -> dt.datetime:
    t = dt.datetime.fromisoformat(starting)
    return t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)


def kafka_options(servers: str, topic: str, starting: str, options: dict | None = None) -> dict[str, str]:
    """Reader options; ``options`` (security, rate limits...) win."""
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting in (EARLIEST, LATEST):
        out["startingOffsets"] = starting
    else:
        out["startingTimestamp"] = str(int(_time(starting).timestamp() * 1000))
    return out | {k: str(v) for k, v in (options or {}).items()}


def _kafka(reader, servers: str, topic: str, starting: str, options: dict | None):
    df = reader.format("kafka").options(**kafka_options(servers, topic, starting, options)).load()
    return df.select(F.col("key").cast("string").alias("key"), "value", "topic", "partition", "offset", "timestamp")


def read_topic(spark: SparkSession, topic: str, servers: str | None = None, path: str | None = None,
               starting: str = EARLIEST, options: dict | None = None) -> DataFrame:
    """Bounded read of a topic from ``starting`` to now."""
    if servers:
        return _kafka(spark.read, servers, topic, starting, options)
    rows = spark.read.schema(TOPIC_RECORD).parquet(path)
    return rows if starting == EARLIEST else rows.where(_from(spark, path, starting, None))


def _from(spark: SparkSession, path: str, starting: str, checkpoint: str | None) -> Column:
    """Filter of a recorded topic's records: those from the start position on."""
    if starting != LATEST:
        return F.col("timestamp") >= F.lit(_time(starting))
    kept = f"{checkpoint.rstrip('/')}/start_position" if checkpoint else None
    if kept and (lines := read_lines(spark, kept)):
        at = json.loads(lines[0])
    else:
        at = _newest(spark, path)
        if kept:
            write_lines(spark, kept, [json.dumps(at)])
    changed = F.col("_metadata.file_modification_time")
    newest = F.lit(at["time"]).cast("timestamp")
    return (changed > newest) | (changed == newest) & ~F.col("_metadata.file_name").isin(at["files"])


def _newest(spark: SparkSession, path: str) -> dict:
    """The last change of a topic's files, and the files of that time."""
    if not exists(spark, path):
        return {"time": "1970-01-01 00:00:00+00:00", "files": []}
    files = spark.read.schema(TOPIC_RECORD).parquet(path).select(
        F.col("_metadata.file_modification_time").alias("t"), F.col("_metadata.file_name").alias("f")).distinct()
    last = files.agg(F.date_format(F.max("t"), "yyyy-MM-dd HH:mm:ss.SSSXXX").alias("t"), F.max("t").alias("m"))
    at = last.first()
    if at.m is None:
        return {"time": "1970-01-01 00:00:00+00:00", "files": []}
    return {"time": at.t, "files": sorted(r.f for r in files.where(F.col("t") == F.lit(at.t).cast("timestamp")).collect())}


def stream_topic(spark: SparkSession, topic: str, servers: str | None = None, path: str | None = None,
                 starting: str | None = None, max_files_per_trigger: int | None = None,
                 options: dict | None = None, checkpoint: str | None = None) -> DataFrame:
    """Unbounded read. ``starting`` is ``latest`` by default for Kafka,
    ``earliest`` for recorded topics; ``latest`` of a recorded topic needs the
    ``checkpoint`` of the query that will read it."""
    if servers:
        return _kafka(spark.readStream, servers, topic, starting or LATEST, options)
    starting = starting or EARLIEST
    if starting == LATEST and not checkpoint:
        raise ValueError("a recorded topic needs the query's checkpoint to start at the latest record")
    r = spark.readStream.schema(TOPIC_RECORD)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = r.parquet(path)
    return rows if starting == EARLIEST else rows.where(_from(spark, path, starting, checkpoint)).select(
        *TOPIC_RECORD.names)
