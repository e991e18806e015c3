"""Windowed revenue over the purchase stream.

Tumbling event-time windows with a watermark; append mode emits each window
once, after the watermark passes its end, so the sink never sees an update.

``windowed_revenue`` alone counts what it is given, and rows later than the
watermark are dropped by Spark (the reference has no late-data rule; the default
one-day delay is our choice). ``start_counted_windows`` loses nothing and counts
nothing twice: Spark's state of seen lines stands before the windows, so resent
events are counted once, and the same query lands every row it has read and the
lines that came in time. What was read but never in time is late
(``read_late_rows``); window sums and late rows add up to all lines. State is
kept for the watermark's delay only, in the cluster's state store. Seen lines
are kept twice (for the windows and for the landed lines): Spark shares no state
between branches of a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import amount, money
from ..schemas import PURCHASE_RT
from .dedup import LINE, line_id, unique
from .landing import QueryId, landed, write_batch

#: Kinds of landed rows: closed windows, lines in time, rows read.
WINDOW, IN_TIME, READ = "window", "in_time", "read"
_SUMS = [T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
         T.StructField("revenue", T.DoubleType()), T.StructField("total_quantity", T.LongType()),
         T.StructField("total_purchases", T.LongType())]
_ROW = [T.StructField(f.name, f.dataType) for f in PURCHASE_RT.fields]
_STORED = T.StructType([*_SUMS, *_ROW, T.StructField("line_id", T.LongType()), T.StructField("dt", T.DateType())])


def windowed_revenue(valid: DataFrame, width: str = "1 hour", delay: str = "1 day",
                     ts: str = "ts", cents: bool = False) -> DataFrame:
    return _sums(valid.withWatermark(ts, delay), width, ts, cents)


def _sums(valid: DataFrame, width: str, ts: str, cents: bool) -> DataFrame:
    rev = F.sum(amount())
    return (valid.groupBy(F.window(ts, width).alias("w"))
            .agg((money(rev) if cents else rev).alias("revenue"),
                 F.sum("quantity").cast("long").alias("total_quantity"),
                 F.count(F.lit(1)).alias("total_purchases"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "revenue", "total_quantity", "total_purchases"))


def start_windowed_revenue(windows: DataFrame, path: str, checkpoint: str,
                           trigger: dict | None = None) -> StreamingQuery:
    """Append closed windows to Parquet through the file sink (exactly-once
    via its metadata log)."""
    return (windows.writeStream.outputMode("append").format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 minute"}))
            .start(path))


def start_counted_windows(valid: DataFrame, path: str, checkpoint: str, width: str = "1 hour", delay: str = "1 day",
                          cents: bool = False, trigger: dict | None = None) -> StreamingQuery:
    """Land the closed windows, the lines in time and all rows read of a
    stream of valid purchases (with ``ts``), one write a micro-batch."""
    source = QueryId()
    rows = valid.select(*PURCHASE_RT.names, line_id().alias("line_id")).withWatermark("ts", delay)
    once = rows.dropDuplicates([*LINE, "ts"])

    def of_kind(df: DataFrame, kind: str) -> DataFrame:
        day = F.to_date("ts" if "ts" in df.columns else "window_start")
        return df.select(F.lit(kind).alias("kind"), *[
            F.col(f.name) if f.name in df.columns else day.alias("dt") if f.name == "dt"
            else F.lit(None).cast(f.dataType).alias(f.name) for f in _STORED.fields])

    every = of_kind(_sums(once, width, "ts", cents), WINDOW).unionByName(
        of_kind(once.select(*LINE, "ts"), IN_TIME)).unionByName(of_kind(rows, READ))
    query = (every.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
             .foreachBatch(lambda batch, n: write_batch(batch, path, source.get(), n, by=("dt",)))
             .trigger(**(trigger or {"processingTime": "1 minute"})).start())
    source.set(query)
    return query


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The closed windows that ``start_counted_windows`` has landed."""
    return landed(spark, path, _STORED, WINDOW).select(*[f.name for f in _SUMS])


def read_late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Lines that came after the watermark, once each: read, but never in time.
    The day of both sides is in the join, so days can be pruned by ``dt``."""
    read = unique(landed(spark, path, _STORED, READ).select(*PURCHASE_RT.names, "line_id", "dt"), [*LINE, "dt"])
    in_time = landed(spark, path, _STORED, IN_TIME).select(*LINE, "dt")
    return read.join(in_time, [*LINE, "dt"], "left_anti").select(*PURCHASE_RT.names, "dt")
