"""Keyed upserts of the real-time dimension tables (X2 products, X3 sellers):
"add and update" messages, newest wins.

The stream appends decoded changes to a landing log (see ``landing``);
messages that are no JSON object, lack the key or have a bad price land as
dead letters with a reason. Messages carry no event time, so recency is the
topic order (broker time, partition, offset). ``read_upserted`` takes the
newest row per key of the refreshed table and the log; ``refresh`` writes that
as the table's next load (K1) and drops the log that the refresh before it took
in, so a reader planned before a refresh still finds all its files. A change
that is read twice, or replayed, changes nothing: the newest is the newest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import lenient_double
from ..operators.decode import BAD_PRICE, MISSING_FIELD, NOT_JSON
from ..schemas import PRODUCT_RT, SELLER_RT
from ..sinks.stage import loads, write_stage
from .landing import DEAD, QueryId, land, landed, pending, take

RECENCY = ("_ts", "_partition", "_offset")
ENTITIES = {
    "products": ("product_id", PRODUCT_RT),
    "sellers": ("seller_id", SELLER_RT),
}
_ORDER = [T.StructField("_ts", T.TimestampType()), T.StructField("_partition", T.IntegerType()),
          T.StructField("_offset", T.LongType())]


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields] + _ORDER)


def _log(schema: T.StructType) -> T.StructType:
    return T.StructType([*_stored(schema).fields, T.StructField("value", T.StringType()),
                         T.StructField("reason", T.StringType())])


def latest_per_key(df: DataFrame, key: str, order: tuple[str, ...] = RECENCY) -> DataFrame:
    """Newest row per key by the ``order`` columns (lexicographic)."""
    rest = [c for c in df.columns if c != key and c not in order]
    return (df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_m"))
              .select(key, *[F.col(f"_m.{c}").alias(c) for c in (*order, *rest)]))


def decode_records(records: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """Topic records -> typed rows with recency columns, the message text and
    ``reason``, NULL for a usable change. Numbers may be sent as text."""
    text = F.col("value").cast("string")
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    m = records.select(text.alias("value"), F.from_json(text, raw).alias("m"), F.col("timestamp").alias("_ts"),
                       F.col("partition").alias("_partition"), F.col("offset").alias("_offset"))
    numbers = [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)]

    def typed(name: str) -> Column:
        return lenient_double(f"m.{name}") if name in numbers else F.col(f"m.{name}")
    bad = F.lit(False)
    for n in numbers:
        bad = bad | (F.col(f"m.{n}").isNotNull() & typed(n).isNull())
    reason = (F.when(F.col(f"m.{key}").isNull() & F.json_object_keys("value").isNull(), NOT_JSON)
              .when(F.col(f"m.{key}").isNull(), MISSING_FIELD).when(bad, BAD_PRICE))
    return m.select(*[typed(f.name).alias(f.name) for f in schema.fields], *RECENCY, "value", reason.alias("reason"))


def upsert(stream: DataFrame, entity: str, log: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start the upsert stream of ``entity`` ("products" or "sellers")."""
    key, schema = ENTITIES[entity]
    source = QueryId()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        land(batch.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value"))), log, source.get(),
             batch_id, sort=(key,))

    query = (decode_records(stream, schema, key).writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"processingTime": "1 second"})).start())
    source.set(query)
    return query


def _current(spark: SparkSession, log: str, entity: str, table: str | None, dirs: list[str]) -> DataFrame:
    key, schema = ENTITIES[entity]
    stored = _stored(schema)
    rows = landed(spark, log, _log(schema), dirs=dirs).select(*stored.names)
    done = loads(spark, table) if table else []
    if done:
        rows = rows.unionByName(spark.read.schema(stored).parquet(done[-1]))
    return latest_per_key(rows, key).select(*stored.names)


def read_upserted(spark: SparkSession, log: str, entity: str, table: str | None = None) -> DataFrame:
    """Current rows: the newest per key of the refreshed table, if any, and
    the log (payload columns only)."""
    return _current(spark, log, entity, table, pending(spark, log)).select(*ENTITIES[entity][1].names)


def read_upsert_dead_letters(spark: SparkSession, log: str, entity: str) -> DataFrame:
    """(value, reason) of the messages that are no usable change."""
    return landed(spark, log, _log(ENTITIES[entity][1]), DEAD).select("value", "reason")


def refresh(spark: SparkSession, log: str, entity: str, table: str, drop_log: bool = True) -> str:
    """Write the current rows as the table's next load and name the log
    batches that are in it as taken, which drops those of the refresh before;
    returns the load. Run it from a scheduler, one at a time per table."""
    taken = pending(spark, log)
    load = write_stage(_current(spark, log, entity, table, taken), table)
    if drop_log:
        take(spark, log, taken)
    return load
