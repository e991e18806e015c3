"""Purchase stream ingest (S6 -> K3/K4/K5, T1-T5).

topic -> decode -> landing directories (valid rows and dead letters, see
``landing``) -> real-time table.

* The stream only appends: every valid row lands, resent or late ones too.
  ``read_realtime`` shows them at once, with the published days if the table is
  named, one row per line if asked for (see ``dedup``).
* ``publish_days`` merges what has landed since the last publish into the days
  of the real-time table that it belongs to, one row per line, and leaves all
  others alone, so cost follows new rows. A day's published rows are read, not
  replaced, so nothing is lost when landed batches are gone.
* ``<table>/load=<stamp>/dt=<day>/part-*``: a publish writes its days to a load
  of its own; a day's rows are those of its newest finished load, and older ones
  stay for ``KEEP`` generations, for readers that began before. The catalog's
  partitions point to the same directories (``ensure_realtime``).
* Offsets live in the checkpoint, so a restart resumes where the last
  finished batch ended (no lost or re-read range).
* Files are sorted by time; Parquet bloom filters on ``client_id`` and
  ``product_id`` let point lookups (client statistics, purchase lists) skip
  row groups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.decode import split_valid
from ..schemas import PURCHASE_RT
from ..sources.finished import MARK_SUCCESS, delete, finished, matching
from .dedup import LINE, line_id, unique
from .landing import DEAD, QueryId, land, landed, pending, take

RT_COLUMNS = [f.name for f in PURCHASE_RT.fields]
SOURCE_COLUMNS = ("key", "partition", "offset")
DEAD_COLUMNS = (*SOURCE_COLUMNS, "value", "reason")
# sized to the distinct values seen, not the 1 MB default
BLOOM = {"parquet.bloom.filter.adaptive.enabled": "true",
         **{f"parquet.bloom.filter.enabled#{c}": "true" for c in ("client_id", "product_id")}}

KEEP = 2

_LINE_ID, _DAY = T.StructField("line_id", T.LongType()), T.StructField("dt", T.DateType())
RT_TABLE = T.StructType([*(T.StructField(f.name, f.dataType) for f in PURCHASE_RT.fields), _LINE_ID, _DAY])
_PUBLISHED = T.StructType([*RT_TABLE.fields, T.StructField("load", T.StringType())])
_LANDED = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("value", T.StringType()),
    T.StructField("reason", T.StringType()), *RT_TABLE.fields])


def ingest_purchases(stream: DataFrame, landing: str, checkpoint: str, trigger: dict | None = None,
                     name: str | None = None) -> StreamingQuery:
    """Start the ingest. ``trigger`` is passed to ``DataStreamWriter.trigger``:
    ``{"processingTime": "1 second"}`` for a service (the reference polls
    every second), ``{"availableNow": True}`` for a catch-up run."""
    source = QueryId()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        valid = F.col("reason").isNull()
        rows = (batch.withColumn("value", F.when(~valid, F.col("value")))
                .withColumn("line_id", F.when(valid, line_id())).withColumn("dt", F.when(valid, F.to_date("ts"))))
        land(rows, landing, source.get(), batch_id, by=("dt",), sort=("ts",), options=BLOOM)

    w = (split_valid(stream, ts_name="ts", keep=SOURCE_COLUMNS).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})))
    query = (w.queryName(name) if name else w).start()
    source.set(query)
    return query


def _landed(spark: SparkSession, landing: str, dirs: list[str] | None = None) -> DataFrame:
    return landed(spark, landing, _LANDED, dirs=dirs).select(*RT_TABLE.names)


def read_realtime(spark: SparkSession, landing: str, with_day: bool = False, once: bool = False,
                  table: str | None = None, with_line: bool = False) -> DataFrame:
    """Every valid row in the landing, of all streams; with ``table``, the
    published days and what has landed since. ``once``: one row per line.
    ``with_day`` keeps ``dt`` so callers can prune by day, ``with_line`` the
    line's id."""
    if table is None:
        rows = _landed(spark, landing)
    else:
        rows = _published(spark, _days(spark, table), table).unionByName(
            _landed(spark, landing, pending(spark, landing, "dt")))
    rows = unique(rows, [*LINE, "dt"]) if once else rows
    return rows.select(*RT_COLUMNS, *(["line_id"] if with_line else []), *(["dt"] if with_day else []))


def read_dead_letters(spark: SparkSession, landing: str) -> DataFrame:
    return landed(spark, landing, _LANDED, DEAD).select(*DEAD_COLUMNS)


def changed_days(spark: SparkSession, landing: str, after: dt.datetime | None = None) -> list[dt.date]:
    """Days of the valid rows that have landed (since ``after``)."""
    rows = landed(spark, landing, _LANDED)
    if after is not None:
        rows = rows.where(F.col("_metadata.file_modification_time") > F.lit(after))
    return sorted(r.dt for r in rows.select("dt").distinct().collect())  # a row per day


def _day(path: str) -> dt.date:
    return dt.date.fromisoformat(path.rpartition("/dt=")[2])


def pending_days(spark: SparkSession, landing: str) -> list[dt.date]:
    """Days with rows that no publish has taken yet."""
    return sorted({_day(p) for p in pending(spark, landing, "dt")})


def _loads(spark: SparkSession, table: str) -> dict[dt.date, list[str]]:
    """Each published day's directories, oldest first."""
    done, out = set(finished(spark, f"{table.rstrip('/')}/load=*")), {}
    for path in matching(spark, f"{table.rstrip('/')}/load=*/dt=*"):
        if path.rpartition("/")[0] in done:
            out.setdefault(_day(path), []).append(path)
    return out


def _days(spark: SparkSession, table: str) -> dict[dt.date, str]:
    """Each published day's directory in its newest load."""
    return {day: dirs[-1] for day, dirs in _loads(spark, table).items()}


def _published(spark: SparkSession, days: dict[dt.date, str], table: str) -> DataFrame:
    rows = (spark.read.schema(_PUBLISHED).option("basePath", table).parquet(*days.values()) if days
            else spark.createDataFrame([], _PUBLISHED))
    return rows.select(*RT_TABLE.names)


def publish_days(spark: SparkSession, landing: str, table: str, days: list[dt.date] | None = None,
                 name: str | None = None) -> list[dt.date]:
    """K3/K5: merge what has landed of the given days (by default, of all)
    since it was last published into the real-time table, one row per line;
    returns the days that it wrote. ``name``: the catalog table to point to
    them. Run it from a scheduler, one at a time per table."""
    new = [p for p in pending(spark, landing, "dt") if days is None or _day(p) in days]
    touched = sorted({_day(p) for p in new})
    if not touched:
        return []
    old = {day: path for day, path in _days(spark, table).items() if day in touched}
    rows = _landed(spark, landing, new).unionByName(_published(spark, old, table))
    load = f"{table.rstrip('/')}/load={dt.datetime.now(dt.timezone.utc):%Y%m%d_%H%M%S_%f}"
    (unique(rows, [*LINE, "dt"]).hint("rebalance", F.col("dt")).sortWithinPartitions("dt", "ts")
     .write.options(**MARK_SUCCESS, **BLOOM).partitionBy("dt").parquet(load))
    if name is not None:
        ensure_realtime(spark, name, table)
    take(spark, landing, new)
    for day, dirs in _loads(spark, table).items():
        for path in dirs[:-KEEP]:
            delete(spark, path)
    for path in finished(spark, f"{table.rstrip('/')}/load=*"):
        if not matching(spark, f"{path}/dt=*"):
            delete(spark, path)
    return touched


def read_published(spark: SparkSession, table: str, with_day: bool = False, with_line: bool = False) -> DataFrame:
    """K5: the published real-time table, by path."""
    return _published(spark, _days(spark, table), table).select(
        *RT_COLUMNS, *(["line_id"] if with_line else []), *(["dt"] if with_day else []))


_SYNCED = "basketry.load"


def ensure_realtime(spark: SparkSession, name: str, table: str) -> DataFrame:
    """K5: register the published table in the catalog if it is absent and
    point its partitions to the days published since; the same rows as
    ``read_published``. A day changes by its partition's location, so a query
    sees the old rows or the new ones."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RT_TABLE.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet PARTITIONED BY (dt) LOCATION '{table}'")
    last = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(_SYNCED, "")
    days = {day: path for day, path in _days(spark, table).items() if path.rpartition("/dt=")[0] > last}
    if days:
        known = {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        fresh = "".join(f" PARTITION (dt='{d}') LOCATION '{p}'" for d, p in days.items() if f"dt={d}" not in known)
        if fresh:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS{fresh}")
        for d, p in days.items():
            if f"dt={d}" in known:
                spark.sql(f"ALTER TABLE {name} PARTITION (dt='{d}') SET LOCATION '{p}'")
        newest = max(p.rpartition("/dt=")[0] for p in days.values())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_SYNCED}'='{newest}')")
    spark.catalog.refreshTable(name)
    return spark.table(name)
