"""Landing directories of the streams: append-only, exactly-once.

``<base>/stream=<id>/batch_id=<n>/kind=<valid|dead>/[dt=<day>/]part-*``

``id`` is the streaming query's own id, which Spark keeps in the checkpoint's
metadata: a restarted stream writes on where it was, while a second stream, or
a fresh checkpoint at the same path, whose batches count from 0 again, is
another query and has directories of its own. A micro-batch replayed after a
failure replaces its directory. Valid rows and dead letters of a micro-batch
are one write: the topic is read and decoded once, and both appear together,
when the job has finished. Files are sized by Spark's rebalancing of the write,
which also splits a day that has most of the rows.

The landing is a buffer. A job that folds it into a table (``publish_days``,
``refresh``) names what it has taken in (``take``); the next such job drops it.
So listings cover what has landed since the last but one, and a reader planned
before a job finds its files until the one after that.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.finished import MARK_SUCCESS, delete, finished, matching, read_lines, write_lines

VALID, DEAD = "valid", "dead"
_PLACE = [T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType()),
          T.StructField("kind", T.StringType())]


class QueryId:
    """The id of a query, for its batch function: known once ``start`` has
    returned, which may be after the first batch has begun."""

    def __init__(self) -> None:
        self._known = threading.Event()

    def set(self, query) -> None:
        self._id = query.id
        self._known.set()

    def get(self, timeout: float = 600) -> str:
        if not self._known.wait(timeout):
            raise RuntimeError("the streaming query has no id yet")
        return self._id


def land(tagged: DataFrame, base: str, stream: str, batch_id: int, by: tuple[str, ...] = (),
         sort: tuple[str, ...] = (), options: dict | None = None) -> None:
    """Write a micro-batch; rows with a ``reason`` are dead letters."""
    rows = tagged.withColumn("kind", F.when(F.col("reason").isNull(), VALID).otherwise(DEAD))
    write_batch(rows, base, stream, batch_id, by, sort, options)


def write_batch(rows: DataFrame, base: str, stream: str, batch_id: int, by: tuple[str, ...] = (),
                sort: tuple[str, ...] = (), options: dict | None = None) -> None:
    """Write a micro-batch by ``kind``."""
    parts = ["kind", *by]
    (rows.hint("rebalance", *map(F.col, parts)).sortWithinPartitions(*parts, *sort).write.mode("overwrite")
     .options(**MARK_SUCCESS, **(options or {})).partitionBy(*parts)
     .parquet(f"{base.rstrip('/')}/stream={stream}/batch_id={batch_id}"))


def batches(spark: SparkSession, base: str) -> list[str]:
    """Directories of the finished micro-batches of all streams."""
    return finished(spark, f"{base.rstrip('/')}/stream=*/batch_id=*")


def landed(spark: SparkSession, base: str, schema: T.StructType, kind: str = VALID,
           dirs: list[str] | None = None) -> DataFrame:
    """Rows of the finished micro-batches (or of ``dirs``); empty, with the
    schema, before the first. ``schema`` has the partition columns last."""
    dirs = batches(spark, base) if dirs is None else dirs
    full = T.StructType(schema.fields + _PLACE)
    rows = (spark.read.schema(full).option("basePath", base).parquet(*dirs) if dirs
            else spark.createDataFrame([], full))
    return rows.where(F.col("kind") == kind)


# ------------------------------------------------------------ folding a landing
def _name(path: str) -> str:
    return path[path.index("/stream=") + 1:]


def pending(spark: SparkSession, base: str, by: str | None = None) -> list[str]:
    """Directories of valid rows of finished micro-batches that no job has
    taken yet: of whole batches, or one for each value of ``by``."""
    base = base.rstrip("/")
    gone = {x for p in matching(spark, f"{base}/_taken/*") for x in read_lines(spark, p)}
    done = set(batches(spark, base))
    tail = f"kind={VALID}" + (f"/{by}=*" if by else "")
    return [p for p in matching(spark, f"{base}/stream=*/batch_id=*/{tail}")
            if p.partition("/kind=")[0] in done and _name(p) not in gone]


def take(spark: SparkSession, base: str, dirs: list[str]) -> None:
    """Name ``dirs`` as taken in by a job that has finished, and drop what
    earlier jobs had named; batches that keep dead letters stay."""
    base = base.rstrip("/")
    old = matching(spark, f"{base}/_taken/*")
    write_lines(spark, f"{base}/_taken/{dt.datetime.now(dt.timezone.utc):%Y%m%d_%H%M%S_%f}", sorted(map(_name, dirs)))
    for path in old:
        names = read_lines(spark, path)
        for name in names:
            delete(spark, f"{base}/{name}")
        for batch in sorted({n.partition("/kind=")[0] for n in names}):
            if not matching(spark, f"{base}/{batch}/kind=*/*"):
                delete(spark, f"{base}/{batch}")
        delete(spark, path)
