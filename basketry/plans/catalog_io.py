"""Catalog queries that pass through sinks, sources and streams: the data
is derived from the test tables, written to a fresh folder under the
shared checkpoint folder, processed by the library's jobs and read back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import jobs
from ..functions import amount
from ..operators import quality, reports, unify
from ..operators import stage as stage_ops
from ..operators.decode import decode_purchases, split_valid, valid_rows
from ..session import shared_dir
from ..sinks.reports import write_report
from ..sinks.stage import write_stage
from ..sources.finished import delete
from ..sources.files import read_latest_report, read_products, read_table_or_files, stage
from ..schemas import STAGE
from ..sources.topics import read_topic, stream_topic
from ..streaming import ingest
from ..streaming import upsert as ups
from ..streaming.windows import (read_late_rows, read_windows, start_counted_windows, start_windowed_revenue,
                                 windowed_revenue)
from . import fixtures as fx
from . import params as P
from .catalog import query
from .oracle import SQL, oracle
from .topic_files import publish

TOPIC = "purchases"
AVAILABLE_NOW = {"availableNow": True}
T_OLD = "2024-02-01 00:00:00"
T_NEW = "2024-02-02 00:00:00"


def _publish_purchase_events(spark, d, path, copies=1, with_defects=True, only=None):
    msgs = fx.purchase_messages(fx.purchases_rt(spark, d))
    for _ in range(copies):
        publish(msgs if only is None else msgs.where(only), TOPIC, path, "purchase_id")
    if with_defects:
        publish(fx.defective_events(spark, d), TOPIC, path, "purchase_id", value=F.col("value"))


def _ingest(spark, topic, landing, checkpoint):
    ingest.ingest_purchases(stream_topic(spark, TOPIC, path=topic), landing, checkpoint,
                            trigger=AVAILABLE_NOW).awaitTermination()


def _run_ingest(spark, d, name):
    base = shared_dir(spark, name)
    _publish_purchase_events(spark, d, f"{base}/topic")
    _ingest(spark, f"{base}/topic", f"{base}/landing", f"{base}/checkpoint")
    return f"{base}/landing"


_RT = "SELECT purchase_id, client_id, product_id, quantity, price, ts FROM purchases_rt"


# ------------------------------------------------------------ decoding
@query("decode_purchases")
def q_decode_purchases(spark, d):
    """Batch decode of every message (valid and planted defects)."""
    topic = f"{shared_dir(spark, 'decode')}/topic"
    _publish_purchase_events(spark, d, topic)
    return decode_purchases(read_topic(spark, TOPIC, path=topic), ts_name="ts")


oracle("decode_purchases", "purchases_rt", f"""{_RT}
UNION ALL
SELECT CASE WHEN k = 0 THEN NULL ELSE purchase_id END,
       CASE WHEN k IN (0, 2) THEN NULL ELSE client_id END,
       CASE WHEN k = 0 THEN NULL ELSE product_id END,
       CASE WHEN k IN (0, 3) THEN NULL ELSE quantity END,
       CASE WHEN k IN (0, 1) THEN NULL ELSE price END,
       CASE WHEN k IN (0, 4) THEN NULL ELSE ts END
FROM errs""", extra="""errs AS (
  SELECT CAST(event_id AS VARCHAR) AS purchase_id, CAST(user_id AS VARCHAR) AS client_id,
         props->>'$.k' AS product_id, CAST(1 + event_id % 5 AS INT) AS quantity, value AS price, ts,
         event_id % 5 AS k
  FROM events WHERE event_type = 'error')""")


# ------------------------------------------------------------- stage ETL
def _stage_round_trip(spark, name, df):
    path = f"{shared_dir(spark, 'stage')}/stage_{name}"
    write_stage(stage_ops.with_load_date(df, P.LOAD_DATE), path)
    return stage(spark, name, path=path)


@query("stage_clients")
def q_stage_clients(spark, d):
    return _stage_round_trip(spark, "clients", fx.clients(spark, d))


@query("stage_sellers")
def q_stage_sellers(spark, d):
    return _stage_round_trip(spark, "sellers", fx.sellers(spark, d))


@query("stage_products")
def q_stage_products(spark, d):
    """Product files -> (no catalog table, so) file fallback -> stage."""
    files = f"{shared_dir(spark, 'product-files')}/products"
    fx.products(spark, d).write.mode("overwrite").parquet(files)
    src = read_table_or_files(spark, "basketry_absent_products_table", files)
    return _stage_round_trip(spark, "products", src)


@query("stage_products_latest")
def q_stage_products_latest(spark, d):
    """Two generations of product files under one glob (an older listing of
    every product, then the current one): the stage keeps the newest row
    per product."""
    files = shared_dir(spark, "product-files")
    current = fx.products(spark, d)
    older = (current.withColumn("name", F.concat(F.col("name"), F.lit(" (old)")))
             .withColumn("updated_at", F.lit("2023-12-31T23:00:00+02:00")))
    older.write.mode("overwrite").parquet(f"{files}/generation=1")
    current.write.mode("overwrite").parquet(f"{files}/generation=2")
    src = read_products(spark, f"{files}/generation=*")
    return _stage_round_trip(spark, "products", stage_ops.latest_products(src))


@query("stage_purchases")
def q_stage_purchases(spark, d):
    """Purchases -> JSON messages on the topic -> decode -> stage."""
    topic = f"{shared_dir(spark, 'stage-topic')}/topic"
    publish(fx.purchases(spark, d), TOPIC, topic, "purchase_id")
    path = f"{shared_dir(spark, 'stage')}/stage_purchases"
    write_stage(jobs.stage_purchases(read_topic(spark, TOPIC, path=topic), P.LOAD_DATE), path)
    return stage(spark, "purchases", path=path)


_LD = f"DATE '{P.LOAD_DATE}' AS load_date"
oracle("stage_clients", "clients", f"SELECT *, {_LD} FROM clients")
oracle("stage_sellers", "sellers", f"SELECT *, {_LD} FROM sellers")
oracle("stage_products", "products", f"SELECT *, {_LD} FROM products")
oracle("stage_products_latest", "products", f"SELECT *, {_LD} FROM products")
oracle("stage_purchases", "purchases", f"SELECT *, {_LD} FROM purchases")


_STAGED: dict[tuple[str, str], str] = {}


def _staged(spark, d):
    """Run the stage job on all four entities, once per application and test
    folder; returns the prefix of its catalog tables (in the session's catalog,
    files in the shared folder)."""
    key = spark.sparkContext.applicationId, d
    if key not in _STAGED:
        _STAGED[key] = _stage_all(spark, d)
    return _STAGED[key]


def _stage_all(spark, d):
    base = shared_dir(spark, "stage-etl")
    fx.products(spark, d).write.parquet(f"{base}/files")
    publish(fx.purchases(spark, d), TOPIC, f"{base}/topic", "purchase_id")
    prefix = "stage_" + base.rsplit("-", 1)[1] + "_"
    jobs.stage_etl(spark, "basketry_absent_products_table", f"{base}/files", TOPIC, f"{base}/stage",
                   masters={"clients": fx.clients(spark, d), "sellers": fx.sellers(spark, d)},
                   topic_path=f"{base}/topic", load_date=P.LOAD_DATE, prefix=prefix)
    return prefix


@query("stage_counts")
def q_stage_counts(spark, d):
    """Counts of the stage tables that the job wrote, by catalog name."""
    counts, _ = jobs.stage_report(spark, prefix := _staged(spark, d))
    return counts.withColumn("table", F.replace("table", F.lit(prefix), F.lit("stage_")))


oracle("stage_counts", "clients sellers products purchases", """
SELECT 'stage_clients' AS "table", COUNT(*) AS "rows" FROM clients
UNION ALL SELECT 'stage_sellers', COUNT(*) FROM sellers
UNION ALL SELECT 'stage_products', COUNT(*) FROM products
UNION ALL SELECT 'stage_purchases', COUNT(*) FROM purchases""")


@query("profile")
def q_profile(spark, d):
    """Column profiles of all four stage tables, by catalog name."""
    _, profiles = jobs.stage_report(spark, prefix := _staged(spark, d))
    return profiles.withColumn("table", F.replace("table", F.lit(prefix), F.lit("stage_")))


def _profile_sql(name):
    cols = [(f.name, f.dataType.simpleString()) for f in STAGE[name].fields]
    return [f"SELECT 'stage_{name}' AS \"table\", '{c}' AS \"column\", '{t}' AS data_type, {i} AS position, "
            f"COUNT(*) AS row_count, COUNT(*) - COUNT(" + ("1" if c == "load_date" else f'"{c}"') +
            f") AS null_count FROM {name}" for i, (c, t) in enumerate(cols)]


oracle("profile", "clients sellers products purchases", "\nUNION ALL\n".join(
    x for n in ("clients", "sellers", "products", "purchases") for x in _profile_sql(n)))


# --------------------------------------------------------------- reports
def _report_round_trip(spark, name, df):
    """Two finished stamps (the newer in several part files) and a newest one
    whose job didn't finish; read back the latest finished."""
    base = shared_dir(spark, "reports")
    decoy = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
    write_report(decoy, base, name, dt.datetime(2024, 1, 1, 8, 0, 0))
    write_report(df.repartition(3), base, name, dt.datetime(2024, 1, 2, 8, 0, 0))
    (decoy.write.option("header", True).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
     .csv(f"{base}/{name}_20240103_080000.csv"))
    return read_latest_report(spark, base, name)


@query("report_round_trip")
def q_report_round_trip(spark, d):
    return _report_round_trip(spark, "top_clients", reports.top_clients(fx.purchases(spark, d), P.TOP_N))


@query("report_round_trip_categories")
def q_report_round_trip_categories(spark, d):
    return _report_round_trip(spark, "revenue_by_category", reports.revenue_by_category(
        fx.purchases(spark, d), fx.listed_products(spark, d), cents=True))


@query("report_round_trip_days")
def q_report_round_trip_days(spark, d):
    """With a purchase without a time: its NULL day is read back."""
    p = fx.purchases(spark, d)
    undated = p.withColumn("timestamp", F.lit(None).cast("timestamp"))
    return _report_round_trip(spark, "avg_check_by_day", reports.avg_check_by_day(p.union(undated), exact_cents=True))


@query("report_round_trip_products")
def q_report_round_trip_products(spark, d):
    return _report_round_trip(spark, "top_selling_products", reports.top_selling_products(
        fx.purchases(spark, d), fx.listed_products(spark, d), P.TOP_N))


SQL["report_round_trip"] = SQL["top_clients"]
SQL["report_round_trip_categories"] = SQL["revenue_by_category"]
SQL["report_round_trip_products"] = SQL["top_selling_products"]
oracle("report_round_trip_days", "purchases", """
SELECT CAST("timestamp" AS DATE) AS "date",
       CAST(SUM(CAST(purchase_total AS DECIMAL(18,2))) AS DOUBLE) / COUNT(purchase_total) AS avg_check,
       COUNT(DISTINCT purchase_id) AS purchases_per_day
FROM totals GROUP BY 1""", extra="""totals AS (
  SELECT purchase_id, "timestamp", SUM(quantity * price) AS purchase_total
  FROM (SELECT * FROM purchases UNION ALL
        SELECT purchase_id, client_id, product_id, quantity, price, NULL AS "timestamp" FROM purchases)
  GROUP BY purchase_id, "timestamp")""")


# -------------------------------------------------------------- streaming
@query("ingest_purchases_stream")
def q_ingest_purchases_stream(spark, d):
    return ingest.read_realtime(spark, _run_ingest(spark, d, "ingest"))


@query("ingest_two_streams")
def q_ingest_two_streams(spark, d):
    """The events in two topics, one stream for each, into one landing."""
    base = shared_dir(spark, "two-streams")
    for i, only in enumerate(("quantity <= 2", "quantity > 2")):
        _publish_purchase_events(spark, d, f"{base}/topic{i}", only=only)
        _ingest(spark, f"{base}/topic{i}", f"{base}/landing", f"{base}/checkpoint{i}")
    return ingest.read_realtime(spark, f"{base}/landing")


def _publish_twice(spark, d, name):
    """Land half of the events and publish, then all of them (so the first
    half twice) and publish the changed days again."""
    base = shared_dir(spark, name)
    landing, table = f"{base}/landing", f"{base}/table"
    _publish_purchase_events(spark, d, f"{base}/topic", only="quantity <= 2")
    _ingest(spark, f"{base}/topic", landing, f"{base}/checkpoint")
    ingest.publish_days(spark, landing, table)
    _publish_purchase_events(spark, d, f"{base}/topic")
    _ingest(spark, f"{base}/topic", landing, f"{base}/checkpoint")
    ingest.publish_days(spark, landing, table, ingest.changed_days(spark, landing))
    return table


@query("daily_publish")
def q_daily_publish(spark, d):
    """The real-time table after two publishes, by path."""
    return ingest.read_published(spark, _publish_twice(spark, d, "publish"))


@query("realtime_catalog_table")
def q_realtime_catalog_table(spark, d):
    """The real-time table after two publishes, by catalog name."""
    table = _publish_twice(spark, d, "publish-catalog")
    name = "purchases_rt_" + table.rsplit("-", 1)[1].split("/")[0]
    return ingest.ensure_realtime(spark, name, table).select(*ingest.RT_COLUMNS)


@query("ingest_fresh_checkpoint")
def q_ingest_fresh_checkpoint(spark, d):
    """Half of the events; then the checkpoint is lost, and a stream at the
    same path, whose batches count from 0 again, takes the other half."""
    base = shared_dir(spark, "fresh-checkpoint")
    for i, only in enumerate(("quantity <= 2", "quantity > 2")):
        _publish_purchase_events(spark, d, f"{base}/topic{i}", only=only, with_defects=False)
        _ingest(spark, f"{base}/topic{i}", f"{base}/landing", f"{base}/checkpoint")
        delete(spark, f"{base}/checkpoint")
    return ingest.read_realtime(spark, f"{base}/landing")


@query("publish_late_after_expiry")
def q_publish_late_after_expiry(spark, d):
    """Most events land and are published; their landing expires; late events
    of the same days land and are published."""
    base = shared_dir(spark, "late")
    landing, table = f"{base}/landing", f"{base}/table"
    for i, only in enumerate(("quantity < 5", "quantity = 5")):
        _publish_purchase_events(spark, d, f"{base}/topic{i}", only=only, with_defects=False)
        _ingest(spark, f"{base}/topic{i}", landing, f"{base}/checkpoint{i}")
        ingest.publish_days(spark, landing, table)
        delete(spark, landing)
    return ingest.read_published(spark, table)


def _publish_lines(spark, d, name):
    """Two lines of every purchase, first those of small purchases, which are
    published, then all (so the first ones twice). Returns (landing, table)."""
    base = shared_dir(spark, name)
    landing, table = f"{base}/landing", f"{base}/table"
    rt = fx.purchases_rt(spark, d)
    lines = rt.union(rt.withColumn("product_id", F.concat("product_id", F.lit("-extra"))))
    for i, some in enumerate((lines.where("quantity <= 2"), lines)):
        publish(fx.purchase_messages(some), TOPIC, f"{base}/topic", "purchase_id")
        _ingest(spark, f"{base}/topic", landing, f"{base}/checkpoint")
        if i == 0:
            ingest.publish_days(spark, landing, table)
    return landing, table


@query("purchase_lines_published")
def q_purchase_lines_published(spark, d):
    """All lines after a second publish, by catalog name."""
    landing, table = _publish_lines(spark, d, "lines")
    name = "purchase_lines_" + table.rsplit("-", 1)[1].split("/")[0]
    ingest.ensure_realtime(spark, name, table)
    ingest.publish_days(spark, landing, table, name=name)
    return spark.table(name).select(*ingest.RT_COLUMNS)


@query("purchase_lines_once")
def q_purchase_lines_once(spark, d):
    """All lines, once each, from the published days and what has landed since."""
    landing, table = _publish_lines(spark, d, "lines-once")
    return ingest.read_realtime(spark, landing, once=True, table=table)


for _name in ("purchase_lines_published", "purchase_lines_once"):
    oracle(_name, "purchases_rt", f"""{_RT}
UNION ALL SELECT purchase_id, client_id, product_id || '-extra', quantity, price, ts FROM purchases_rt""")


for _name in ("ingest_fresh_checkpoint", "publish_late_after_expiry"):
    oracle(_name, "purchases_rt", _RT)


for _name in ("ingest_purchases_stream", "ingest_two_streams", "daily_publish", "realtime_catalog_table"):
    oracle(_name, "purchases_rt", _RT)


@query("rt_client_statistics_ingested")
def q_rt_client_statistics_ingested(spark, d):
    """Client statistics over what the stream landed (the client filter meets
    the files' bloom filters)."""
    from ..operators.realtime import rt_client_statistics
    landing = _run_ingest(spark, d, "ingest-stats")
    return rt_client_statistics(ingest.read_realtime(spark, landing), P.STAT_CLIENT, cents=True)


oracle("rt_client_statistics_ingested", "purchases_rt", f"""
SELECT client_id, COUNT(*) AS total_purchases, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       ROUND(SUM(quantity * price), 2) AS total_spent,
       CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / COUNT(price) AS avg_price
FROM purchases_rt WHERE client_id = '{P.STAT_CLIENT}' GROUP BY client_id""")


@query("dead_letters")
def q_dead_letters(spark, d):
    """Rejected messages; the text of those that keep their JSON form is
    compared field by field."""
    dead = ingest.read_dead_letters(spark, _run_ingest(spark, d, "dead-letters"))
    text = F.when(F.col("reason") == "not_json", F.col("value"))
    return dead.select("key", "reason", text.alias("value"), *[
        F.get_json_object("value", f"$.{c}").alias(c) for c in ("purchase_id", "client_id", "product_id")])


oracle("dead_letters", "purchases_rt", """
SELECT CAST(event_id AS VARCHAR) AS "key",
       CASE event_id % 5 WHEN 0 THEN 'not_json' WHEN 1 THEN 'bad_price' WHEN 2 THEN 'missing_field'
                         WHEN 3 THEN 'bad_quantity' ELSE 'bad_timestamp' END AS reason,
       CASE WHEN event_id % 5 = 0 THEN 'error event ' || CAST(event_id AS VARCHAR) END AS "value",
       CASE WHEN event_id % 5 <> 0 THEN CAST(event_id AS VARCHAR) END AS purchase_id,
       CASE WHEN event_id % 5 NOT IN (0, 2) THEN CAST(user_id AS VARCHAR) END AS client_id,
       CASE WHEN event_id % 5 <> 0 THEN props->>'$.k' END AS product_id
FROM events WHERE event_type = 'error'""")


@query("dedup_stream")
def q_dedup_stream(spark, d):
    """Every event sent twice, once more after a restart, and then a new
    purchase for each, three days older than anything sent before it: one row
    per purchase, none lost for being late."""
    base = shared_dir(spark, "dedup")
    topic, landing, checkpoint = f"{base}/topic", f"{base}/landing", f"{base}/checkpoint"
    _publish_purchase_events(spark, d, topic, copies=2)
    _ingest(spark, topic, landing, checkpoint)
    _publish_purchase_events(spark, d, topic, with_defects=False)
    late = fx.purchases_rt(spark, d).withColumn("purchase_id", F.concat("purchase_id", F.lit("-late"))).withColumn(
        "ts", F.col("ts") - F.expr("INTERVAL 3 DAYS"))
    publish(fx.purchase_messages(late), TOPIC, topic, "purchase_id")
    _ingest(spark, topic, landing, checkpoint)
    return ingest.read_realtime(spark, landing, once=True)


oracle("dedup_stream", "purchases_rt", f"""{_RT} UNION ALL
SELECT purchase_id || '-late', client_id, product_id, quantity, price, ts - INTERVAL 3 DAY FROM purchases_rt""")


@query("windowed_revenue_stream")
def q_windowed_revenue_stream(spark, d):
    base = shared_dir(spark, "windows")
    topic, out, ck = f"{base}/topic", f"{base}/out", f"{base}/checkpoint"
    _publish_purchase_events(spark, d, topic)
    valid = valid_rows(split_valid(stream_topic(spark, TOPIC, path=topic)))
    q = start_windowed_revenue(windowed_revenue(valid, "1 hour", "1 day", cents=True), out, ck,
                               trigger=AVAILABLE_NOW)
    q.awaitTermination()
    return spark.read.parquet(out)


oracle("windowed_revenue_stream", "purchases_rt", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       ROUND(SUM(quantity * price), 2) AS revenue, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       COUNT(*) AS total_purchases
FROM purchases_rt GROUP BY 1, 2
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM purchases_rt) - INTERVAL 1 DAY""")


@query("windowed_revenue_counted")
def q_windowed_revenue_counted(spark, d):
    """The later half of the events twice; then all of them, so the earlier
    half is late, and one that closes all windows. Window sums and late rows,
    by hour."""
    base = shared_dir(spark, "counted-windows")
    rt = fx.purchases_rt(spark, d)
    span = rt.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    later = rt.where(F.col("ts") >= F.lit(span.first + (span.last - span.first) / 2))
    end = rt.limit(1).withColumn("ts", F.lit(span.last + dt.timedelta(days=9)))
    for rows in (later.union(later), rt.union(end)):
        publish(fx.purchase_messages(rows), TOPIC, f"{base}/topic", "purchase_id")
        valid = valid_rows(split_valid(stream_topic(spark, TOPIC, path=f"{base}/topic")))
        start_counted_windows(valid, f"{base}/windows", f"{base}/checkpoint", "1 hour", "1 day",
                              trigger=AVAILABLE_NOW).awaitTermination()
    late = read_late_rows(spark, f"{base}/windows").groupBy(F.date_trunc("hour", "ts").alias("window_start")).agg(
        F.sum(amount()).alias("revenue"), F.sum("quantity").alias("total_quantity"),
        F.count("*").alias("total_purchases"))
    sums = read_windows(spark, f"{base}/windows").drop("window_end")
    return sums.unionByName(late).groupBy("window_start").agg(
        F.round(F.sum("revenue"), 2).alias("revenue"), F.sum("total_quantity").alias("total_quantity"),
        F.sum("total_purchases").alias("total_purchases"))


oracle("windowed_revenue_counted", "purchases_rt", """
SELECT date_trunc('hour', ts) AS window_start, ROUND(SUM(quantity * price), 2) AS revenue,
       CAST(SUM(quantity) AS BIGINT) AS total_quantity, COUNT(*) AS total_purchases
FROM purchases_rt GROUP BY 1""")


@query("ingest_from_latest")
def q_ingest_from_latest(spark, d):
    """A topic with events in it; a stream that starts at the latest record,
    more events, a restart, the last events."""
    base = shared_dir(spark, "latest")
    for only in ("quantity <= 2", "quantity = 3", "quantity > 3"):
        _publish_purchase_events(spark, d, f"{base}/topic", only=only, with_defects=False)
        stream = stream_topic(spark, TOPIC, path=f"{base}/topic", starting="latest", checkpoint=f"{base}/checkpoint")
        ingest.ingest_purchases(stream, f"{base}/landing", f"{base}/checkpoint",
                                trigger=AVAILABLE_NOW).awaitTermination()
    return ingest.read_realtime(spark, f"{base}/landing")


oracle("ingest_from_latest", "purchases_rt", f"{_RT} WHERE quantity > 2")


def _run_upsert(spark, entity, current, key):
    """An older version of every row at T_OLD, taken into the table; then the
    current one at T_NEW (numbers sent as text), and messages that are no
    change: text, and rows without the key. Returns (log, table)."""
    base = shared_dir(spark, f"upsert-{entity}")
    topic, log, table = f"{base}/topic", f"{base}/log", f"{base}/table"
    old = current.withColumn("name", F.concat(F.col("name"), F.lit(" (old)")))
    if "price" in current.columns:
        old = old.withColumn("price", F.col("price") + 1)
        current = current.withColumn("price", F.col("price").cast("string"))

    def run():
        ups.upsert(stream_topic(spark, entity, path=topic), entity, log, f"{base}/checkpoint",
                   trigger=AVAILABLE_NOW).awaitTermination()

    publish(old, entity, topic, key, at=T_OLD)
    run()
    ups.refresh(spark, log, entity, table)
    publish(current, entity, topic, key, at=T_NEW)
    publish(current.select(key), entity, topic, key, at=T_NEW, value=F.concat(F.lit("no json "), F.col(key)))
    publish(current.drop(key), entity, topic, None, at=T_NEW)
    run()
    return log, table


@query("upsert_products")
def q_upsert_products(spark, d):
    log, table = _run_upsert(spark, "products", fx.products_rt(spark, d), "product_id")
    return ups.read_upserted(spark, log, "products", table)


@query("upsert_sellers")
def q_upsert_sellers(spark, d):
    """As products, after a second refresh."""
    log, table = _run_upsert(spark, "sellers", fx.sellers_rt(spark, d), "seller_id")
    ups.refresh(spark, log, "sellers", table)
    return ups.read_upserted(spark, log, "sellers", table)


@query("upsert_dead_letters")
def q_upsert_dead_letters(spark, d):
    log, _ = _run_upsert(spark, "products", fx.products_rt(spark, d), "product_id")
    dead = ups.read_upsert_dead_letters(spark, log, "products")
    return dead.select("reason", F.when(F.col("reason") == "not_json", F.col("value")).alias("value"),
                       F.get_json_object("value", "$.name").alias("name"))


oracle("upsert_products", "products_rt",
       "SELECT product_id, name, category, price, description, seller_id FROM products_rt")
oracle("upsert_sellers", "sellers_rt", "SELECT seller_id, name, email, phone, address FROM sellers_rt")
oracle("upsert_dead_letters", "products_rt", """
SELECT 'not_json' AS reason, 'no json ' || product_id AS "value", NULL AS name FROM products_rt
UNION ALL SELECT 'missing_field', NULL, name FROM products_rt""")


# ------------------------------------------------- unified record, quality
@query("unified_record")
def q_unified_record(spark, d):
    return unify.flatten_unified(unify.unified(fx.purchases(spark, d), fx.clients(spark, d),
                                               fx.listed_products(spark, d)))


oracle("unified_record", "purchases clients listed_products", """
SELECT p.purchase_id, p.client_id, p.product_id, p.quantity, p.price, p."timestamp",
       c.first_name, c.last_name, c.email, pr.name AS product_name, pr.category,
       pr.price AS product_price
FROM purchases p LEFT JOIN clients c ON p.client_id = c.client_id
LEFT JOIN listed_products pr ON p.product_id = pr.product_id""")


@query("constraint_report")
def q_constraint_report(spark, d):
    clients, sellers = fx.clients(spark, d), fx.sellers(spark, d)
    products, purchases = fx.listed_products(spark, d), fx.purchases(spark, d)
    purchase_rules = quality.Rules(
        not_null=["purchase_id", "client_id", "product_id", "quantity", "price", "timestamp"],
        value_range={"quantity": (0, 2147483647)},
        castable={"purchase_id": "bigint", "client_id": "bigint"},
        foreign_keys={"client_id": (clients, "client_id"), "product_id": (products, "product_id")})
    return quality.constraint_reports([
        (clients, "clients", quality.CLIENT_RULES), (sellers, "sellers", quality.SELLER_RULES),
        (products, "products", quality.PRODUCT_RULES), (purchases, "purchases", purchase_rules)])


def _nn(t, cols):
    return [f"SELECT '{t}' AS \"table\", 'not_null' AS rule, '{c}' AS \"column\", "
            f"COUNT(*) - COUNT(\"{c}\") AS violations FROM {t}" for c in cols]


def _len(t, cols):
    return [f"SELECT '{t}', 'max_length', '{c}', COUNT(*) FILTER (WHERE length({c}) > {n}) FROM {t}"
            for c, n in cols.items()]


def _rng(t, cols):
    return [f"SELECT '{t}', 'range', '{c}', COUNT(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) FROM {t}"
            for c, (lo, hi) in cols.items()]


def _pat(t, cols):
    return [f"SELECT '{t}', 'pattern', '{c}', COUNT(*) FILTER (WHERE {c} IS NOT NULL "
            f"AND NOT regexp_matches({c}, '{rx}')) FROM {t}" for c, rx in cols.items()]


def _typ(t, cols):
    return [f"SELECT '{t}', 'type', '{c}', COUNT(*) FILTER (WHERE {c} IS NOT NULL "
            f"AND TRY_CAST({c} AS {ty.upper()}) IS NULL) FROM {t}" for c, ty in cols.items()]


def _uniq(t, cols):
    return [f"SELECT '{t}', 'unique', '{c}', (SELECT COUNT(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL "
            f"GROUP BY {c} HAVING COUNT(*) > 1)) FROM (SELECT 1)" for c in cols]


def _fk(t, c, parent, pk):
    return [f"SELECT '{t}', 'foreign_key', '{c}', COUNT(*) FROM {t} WHERE {c} IS NOT NULL "
            f"AND {c} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)"]


def _rules_sql(t, r):
    r = quality.Rules(**r) if isinstance(r, dict) else r
    return (_nn(t, r.not_null) + _len(t, r.max_length) + _rng(t, r.value_range) + _pat(t, r.pattern)
            + _typ(t, r.castable) + _uniq(t, r.unique))


oracle("constraint_report", "clients sellers listed_products purchases", "\nUNION ALL\n".join(
    _rules_sql("clients", quality.CLIENT_RULES) + _rules_sql("sellers", quality.SELLER_RULES)
    + _rules_sql("products", quality.PRODUCT_RULES)
    + _rules_sql("purchases", dict(
        not_null=["purchase_id", "client_id", "product_id", "quantity", "price", "timestamp"],
        value_range={"quantity": (0, 2147483647)},
        castable={"purchase_id": "bigint", "client_id": "bigint"}))
    + _fk("purchases", "client_id", "clients", "client_id")
    + _fk("purchases", "product_id", "products", "product_id")),
    extra="products AS (SELECT * FROM listed_products)")


@query("fill_defaults")
def q_fill_defaults(spark, d):
    """New clients arrive with names and contacts only; id, registration
    time and status come from the defaults (generated values are checked
    for presence only)."""
    arriving = fx.clients(spark, d).select("first_name", "last_name", "email", "phone", "address")
    filled = quality.fill_defaults(arriving, "clients")
    uuid_re = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
    return filled.select("first_name", "last_name", "email", "phone", "address", "status",
                         F.col("client_id").rlike(uuid_re).alias("has_id"),
                         F.col("registration_date").isNotNull().alias("has_registration_date"))


oracle("fill_defaults", "clients", """
SELECT first_name, last_name, email, phone, address, 'active' AS status, TRUE AS has_id,
       TRUE AS has_registration_date FROM clients""")
