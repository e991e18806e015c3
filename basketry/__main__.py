"""Command line for the batch and streaming jobs (``spark-submit`` target).

    S="spark-submit --py-files basketry.zip basketry/__main__.py"
    $S stage-etl --stage-base s3a://lake/stage --products-path 's3a://products/*.parquet' \
        --topic purchases --servers broker:9092 --jdbc-url jdbc:postgresql://db/shop --jdbc-user etl --jdbc-partitions 16
    $S reports --stage-base s3a://lake/stage --reports-base s3a://lake/reports
    $S stage-report
    $S ingest --topic purchases --servers broker:9092 --landing s3a://rt/landing --checkpoint s3a://rt/_checkpoints/purchases
    $S publish-days --landing s3a://rt/landing --table s3a://rt/purchases --after 2024-05-01T00:00:00
    $S publish --entity products --files s3a://lake/new_products --topic products --servers broker:9092
    $S upsert --entity products --topic products --servers broker:9092 --log s3a://rt/products_log \
        --checkpoint s3a://rt/_checkpoints/products
    $S refresh --entity products --log s3a://rt/products_log --table s3a://rt/products

(``python -m basketry ...`` works the same where the package is installed.)

The session comes from the cluster (``SparkSession.builder.getOrCreate``);
only the UTC time zone is set, which the day and hour reports rely on.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import SparkSession

if not __package__:  # run as a script: make the package importable from its checkout
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="basketry")
    sub = ap.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stage-etl", help="sources -> stage tables (full refresh)")
    s.add_argument("--stage-base", required=True)
    s.add_argument("--products-table", default="products")
    s.add_argument("--products-path", required=True)
    s.add_argument("--topic", default="purchases")
    s.add_argument("--servers", help="Kafka bootstrap servers")
    s.add_argument("--topic-path", help="recorded topic (no Kafka)")
    s.add_argument("--jdbc-url")
    s.add_argument("--jdbc-partitions", type=int, default=1, help="parallel reads of each master table")
    s.add_argument("--jdbc-user", default=os.environ.get("JDBC_USER"))
    s.add_argument("--jdbc-password-env", default="JDBC_PASSWORD",
                   help="environment variable holding the password")
    s.add_argument("--dedup-products", action="store_true")

    r = sub.add_parser("reports", help="stage tables -> four CSV reports")
    r.add_argument("--stage-base", required=True)
    r.add_argument("--reports-base", required=True)
    r.add_argument("--top-clients", type=int, default=10)
    r.add_argument("--top-products", type=int, default=10)

    t = sub.add_parser("stage-report", help="show counts, profiles and sample rows of the stage tables")
    t.add_argument("--rows", type=int, default=20, help="sample rows per table")

    i = sub.add_parser("ingest", help="purchase topic -> landing of valid rows and dead letters")
    i.add_argument("--topic", default="purchases")
    i.add_argument("--landing", required=True)
    u = sub.add_parser("upsert", help="product or seller topic -> log of changes")
    u.add_argument("--entity", required=True, choices=["products", "sellers"])
    u.add_argument("--topic", required=True)
    u.add_argument("--log", required=True)
    for x in (i, u):
        x.add_argument("--servers")
        x.add_argument("--topic-path")
        x.add_argument("--starting", help="earliest, latest or an ISO time; for the first run only")
        x.add_argument("--stop-file", help="end the service once this path exists")
        x.add_argument("--restarts", type=int, default=3, help="failures in a row after which it gives up")
        x.add_argument("--checkpoint", required=True)
        x.add_argument("--trigger", default="1 second", help="processing-time interval, or 'available-now'")

    d = sub.add_parser("publish-days", help="landing -> real-time table, days that changed")
    d.add_argument("--landing", required=True)
    d.add_argument("--table", required=True)
    d.add_argument("--name", help="catalog table over the published days")
    d.add_argument("--after", type=dt.datetime.fromisoformat, help="only days with rows landed since (UTC)")
    f = sub.add_parser("refresh", help="log of changes -> next load of the table")
    f.add_argument("--entity", required=True, choices=["products", "sellers"])
    f.add_argument("--log", required=True)
    f.add_argument("--table", required=True)

    p = sub.add_parser("publish", help="Parquet rows -> JSON messages on a topic")
    p.add_argument("--entity", required=True, choices=["products", "sellers", "purchases"])
    p.add_argument("--files", required=True)
    p.add_argument("--topic", required=True)
    p.add_argument("--servers", required=True)
    return ap


KEYS = {"products": "product_id", "sellers": "seller_id", "purchases": "purchase_id"}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"basketry-{args.cmd}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    from basketry import jobs
    from basketry.sources.files import stage

    if args.cmd == "stage-etl":
        props = {"user": args.jdbc_user or "", "password": os.environ.get(args.jdbc_password_env, "")}
        return jobs.stage_etl(spark, args.products_table, args.products_path, args.topic, args.stage_base,
                              jdbc_url=args.jdbc_url, jdbc_props=props, servers=args.servers,
                              topic_path=args.topic_path, dedup_products=args.dedup_products,
                              jdbc_partitions=args.jdbc_partitions)
    if args.cmd == "stage-report":
        from basketry.operators.stage import sample
        counts, profiles = jobs.stage_report(spark)
        for df in (counts, profiles, *(sample(spark.table(f"stage_{n}"), args.rows) for n in jobs.STAGE_TABLES)):
            df.show(1000, truncate=False)
        return {"tables": list(jobs.STAGE_TABLES)}
    if args.cmd == "reports":
        base = args.stage_base.rstrip("/")
        purchases = stage(spark, "purchases", path=f"{base}/stage_purchases")
        products = stage(spark, "products", path=f"{base}/stage_products")
        return jobs.report_job(purchases, products, args.reports_base, args.top_clients, args.top_products)
    if args.cmd == "publish-days":
        from basketry.streaming.ingest import changed_days, publish_days
        days = args.after and changed_days(spark, args.landing, args.after.replace(tzinfo=dt.timezone.utc))
        return {"days": publish_days(spark, args.landing, args.table, days, name=args.name)}
    if args.cmd == "refresh":
        from basketry.streaming.upsert import refresh
        return {"load": refresh(spark, args.log, args.entity, args.table)}
    if args.cmd == "publish":
        from basketry.sinks.topics import publish_json
        publish_json(spark.read.parquet(args.files), args.topic, args.servers, KEYS[args.entity])
        return {"topic": args.topic}
    from basketry.sources.topics import stream_topic
    from basketry.streaming.ingest import ingest_purchases
    from basketry.streaming.service import keep_running, stop_file
    from basketry.streaming.upsert import upsert
    trigger = ({"availableNow": True} if args.trigger == "available-now"
               else {"processingTime": args.trigger})

    def start():
        stream = stream_topic(spark, args.topic, servers=args.servers, path=args.topic_path, starting=args.starting,
                              checkpoint=args.checkpoint)
        return (ingest_purchases(stream, args.landing, args.checkpoint, trigger) if args.cmd == "ingest"
                else upsert(stream, args.entity, args.log, args.checkpoint, trigger))
    last = keep_running(start, lambda p: print(p, flush=True),
                        stop_file(spark, args.stop_file) if args.stop_file else None, args.restarts)
    return {"last_batch": last}


if __name__ == "__main__":
    main(sys.argv[1:])
