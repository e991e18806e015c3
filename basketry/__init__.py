"""basketry: retail purchase analytics as plain PySpark DataFrame functions.

Layout
------
schemas     explicit StructTypes for every entity (never inferred)
session     session builder for tests/bench and the shared scratch folder
functions/  Column -> Column helpers (amount, time parsing, formatting)
sources/    readers: files, tables, topics (Kafka or file stand-in), JDBC, reports
sinks/      writers: stage tables, CSV reports, topic publishing
operators/  DataFrame -> DataFrame operators: decode, reports, real-time
            queries, unified record, quality checks, profiling
streaming/  Structured Streaming jobs: ingest with dead letters, dedup,
            windowed revenue, keyed upserts
plans/      test-table adapters and the named query catalog used by the
            entry module and bench
"""

__version__ = "0.1.0"
