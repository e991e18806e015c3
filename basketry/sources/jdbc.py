"""Relational sources (S1, S2): master tables over JDBC.

The reference reads each table in one partition. Here a numeric or date
column can split the read into parallel range queries (bounds fetched from
the database when not given), or ``predicates`` can, for instance
``hash_predicates`` on a UUID key. Filters and column selection on the result are pushed
into the database query by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Hash expressions per database for splitting a read on a text key (the
# master tables' keys are UUIDs, so there is no numeric range to split on).
HASH_SQL = {
    "postgresql": "(hashtext(CAST({col} AS text)) & 2147483647)",  # never negative; abs() overflows
    "mysql": "CRC32(CAST({col} AS CHAR))",
}


def hash_predicates(column: str, n: int, dialect: str = "postgresql") -> list[str]:
    """``n`` WHERE clauses that split a table into disjoint parts by a hash
    of ``column``; together they cover every row (NULL keys in the last).
    Pass them as ``predicates`` to ``read_jdbc``: one partition each."""
    h = HASH_SQL[dialect].format(col=column)
    parts = [f"MOD({h}, {n}) = {i}" for i in range(n)]
    parts[-1] = f"({parts[-1]} OR {column} IS NULL)"
    return parts


def numeric_bounds(spark: SparkSession, url: str, table: str, column: str,
                   props: dict | None = None) -> tuple:
    """(min, max) of a numeric column, computed by the database (one row)."""
    q = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"
    row = spark.read.jdbc(url, q, properties=dict(props or {})).first()
    return row["lo"], row["hi"]


def read_jdbc(spark: SparkSession, url: str, table: str, props: dict | None = None,
              partition_column: str | None = None, lower: int | str | None = None,
              upper: int | str | None = None, num_partitions: int | None = None,
              predicates: list[str] | None = None, fetch_size: int = 10000) -> DataFrame:
    props = dict(props or {})
    props.setdefault("fetchsize", str(fetch_size))
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    if partition_column:
        if lower is None or upper is None:
            lower, upper = numeric_bounds(spark, url, table, partition_column, props)
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions or 8, properties=props)
    return spark.read.jdbc(url, table, properties=props)


# Master tables and the keys that split their reads.
MASTER_KEYS = {"clients": "client_id", "sellers": "seller_id"}


def master_predicates(url: str, partitions: int) -> dict[str, list[str] | None]:
    """WHERE clauses that split each master table into ``partitions`` reads by
    a hash of its key; None (one read) for 1, or for a database whose hash
    function isn't known."""
    dialect = url.removeprefix("jdbc:").split(":", 1)[0]
    return {n: hash_predicates(k, partitions, dialect) if partitions > 1 and dialect in HASH_SQL else None
            for n, k in MASTER_KEYS.items()}


def read_masters(spark: SparkSession, url: str, props: dict | None = None, schema: str = "public",
                 partitions: int = 1) -> dict[str, DataFrame]:
    """The master tables the stage job loads, each in ``partitions``
    parallel reads."""
    return {n: read_jdbc(spark, url, f"{schema}.{n}", props, predicates=p)
            for n, p in master_predicates(url, partitions).items()}
