"""Data checks from the master-table definitions (X4) and column defaults
for new master rows (P13).

constraint_report scans each table once for the row-level rules (NULLs,
text length, numeric range) with conditional counts, adds one aggregate
per unique key and one anti join per foreign key, and returns one row per
(table, rule, column) with the number of violations.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Rules:
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    max_length: dict[str, int] = field(default_factory=dict)
    value_range: dict[str, tuple[float, float]] = field(default_factory=dict)
    # column -> regular expression every non-NULL value must match
    pattern: dict[str, str] = field(default_factory=dict)
    # column -> Spark type every non-NULL value must convert to (try_cast)
    castable: dict[str, str] = field(default_factory=dict)
    # column -> (parent DataFrame, parent key column)
    foreign_keys: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)


# Fixed values from the master-table definitions: NOT NULL columns, keys,
# VARCHAR lengths and the DECIMAL(3,2) range of the seller rating; plus the
# documented input checks: an e-mail has one @ and a dot after it.
EMAIL_PATTERN = "^[^@ ]+@[^@ ]+[.][^@ ]+$"
CLIENT_RULES = dict(
    not_null=["client_id", "first_name", "last_name", "email", "registration_date", "status"],
    unique=["client_id", "email"],
    max_length={"first_name": 100, "last_name": 100, "email": 150, "phone": 20, "status": 20},
    pattern={"email": EMAIL_PATTERN},
)
SELLER_RULES = dict(
    not_null=["seller_id", "name", "joined_date"],
    unique=["seller_id"],
    max_length={"name": 150, "contact_email": 150, "contact_phone": 20},
    value_range={"rating": (-9.99, 9.99)},
    pattern={"contact_email": EMAIL_PATTERN},
)
PRODUCT_RULES = dict(not_null=["product_id"], unique=["product_id"])

_ROW = "table string, rule string, column string, violations long"


def _row_rules(df: DataFrame, table: str, r: Rules) -> DataFrame | None:
    checks = []  # (rule, column, condition)
    checks += [("not_null", c, F.col(c).isNull()) for c in r.not_null]
    checks += [("max_length", c, F.length(c) > n) for c, n in r.max_length.items()]
    checks += [("range", c, (F.col(c) < lo) | (F.col(c) > hi)) for c, (lo, hi) in r.value_range.items()]
    checks += [("pattern", c, F.col(c).isNotNull() & ~F.col(c).rlike(rx)) for c, rx in r.pattern.items()]
    checks += [("type", c, F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
               for c, t in r.castable.items()]
    if not checks:
        return None
    one = df.agg(*[F.count_if(cond).alias(f"_v{i}") for i, (_, _, cond) in enumerate(checks)])
    rows = [F.struct(F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.lit(c).alias("column"),
                     F.col(f"_v{i}").cast("long").alias("violations"))
            for i, (rule, c, _) in enumerate(checks)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _unique(df: DataFrame, table: str, c: str) -> DataFrame:
    """Key values held by more than one row (NULL keys ignored). The count
    per key is a partial aggregate, so a hot key is merged map-side."""
    dup = (df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1))
    return dup.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit("unique").alias("rule"), F.lit(c).alias("column"),
        F.col("violations").cast("long"))


def _orphans(df: DataFrame, table: str, c: str, parent: DataFrame, pkey: str) -> DataFrame:
    """Rows whose non-NULL foreign key has no parent row. Child keys are
    counted first (a partial aggregate: a key held by a third of the rows
    becomes one row per task), so the anti join sees distinct keys only."""
    keys = parent.select(F.col(pkey).alias(c))
    per_key = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    miss = per_key.join(keys, c, "left_anti")
    return miss.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit("foreign_key").alias("rule"), F.lit(c).alias("column"),
        F.col("violations").cast("long"))


def constraint_report(df: DataFrame, table: str, rules: Rules | dict) -> DataFrame:
    r = rules if isinstance(rules, Rules) else Rules(**rules)
    parts = []
    rr = _row_rules(df, table, r)
    if rr is not None:
        parts.append(rr)
    parts += [_unique(df, table, c) for c in r.unique]
    parts += [_orphans(df, table, c, p, k) for c, (p, k) in r.foreign_keys.items()]
    if not parts:
        return df.sparkSession.createDataFrame([], _ROW)
    return reduce(DataFrame.unionByName, parts)


def constraint_reports(checks: list[tuple[DataFrame, str, Rules | dict]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [constraint_report(d, t, r) for d, t, r in checks])


# Defaults of the master tables (fixed values): generated id, status
# 'active', rating 0.00, time of insertion.
def _defaults(entity: str) -> dict:
    now = F.current_timestamp()
    if entity == "clients":
        return {"client_id": F.expr("uuid()"), "registration_date": now, "status": F.lit("active")}
    if entity == "sellers":
        return {"seller_id": F.expr("uuid()"), "rating": F.lit(0).cast("decimal(3,2)"),
                "joined_date": now}
    raise ValueError(f"no defaults for {entity!r}")


def fill_defaults(df: DataFrame, entity: str) -> DataFrame:
    """Missing or NULL default columns get their default value."""
    out = df
    for c, default in _defaults(entity).items():
        out = out.withColumn(c, F.coalesce(F.col(c), default) if c in df.columns else default)
    return out
