"""One decoder for purchase messages, shared by the batch ETL and the stream
(P2-P4, F2-F5, F14, F16).

* ``value`` (bytes or text) is cast to text and parsed with ``from_json``
  against an explicit schema; ``price`` is read as text and converted with
  try_cast, so ``"9.5"`` and ``9.5`` both work and ``"x"`` gives NULL.
* ISO times with ``Z``, offsets or no zone parse with ``try_to_timestamp``
  (Spark 4 runs ANSI mode, where ``to_timestamp`` would raise on bad text).
* Batch keeps every message (malformed JSON becomes an all-NULL row, as in
  the reference); the stream splits messages into valid rows and dead letters
  with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lenient_double, parse_iso_ts
from ..schemas import PURCHASE_MESSAGE

FIELDS = [f.name for f in PURCHASE_MESSAGE.fields]

# Dead-letter reasons, checked in this order (fixed values).
NOT_JSON = "not_json"
MISSING_FIELD = "missing_field"
BAD_PRICE = "bad_price"
BAD_QUANTITY = "bad_quantity"
BAD_TIMESTAMP = "bad_timestamp"


def parsed(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``value`` -> struct ``m`` of the message fields (raw text for price and
    time), plus the raw text as ``value`` and any ``keep`` columns."""
    text = F.col(value).cast("string")
    return raw.select(*keep, text.alias("value"), F.from_json(text, PURCHASE_MESSAGE).alias("m"))


def _typed(ts_name: str) -> list[Column]:
    return [
        F.col("m.purchase_id").alias("purchase_id"),
        F.col("m.client_id").alias("client_id"),
        F.col("m.product_id").alias("product_id"),
        F.col("m.quantity").alias("quantity"),
        lenient_double("m.price").alias("price"),
        parse_iso_ts("m.timestamp").alias(ts_name),
    ]


def decode_purchases(raw: DataFrame, value: str = "value", ts_name: str = "timestamp",
                     drop_malformed: bool = False) -> DataFrame:
    """Every message becomes one typed row; unparsable parts are NULL.
    A message that is not a JSON object becomes an all-NULL row, as in the
    reference, unless ``drop_malformed`` (then use ``split_valid`` and
    ``dead_letters`` to keep them aside)."""
    p = parsed(raw, value)
    if drop_malformed:
        p = p.withColumn("reason", reject_reason()).where(
            F.col("reason").isNull() | (F.col("reason") != F.lit(NOT_JSON)))
    return p.select(*_typed(ts_name))


def reject_reason() -> Column:
    """NULL for a valid message, else the first failed check (P3 rules:
    every field present, price numeric, quantity a whole number >= 0, time
    parses). Works on the output of ``parsed``."""
    m = F.col("m")
    all_null = F.lit(True)
    for f in FIELDS:  # fields differ in type, so no coalesce (ANSI would cast ids)
        all_null = all_null & m[f].isNull()
    # Only messages whose every field is NULL pay for a second parse.
    not_object = all_null & F.json_object_keys(F.col("value")).isNull()
    missing = F.lit(False)
    for f in ("purchase_id", "client_id", "product_id", "price", "timestamp"):
        missing = missing | m[f].isNull()
    return (F.when(not_object, F.lit(NOT_JSON))
             .when(missing, F.lit(MISSING_FIELD))
             .when(lenient_double(m["price"]).isNull(), F.lit(BAD_PRICE))
             .when(m["quantity"].isNull() & F.get_json_object("value", "$.quantity").isNull(), F.lit(MISSING_FIELD))
             .when(m["quantity"].isNull() | (m["quantity"] < 0), F.lit(BAD_QUANTITY))
             .when(parse_iso_ts(m["timestamp"]).isNull(), F.lit(BAD_TIMESTAMP)))


def split_valid(raw: DataFrame, value: str = "value", ts_name: str = "ts",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode and tag: typed columns plus ``reason`` (NULL when valid) and the
    raw ``value`` text; ``keep`` carries source columns (key, offset...)."""
    p = parsed(raw, value, keep).withColumn("reason", reject_reason())
    return p.select(*keep, "value", "reason", *_typed(ts_name))


def valid_rows(tagged: DataFrame, ts_name: str = "ts") -> DataFrame:
    return tagged.where(F.col("reason").isNull()).select(
        "purchase_id", "client_id", "product_id", "quantity", "price", ts_name)


def dead_letters(tagged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """K4: rejected messages with their raw text and reason."""
    return tagged.where(F.col("reason").isNotNull()).select(*keep, "value", "reason")


def encode_json(df: DataFrame, ts_format: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX") -> Column:
    """the row as a JSON object; timestamps as ISO text with zone."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"timestampFormat": ts_format})
