import datetime as dt

from pyspark.sql import functions as F

from basketry.operators import decode as D

OK = '{"purchase_id":"%s","client_id":"c","product_id":"p","quantity":2,"price":%s,"timestamp":"%s"}'


def _raw(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, value string")


def test_batch_decode_edge_rows(spark):
    raw = _raw(spark, [
        "garbage",
        OK % ("a", '"9.5"', "2025-04-06T12:00:00+03:00"),
        OK % ("b", '"x"', "2025-04-06T12:00:00Z"),
        OK.replace('"quantity":2', '"quantity":2.5') % ("c", "1", "2025-04-06T12:00:00"),
        OK.replace('"quantity":2', '"quantity":"3"') % ("d", "1", "2025-04-06T12:00:00"),
        OK.replace('"quantity":2', '"quantity":-1') % ("e", "1", "2025-04-06T12:00:00"),
        OK.replace('"client_id":"c",', "") % ("f", "1", "2025-04-06T12:00:00"),
        OK % ("g", "1", "bad"),
    ])
    out = {r.purchase_id: r for r in D.decode_purchases(raw).collect()}
    assert out[None].client_id is None and out[None].price is None  # not JSON -> all NULL
    assert out["a"].price == 9.5 and out["a"].timestamp == dt.datetime(2025, 4, 6, 9, 0)  # +03:00 -> 09:00 UTC
    assert out["b"].price is None and out["b"].timestamp == dt.datetime(2025, 4, 6, 12, 0)
    assert out["c"].quantity is None and out["d"].quantity is None
    assert out["e"].quantity == -1  # batch keeps negative quantity
    assert out["f"].client_id is None
    assert out["g"].timestamp is None  # no ANSI exception


def test_stream_reasons(spark):
    raw = _raw(spark, [
        "garbage", "[1,2]",
        OK % ("a", '"9.5"', "2025-04-06T12:00:00Z"),
        OK % ("b", '"x"', "2025-04-06T12:00:00Z"),
        OK.replace('"quantity":2', '"quantity":2.5') % ("c", "1", "2025-04-06T12:00:00"),
        OK.replace('"quantity":2', '"quantity":-1') % ("e", "1", "2025-04-06T12:00:00"),
        OK.replace('"client_id":"c",', "") % ("f", "1", "2025-04-06T12:00:00"),
        OK % ("g", "1", "bad"),
    ])
    tagged = D.split_valid(raw, keep=("k",))
    reasons = dict(tagged.select("k", "reason").collect())
    assert reasons == {0: D.NOT_JSON, 1: D.NOT_JSON, 2: None, 3: D.BAD_PRICE, 4: D.BAD_QUANTITY,
                       5: D.BAD_QUANTITY, 6: D.MISSING_FIELD, 7: D.BAD_TIMESTAMP}
    valid = D.valid_rows(tagged).collect()
    assert [(r.purchase_id, r.price) for r in valid] == [("a", 9.5)]
    dead = D.dead_letters(tagged, keep=("k",))
    assert dead.count() == 7 and set(dead.columns) == {"k", "value", "reason"}


def test_zone_less_time_is_utc(spark):
    raw = _raw(spark, [OK % ("a", "1", "2025-04-06T12:00:00"), OK % ("b", "1", "2025-04-06T12:00:00Z")])
    ts = [r.ts for r in D.split_valid(raw).orderBy("purchase_id").collect()]
    assert ts[0] == ts[1] == dt.datetime(2025, 4, 6, 12, 0)


def test_encode_decode_round_trip(spark, sf_small):
    from basketry.plans import fixtures as fx
    rt = fx.purchases_rt(spark, sf_small)
    msgs = fx.purchase_messages(rt)
    back = D.decode_purchases(msgs.select(D.encode_json(msgs).alias("value")), ts_name="ts")
    assert back.exceptAll(rt).count() == 0 and rt.exceptAll(back).count() == 0


def test_bytes_value(spark):
    raw = spark.createDataFrame([(bytearray(OK % ("a", "1", "2025-01-01T00:00:00Z"), "utf-8"),)], "value binary")
    assert D.decode_purchases(raw).where(F.col("purchase_id") == "a").count() == 1


def test_batch_drop_malformed(spark):
    raw = _raw(spark, ["garbage", OK % ("a", '"x"', "2025-04-06T12:00:00Z")])
    out = D.decode_purchases(raw, drop_malformed=True).collect()
    assert [(r.purchase_id, r.price) for r in out] == [("a", None)]  # other defects stay as NULLs
