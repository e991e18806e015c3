import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import omh
from basketry.llm.queries import op5_order_minhash

M = (1 << 64) - 1
P1, P2, P3, P4, P5 = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                      0x27D4EB2F165667C5)


def rotl(x, r):
    return (x << r | x >> 64 - r) & M


def final(h):
    h = (h ^ h >> 33) * P2 & M
    h = (h ^ h >> 29) * P3 & M
    return h ^ h >> 32


def spark_hash(*values):
    """Spark's xxhash64 of words and numbers: each seeds the next."""
    import xxhash
    seed = 42
    for v in values:
        if v is None:
            continue
        if isinstance(v, str):
            seed = xxhash.xxh64_intdigest(v.encode(), seed)
        elif isinstance(v, tuple):  # a bigint
            h = (seed + P5 + 8) & M
            h ^= rotl((v[0] & M) * P2 & M, 31) * P1 & M
            seed = final((rotl(h, 27) * P1 + P4) & M)
        else:  # an int
            h = (seed + P5 + 4) & M
            h ^= (v & 0xFFFFFFFF) * P1 & M
            seed = final((rotl(h, 23) * P2 + P3) & M)
    return seed - (1 << 64) if seed >> 63 else seed


def order_keys(found, t):
    """spark_hash((e,), t) of an array of numbers."""
    u = np.uint64
    rot = lambda x, r: x << u(r) | x >> u(64 - r)
    last = lambda h: (lambda g: g ^ g >> u(32))((lambda f: (f ^ f >> u(29)) * u(P3))((h ^ h >> u(33)) * u(P2)))
    h = u(42 + P5 + 8 & M) ^ rot(found.astype(u) * u(P2), 31) * u(P1)
    seed = last(rot(h, 27) * u(P1) + u(P4))
    h = (seed + u(P5) + u(4)) ^ u(t * P1 & M)
    return last(rot(h, 23) * u(P2) + u(P3)).astype(np.int64)


def test_hash_of_arrays():
    e = np.array([0, 5, -7, 1 << 35], np.int64)
    assert order_keys(e, 9).tolist() == [spark_hash((int(x),), 9) for x in e]


def plain_signature(text, k=omh.K):
    """64 orders of all occurrence-numbered k-mers: the least of each, and the
    least of the reversed one, in text order."""
    words = (text or "").split()
    grams = [words[i:i + k] for i in range(len(words) - k + 1)] or ([words] if words else [])
    seen, found = {}, []
    for place, g in enumerate(grams):
        h = spark_hash(*g) >> 28
        found.append((spark_hash((h,), seen.get(h, 0)) >> 28, place))
        seen[h] = seen.get(h, 0) + 1
    if not found:
        return [0] * omh.TUPLES
    out, numbers = [], np.array([e for e, _ in found], np.int64)
    for t in range(omh.TUPLES):
        keys = order_keys(numbers, t) >> 28
        low, high = int(keys.argmin()), len(keys) - 1 - int(keys[::-1].argmax())
        out.append(spark_hash(*[(int(keys[i]),) for i in sorted({low, high})]) & 65535)
    return out


def likeness(a, b):
    return sum(x == y for x, y in zip(a, b)) / len(a)


def make_texts(seed=1, n=30):
    rnd = random.Random(seed)
    words = "a bb ccc d é ff g 中文 hh".split()
    out = [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 3, 10, 200]))) for _ in range(n)]
    return out + ["", None, " \n ", "a " * 400, "x", "x", " a\tb\nc "]


def plain_rows(rows):
    """rows: (id, text) -> the query's columns, brute force."""
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for k, (i, t) in enumerate(order):
        n = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + n[:half]
        a, b, c = map(plain_signature, (t, edited, n))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{x:04x}" for x in a),
                    "".join(f"{x:04x}" for x in b), likeness(a, b), likeness(a, c)))
    return out


def query_rows(df, **kw):
    found = omh.fingerprint_pairs(df, **kw)
    return [tuple(r) for r in found.select(
        "id", "n_chars", "edited_sha256", omh.as_text("signature"), omh.as_text("edited_signature"),
        omh.likeness("signature", "edited_signature"), omh.likeness("signature", "next_signature")).collect()]


@pytest.mark.parametrize("bucket_rows", [500, 3])
def test_against_plain_order_minhash(docs_of, bucket_rows):
    texts = make_texts()
    rnd = random.Random(4)
    ids = rnd.sample(range(-50, 1000), len(texts) - 3) + [5000, 5000, None]
    rows = list(zip(ids, texts))
    got = query_rows(docs_of([(i, t, "en", "s", 1) for i, t in rows]), bucket_rows=bucket_rows)
    assert sorted(got, key=repr) == sorted(plain_rows(rows), key=repr)


def test_order_matters(spark):
    a = " ".join(f"w{i}" for i in range(40))
    swapped = " ".join([f"w{i}" for i in range(20, 40)] + [f"w{i}" for i in range(20)])
    df = omh.signatures(spark.createDataFrame([(1, a), (2, swapped)], "key bigint, text string"))
    x, y = (r.signature for r in df.orderBy("key").collect())
    assert likeness(x, x) == 1 and likeness(x, y) < 0.7


def test_one_row_and_empty_table(docs_of):
    assert query_rows(docs_of([])) == []
    assert query_rows(docs_of(["some words in a row"])) == plain_rows([(0, "some words in a row")])


def test_long_text_and_clashing_names(docs_of):
    rnd = random.Random(8)
    long = " ".join(rnd.choice(["aa", "b", "ccc", "dd"]) + str(rnd.randrange(900)) for _ in range(20_000))
    rows = [(1, long), (2, long[:70_000]), (3, "short one"), (3, "short one")]
    df = docs_of([(i, t, "en", "s", 1) for i, t in rows])
    for c in ("row", "next_row", "bucket", "edited", "signature", "lead", "first", "parts", "g", "b", "n_chars"):
        df = df.withColumn(c, F.lit("clash"))
    assert sorted(query_rows(df), key=repr) == sorted(plain_rows(rows), key=repr)


def test_query_on_whole_table(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    out = op5_order_minhash(spark, d)
    got = {r.doc_id: tuple(r) for r in out.collect()}
    want = plain_rows([(r.doc_id, r.text) for r in docs])
    assert got == {r[0]: r for r in want}
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert sum(r[5] > r[6] for r in want) > 0.8 * len(want)
