"""Crowded cells are divided by their other segments and keep every link."""

import random

import pytest

from basketry.llm import simhash


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def near_pairs(rnd, n, low):
    """``n`` pairs 0 to 3 bits apart, all with the low half ``low`` before the bits are flipped."""
    for k in range(n):
        f = rnd.getrandbits(32) << 32 | low
        g = f
        for b in rnd.sample(range(64), k % 4):
            g ^= 1 << b
        yield f, g


@pytest.mark.parametrize("bits", [2, 3, 5])
def test_no_link_of_a_crowded_cell_is_lost(spark, bits):
    rnd = random.Random(bits)
    pairs = list(near_pairs(rnd, 400, 0x1234ABCD))
    df = spark.createDataFrame([(signed(f),) for f in {x for p in pairs for x in p}], "fp bigint")
    links = {frozenset((r.a & (1 << 64) - 1, r.b & (1 << 64) - 1))
             for r in simhash.near_links(df, bits, 50, 4).collect()}
    assert all(bin(a ^ b).count("1") <= bits for a, b in map(tuple, links))
    assert {frozenset(p) for p in pairs if 0 < bin(p[0] ^ p[1]).count("1") <= bits} <= links


def test_a_crowded_cell_is_dealt_over_many(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(signed(f),) for f in {rnd.getrandbits(32) << 32 | 0xF0F0AAAA for _ in range(4000)}],
                               "fp bigint")
    whole = simhash._cells(df, 3).groupBy("cell").count().agg({"count": "max"}).first()[0]
    dealt = simhash._spread(df, 3, 500, 4).groupBy("cell").count().agg({"count": "max"}).first()[0]
    assert whole >= 4000 > 20 * dealt


def test_no_crowded_cell_and_no_rows(spark):
    few = spark.createDataFrame([(1,), (3,), (1 << 40,)], "fp bigint")
    assert sorted(map(tuple, simhash._spread(few, 3, 500, 4).collect())) == sorted(
        (r.cell, r.up, r.fp) for r in simhash._cells(few, 3).collect())
    assert simhash.near_links(few.where("fp < 0")).count() == 0
