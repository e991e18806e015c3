"""Blocks of a large cell, with Arrow batches smaller than the cell."""

import random

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import simhash


@pytest.mark.parametrize("size", [1, 3, 5])
def test_no_block_is_over_the_limit(size):
    keys = np.repeat([1, 2, 3, 4], [9, 11, 2, 23])
    rows = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.zeros(len(keys), bool)),
                                       pa.array(np.arange(len(keys)))], names=["key", "up", "fp"])
    got = [(k.tolist(), v.tolist(), block) for k, v, block in
           simhash._groups([rows.slice(a, size) for a in range(0, len(keys), size)], 4)]
    assert sorted(x for _, v, _ in got for x in v) == list(range(len(keys)))
    blocks = {}
    for k, v, block in got:
        if block >= 0:
            assert len(set(k)) == 1 and len(v) <= 4
            blocks.setdefault(k[0], []).append(block)
    assert blocks == {1: [0, 1, 2], 2: [0, 1, 2], 4: [0, 1, 2, 3, 4, 5]}


def test_every_near_pair_of_a_large_cell_is_linked(spark):
    rnd = random.Random(7)
    # 64 pairs in one cell of the first part: the low half is shared, pairs are 1 bit apart
    pairs = [(h << 33 | 0x2AAAAAAA, h << 33 | 1 << 32 | 0x2AAAAAAA) for h in rnd.sample(range(1 << 30), 64)]
    df = spark.createDataFrame([(f,) for p in pairs for f in p], "fp bigint")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "5")
    try:
        found = {frozenset((r.a, r.b)) for r in simhash.near_links(df, 3, 8).collect()}
    finally:
        spark.conf.unset(key)
    assert {frozenset(p) for p in pairs} <= found
