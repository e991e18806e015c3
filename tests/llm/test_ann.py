import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import ann
from basketry.llm.queries import op8_learned_partitions

KIND = "vec_id bigint, embedding array<float>, label int"


def clean(v, length):
    return v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v) and any(v)


def nearest(rows, q, k):
    """rows: (id, vector as doubles)."""
    me, v = q
    d = [(float(np.sqrt(np.square(np.array(w) - np.array(v)).sum())), i) for i, w in rows if i != me]
    return sorted(set(d))[:k]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], KIND).withColumn("id", F.lit("x")).withColumn(
        "part", F.lit("y")).withColumn("v", F.lit("z"))


def test_exact_when_every_part_is_visited(spark):
    rnd = np.random.default_rng(1)
    vecs = [rnd.normal(size=5).astype(np.float32).tolist() for _ in range(300)]
    vecs += [vecs[7]] * 40 + [[0.0] * 5, None, [1.0, None, 1.0, 1.0, 1.0], [math.nan] * 5, [math.inf, 0.0, 0.0, 0.0, 0.0], [1.0], []]
    rows = list(zip([*range(100, 100 + len(vecs) - 8), 7, 8, 9, 10, 10, 11, 12, None], vecs))
    good = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if i is not None and clean(v, 5)]
    df = frame(spark, rows)
    for block in (4096, 37):
        router = ann.Router(np.random.default_rng(2).normal(size=(6, 4)))
        got = ann.search(df, F.col("id") % 10 == 0, k=6, probes=4, router=router, block=block).collect()
        want = {i: nearest(good, (i, v), 6) for i, v in good if i % 10 == 0}
        mine = {}
        for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
            mine.setdefault(r.query_id, []).append((r.score, r.id))
        assert mine == want
        assert sorted((r.query_id, r["rank"]) for r in got) == [(q, k + 1) for q in sorted(want) for k in range(6)]


def test_few_candidates_no_queries_empty(spark):
    df = frame(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [4.0, 6.0])])
    got = ann.search(df, F.col("id") == 0).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0.0), (0, 2, 2, 5.0)]
    assert ann.search(df, F.col("id") == 9).count() == 0
    assert ann.search(df.limit(0), F.col("id") == 0).count() == 0
    assert ann.search(frame(spark, [(0, None), (1, [0.0])]), F.col("id") == 0).count() == 0


def test_parts_are_balanced_and_cut_little():
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(8, 16)) * 10
    x = np.concatenate([c + rnd.normal(size=(64, 16)) for c in centres])
    part = ann.balanced_parts(x, 8)
    assert np.bincount(part).tolist() == [64] * 8
    near = ann._graph(x, 8)
    assert (part[near] == part[:, None]).mean() > 0.8


def test_recall(spark):
    d = "/root/testdata/sf0.1"
    out = op8_learned_partitions(spark, d).collect()
    rows = [(r.vec_id, np.array(r.embedding, np.float64)) for r in
            spark.read.parquet(f"{d}/embeddings.parquet").collect() if clean(r.embedding, 64)]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    found = {}
    for r in out:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    queries = [i for i in ids.tolist() if i % 100 == 0]
    hits = 0
    for q in queries:
        dist = np.sqrt(np.square(x - x[ids == q][0]).sum(axis=1))
        order = [k for k in np.lexsort((ids, dist)) if ids[k] != q][:10]
        hits += len(set(ids[order].tolist()) & {v for _, v, _ in found[q]})
        for _, v, s in found[q]:
            assert s == dist[ids == v][0]
        assert [k for k, _, _ in sorted(found[q])] == list(range(1, 11))
        assert sorted(found[q]) == sorted(found[q], key=lambda t: (t[2], t[1]))
    assert hits >= 0.9 * 10 * len(queries)


@pytest.mark.parametrize("seed", [0])
def test_copies_of_one_vector(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 900)] + [(1000 + i, [rnd.random(), 1.0, 0.5]) for i in range(600)]
    got = ann.search(frame(spark, rows), F.col("id") == 500, k=5, block=64).orderBy("rank").collect()
    assert [r.id for r in got] == [0, 1, 2, 3, 4] and all(r.score == 0 for r in got)
