"""Approximate nearest neighbours by learned partitions.

After Dong et al. 2020, "Learning space partitions for nearest neighbor
search": on a sample of ``SAMPLE`` vectors at most (the least hashes of the
id), the graph of each vector's nearest neighbours is cut into balanced parts;
a small classifier (softmax regression on the vector) learns the parts. Every
vector is indexed under its most probable part; a query goes to its most
probable parts, where distances are computed exactly and reranked. How many
parts is measured: the least number with which the sample's vectors that the
classifier wasn't trained on find ``RECALL`` of their ``CHECKED`` nearest
neighbours in the sample (those are farther away, so easier to miss, than the
nearest ones in the whole table).

The graph is cut by repeated bisection: the vertices are ordered along the
second eigenvector of the random walk on the graph and split in the middle,
then pairs of vertices are swapped while that lowers the cut, so the halves
stay equal.

Search: a part's vectors are dealt by hash to blocks of about ``BLOCK``, and
so are its queries; each pair of blocks is one task's work, of bounded memory,
and gives the ``k`` nearest of its block to each query. The last step keeps the
``k`` least (distance, id) of a query. Frequent vectors only mean more blocks.
What goes to the driver is the sample, the classifier and a count per part.

Distances are Euclidean, in double precision, summed from the differences of
the original components. Vectors that are null, zero, hold null or non-finite
components, or don't have the sample's most frequent length take no part, nor
do null ids; equal ids are each other's own row; ties go to the smaller id. An
empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

SAMPLE = 4_096
NEIGHBOURS = 12
#: A part is meant to have so many of the sample's vectors at least.
PART_SAMPLE = 64
#: Rows that a part is meant to have, and how many parts there are at most.
PART_ROWS, MAX_PARTS = 300, 64
#: Share of the sample's neighbours that a query's parts have to hold.
RECALL, CHECKED = 0.94, 10
BLOCK = 4_096


def valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): the vectors that take part, components as doubles."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()).where(~bad & F.exists("v", lambda x: x != 0))


def _graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` nearest other rows of each row."""
    square = (x * x).sum(axis=1)
    near = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), 512):
        d = square[None, :] - 2 * x[i:i + 512] @ x.T
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        near[i:i + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return near


def _bisect(near: np.ndarray, members: np.ndarray, rng) -> np.ndarray:
    """True for the half of ``members`` on one side of a small, balanced cut."""
    n = len(members)
    local = np.full(len(near), -1)
    local[members] = np.arange(n)
    to = local[near[members]]
    a, b = np.repeat(np.arange(n), near.shape[1]), to.reshape(-1)
    a, b = a[b >= 0], b[b >= 0]
    ends, other = np.concatenate((a, b)), np.concatenate((b, a))  # both directions
    degree = np.bincount(ends, minlength=n) + 1e-9
    f = rng.standard_normal(n)
    for _ in range(60):  # lazy random walk without its stationary part
        f -= (f * degree).sum() / degree.sum()
        f = 0.5 * f + 0.5 * np.bincount(ends, f[other], minlength=n) / degree
        f /= np.abs(f).max() + 1e-300
    side = np.zeros(n, bool)
    side[np.argsort(f, kind="stable")[n // 2:]] = True
    for _ in range(10):  # swap the vertices that gain most by changing sides
        same = np.bincount(ends, side[ends] == side[other], minlength=n)
        gain = degree - 2 * same
        up, down = np.flatnonzero(side), np.flatnonzero(~side)
        up, down = up[np.argsort(-gain[up], kind="stable")], down[np.argsort(-gain[down], kind="stable")]
        m = min(len(up), len(down))
        good = int((np.cumsum(gain[up[:m]] + gain[down[:m]] > 0.5) == np.arange(1, m + 1)).sum()) // 2
        if not good:
            break
        side[up[:good]], side[down[:good]] = False, True
        if (side[ends] == side[other]).sum() < same.sum():  # swapped neighbours: undo
            side[up[:good]], side[down[:good]] = True, False
            break
    return side


def balanced_parts(x: np.ndarray, parts: int, neighbours: int = NEIGHBOURS, seed: int = 0) -> np.ndarray:
    """Part of each row of ``x``; parts is a power of two."""
    part = np.zeros(len(x), np.int64)
    if parts > 1:
        near, rng = _graph(x, min(neighbours, len(x) - 1)), np.random.default_rng(seed)
        for _ in range(parts.bit_length() - 1):
            old = part.copy()
            for p in np.unique(old):
                members = np.flatnonzero(old == p)
                part[members] = 2 * p + _bisect(near, members, rng)
    return part


@dataclass
class Router:
    weights: np.ndarray  # (length + 1, part)
    probes: int = 1

    @property
    def length(self) -> int:
        return len(self.weights) - 1

    def scores(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[:-1] + self.weights[-1]


def learn(x: np.ndarray, part: np.ndarray, parts: int, steps: int = 300) -> Router:
    """Softmax regression of the parts on the vectors (Adam, full batch)."""
    scale = 1 / max(np.sqrt((x * x).sum(axis=1).mean()), 1e-300)
    a = np.hstack([x * scale, np.ones((len(x), 1))])
    y = np.eye(parts)[part]
    w, m, s = (np.zeros((a.shape[1], parts)) for _ in range(3))
    for t in range(1, steps + 1):
        z = a @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        g = a.T @ (p / p.sum(axis=1, keepdims=True) - y) / len(a) + 1e-5 * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= 0.3 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
    w[:-1] *= scale
    return Router(w)


def fit(vectors: DataFrame, sample: int = SAMPLE, part_rows: int = PART_ROWS, max_parts: int = MAX_PARTS) -> Router | None:
    """A router for the vectors (id, v); None if there are none."""
    n = vectors.count()
    share = min(1.0, sample / max(n, 1))
    some = vectors if share == 1 else vectors.where(
        F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = some.orderBy(F.xxhash64("id"), "id").limit(2 * sample).collect() or vectors.limit(1).collect()
    if not rows:
        return None
    sizes, count = np.unique([len(r.v) for r in rows], return_counts=True)
    length = int(sizes[np.argmax(count)])
    x = np.array([r.v for r in rows if len(r.v) == length])
    most = max(1, min(max_parts, len(x) // PART_SAMPLE, -(-n // part_rows)))
    parts = 1 << most.bit_length() - 1
    if parts == 1:
        return Router(np.zeros((length + 1, 1)))
    distinct = np.unique(x, axis=0)  # copies add nothing to the graph
    if len(distinct) < parts * PART_SAMPLE // 4:
        return Router(np.zeros((length + 1, 1)))
    distinct = distinct[np.random.default_rng(1).permutation(len(distinct))]
    train = distinct[:len(distinct) * 3 // 4]
    router = learn(train, balanced_parts(train, parts), parts)
    router.probes = _enough(router, distinct, len(train))
    return router


def _enough(router: Router, x: np.ndarray, trained: int) -> int:
    """How many parts the rows from ``trained`` on have to visit."""
    z = router.scores(x)
    home, rank = z.argmax(axis=1), np.argsort(np.argsort(-z, axis=1, kind="stable"), axis=1)
    near = _graph(x, min(CHECKED, len(x) - 1))[trained:]
    at = np.take_along_axis(rank[trained:], home[near], axis=1)  # place of the neighbour's part in the query's order
    return int(np.quantile(at, RECALL, method="higher")) + 1


def _matrix(col, length: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.asarray(col.flatten()).reshape(-1, length)


def _routed(vectors: DataFrame, router: Router, probes: int) -> DataFrame:
    """(id, v, parts): the ``probes`` most probable parts of each vector."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                z = router.scores(_matrix(b.column(1), router.length))
                top = np.argsort(-z, axis=1, kind="stable")[:, :probes].astype(np.int32)
                at = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * top.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.ListArray.from_arrays(at, pa.array(top.reshape(-1)))], names=["id", "v", "parts"])

    kind = T.StructType([*vectors.schema.fields, T.StructField("parts", T.ArrayType(T.IntegerType()))])
    return vectors.mapInArrow(run, kind)


def _nearest(queries, q_id, rows, ids, k: int):
    """(query, id, distance) of the ``k`` nearest rows of each query."""
    out = []
    for q, me in zip(queries, q_id.tolist()):
        d = np.sqrt(np.square(rows - q).sum(axis=1))
        d[ids == me] = np.inf
        if len(d) > k:
            limit = np.partition(d, k - 1)[k - 1]
            some = np.flatnonzero(d <= limit)
        else:
            some = np.arange(len(d))
        some = some[np.isfinite(d[some])]
        best = some[np.lexsort((ids[some], d[some]))][:k]
        out.append((np.full(len(best), me), ids[best], d[best]))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 2 + [np.empty(0)]


def search(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           probes: int | None = None, router: Router | None = None, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest rows that were found for
    each row with ``is_query`` (an expression of ``id``). ``probes``: parts that
    a query visits, if not the router's number."""
    result = "query_id bigint, rank int, id bigint, score double"
    vectors = valid(df, id_col, vec_col)
    router = router or fit(vectors)
    if router is None:
        return df.sparkSession.createDataFrame([], result)
    vectors = vectors.where(F.size("v") == router.length)
    rows = _routed(vectors, router, 1).select("id", "v", F.col("parts")[0].alias("part"))
    queries = _routed(vectors.where(is_query).dropDuplicates(["id", "v"]), router, probes or router.probes).select(
        "id", "v", F.explode("parts").alias("part"))
    parts = router.weights.shape[1]
    # a number per part: of blocks of rows, and of blocks of queries
    n_rows, n_queries = ({r.part: -(-r.n // block) for r in x.groupBy("part").agg(F.count("*").alias("n")).collect()}
                         for x in (rows, queries))

    def number(n):
        return F.element_at(F.array(*[F.lit(n.get(p, 1)) for p in range(parts)]), F.col("part") + 1)

    def every(n):
        return F.explode(F.sequence(F.lit(0), number(n) - 1))
    own = F.xxhash64("id", "v")
    rows = rows.select("*", F.pmod(own, number(n_rows)).cast("int").alias("r")).select(
        "*", every(n_queries).alias("q"))
    queries = queries.select("*", F.pmod(F.xxhash64("id"), number(n_queries)).cast("int").alias("q")).select(
        "*", every(n_rows).alias("r"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        q, i, d = [np.empty(0, np.int64)] * 2 + [np.empty(0)]
        if left.num_rows and right.num_rows:
            q, i, d = _nearest(_matrix(left["v"], router.length), np.asarray(left["id"]),
                               _matrix(right["v"], router.length), np.asarray(right["id"]), k)
        return pa.table({"query_id": pa.array(q, pa.int64()), "id": pa.array(i, pa.int64()),
                         "score": pa.array(d, pa.float64())})

    key = ["part", "q", "r"]
    found = queries.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(
        compare, "query_id bigint, id bigint, score double")
    found = found.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score")
