"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers, floor(scale * entry) + offset, so that sums and
deviations are exact. With A the rows minus their mean, the recurrence

    A v_k = alpha_k u_k + beta_(k-1) u_(k-1),   A' u_k = alpha_k v_k + beta_k v_(k+1)

builds orthonormal v and u with A V = U B, B upper bidiagonal. The singular
values and right vectors of the small B give the components (V times the right
vectors) and the deviations along them (singular value over root n).

One step is one distributed pass over the rows. A u has as many entries as the
table has rows, so it is never gathered: every u_k is A c_k for a vector c_k as
long as a row, and a task rebuilds its rows' entries of all u_j so far in
blocks. A pass returns A'(A w), the inner products of A w with all u_j and its
square: as many numbers as a row is long plus the step, summed by Spark.
Full reorthogonalisation: the new u loses its parts along all earlier ones by
these products (and is passed over again if that took half of it away), the new
v along all earlier v, twice. Where a recurrence ends early (a product is zero
to rounding) it goes on from a fresh direction orthogonal to all v, so repeated
and zero singular values are found too. It stops when all directions are used,
or, for longer rows, when the wanted components and the largest of the last
start have converged and a fresh start has brought nothing larger.

What bounds memory: blocks of rows in tasks; on the driver, vectors as long as
a row, one per step. Rows are kept in a scratch table in the shared folder, so
a lost executor costs its own tasks only.

Rows whose vector is null, empty, holds a null or non-finite entry or one whose
integer is no 64-bit number are dropped, and rows that don't have the most
frequent length (of equally frequent ones the shorter). Repeated rows count as
often as they are there; null and repeated ids are rows like any other. Other
columns play no part, whatever their names. A table without rows, or whose rows
are all equal, has no components and gives an empty result. Components with a
deviation of nothing (RANK times the largest, or less) are left out, so there
may be fewer than asked for. Equal eigenvalues: any orthonormal basis of their
space, the same for all rows. A deviation beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch

#: Rows of one block of a task's arithmetic.
BLOCK_ROWS = 8_192
#: Singular values below this share of the largest count as zero.
RANK = 1e-10
#: A direction has converged when its residual is below this share of the largest singular value.
CONVERGED = 1e-13
#: A recurrence has ended when what is left of a product is below this share of the largest.
ENDED = 1e-13


@dataclass
class Whitening:
    """n rows with the integer sums ``sums``; ``basis`` (length, component)
    and the variances along it, falling; ``trace``: sum of all variances;
    ``identity_error``: largest entry of the whitened rows' covariance minus
    the identity."""
    n: int
    sums: list[int]
    basis: np.ndarray
    variances: np.ndarray
    trace: float = 0.0
    identity_error: float = 0.0
    steps: int = 0

    @property
    def components(self) -> int:
        return len(self.variances)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return np.asarray(exact_deviation(x, self.n, self.sums), np.float64) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.basis / np.sqrt(self.variances)


def exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums without rounding: 64-bit integers, or Python's where they don't fit."""
    if x.size and n * max(-int(x.min()), int(x.max())) + max(map(abs, sums)) >= 1 << 62:
        return x.astype(object) * n - np.array(sums, object)
    return x * np.int64(n) - np.array(sums, np.int64)


def squared_length(deviation: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row; None beyond 64 bits."""
    if not deviation.size:
        return [0] * len(deviation)
    largest = max(-int(deviation.min()), int(deviation.max()))
    if deviation.dtype == object or largest * largest * deviation.shape[1] >= 1 << 63:
        totals = (deviation.astype(object) ** 2).sum(axis=1)
        return [int(t) if t < 1 << 63 else None for t in totals]
    return (deviation * deviation).sum(axis=1).tolist()


def quantised(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64,
              offset: int = 1_000_000) -> DataFrame:
    """(id, x): the integer rows that take part, of any length; x as the bytes
    of little-endian 64-bit integers."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda c: c.cast("double"))
    limit = float(1 << 62) / scale
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= limit))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0)).where(~bad)
    rows = rows.select("id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale))) + F.lit(offset)).alias("x"))

    def pack(batches):
        for b in batches:
            x = b.column(1)
            size = np.diff(np.asarray(x.offsets)) if len(x) else np.zeros(0, np.int32)
            data = np.ascontiguousarray(np.asarray(x.flatten()), dtype="<i8")
            at = np.concatenate(([0], np.cumsum(size, dtype=np.int64) * 8)).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(at), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([b.column(0), packed], names=["id", "x"])

    return rows.mapInArrow(pack, "id bigint, x binary")


def unpacked(batch: pa.RecordBatch, length: int, rows: int = BLOCK_ROWS):
    """Blocks (ids, x as (rows, length)) of a batch of packed rows."""
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        yield part.column(0), np.frombuffer(b"".join(part.column(1).to_pylist()), "<i8").reshape(-1, length)


def _totals(rows: DataFrame, fn: Callable, size: int) -> np.ndarray:
    """Sums over all rows of ``fn(x)``, ``size`` numbers each: partial sums in
    the tasks, added up by Spark."""
    def run(batches):
        total = np.zeros(size)
        for b in batches:
            total += fn(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)],
                                         names=["slot", "value"])

    out = np.zeros(size)
    for r in rows.mapInArrow(run, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect():
        out[r.slot] = r.value
    return out


def bidiagonalise(product: Callable, length: int, wanted: int, seed: int = 0):
    """(V, B, steps) of A V = U B. ``product(w, C)`` returns A'A w, (A C)'A w
    and |A w|^2 for a vector and a matrix whose columns make up U."""
    rng = np.random.default_rng(seed)
    v, c, q = (np.zeros((length, 0)) for _ in range(3))
    alpha, beta, scale, started, steps = [], [], 0.0, 0, 0

    def fresh(r):
        for _ in range(2):
            r = r - v @ (v.T @ r)
        return r

    def grown(m, x):
        return np.column_stack((m, x))

    new = rng.standard_normal(length)
    new /= np.linalg.norm(new)
    checked = False
    while True:
        v = grown(v, new)
        w = new - (beta[-1] * c[:, -1] if beta else 0)
        for _ in range(3):
            back, along, square = product(w, c)
            steps += 1
            left = square - along @ along
            w, back = w - c @ along, back - q @ along
            if left > square / 2:  # little was taken away: orthogonal to rounding
                break
        a = np.sqrt(max(left, 0.0))
        scale = max(scale, a)
        if a <= ENDED * scale or not np.isfinite(a) or a == 0:
            a, w, back = 0.0, np.zeros(length), np.zeros(length)
        else:
            w, back = w / a, back / a
        alpha.append(a)
        c, q = grown(c, w), grown(q, back)
        if v.shape[1] == length:
            break
        rest = fresh(back - a * new)
        b = np.linalg.norm(rest)
        scale = max(scale, b)
        restart = b <= ENDED * scale or scale == 0
        if not restart and v.shape[1] - started >= 8 and v.shape[1] >= wanted and v.shape[1] % 4 == 0:
            left_s, s, _ = np.linalg.svd(_bidiagonal(alpha, beta))
            own = np.abs(left_s[started:, :]).max(axis=0) > 1e-8  # directions of the last start
            open_ = b * np.abs(left_s[-1, :]) > CONVERGED * s[0]
            first_own = np.flatnonzero(own)[:1]
            if not open_[:wanted].any() and not open_[first_own].any():
                if checked and not own[:wanted].any():
                    break
                restart, checked = True, True
        if restart:
            b, started = 0.0, v.shape[1]
            rest = fresh(rng.standard_normal(length))
            new = rest / np.linalg.norm(rest)
        else:
            new = rest / b
        beta.append(b)
    return v, _bidiagonal(alpha, beta), steps


def _bidiagonal(alpha: list[float], beta: list[float]) -> np.ndarray:
    return np.diag(alpha) + np.diag(beta[:len(alpha) - 1], 1)


def fit(rows: DataFrame, components: int) -> Whitening | None:
    """The whitening of packed rows of one length; None without components.
    ``rows`` is read once per step: a written table."""
    sizes = rows.groupBy(F.octet_length("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return None
    length, n = sizes["size"] // 8, sizes["count"]
    rows = rows.where(F.octet_length("x") == length * 8)

    def add(batches):
        total = [0] * length
        for b in batches:
            for _, x in unpacked(b, length):
                wide = max(-int(x.min()), int(x.max())) * len(x) >= 1 << 62
                total = [s + int(t) for s, t in zip(total, (x.astype(object) if wide else x).sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(length), pa.int32()), pa.array(map(str, total))],
                                         names=["slot", "value"])

    sums = [0] * length
    for r in rows.mapInArrow(add, "slot int, value string").groupBy("slot").agg(
            F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        sums[r.slot] = int(r.value)
    mean = Whitening(n, sums, np.zeros((length, 0)), np.zeros(0))

    def product(w, c):
        k = c.shape[1]

        def one(batch):
            out = np.zeros(length + k + 1)
            for _, x in unpacked(batch, length):
                y = mean.centred(x)
                p = y @ w
                out += np.concatenate((y.T @ p, (y @ c).T @ p, [p @ p]))
            return out
        got = _totals(rows, one, length + k + 1)
        return got[:length], got[length:-1], got[-1]

    v, b, steps = bidiagonalise(product, length, components)
    _, s, right = np.linalg.svd(b)
    kept = int((s[:components] > RANK * s[0]).sum()) if s[0] > 0 else 0
    if not kept:
        return None
    model = Whitening(n, sums, np.linalg.qr(v)[0] @ _signed(v, right[:kept]), s[:kept] ** 2 / n, steps=steps)

    def moments(batch):
        out = np.zeros(1 + kept + kept * kept)
        for _, x in unpacked(batch, length):
            y, z = model.centred(x), model.whitened(x)
            out += np.concatenate(([(y * y).sum()], z.sum(axis=0), (z.T @ z).ravel()))
        return out
    got = _totals(rows, moments, 1 + kept + kept * kept) / n
    middle = got[1:1 + kept]
    covariance = got[1 + kept:].reshape(kept, kept) - np.outer(middle, middle)
    model.trace = float(got[0])
    model.identity_error = float(np.abs(covariance - np.eye(kept)).max())
    return model


def _signed(v: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Right vectors as columns, for V orthonormalised once more (its columns
    may have changed sign)."""
    q, r = np.linalg.qr(v)
    return np.sign(np.diag(r))[:, None] * right.T


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """(id, component, deviation, whitened): each packed row along each
    component, numbered from 1."""
    length, k = len(model.sums), model.components

    def run(batches):
        for b in batches:
            for ids, x in unpacked(b, length):
                d = exact_deviation(x, model.n, model.sums)
                z = model.whitened(x)
                at = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(squared_length(d), pa.int64()).take(at), pa.array(z.ravel())],
                    names=["id", "component", "deviation", "whitened"])

    return rows.where(F.octet_length("x") == length * 8).mapInArrow(
        run, "id bigint, component int, deviation bigint, whitened double")


def whiten(df: DataFrame, components: int = 32, id_col: str = "vec_id", vec_col: str = "embedding",
           scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for
    every row that takes part and every component up to ``components``:
    ``deviation`` is the exact squared length of n times the row's distance
    from the mean, ``whitened`` the row along the component over the deviation
    there, ``explained`` the component's share of the variance."""
    rows = scratch(quantised(df, id_col, vec_col, scale, offset), "whitening")
    model = fit(rows, components)
    if model is None:
        return df.sparkSession.createDataFrame(
            [], "id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
                "identity_error double")
    share = F.element_at(F.array(*[F.lit(float(e / model.trace)) for e in model.variances]), F.col("component"))
    return whitened(rows, model).select(
        "id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(model.identity_error).alias("identity_error"))
