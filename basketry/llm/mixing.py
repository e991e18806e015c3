"""Mixing sources to target weights with soft membership.

A text belongs to every domain with some probability: a classifier trained on
the labelled table (multinomial word models, calibrated by a softmax
regression on texts that they haven't seen) predicts domain posteriors for
every text. The rates r >= 0 of the texts are to make the expected tokens of
the domains, sum r * tokens * posterior, match the targets, and to stay as close
to 1 as that allows (in the metric of the texts' tokens): nonnegative least
squares by projected gradient steps with lazy projection. The steps add up to
one vector, a number per domain; a text's rate is the projection of what they
give it, max(0, 1 + posterior . vector), so rates are never stored or joined.
The gradient of a step is how much each domain's expected tokens fall short,
scaled by the inverse of the Gram matrix of the texts whose rates are positive;
of several lengths (``LENGTHS``) the one with the lowest objective is taken. One
pass of grouped sums over all texts measures all lengths at once, and only as
many numbers as domains (squared, once per length) go to the driver. It ends
when every domain is within ``TOLERANCE`` of its target; targets that no rates
can meet end after ``PASSES`` with a warning that names what is missing.

Training uses at most about ``MAX_LABELLED`` labelled texts (least hash of
the id). ``copies`` turns rates into whole copies: the whole part of the rate,
and one more with the chance of the rest, drawn by a hash of the row.

Targets are shares of ``budget`` x the tokens there are. If a domain has no
expected tokens, its target can't be met and the others' are still matched.

Edge cases: null and empty texts have no tokens, the average posterior of the
training texts and no influence; labels without a domain are ignored; without
labelled texts every posterior is even; repeated rows have equal rates and
equal copies; an empty table gives an empty result. Other columns stay.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textmodel
from .common import blocks, free_name, scratch

MAX_LABELLED = 6_000
TOLERANCE, PASSES = 1e-9, 60
LENGTHS = (1.0, 0.5, 0.25, 0.125, 1 / 16, 1 / 256)


@dataclass
class Classifier:
    words: textmodel.TextModel
    weights: np.ndarray  # (evidence + 1, domain)

    def posteriors(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, (text, domain) posterior)."""
        n, ll = self.words.score(col)
        z = np.hstack([evidence(n, ll), np.ones((len(n), 1))]) @ self.weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return n, p / p.sum(axis=1, keepdims=True)


def evidence(n: np.ndarray, ll: np.ndarray) -> np.ndarray:
    """Log likelihoods against their mean over domains: per word, and per
    square root of words (signal against noise)."""
    d = ll - ll.mean(axis=1, keepdims=True)
    m = np.maximum(n, 1)[:, None]
    return np.hstack([d / m, d / np.sqrt(m)])


def _softmax_regression(x: np.ndarray, y: np.ndarray, k: int, steps: int = 400) -> np.ndarray:
    """Weights (feature + 1, class), Adam on the whole sample."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    a, t = np.hstack([x / scale, np.ones((len(x), 1))]), np.eye(k)[y]
    w, m, s = (np.zeros((a.shape[1], k)) for _ in range(3))
    for i in range(1, steps + 1):
        z = a @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        g = a.T @ (p / p.sum(axis=1, keepdims=True) - t) / len(a) + 1e-4 * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= 0.2 * (m / (1 - 0.9 ** i)) / (np.sqrt(s / (1 - 0.999 ** i)) + 1e-8)
    w[:-1] /= scale[:, None]
    return w


def fit(docs: DataFrame, labels: DataFrame, domain: Column, domains: list[str], id_col: str = "doc_id",
        text_col: str = "text", most: int = MAX_LABELLED) -> Classifier:
    """Train on the texts of ``docs`` that ``labels`` covers; ``domain`` is an
    expression on ``labels`` giving one of ``domains``."""
    k = len(domains)
    index = F.array_position(F.array(*[F.lit(d) for d in domains]), domain).cast("int") - 1
    known = labels.select(F.col(f"`{id_col}`").alias("l_id"), index.alias("class")).where(
        "l_id IS NOT NULL AND class >= 0").groupBy("l_id").agg(F.min("class").alias("class"))
    n = known.count()
    share = min(1.0, most / max(n, 1))
    spot = F.pmod(F.xxhash64("l_id"), F.lit(1 << 30))
    known = known.where(spot < int(share * (1 << 30)) + (share == 1))
    # bounded by ``most``, whatever the size of the tables
    texts = docs.select(F.col(f"`{id_col}`").alias("l_id"), F.col(f"`{text_col}`").alias("text")).join(
        F.broadcast(known), "l_id").where(F.length("text") > 0)
    half = F.pmod(F.xxhash64("l_id", F.lit(1)), F.lit(2))
    words = textmodel.fit(texts.where(half == 0), domains, textmodel.WORDS)

    def rows(batches):
        for b in blocks(batches, "text", 2 << 20):
            n, ll = words.score(b.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(evidence(n, ll).tolist(), pa.list_(pa.float64())), b.column(1)], names=["x", "class"])

    held = texts.where(half == 1).select("text", "class").mapInArrow(rows, "x array<double>, class int").collect()
    if not held:
        return Classifier(words, np.zeros((2 * k + 1, k)))
    return Classifier(words, _softmax_regression(np.array([r.x for r in held]),
                                                 np.array([r["class"] for r in held]), k))


def classify(df: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """``df`` with, as the last column, a struct ``mix`` (``free_name``): tokens
    and posterior."""
    rest = {c: f"c{i}" for i, c in enumerate(df.columns) if c != text_col}
    slim = df.select(F.col(f"`{text_col}`").alias("text"),
                     F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(a) for c, a in rest.items()]).alias("row"))
    out = T.StructType([*slim.schema.fields, T.StructField("tokens", T.LongType()),
                        T.StructField("posterior", T.ArrayType(T.DoubleType()))])
    k = len(model.words.classes)

    def run(batches):
        for b in blocks(batches, "text", 2 << 20):
            n, p = model.posteriors(b.column(0))
            at = pa.array(np.arange(len(n) + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(at, pa.array(p.reshape(-1)))],
                names=["text", "row", "tokens", "posterior"])

    return slim.mapInArrow(run, out).select(
        *[F.col("text" if c == text_col else f"row.{rest[c]}").alias(c) for c in df.columns],
        F.struct("tokens", "posterior").alias(free_name(df, "mix")))


def _rate(p: list[Column], vector: np.ndarray) -> Column:
    """The rate of a text with posterior ``p``: max(0, 1 + posterior . vector)."""
    return F.greatest(F.lit(0.0), sum((x * float(v) for x, v in zip(p, vector)), F.lit(1.0)))


def solve(mix: DataFrame, targets: list[float], budget: float = 1.0) -> np.ndarray:
    """The vector of the rates for the rows (tokens, posterior); ``targets``
    are the domains' shares."""
    k = len(targets)
    p, vector = [F.col("posterior")[i] for i in range(k)], np.zeros(k)
    total = mix.agg(F.sum("tokens").cast("double")).first()[0] or 0.0
    if not total:
        return vector
    goal = np.array(targets) / sum(targets) * budget
    upper = np.triu_indices(k)

    def measured(vectors):
        """(objective, shortfall, Gram matrix) of each vector, in one pass."""
        rates = mix.select("tokens", "posterior", *[_rate(p, v).alias(f"r{i}") for i, v in enumerate(vectors)])
        sums = []
        for i in range(len(vectors)):
            r, t = F.col(f"r{i}"), F.col("tokens")
            sums += [F.sum(t * r * r), *[F.sum(t * r * x) for x in p],
                     *[F.sum(F.when(r > 0, t * p[a] * p[b]).otherwise(0.0)) for a, b in zip(*upper)]]
        got = np.array(rates.agg(*sums).first(), float).reshape(len(vectors), -1) / total
        out = []
        for v, row in zip(vectors, got):
            gram = np.zeros((k, k))
            gram[upper] = row[1 + k:]
            out.append((row[0] / 2 - goal @ v, goal - row[1:1 + k], gram + gram.T - np.diag(np.diag(gram))))
        return out

    objective, short, gram = measured([vector])[0]
    goal = np.where(np.diag(gram) < 1e-12, goal - short, goal)  # no text is of that domain
    short = np.where(np.diag(gram) < 1e-12, 0.0, short)
    best, least = vector, np.abs(short).max()
    for _ in range(PASSES):
        if least < TOLERANCE:
            return best
        step = np.linalg.pinv(gram, rcond=1e-12) @ short
        vectors = [vector + x * step for x in LENGTHS]
        found = measured(vectors)
        i = min(range(len(found)), key=lambda j: found[j][0])
        vector, (objective, short, gram) = vectors[i], found[i]
        if np.abs(short).max() < least:
            best, least = vector, np.abs(short).max()
    warnings.warn(f"the targets can't be met: a domain is off by {least:.3g} of all tokens", stacklevel=2)
    return best


def mixed(df: DataFrame, model: Classifier, targets: dict[str, float], id_col: str = "doc_id",
          text_col: str = "text", budget: float = 1.0) -> DataFrame:
    """``df`` with, as the last column, a struct ``mix`` (``free_name``):
    tokens, posterior, rate and copies."""
    found = classify(df, model, text_col)
    light = classify(df.select(F.col(f"`{text_col}`").alias("text")), model)
    light = scratch(light.select("mix.*"), "mix")
    goal = [targets[c] for c in model.words.classes]
    vector = solve(light, goal, budget)
    name, at = found.columns[-1], free_name(found, "rate")
    rate = _rate([F.col(f"`{name}`.posterior")[i] for i in range(len(goal))], vector)
    found = found.withColumn(at, rate)
    chance = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.lit("mix")), F.lit(1 << 40)) / (1 << 40)
    return found.withColumn(name, F.struct(
        f"{name}.tokens", f"{name}.posterior", F.col(at).alias("rate"),
        F.floor(F.col(at) + chance).cast("int").alias("copies"))).drop(at)


def sampled(found: DataFrame) -> DataFrame:
    """As many copies of each row as its ``mix`` (the last column) says,
    without that column."""
    *names, mix = found.columns
    copies = F.col(f"`{mix}`.copies")
    return found.where(copies > 0).withColumn(
        free_name(found, "copy"), F.explode(F.sequence(F.lit(1), copies))).select(*[F.col(f"`{c}`") for c in names])


#: Domains of the labelled table, and their shares.
DOMAINS = ["high", "low", "toxic"]
TARGETS = {"high": 0.85, "low": 0.10, "toxic": 0.05}
BUDGET = 1.25


def label_domain() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
