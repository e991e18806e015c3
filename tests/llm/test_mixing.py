import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import mixing
from basketry.llm.queries import op7_mixing


def certified(rates, tokens, p, goal, budget):
    """Whether the rates match the targets and are the closest to 1 that do:
    1 + p . v where positive, for one v by which all others aren't positive."""
    goal = np.array(goal) / sum(goal) * budget
    share = (p * (rates * tokens)[:, None]).sum(axis=0) / tokens.sum()
    some = rates > 0
    v = np.linalg.lstsq(p[some], rates[some] - 1, rcond=None)[0]
    return (rates >= 0).all() and np.abs(share - goal).max() < 1e-6 and np.allclose(
        np.maximum(0, 1 + p @ v), rates, rtol=1e-6, atol=1e-6)


@pytest.mark.parametrize("goal,budget", [([.6, .3, .1], 1.0), ([.7, .2, .1], 1.5), ([.3, .3, .4], .4),
                                         ([.98, .01, .01], 1.5)])
def test_rates_meet_the_targets(spark, goal, budget):
    rnd = np.random.default_rng(5)
    p = rnd.dirichlet([.4, .3, .2], 500)
    tokens = rnd.integers(0, 900, 500)
    mix = spark.createDataFrame([(int(n), x.tolist()) for n, x in zip(tokens, p)], "tokens bigint, posterior array<double>")
    vector = mixing.solve(mix, goal, budget)
    rate = mixing._rate([F.col("posterior")[i] for i in range(3)], vector)
    got = np.array([r.r for r in mix.select(rate.alias("r")).collect()])
    assert certified(got, tokens, p, goal, budget)


def test_targets_that_no_rates_meet(spark):
    kind = "tokens bigint, posterior array<double>"
    mix = spark.createDataFrame([(10, [.5, .4, .1]), (20, [.6, .3, .1])], kind)
    with pytest.warns(UserWarning, match="can't be met"):
        vector = mixing.solve(mix, [.1, .1, .8])
    rate = mixing._rate([F.col("posterior")[i] for i in range(3)], vector)
    assert all(r.r >= 0 for r in mix.select(rate.alias("r")).collect())


def test_missing_domain_and_no_tokens(spark):
    kind = "tokens bigint, posterior array<double>"
    mix = spark.createDataFrame([(10, [.5, .5, 0.0]), (20, [.9, .1, 0.0])], kind)
    vector = mixing.solve(mix, [.5, .3, .2])
    rate = mixing._rate([F.col("posterior")[i] for i in range(3)], vector)
    s = mix.select((rate * F.col("tokens")).alias("t"), "posterior").collect()
    assert sum(r.t * r.posterior[0] for r in s) / 30 == pytest.approx(.5, abs=1e-6)
    assert not mixing.solve(mix.limit(0), [.5, .3, .2]).any()
    assert not mixing.solve(spark.createDataFrame([(0, [1.0, 0.0, 0.0])], kind), [.5, .3, .2]).any()


def sample_docs(docs_of):
    rnd = random.Random(3)
    words = {"high": "fine clear words here".split(), "low": "spam buy now cheap".split(), "toxic": "vile nasty rude bad".split()}
    rows, labels = [], []
    for i in range(240):
        d = rnd.choice(mixing.DOMAINS)
        rows.append((i, " ".join(rnd.choice(words[d]) for _ in range(rnd.randrange(5, 40))), d, "s", 1))
        if i % 2:
            labels.append((i, int(d == "high"), int(d == "toxic")))
    labels += labels[:5] + [(None, 1, 0), (3, None, None), (9999, 1, 1)]
    return rows, labels


def test_classifier_and_sampling(docs_of, spark):
    rows, labels = sample_docs(docs_of)
    rows += [(1000, None, "high", "s", 1), (1001, "", "high", "s", 1), (None, "fine words", "high", "s", 1),
             (5, rows[5][1], rows[5][2], "s", 1)]
    df = docs_of(rows)
    model = mixing.fit(df, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
                       mixing.label_domain(), mixing.DOMAINS)
    found = mixing.mixed(df, model, mixing.TARGETS, budget=mixing.BUDGET)
    out = found.collect()
    assert len(out) == len(rows) and out[0]["key"] == "x"
    right = [mixing.DOMAINS[int(np.argmax(r.mix.posterior))] == r.lang for r in out if r.text]
    assert sum(right) > 0.95 * len(right)
    tokens = [len((r.text or "").split()) for r in out]
    assert [r.mix.tokens for r in out] == tokens
    assert certified(np.array([r.mix.rate for r in out]), np.array(tokens), np.array([r.mix.posterior for r in out]),
                     [mixing.TARGETS[d] for d in mixing.DOMAINS], mixing.BUDGET)
    assert all(r.mix.copies in (int(r.mix.rate), int(r.mix.rate) + 1) for r in out)
    same = {(r.mix.rate, r.mix.copies) for r in out if r.doc_id == 5}
    assert len(same) == 1
    drawn = mixing.sampled(found)
    assert drawn.columns == df.columns and drawn.count() == sum(r.mix.copies for r in out)


def test_no_labels_and_empty_table(docs_of, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = mixing.fit(docs_of(["a b"]), none, mixing.label_domain(), mixing.DOMAINS)
    assert model.posteriors(__import__("pyarrow").array(["a b", None]))[1].tolist() == [[pytest.approx(1 / 3)] * 3] * 2
    assert mixing.mixed(docs_of([]), model, mixing.TARGETS).count() == 0


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_query_on_whole_table(spark, size):
    d = f"/root/testdata/{size}"
    rows = op7_mixing(spark, d).collect()
    assert len(rows) == spark.read.parquet(f"{d}/documents.parquet").count()
    p, tokens = np.array([[r.p_high, r.p_low, r.p_toxic] for r in rows]), np.array([r.tokens for r in rows])
    assert certified(np.array([r.rate for r in rows]), tokens, p, [mixing.TARGETS[x] for x in mixing.DOMAINS], mixing.BUDGET)
