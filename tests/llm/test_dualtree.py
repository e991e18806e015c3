import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import dualtree
from basketry.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    """docs, items: (id, text) -> {item: [(id, score)]}, every pair."""
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms_of(t))
    out = {}
    for item, terms in wanted.items():
        scores = []
        for i, c, n in held:
            m = 10 + 90 * n * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                    (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        if scores:
            out[item] = [(None if none else i, -s) for s, none, i in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(out.setdefault(r.item_id, [])) + 1
        out[r.item_id].append((r.id, r.score))
    return out


def tables(spark, docs, items):
    d, i = (spark.createDataFrame(x, "i bigint, text string") for x in (docs, items))
    for c in ("id", "n", "terms", "tfs", "score", "rank", "place", "salt", "item", "w", "c"):
        d, i = d.withColumn(c, F.lit("clash")), i.withColumn(c, F.lit("clash"))
    return d.withColumnRenamed("i", "doc_id"), i.withColumnRenamed("i", "item_id")


def texts(rnd, n, words=400):
    vocabulary = [f"{a}{b}" for a in ("Wort", "ñandú", "x", "42", "Term") for b in range(words // 5)]
    return [" ".join(rnd.choices(vocabulary, [1 / (1 + k) for k in range(len(vocabulary))], k=rnd.choice([1, 5, 40, 300])))
            for _ in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_against_all_pairs(spark, monkeypatch, small):
    rnd = random.Random(7)
    docs = list(enumerate(texts(rnd, 600))) + [(i, "copy of a text, Wort1 x1") for i in range(700, 760)]
    rnd.shuffle(docs)
    docs += [(None, None), (800, ""), (801, " .,;"), (5, "Wort1 x1"), (None, "Wort1 x1 Term2"), (802, "ſ ſ K k")]
    items = list(enumerate(texts(rnd, 90))) + [(200, None), (201, "nowhere"), (3, "Wort2 Wort2 42-1"), (None, "x1 K")]
    kw = {}
    if small:  # blocks, chunks, pieces and a floor of seeds, several each
        monkeypatch.setattr(dualtree, "BLOCK_ITEMS", 20)
        monkeypatch.setattr(dualtree, "CELLS", 1 << 12)
        kw = {"vocabulary": 100, "seed": 100, "piece": 50}
    d, i = tables(spark, docs, items)
    got = found(dualtree.search(d.repartition(3), i, **kw))
    assert got == plain(docs, items)
    assert 201 not in got and None in got


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, "same words here") for i in range(500, 0, -1)] + [(1000, "other")]
    got = found(dualtree.search(*tables(spark, docs, [(1, "words here")]), seed=40))
    assert [i for i, _ in got[1]] == list(range(1, 11))


def test_empty_tables(spark):
    assert found(dualtree.search(*tables(spark, [], [(1, "a")]))) == {}
    assert found(dualtree.search(*tables(spark, [(1, "a")], []))) == {}
    assert found(dualtree.search(*tables(spark, [(1, None), (2, "-")], [(1, "a"), (2, None)]))) == {}
    assert found(dualtree.search(*tables(spark, [(1, "b")], [(1, "a")]))) == {}


def test_long_texts_are_counted_in_pieces():
    text = ("Ein Wort, " * 5000 + "ñ" * 4000 + " end").encode()
    want = Counter(t.encode() for t in terms_of(text.decode()))
    assert all(dualtree.count_terms(text, piece) == want for piece in (1, 7, 64, 4096, 1 << 20))


def test_bounds_hold_and_drop_pairs():
    """Every node's maxima are those of its members; most pairs of leaves go."""
    rnd, rng = random.Random(1), np.random.default_rng(1)
    groups = [[f"g{g}w{i}".encode() for i in range(30)] for g in range(16)]
    items = dualtree.Items([(i, sorted(rnd.sample(groups[i % 16], 8)), [1000] * 8) for i in range(128)], 10)
    items.open()
    for node, (a, b) in enumerate(items.tree.bounds):
        assert (items.top[:, node] == items.weights[:, a:b].max(axis=1)).all()
    place = {t: i for i, t in enumerate(items.vocabulary)}
    rows = [sorted({place[t] for t in rnd.sample(groups[rnd.randrange(16)], 10) if t in place}) for _ in range(2000)]
    start = np.cumsum([0, *map(len, rows)])
    x = dualtree.Sparse(start, np.array([c for r in rows for c in r]), rng.integers(1, 10 ** 6, start[-1]), len(place))
    best = dualtree.Best(items)
    best.search(np.arange(2000), x)
    dense = np.zeros((2000, len(place)))
    for r in range(2000):
        dense[r, x.column[start[r]:start[r + 1]]] = x.value[start[r]:start[r + 1]]
    scores = dense @ items.weights
    for j in range(128):
        want = sorted(zip(-scores[:, j], range(2000)))[:10]
        assert list(zip(-best.score[j], best.doc[j])) == [(s, i) for s, i in want]
    assert best.leaves < 0.4 * 16 * 64


def test_wide_scores_use_integers():
    items = dualtree.Items([(1, [b"a", b"b"], [1 << 34, 3])], 2)
    assert items.kind is np.int64
    items.open()
    best = dualtree.Best(items)
    best.search(np.array([4, 9]), dualtree.Sparse(np.array([0, 2, 3]), np.array([0, 1, 0]),
                                                  np.array([999_999, 1, 999_999]), 2))
    assert best.score.tolist() == [[999_999 * (1 << 34) + 3, 999_999 * (1 << 34)]] and best.doc.tolist() == [[4, 9]]


def test_blocks_hold_every_item():
    got = dualtree.item_blocks({0: 5, 6: 300, 7: 100, 20: 3, 40: 2})
    assert sorted(c for cs, _ in got for c in cs) == [0, 6, 7, 20, 40]
    assert all(n >= 1 for _, n in got) and dict((tuple(c), n) for c, n in got)[(40,)] == 2


def test_query_on_whole_table(spark, sf_small):
    read = lambda t: [(r[0], r.text) for r in spark.read.parquet(f"{sf_small}/{t}.parquet").collect()]
    got = QUERIES["op13_dual_tree"](spark, sf_small)
    assert sorted(got.columns) == ["doc_id", "item_id", "rank", "score"]
    assert found(got.withColumnRenamed("doc_id", "id")) == plain(read("documents"), read("benchmark"))
