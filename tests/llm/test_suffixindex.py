import hashlib
import os
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import suffixindex
from basketry.llm.queries import op6_suffix_index


def plain(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        hit = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                hit[i:i + length] = [True] * length
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out.append((len(r), sum(hit), spans, bytes(c for c, h in zip(r, hit) if not h)))
    return out


def got(df, **kw):
    rows = suffixindex.repeated(df, **kw).collect()
    return [(r.id, r.n_bytes, sum(s["end"] - s["start"] for s in r.spans), len(r.spans), bytes(r.kept)) for r in rows]


def random_texts(seed, n=40):
    rnd = random.Random(seed)
    def run(k, letters="abé"):
        return "".join(rnd.choice(letters) for _ in range(k))
    passages = [run(rnd.randrange(10, 60)) for _ in range(6)]
    texts = ["".join(rnd.choice([rnd.choice(passages), run(rnd.randrange(30))]) for _ in range(rnd.randrange(8)))
             for _ in range(n)]
    return texts + texts[:4] + ["", None, "a" * 100, "ab" * 70, run(19), run(20), "xyz" + texts[3] + "q"]


@pytest.mark.parametrize("seed,gram,batches,group", [(1, 8, 4, 4 << 20), (2, 1, 1, 200), (3, 20, 3, 200),
                                                     (4, 13, 6, 1)])
def test_against_every_window(docs_of, seed, gram, batches, group):
    texts = random_texts(seed)
    want = [(i, *w) for i, w in enumerate(plain(texts, 20))]
    assert sorted(got(docs_of(texts), length=20, gram=gram, batches=batches, group_bytes=group)) == want


def test_long_texts_in_stretches(docs_of):
    texts = random_texts(6)
    want = [(i, *w) for i, w in enumerate(plain(texts, 20))]
    for stretch in (20, 27, 64):
        assert sorted(got(docs_of(texts), length=20, gram=8, stretch=stretch)) == want


class Batches:
    """Stands for a table: its batches go through a worker's function here."""
    def __init__(self, batch):
        self.batch = batch

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return run(iter([self.batch]))


def peak(of):
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in of())
        return n, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_worker_holds_arrays_for_little_text_at_once():
    # many texts, then a long one after a short one; arrays of 2 MB or of a whole text at once took 372 MB
    rnd = np.random.default_rng(7)
    texts = [rnd.integers(97, 123, n, np.uint8).tobytes().decode() for n in [4000] * 900 + [500, 3 << 20, 500]]
    at = pa.array(range(len(texts)))
    batch = pa.RecordBatch.from_arrays([at, at, pa.array(texts)], names=["ka", "kb", "text"])
    n, most = peak(lambda: suffixindex.suffixes(Batches(batch), 400, 128))
    assert n > 40_000 and most < 40e6
    cuts = pa.array([[{"start": 10, "end": 410}]] * len(texts))
    batch = pa.RecordBatch.from_arrays([at, pa.array([t[:4000] for t in texts]), cuts], names=["id", "text", "cuts"])
    n, most = peak(lambda: suffixindex._kept(iter([batch])))
    assert n == len(texts) and most < 3e6


def test_short_and_long_texts_of_one_batch(docs_of):
    # a text is cut in the same stretches whichever texts it is read with, when indexed and when looked up
    rnd = random.Random(8)
    long = "".join(rnd.choice("abcd") for _ in range(400))
    texts = ["x", long[90:130], "", long, None, long[:45] + "zz" + long[300:], "yy" + long[200:240], "ab"]
    want = [(i, *w) for i, w in enumerate(plain(texts, 20))]
    for stretch in (40, 64, 400):
        assert sorted(got(docs_of(texts), length=20, gram=8, stretch=stretch)) == want


def test_matches_are_found_when_a_batch_is_added(docs_of, spark):
    same, ends = "abcdefghijklmnopqrstuvwxyz0123", "KLMNOPQRSTUVWXYZ"
    batches = [[same, "1" + ends + "98"], ["no match in this one, none"], [same + "!"], ["3" + ends + "54"], ["nothing new"]]
    index, seen = suffixindex.Index(spark, 16, 8), []
    for texts in batches:
        index.add(suffixindex._keyed(docs_of(texts, extra=False), "doc_id", "text"))
        seen.append(spark.read.parquet(index.found[-1]).collect())
    assert [bool(s) for s in seen] == [False, False, True, True, False]
    # what the batch and the levels share, of both sides, with the places in all of them
    plain_rows = spark.read.parquet(*[p for _, p in index.levels]).collect()
    total = Counter()
    for r in plain_rows:
        total[r.gram, r.block] += r.places
    grams = Counter()
    for (g, _), n in total.items():
        grams[g] += n
    assert {(r.gram, r.block, r.whole) for r in index.matches().collect()} == {
        (g, b, n > 1) for (g, b), n in total.items() if grams[g] > 1}


def test_null_and_repeated_ids(docs_of):
    t = [(None, "abcdefghij" * 3, None, None, None), (5, "klmnopqrst", None, None, None),
         (5, "klmnopqrst", None, None, None), (5, "other text", None, None, None), (None, None, None, None, None)]
    df = docs_of(t)
    want = [(x[0], *w) for x, w in zip(t, plain([x[1] for x in t], 8))]
    assert sorted(got(df, length=8, gram=3), key=repr) == sorted(want, key=repr)


def test_empty_table(docs_of):
    assert got(docs_of([]), length=20, gram=8) == []


def test_levels_double(docs_of, spark):
    index = suffixindex.Index(spark, 20, 8)
    docs = suffixindex._keyed(docs_of(random_texts(5), extra=False), "doc_id", "text")
    sizes = []
    for i in range(7):
        index.add(docs.where(f"pmod(ka, 7) = {i}"))
        sizes.append([n for n, _ in index.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1]]


def test_query_on_whole_table(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").orderBy("doc_id").collect()
    want = {r.doc_id: (n, m, s, hashlib.sha256(k).hexdigest())
            for r, (n, m, s, k) in zip(docs, plain([r.text for r in docs], 400))}
    got_ = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op6_suffix_index(spark, d).collect()}
    assert got_ == want and any(v[1] for v in want.values())


def test_merged_levels_are_deleted(docs_of, spark):
    index = suffixindex.Index(spark, 20, 8)
    docs = suffixindex._keyed(docs_of(random_texts(5), extra=False), "doc_id", "text")
    made = set()
    for i in range(3):
        index.add(docs.where(f"pmod(ka, 3) = {i}"))
        made |= {p for _, p in index.levels}
    there = {p for p in made if os.path.exists(p.removeprefix("file:"))}
    assert there == {p for _, p in index.levels} and len(made) > len(there)
    kept = [p.removeprefix("file:") for p in [p for _, p in index.levels] + index.found]
    index.close()
    assert not any(map(os.path.exists, kept))
