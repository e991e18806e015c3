import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from basketry.llm import bpe, linededup
from basketry.llm.queries import rank_file

from .test_simhash import plain_components, plain_fingerprint

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave, as lists of rows."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    # nulls, empty texts, repeated rows and a long text, after the documents
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "src0", 0), (9003, "12 .", "en", "x", 4),
                                 (9005, "the and of " * 20_000, "en", "src1", 220_000)], docs.schema)
    docs = docs.union(odd).union(docs.where("doc_id < 3"))
    out = [docs.collect()]
    for name, f in cp.STAGES:
        docs = cp.scratch(f(spark, docs, D), f"test-{name}")
        out.append(docs.collect())
    return out


def test_columns(stages):
    columns = stages[0][0].__fields__
    assert all(rows[0].__fields__ == columns for rows in stages[1:-1])
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "tokens"]


def test_language_keeps_texts_and_drops_empty_ones(stages):
    before, after = Counter(r.doc_id for r in stages[0]), Counter(r.doc_id for r in stages[1])
    assert not after - before and {9001, 9002, 9003} <= set(before - after)
    assert sum((before - after).values()) <= 4


def test_lines(stages):
    rows = sorted({(r.doc_id, r.text) for r in stages[1]})
    first = {}
    for k, (_, text) in enumerate(rows):
        for n, line in enumerate(text.split("\n")):
            if len(line.encode()) >= 40 or line.strip():  # copies of short lines go too, but for blank ones
                first.setdefault(line, (k, n))
    lines = sorted((x for x in first if len(x.encode()) >= 40), key=lambda x: len(x.encode()))
    sizes = [len(x.encode()) for x in lines]
    earlier = set()
    for i, a in enumerate(lines):
        for j in range(i + 1, len(lines)):
            if sizes[j] - sizes[i] > 2:
                break
            if linededup.within(a.encode(), lines[j].encode(), 2):
                earlier.add(max(a, lines[j], key=first.get))
    want = {}
    for k, (i, text) in enumerate(rows):
        want[i] = "\n".join(x for n, x in enumerate(text.split("\n")) if x not in first or
                            first[x] == (k, n) and x not in earlier)
    assert {r.doc_id: r.text for r in stages[2]} == want and len(stages[2]) == len(stages[1])
    assert all(r.n_chars == len(r.text) for r in stages[2])


def test_one_of_each_group_stays(stages):
    groups = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in stages[2]])
    assert sorted(r.doc_id for r in stages[3]) == sorted({c for _, _, c in groups})


def test_mixing_copies_rows(stages):
    before, after = {r.doc_id: r for r in stages[3]}, Counter(r.doc_id for r in stages[4])
    assert set(after) <= set(before) and all(before[r.doc_id] == r for r in stages[4])
    assert 1.0 < sum(len(before[i].text.split()) * n for i, n in after.items()) / sum(
        len(r.text.split()) for r in stages[3]) < 1.6


def test_tokens(stages):
    enc, texts = bpe.encoding(*rank_file()), {r.doc_id: r.text for r in stages[3]}
    assert Counter(r.doc_id for r in stages[5]) == Counter(r.doc_id for r in stages[4])
    for r in stages[5]:
        ids = enc.encode_ordinary(texts[r.doc_id])
        assert np.frombuffer(r.token_ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_and_rows_without_ids(spark):
    assert cp.run(spark, D).where(F.col("n_tokens") > 0).count() > 100
    kind = spark.read.parquet(f"{D}/documents.parquet").schema
    rows = [(None, "a text without an id", "en", "s", 1), (None, "a text without an id", "en", "s", 1),
            (4, "another one here now", "en", "s", 1), (None, "another one here now", "en", "s", 1)]
    left = cp.near_dedup(spark, spark.createDataFrame(rows, kind), D).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, "a text without an id"), (4, "another one here now")]


def test_empty_table(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").limit(0)
    for _, f in cp.STAGES:
        docs = f(spark, docs, D)
        assert docs.count() == 0
