import hashlib
import random

import numpy as np
import pytest

from basketry.llm import bpe
from basketry.llm.queries import op3_bpe, rank_file

RANKS, PATTERN = rank_file()
ODD = ["", None, " ", "a", "don't we'll  go\n\n\tthere", "x" * 3000, " " * 3000 + "y", "é中文😀\u3000 \x1c!", "1234 5678",
       "<|endoftext|>", "a\x0b b\xa0 c"]


def want(text):
    return bpe.encoding(RANKS, PATTERN).encode_ordinary(text or "")


def test_cut_texts_encode_like_whole_ones():
    enc, rnd = bpe.encoding(RANKS, PATTERN), random.Random(7)
    letters = " \n\t\r\x0b\x1c\x85\xa0\u3000a!'sÉ1́😀"
    for _ in range(3000):
        t = "".join(rnd.choice(letters) for _ in range(rnd.randrange(40)))
        got = bpe.encode_text(enc, PATTERN, t, chunk=rnd.choice([1, 2, 3, 9]))
        assert np.frombuffer(got, "<u4").tolist() == want(t), repr(t)


def test_long_stretch_without_a_safe_place():
    enc = bpe.encoding(RANKS, PATTERN)
    for t in ("ab1!" * 500, " " * 2000, "'s" * 900):
        assert np.frombuffer(bpe.encode_text(enc, PATTERN, t, chunk=16), "<u4").tolist() == want(t)


def test_round_trip_and_edge_rows(docs_of):
    df = docs_of(ODD + ["same", "same"])
    coded = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS, PATTERN)
    assert set(df.columns) <= set(coded.columns)
    rows = coded.select("doc_id", "text", "decoded", bpe.n_tokens().alias("n"), bpe.ids().alias("ids")).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        assert r.ids == want(r.text) and r.n == len(r.ids)
        assert bytes(r.decoded) == (r.text or "").encode()


def test_both_in_one_pass(docs_of):
    df = docs_of(ODD)
    one = bpe.encode(df, RANKS, PATTERN, decoded="decoded")
    two = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS, PATTERN)
    assert sorted(map(repr, one.select(*two.columns).collect())) == sorted(map(repr, two.collect()))


def test_raw_bytes_need_not_be_utf8(spark):
    first = want("é")[0] if len(want("é")) > 1 else want("中")[0]
    df = spark.createDataFrame([(bytearray(np.array([first], "<u4").tobytes()),), (None,)], "token_ids binary")
    got = [bytes(r.decoded) for r in bpe.decode(df, RANKS, PATTERN).collect()]
    assert got == [bpe.encoding(RANKS, PATTERN).decode_bytes([first]), b""]


def test_empty_table(docs_of):
    assert bpe.encode(docs_of([]), RANKS, PATTERN).count() == 0


@pytest.mark.parametrize("d", ["/root/testdata/sf0.001"])
def test_query_against_the_library(spark, d):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = op3_bpe(spark, d).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        ids = np.array(want(texts[r.doc_id]), "<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
