"""Short lines: exact copies go, near ones and blank ones stay."""

import corpus_pipeline as cp
from basketry.llm import linededup
from basketry.llm.queries import op9_line_dedup

TEXTS = ["Title\none line", "Title\n\n \ntwo lines\n", "Titles\n\n \none line\nx\nx", "é\né\n "]
KEPT = ["Title\none line", "\n \ntwo lines\n", "Titles\n\n \nx", "é\n "]


def test_short_copies_go(docs_of):
    found = linededup.dedup_lines(docs_of(TEXTS), copy_bytes=1).orderBy("doc_id").collect()
    assert [r.text for r in found] == KEPT
    assert [tuple(r.lines_found) for r in found] == [(2, 0, 0), (5, 1, 0), (6, 2, 0), (3, 1, 0)]


def test_query_and_stage_keep_each_line_once(spark, docs_of):
    d = "/root/testdata/sf0.001"
    rows = op9_line_dedup(spark, d).collect()
    kept = [x for r in rows for x in r.text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    texts = [r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    short = {x for t in texts for x in t.split("\n") if x.strip(" \t\r\x0b\x0c") and len(x.encode()) < 40}
    assert len(kept) == len(set(kept)) and short <= set(kept)
    stage = cp.line_dedup(spark, docs_of(TEXTS), d).orderBy("doc_id").collect()
    assert [r.text for r in stage] == KEPT
