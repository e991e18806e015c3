"""Corpus pipeline: language ID, line de-duplication, SimHash near-dedup,
mixing to target weights, byte-level BPE.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, the next one's docs. All but the last return the columns
of documents.

* language_id: texts of no known language, and empty ones, go.
* line_dedup: repeated lines go; ``n_chars`` follows the text. A text that
  loses all its lines stays, as an empty text.
* near_dedup: of each group of near-duplicates the document with the smallest
  doc_id stays (of several with that id, the same one each run). A document is
  a doc_id and a text: different texts with one id are different documents, rows
  with both equal are one, and rows without an id come after all others.
  Documents are told apart by 128 bits of hash, and linked by 64 of them.
* mixing: a row stays as often as its rate says, copies next to each other.
  ``MIX_TARGETS`` are near what the texts are, with a larger budget, so that
  rates of clean texts are over 1 and they stay (the classifier gives ordinary
  texts some chance of being toxic; far targets would cost most of them).
* tokens: the ids of each text, and a digest of the decoded bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import bpe, langid, linededup, mixing, simhash
from basketry.llm.common import bounded, scratch
from basketry.llm.queries import (LINE_BYTES, LINE_COPY_BYTES, LINE_EDITS, SIMHASH_BITS, SIMHASH_SHINGLE, rank_file, table)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = langid.identify_documents(docs, langid.fit(docs))
    return found.where(F.col(f"`{found.columns[-1]}`.accepted")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(docs, threshold=LINE_EDITS, min_bytes=LINE_BYTES, copy_bytes=LINE_COPY_BYTES)
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)])
    named = docs.select(F.xxhash64("doc_id", "text").alias("h"), F.xxhash64("text", F.lit(1), "doc_id").alias("g"),
                        F.col("doc_id").cast("long").alias("d"), "text", row.alias("row"))
    found = simhash.near_duplicates(named.select("h", "text"), "h", "text", SIMHASH_SHINGLE, SIMHASH_BITS)
    names = named.select("h", "g", "d").distinct().join(
        found.select(F.col("id").alias("h"), "component").distinct(), "h")
    first = names.groupBy("component").agg(F.min(F.struct(F.col("d").isNull(), "d", "h", "g")).alias("m"))
    kept = named.select("h", "g", "row").join(first.select("m.h", "m.g"), ["h", "g"], "left_semi")
    return kept.groupBy("h", "g").agg(F.min("row").alias("row")).select(  # one of rows that are equal in id and text
        *[F.col(f"row.c{k}").alias(c) for k, c in enumerate(docs.columns)])


MIX_TARGETS = {"high": 0.78, "low": 0.12, "toxic": 0.10}


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = mixing.fit(docs, table(spark, sf_dir, "labels"), mixing.label_domain(), mixing.DOMAINS)
    return mixing.sampled(mixing.mixed(docs, model, MIX_TARGETS, budget=mixing.BUDGET))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks, pattern = rank_file()
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, pattern, decoded="decoded")
    return coded.select("doc_id", "lang", "source", bpe.n_tokens().alias("n_tokens"), "token_ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [(name, bounded(f)) for name, f in (
    ("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mix),
    ("tokens", tokens))]

#: No stage but the last could be said in SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
