"""Tables whose extra columns have the names that the operators give."""

import pytest
from pyspark.sql import functions as F

from basketry.llm import langid, linededup, mixing
from basketry.llm.common import free_name

corpus_pipeline = pytest.importorskip("corpus_pipeline")
NAMES = ["lines_found", "Language", "mix", "rate", "copy", "row", "found", "visible", "text_lang", "n_lines", "tokens",
         "posterior", "component", "fp", "__id", "__rate", "__copy", "declared", "host"]
TEXTS = ["a line that is long enough to be compared with others\nsecond line here", "other words in a text",
         "a line that is long enough to be compared with others\nmore", "", None, "other words in a text"]


@pytest.fixture
def clashing(docs_of):
    df = docs_of(TEXTS)
    for c in NAMES:
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_free_names(spark):
    df = spark.range(1).selectExpr("1 as mix", "2 as MIX_2")
    assert free_name(df, "mix") == "mix_3" and free_name(df, "other") == "other"


def values(df, names):
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def test_each_operator_keeps_the_columns(clashing, docs_of, spark):
    lines = linededup.dedup_lines(clashing)
    assert lines.columns == [*clashing.columns, "lines_found_2"]
    plain = linededup.dedup_lines(docs_of(TEXTS))
    assert values(lines, ["doc_id", "text", "lines_found_2"]) == values(plain, ["doc_id", "text", "lines_found"])
    model = langid.fit(clashing)
    found = langid.identify_documents(clashing, model)
    assert found.columns == [*clashing.columns, "language_2"] and found.count() == len(TEXTS)
    assert {r["Language"] for r in found.collect()} == {"clash"}
    pages = spark.createDataFrame([(1, "http://a.de/", "<html lang=en>words in a text")], "page_id bigint, url string, html string")
    pages = pages.withColumn("visible", F.lit("clash")).withColumn("language", F.lit("clash"))
    assert langid.identify_pages(pages, model).columns == [*pages.columns, "language_2"]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(6)], "doc_id bigint, quality int, toxic int")
    fit = mixing.fit(clashing, labels, mixing.label_domain(), mixing.DOMAINS)
    mix = mixing.mixed(clashing, fit, mixing.TARGETS)
    assert mix.columns == [*clashing.columns, "mix_2"] and set(mix.schema["mix_2"].dataType.names) == {
        "tokens", "posterior", "rate", "copies"}
    assert mixing.sampled(mix).columns == clashing.columns


def test_pipeline_stages(spark, clashing, tmp):
    clashing.write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(6)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp}/labels.parquet")
    docs = spark.read.parquet(f"{tmp}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tmp)
        assert docs.columns == clashing.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, tmp).count() == docs.count()


def test_different_texts_with_one_id_are_two_documents(spark, docs_of, tmp):
    docs = docs_of([(1, "one text with words of its own kind here", "en", "s", 1),
                    (1, "quite another text that shares nothing with it", "en", "s", 1),
                    (2, "one text with words of its own kind here", "en", "s", 1),
                    (2, "a third one, which is only here", "en", "s", 1),
                    (2, "a third one, which is only here", "en", "s", 1)])
    near = dict(corpus_pipeline.STAGES)["near_dedup"]
    got = sorted((r.doc_id, r.text) for r in near(spark, docs, tmp).collect())
    assert got == [(1, "one text with words of its own kind here"), (1, "quite another text that shares nothing with it"),
                   (2, "a third one, which is only here")]
