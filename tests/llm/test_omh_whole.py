"""Every order selects over the whole text, by a hash of its own."""

from basketry.llm import omh

from .test_omh import make_texts, plain_signature


def signatures(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "key bigint, text string")
    found = {r.key: r.signature for r in omh.signatures(df).collect()}
    return [found.get(i, [0] * omh.TUPLES) for i in range(len(texts))]


def test_against_the_definition(spark):
    texts = [t for t in make_texts() if t is not None]
    assert signatures(spark, texts) == [plain_signature(t) for t in texts]
