"""Language identification by Bayesian evidence fusion.

The posterior of a language is the product of

* the text's likelihood: a model of hashed byte 3-grams, one per language, of
  the whole text, and one for no known language ("und") that every 3-gram fits
  equally badly. A text counts as ``EVIDENCE`` independent 3-grams at most, so
  the mean over a long text isn't taken for certainty;
* the declared language (of the markup, or a language column): how often
  texts that read as language k declare d, over all texts;
* the prior of the host: how often texts of the host read as k, smoothed by
  the host's parent domain, that by the address suffix, and that by all hosts
  (each with a weight of ``SMOOTH`` texts). A text's own reading is left out
  of its host's.

The languages are those of all labelled texts. Each one's model comes from about
``MAX_LABELLED`` of its texts at most (least hashes of the id, one at least), so
a language has a model however rare it is. If there are more than
``MAX_LANGUAGES``, those after the ones with most texts share a model, made in
the same way of 10 times as many of their texts; a text that reads as one of them
has the language that it declares, or "mis" if it declares none, and is
accepted like any other. Declarations and hosts are grouped aggregations
over everything that is identified. Texts are never shuffled by
key unless the host table outgrows a broadcast, and then a frequent host can
be split, as a host has one row on the other side.

Edge cases: a null or empty text, or one without letters, is "und"; null
declarations say nothing; null hosts are the host ""; without labelled texts
all is "und"; an empty table gives an empty result. Other columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textmodel
from .common import blocks, free_name, scratch
from .urlfilter import host_of

#: Texts that a language's model is made of, and languages with one of their own, at most.
MAX_LABELLED, MAX_LANGUAGES = 1_000, 200
_HASHES = 1 << 30
EVIDENCE = 60
SMOOTH = 20.0
#: How much less likely, per 3-gram, than the worst hundredth of the labelled
#: texts a text of no known language is taken to be.
MARGIN = 2.5
UND = "und"
#: The languages that share a model.
MIS = "mis"
#: Posterior that a language needs.
CONFIDENCE = 0.5


@dataclass
class Model:
    text: textmodel.TextModel
    und: float  # mean log likelihood of a 3-gram of no language
    shared: bool = False  # the last language of ``text`` is ``MIS``

    @property
    def classes(self) -> list:
        return [*self.text.classes, UND]


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        most: int = MAX_LABELLED, languages: int = MAX_LANGUAGES) -> Model:
    """Text models of the languages in ``lang_col``, of about ``most`` texts each."""
    known = df.where(F.col(f"`{lang_col}`").isNotNull()).select(
        F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(_HASHES)).alias("hash"), F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{lang_col}`").alias("lang"))
    every = known.groupBy("lang").agg(F.count("*").alias("n"), F.min("hash").alias("least"))
    found = every.orderBy(F.desc("n"), "lang").limit(languages + 1).collect()
    shared = len(found) > languages
    found = sorted(found[:languages], key=lambda r: r.lang)
    classes = [r.lang for r in found]
    upto = [max(r.least, int(min(1.0, most / r.n) * _HASHES)) for r in found]
    if shared:
        n, least = every.where(~F.col("lang").isin(classes)).agg(F.sum("n"), F.min("least")).first()
        upto.append(max(least, int(min(1.0, 10 * most / n) * _HASHES)))
    if not classes:
        return Model(textmodel.TextModel(textmodel.GRAMS, [], np.zeros((0, textmodel.BINS), np.float32)), 0.0)
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("lang")).cast("int") - 1
    texts = known.withColumn("class", F.when(index < 0, len(classes)).otherwise(index)).where(
        F.col("hash") <= F.element_at(F.array(*[F.lit(x) for x in upto]), F.col("class") + 1)).select("text", "class")
    classes += [MIS] * shared
    model = textmodel.fit(texts, classes, textmodel.GRAMS)

    def means(batches):
        for b in blocks(batches, "text", 2 << 20):
            n, ll = model.score(b.column(0))
            own = ll[np.arange(len(n)), np.asarray(b.column(1))]
            some = n > 0
            yield pa.RecordBatch.from_arrays([pa.array(own[some] / n[some])], names=["mean"])

    low = texts.mapInArrow(means, "mean double").agg(F.percentile_approx("mean", F.lit(0.01), F.lit(1000))).first()[0]
    und = (low if low is not None else -8.0) - MARGIN
    # any 3-gram of a text may be of no language: junk in a text costs only so much
    model.table = np.logaddexp(model.table, und).astype(np.float32) + np.float32(np.log(0.5))
    return Model(model, und, shared)


def _read(df: DataFrame, text_col: str, model: Model) -> DataFrame:
    """``df`` (all columns in struct ``row``) with the tempered log likelihood
    by class, ``ll``, and the posterior of the text alone, ``p``."""
    slim = df.select(F.col(f"`{text_col}`").alias("text"), *[c for c in ("row", "declared", "host")])
    numbers = T.ArrayType(T.DoubleType())
    out = T.StructType([*slim.schema.fields, T.StructField("ll", numbers), T.StructField("p", numbers)])
    k = len(model.classes)

    def run(batches):
        for b in blocks(batches, "text", 2 << 20):
            n, ll = model.text.score(b.column(0))
            share = (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
            ll = np.hstack([ll * share, (np.minimum(n, EVIDENCE) * model.und)[:, None]])
            bare = textmodel.letters(b.column(0)) == 0
            ll[n == 0, -1] = -5.0  # too short to say
            ll[bare, :-1], ll[bare, -1] = -1000.0, 0.0
            p = np.exp(ll - ll.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            at = pa.array(np.arange(len(n) + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.ListArray.from_arrays(at, pa.array(x.reshape(-1))) for x in (ll, p))],
                names=[*b.schema.names, "ll", "p"])

    return slim.mapInArrow(run, out)


def _sums(k: int) -> list[Column]:
    return [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(k)]


def _vector(k: int) -> Column:
    return F.array(*[F.col(f"s{i}") for i in range(k)])


def parent_of(host: Column) -> Column:
    return F.when(F.instr(host, ".") > 0, F.regexp_extract(host, r"^[^.]*\.(.*)$", 1)).otherwise(F.lit(""))


def suffix_of(host: Column) -> Column:
    return F.when(F.instr(host, ".") > 0, F.regexp_extract(host, r"([^.]*)$", 1)).otherwise(F.lit(""))


def _smoothed(n: Column, prior: Column) -> Column:
    total = F.aggregate(n, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(n, prior, lambda x, p: (x + SMOOTH * p) / (total + SMOOTH))


def _tables(readings: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(host, n, base): texts of the host by class, and the prior that smooths
    them; (d, said): log chance of the declaration by class."""
    seen = scratch(readings.groupBy("host", "declared").agg(*_sums(k)), "lang-seen")
    again = [F.sum(f"s{i}").alias(f"s{i}") for i in range(k)]
    hosts = seen.groupBy("host").agg(*again).select(
        "host", parent_of(F.col("host")).alias("parent"), suffix_of(F.col("host")).alias("suffix"),
        *[f"s{i}" for i in range(k)])
    total = np.array([x or 0.0 for x in hosts.agg(*again).first()])  # a number per class
    every = F.array(*[F.lit(float(x)) for x in (total + SMOOTH / k) / (total.sum() + SMOOTH)])
    suffixes = hosts.groupBy("suffix").agg(*again).select(
        F.col("suffix").alias("x"), _smoothed(_vector(k), every).alias("by_suffix"))
    parents = hosts.groupBy("parent", "suffix").agg(*again).join(suffixes, F.col("suffix") == F.col("x")).select(
        F.col("parent").alias("y"), F.col("suffix").alias("z"),
        _smoothed(_vector(k), F.col("by_suffix")).alias("base"))
    by_host = hosts.join(parents, (F.col("parent") == F.col("y")) & (F.col("suffix") == F.col("z"))).select(
        F.col("host").alias("h"), _vector(k).alias("n"), "base")
    said = seen.where("declared IS NOT NULL").groupBy("declared").agg(*again)
    kinds, *whole = said.agg(F.count("*"), *[F.sum(f"s{i}") for i in range(k)]).first()
    said = said.select(F.col("declared").alias("d"), F.array(*[
        F.log((F.col(f"s{i}") + 1) / ((whole[i] or 0.0) + kinds + 1)) for i in range(k)]).alias("said"))
    return scratch(by_host, "lang-hosts"), scratch(said, "lang-said")


def identify(df: DataFrame, model: Model, text_col: str, declared: Column, host: Column) -> DataFrame:
    """``df`` with, as the last column, a struct ``language`` (``free_name``):
    lang (or "und"), confidence (its posterior), text_lang (by the text alone)
    and accepted."""
    k = len(model.classes)
    names = F.array(*[F.lit(c) for c in model.classes])
    rest = {c: f"c{i}" for i, c in enumerate(df.columns) if c != text_col}
    row = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(a) for c, a in rest.items()])
    keyed = df.select(row.alias("row"),
                      declared.alias("declared"), F.coalesce(host, F.lit("")).alias("host"),
                      F.col(f"`{text_col}`").alias("text"))
    light = keyed.select(F.lit(0).alias("row"), "declared", "host", "text")
    by_host, said = _tables(_read(light, "text", model), k)
    read = _read(keyed, "text", model)
    read = read.join(by_host, F.col("host") == F.col("h"), "left").join(said, F.col("declared") == F.col("d"), "left")
    left = [F.greatest(F.col("n")[i] - F.col("p")[i], F.lit(0.0)) for i in range(k)]  # the host's other texts
    total = F.log(sum(left[1:], left[0]) + SMOOTH)
    read = read.withColumn("z", F.array(*[
        F.col("ll")[i] + F.log(left[i] + SMOOTH * F.col("base")[i]) - total + F.coalesce(F.col("said")[i], F.lit(0.0))
        for i in range(k)]))
    read = read.withColumn("top", F.array_max("z"))
    best = 1 / F.aggregate("z", F.lit(0.0), lambda a, z: a + F.exp(z - F.col("top")))
    at = F.array_position("z", F.col("top")).cast("int")
    lang = F.element_at(names, at)
    if model.shared:
        lang = F.when(at == k - 1, F.coalesce("declared", F.lit(MIS))).otherwise(lang)
    text_lang = F.element_at(names, F.array_position("p", F.array_max("p")).cast("int"))
    return read.select(
        *[F.col("text" if c == text_col else f"row.{rest[c]}").alias(c) for c in df.columns],
        F.struct(lang.alias("lang"), best.alias("confidence"), text_lang.alias("text_lang"),
                 ((lang != UND) & (best >= CONFIDENCE)).alias("accepted")).alias(free_name(df, "language")))


def identify_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Documents: ``lang`` is the declaration and ``source`` the host."""
    return identify(docs, model, "text", F.lower(F.substring("lang", 1, 2)), F.col("source"))


def identify_pages(pages: DataFrame, model: Model) -> DataFrame:
    """Web pages: the markup's language attribute and the url's host; the text
    is what stands between tags, without scripts and styles."""
    visible = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.lower(F.regexp_extract("html", r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-zA-Z]{2})", 1))
    name = free_name(pages, "visible")
    seen = pages.withColumn(name, visible)
    found = identify(seen, model, name, F.when(declared != "", declared), host_of("url"))
    return found.drop(name)
