import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import langid, textmodel
from basketry.llm.queries import op10_language_id

ODD = ["", None, "a", "ab", "abc", "ABC abc", " a\tb  c ", "é", "éa b", "123 456", "x" * 50, "a\nb", "ends ", " begins"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()


def is_letter(b):
    return b >= 128 or 97 <= b <= 122


@pytest.mark.parametrize("texts", [ODD, ODD[::-1], ["", None], ["word"], []])
def test_features_of_many_texts_at_once(texts):
    col = pa.array(texts, pa.string())
    data, off = textmodel.text_buffer(col)
    code, at = textmodel.bins_of(data, off, textmodel.WORDS)
    assert np.diff(at).tolist() == [len(lower(t).split()) for t in texts]
    alone = [textmodel.bins_of(*textmodel.text_buffer(pa.array([t])), textmodel.WORDS)[0].tolist() for t in texts]
    assert [code[a:z].tolist() for a, z in zip(at, at[1:])] == alone
    code, at = textmodel.bins_of(data, off, textmodel.GRAMS)
    want = []
    for t in texts:
        b = lower(t)
        grams = [b[i:i + 3] for i in range(len(b) - 2) if any(map(is_letter, b[i:i + 3]))]
        want.append([((int.from_bytes(g, "big") * 0x9E3779B1) & 0xFFFFFFFF) >> 17 for g in grams])
    assert [code[a:z].tolist() for a, z in zip(at, at[1:])] == want
    assert textmodel.letters(col).tolist() == [sum(map(is_letter, lower(t))) for t in texts]


EN, FR = "the house and this thing with that there", "les maisons dans une chose avec cela voila"


def train(docs_of):
    rnd = random.Random(1)
    rows = []
    for i in range(60):
        lang, words = ("en", EN) if i % 2 else ("fr", FR)
        rows.append((i, " ".join(rnd.choice(words.split()) for _ in range(30)), lang, "a.com", 1))
    return langid.fit(docs_of(rows))


def plain(rows, model):
    """rows: (text, declared, host) -> posteriors, as the docstring says."""
    n, ll = model.text.score(pa.array([r[0] for r in rows], pa.string()))
    share = np.minimum(n, langid.EVIDENCE)[:, None] / np.maximum(n, 1)[:, None]
    ll = np.hstack([ll * share, (np.minimum(n, langid.EVIDENCE) * model.und)[:, None]])
    for i, r in enumerate(rows):
        if not any(map(is_letter, lower(r[0]))):
            ll[i] = [-1000.0] * (ll.shape[1] - 1) + [0.0]
        elif n[i] == 0:
            ll[i, -1] = -5.0
    p = np.exp(ll - ll.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    k = ll.shape[1]
    by = {level: defaultdict(lambda: np.zeros(k)) for level in ("host", "parent", "suffix")}
    all_ = np.zeros(k)
    said, total = defaultdict(lambda: np.zeros(k)), np.zeros(k)
    up = {}
    for (_, d, h), x in zip(rows, p):
        h = h or ""
        parent, suffix = (h.split(".", 1)[1], h.rsplit(".", 1)[1]) if "." in h else ("", "")
        up[h] = parent, suffix
        for level, key in (("host", h), ("parent", (parent, suffix)), ("suffix", suffix)):
            by[level][key] += x
        all_ += x
        if d is not None:
            said[d] += x
            total += x

    def smooth(c, prior):
        return (c + langid.SMOOTH * prior) / (c.sum() + langid.SMOOTH)
    out = []
    for (_, d, h), x, l in zip(rows, p, ll):
        h = h or ""
        parent, suffix = up[h]
        base = smooth(by["parent"][parent, suffix], smooth(by["suffix"][suffix], smooth(all_, np.full(k, 1 / k))))
        z = l + np.log(smooth(np.maximum(by["host"][h] - x, 0), base))
        if d is not None:
            z = z + np.log((said[d] + 1) / (total + len(said) + 1))
        q = np.exp(z - z.max())
        out.append(q / q.sum())
    return np.array(out)


def test_fusion_against_plain_bayes(docs_of, spark):
    model = train(docs_of)
    assert model.classes == ["en", "fr", "und"]
    rnd = random.Random(2)
    hosts = ["a.com", "b.a.com", "c.fr", "d.c.fr", "src0", "", None]
    rows = []
    for i in range(80):
        words = rnd.choice([EN, FR, EN + " " + FR, "zzqx qqk wzx"]).split()
        text = rnd.choice([None, "", "12 34", "ab"]) if i % 9 == 0 else " ".join(
            rnd.choice(words) for _ in range(rnd.choice([1, 3, 40])))
        rows.append((text, rnd.choice(["en", "fr", "de", None]), rnd.choice(hosts)))
    df = docs_of([(i, t, d, h, 1) for i, (t, d, h) in enumerate(rows)])
    got = langid.identify(df, model, "text", F.col("lang"), F.col("source")).orderBy("doc_id").collect()
    want = plain(rows, model)
    names = np.array(model.classes)
    assert len(got) == len(rows) and got[0]["key"] == "x" and [g.text for g in got] == [r[0] for r in rows]
    for g, q in zip(got, want):
        assert math.isclose(g.language.confidence, q.max(), rel_tol=1e-4)
        assert g.language.lang in names[q > q.max() - 1e-6]
        assert g.language.accepted == (g.language.lang != "und" and g.language.confidence >= 0.5)
    empty = [g.language.lang for g, r in zip(got, rows) if not r[0] or r[0] == "12 34"]
    assert set(empty) == {"und"}


def test_markup_and_host_decide_short_pages(docs_of, spark):
    model = train(docs_of)
    rows = [(i, f"http://x.site.fr/{i}", f'<html class="a" lang="fr-FR"><script>the house and this</script>'
             f'<p title="the">{FR}</p><!-- and this thing --></html>') for i in range(30)]
    rows += [(100, "http://y.site.fr/", "<p>ab</p>"), (101, None, None), (102, "no url", "<html lang=en><p>ab</p>"),
             (103, "http://x.site.fr/", "<b>12</b>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("x"))
    out = langid.identify_pages(df, model)
    assert out.columns == [*df.columns, "language"]
    got = {r.page_id: r.language for r in out.collect()}
    assert got[0].lang == got[0].text_lang == "fr" and got[100].lang == "fr" and got[100].accepted
    assert got[101].lang == got[103].lang == "und" and not got[103].accepted


def test_no_labels_and_empty_table(docs_of):
    bare = langid.fit(docs_of([(1, "text", None, None, None)]))
    assert [r.language.lang for r in langid.identify_documents(docs_of(["a b c"]), bare).collect()] == ["und"]
    assert langid.identify_documents(docs_of([]), train(docs_of)).count() == 0


def test_query_on_whole_tables(spark):
    d = "/root/testdata/sf0.01"
    rows = op10_language_id(spark, d).collect()
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    pages = spark.read.parquet(f"{d}/pages.parquet").count()
    assert Counter(r.doc_id for r in rows if r.doc_id is not None) == Counter(list(docs)) and len(rows) == len(docs) + pages
    right = sum(r.lang == docs[r.doc_id] for r in rows if r.doc_id is not None)
    assert right > 0.97 * len(docs) and sum(not r.accepted for r in rows) < 0.01 * len(rows)
