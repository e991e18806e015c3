import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import toxicity
from basketry.llm.queries import op1_toxicity

PRIOR = np.repeat([1.0, .2, .3, 1.0, .2, .3], 2) * np.tile([1.0, 1.5], 6)
MODEL = toxicity.Model({"idio": 4.0}, {"scum": 5.0}, {"kill": 3.0}, PRIOR, -3.0)
READ = {(r, y): 2 * i + y for i, r in enumerate(toxicity.READINGS) for y in (0, 1)}


def read_plainly(words, scope=toxicity.SCOPE):
    """{(reading, named): weight} of a clause, by the words of the docstring."""
    lists = {k: v.split() for k, v in toxicity.WORDS.items()}
    hits = []
    for k, w in enumerate(words):
        if w == "kill":
            hits.append((k, "T", 3.0))
        elif w.startswith("idio") or w == "scum":
            strong = k and words[k - 1] in lists[toxicity.STRONG]
            hits.append((k, "I", (4.0 if w != "scum" else 5.0) * (1.25 if strong else 1.0)))
        elif any(words[max(k + 1 - len(p), 0):k + 1] == p for p in map(str.split, toxicity.PHRASES)):
            hits.append((k, "T", 3.0))
    named = int(any(w in lists[toxicity.TARGET] for w in words))
    out = {}
    for k, kind, weight in hits:
        quote = said = False
        for w in words[:k]:
            if quote and w in lists[toxicity.CLOSE]:
                quote = said = False
            elif w in lists[toxicity.OPEN]:
                quote = True
            said = said or w in lists[toxicity.REPORT]
        negated = any(w in lists[toxicity.NEGATION] for w in words[max(k - scope, 0):k])
        r = {"I": "r", "T": "q"}[kind] if quote or said else kind.lower() if negated else kind
        out[r, named] = out.get((r, named), 0.0) + weight
    return out


ALPHABET = ["idiotic", "scum", "kill", "you", "not", "said", "total", "fine", "“", "”", "watch", "your", "back"]


def vector(found):
    out = np.zeros(len(PRIOR))
    for k, v in found.items():
        out[READ[k]] = v
    return out


def test_composed_machine():
    units, m = toxicity.Matcher(MODEL, np.ones(len(PRIOR))), toxicity.Matcher(MODEL)
    rnd = __import__("random").Random(3)
    clauses = [list(c) for n in range(4) for c in itertools.product(ALPHABET, repeat=n)]
    clauses += [rnd.choices(ALPHABET, k=rnd.randrange(4, 12)) for _ in range(3000)]
    for words in clauses:
        want = vector(read_plainly(words))
        assert units.features(" ".join(words))[:-1].tolist() == want.tolist(), words
        assert np.allclose(m.features(" ".join(words))[:-1], want * PRIOR)


def test_scores_against_a_plain_scorer(docs_of):
    """Whole texts: clauses, readings, weights, the cap, the chance."""
    rnd = __import__("random").Random(5)
    texts = ["".join(rnd.choice(ALPHABET + ["plain"]) + rnd.choice([" ", " ", " ", ". ", ", ", "\n"])
                     for _ in range(rnd.choice([3, 10, 40, 400]))) for _ in range(150)] + ["", None]
    want = []
    for t in texts:
        f = np.zeros(len(PRIOR))
        for clause in __import__("re").split(r"[.!?;,:\n()]", t or ""):
            f += vector(read_plainly(clause.split()))
        want.append(1 / (1 + np.exp(3 - np.clip(f, 0, toxicity.CAP) @ PRIOR)))
    got = [r.score for r in toxicity.score(docs_of(texts), MODEL).orderBy("doc_id").collect()]
    assert np.allclose(got, want)


@pytest.mark.parametrize("text,want", [
    ("What idiots. All fine", {("I", 0): 4.0}),
    ("you idiot, and you", {("I", 1): 4.0}),
    ("he is not an idiot", {("i", 1): 4.0}),
    ("not a word of it was ever meant idiotic", {("I", 0): 4.0}),
    ("someone said idiot", {("r", 0): 4.0}),
    ("they wrote \"I will kill\" there", {("q", 1): 3.0}),
    ("SCUM and scumble, myscum", {("I", 0): 5.0}),
    ("kill\nidiot idiot", {("T", 0): 3.0, ("I", 0): 8.0}),
    ("\"Fine\" he wrote of the idiot", {("r", 1): 4.0}),
    ("the \"fine\" idiot", {("I", 0): 4.0}),
    ("he „mag“ idiots", {("I", 1): 4.0}),
    ("a total idiot", {("I", 0): 5.0}),
    ("better watch your back", {("T", 1): 3.0}),
    ("", {}), (None, {}), (" . ,", {}),
])
def test_clauses(text, want):
    f = toxicity.Matcher(MODEL, np.ones(len(PRIOR))).features(text)
    got = np.zeros(len(f) - 1)
    for k, v in want.items():
        got[READ[k]] = v
    assert f[:-1].tolist() == got.tolist()


def test_long_text_and_model_without_entries():
    m = toxicity.Matcher(MODEL)
    f = m.features("idiot scum " * 100_000)
    assert f[0] == 900_000.0 and 0.99 < m.score(f) <= 1
    none = toxicity.Matcher(toxicity.Model({}, {}, {}, PRIOR, -3.0))
    assert none.score(none.features("idiot")) == pytest.approx(1 / (1 + np.exp(3)))


def test_score_keeps_rows_and_columns(docs_of):
    df = docs_of(["you scum", None, "", "fine", "fine"])
    rows = toxicity.score(df, MODEL).orderBy("doc_id").collect()
    assert [r.matched for r in rows] == [1, 0, 0, 0, 0] and rows[0].score > 0.9 and rows[0]["key"] == "x"
    assert all(0 <= r.score <= 1 for r in rows) and rows[0]["text"] == "you scum"
    assert toxicity.score(docs_of([]), MODEL).count() == 0


@pytest.mark.parametrize("labels", [[], [(0, 1)], [(0, 0), (1, None), (None, 1)]])
def test_too_few_labels(docs_of, spark, labels):
    df = docs_of(["bad words", "good words", None])
    m = toxicity.fit(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert not m.stems and not m.words and toxicity.score(df, m).count() == 3


def test_learns_words_and_stems(docs_of, spark):
    bad = ["and then zorbat" + x + " again" for x in ("a", "eb", "ic", "od", "uf", "", "an", "en")] * 3
    good = [f"and then number {i} again" for i in range(150)]
    df = docs_of(bad + good)
    rows = [(i, int(i < len(bad))) for i in range(len(bad + good))]
    rows += rows[:3] + [(0, 0), (None, 1)]  # repeated and differing labels
    m = toxicity.fit(df, spark.createDataFrame(rows, "doc_id bigint, toxic int"))
    s = {r.text: r.score for r in toxicity.score(docs_of(["zorbatix!", "and then", "number 5 again"]), m).collect()}
    assert s["zorbatix!"] > 0.5 > max(s["and then"], s["number 5 again"])


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    out = op1_toxicity(spark, d)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").select(
        "predicted", "toxic").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit >= 0.85 * sum(r.toxic for r in rows) and hit >= 0.95 * sum(r.predicted for r in rows)
    want = {i for i in range(200) if __import__("zlib").crc32(str(i).encode()) % 5 == 0}
    assert {r.doc_id for r in out.where("held_out AND doc_id < 200").select("doc_id").collect()} == want
    assert out.where(F.col("score").isNull()).count() == 0
