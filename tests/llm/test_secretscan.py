import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import secretscan as S
from basketry.llm.queries import QUERIES

NAMES = "password passwd secret token apikey api_key".split()


def plain_base(text):
    """The contract, word by word: match, then drop those that are too short."""
    keyword = "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in n) for n in NAMES)
    rules = [("assign", rf"""({keyword})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
             ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24)]
    out = [(k, m.start(), m.end()) for k, p, good in rules for m in re.finditer(p, text) if good(m)]
    return sorted(out, key=lambda f: (f[1], ["assign", "access", "hex"].index(f[0])))


@pytest.fixture(scope="module")
def scanner():
    return S.fitted(S.made_findings(S.MADE))


def test_base_findings_on_random_texts():
    rnd = random.Random(2)
    pieces = [*NAMES, "ToKeN", "pa\u017fsword", "to\u212aen", '"', "'", " ", "  ", ":", "=", "= =", "abc", "abcdef", "x.y-z/1+2=",
              "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeefdeadbeef", "\n", "\t", "é", "AKIAAKIA", "token=a token=bcdefgh"]
    for _ in range(4000):
        text = "".join(rnd.choices(pieces, k=rnd.randrange(1, 14)))
        assert S.base_findings(text) == plain_base(text), text


def test_candidates():
    assert S.candidates("see abcdefgh12345678. and mail7.example.com.") == [(4, 20), (26, 43)]
    assert S.candidates("1234567890123456 abcdefghijklmnopqrst a1b2") == []
    assert S.candidates("pw=" + "aB3" * 8 + "==") == [(3, 29)]
    assert S.candidates("") == [] and S.candidates("." * 30 + "a1") == []


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    f = S.Findings.of([("key=", "a1b2c3d4e5f6g7h8", " x"), ("", "0123456789abcdef", ""), ("é", "W-2024-release.txt", "\n\n")])
    label, p = np.array([1, 0, 0]), S._parameters(rng)
    _, g = S.gradient(p, f, label)
    for name, x in p.items():
        for at in {tuple(rng.integers(n) for n in x.shape) for _ in range(12)} | {np.unravel_index(np.abs(g[name]).argmax(), x.shape)}:
            moved = {k: v.copy() for k, v in p.items()}
            losses = []
            for e in (1e-6, -1e-6):
                moved[name][at] = x[at] + e
                losses.append(S.gradient(moved, f, label)[0])
            assert (losses[0] - losses[1]) / 2e-6 == pytest.approx(g[name][at], abs=1e-6)


def plain_logit(p, left, value, right):
    """One candidate, one position and filter at a time."""
    code = [S._PAD] * 2 + [min(ord(c), 128) for c in left + value + right] + [S._PAD] * 2
    kind = [0] * (2 + len(left)) + [1] * len(value) + [2] * (len(right) + 2)
    h = []
    for i in range(len(code)):
        z = p["segment"][kind[i]].copy()
        for j in range(-2, 3):
            c = code[i + j] if 0 <= i + j < len(code) else S._PAD
            z += p["embedding"][c] @ p["kernel"][(j + 2) * S.EMBEDDING:(j + 3) * S.EMBEDDING]
        h.append(np.maximum(z, 0))
    h, kind = np.array(h), np.array(kind)
    features = np.concatenate([h[kind == k].max(axis=0) for k in range(3)] + [h[kind == 1].mean(axis=0),
                                                                               [np.log(len(value) / 32)]])
    return features @ p["unit"] + p["bias"][0]


@pytest.mark.parametrize("stretch", [1, 3, 50, 1 << 16])
def test_network_against_plain_loops(scanner, stretch):
    p = dict(scanner.parameters)
    parts = [(f[0], f[1], f[2]) for f in S.made_findings(4, seed=5)] + [("", "é" * 16, ""), ("x" * 24, "a1" * 200, "y")]
    assert np.allclose(S.logits(p, S.Findings.of(parts), stretch), [plain_logit(p, *x) for x in parts])
    assert len(S.logits(p, S.Findings.of([]))) == 0


def test_thresholds_keep_the_recall():
    rng = np.random.default_rng(3)
    label = rng.integers(0, 2, 5000)
    score = rng.normal(2 * label, 1.0)
    for recall in (0.8, 0.95, 0.99, 1.0):
        t = S.threshold(score, label, recall)
        assert (score[label == 1] >= t).mean() >= recall
        assert (score[label == 1] >= t + 0.05).mean() < recall + 0.01  # hardly higher than needed
    assert S.threshold(np.array([1.0]), np.array([0])) is None
    a, b = S.platt(score, label)
    q = 1 / (1 + np.exp(-(a * score + b)))
    for lo in (0.1, 0.4, 0.7):
        mine = (q > lo) & (q < lo + 0.2)
        assert label[mine].mean() == pytest.approx(q[mine].mean(), abs=0.06)


def test_held_out_findings(scanner):
    assert scanner.report["held_out"] > 400
    assert scanner.report["recall"] >= 0.98 and scanner.report["false_flags"] <= 0.02
    fresh = S.made_findings(500, seed=77)
    got, label = scanner.accepted([f[:3] for f in fresh], scanner.log_odds([f[:3] for f in fresh])), np.array([f[3] for f in fresh])
    assert got[label == 1].mean() >= 0.98 and got[label == 0].mean() <= 0.02


def plain_spans(text, scanner):
    base = plain_base(text or "")
    spans = list(base)
    for a, b in S.candidates(text or ""):
        part = S._surrounded(text, a, b)
        if not all(any(i <= x < j for _, i, j in base) for x in range(a, b)) and scanner.accepted([part], scanner.log_odds([part]))[0]:
            spans.append(("model", a, b))
    return base, sorted(spans, key=lambda f: (f[1], S.KINDS.index(f[0])))


TEXTS = ["", None, "no secrets here", "token = 9c8b45435718dcc700c184a7e303cdc64c6a8f7f end",
         "the key is ghp_a8Kd02jf83Kdl29dkfj38dkf93kdE83kdl2S ok", "password: short", "é" * 50 + " secret=abcdef",
         "mail to x@mail7.example.com or www.page-12.org", "AKIA" + "Z9" * 9 + " " + "0af" * 12, "x" * 300_000 + " Zx81kQ" * 3,
         "blob " + "aB3/" * 60_000 + " end", "token = 9c8b45435718dcc700c184a7e303cdc64c6a8f7f end"]


def test_scan_of_odd_rows(spark, scanner, docs_of):
    df = docs_of([*TEXTS, (3, "hex " + "0f" * 12, None, None, 1), (None, "token=abcdefgh", None, None, 1)])
    for c in ("findings", "redacted", "kind", "start", "end", "left", "value", "right", "label", "m"):
        df = df.withColumn(c, F.lit("clash"))
    got = S.find(df, scanner, redact=True).collect()
    rows = df.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r, g in zip(rows, got):
        _, spans = plain_spans(r.text, scanner)
        assert g.id == r.doc_id and [(f.kind, f.start, f.end) for f in g.findings] == spans
        assert (g.redacted == r.text) == (not spans)
    assert any(f.kind == "model" for f in got[4].findings) and got[4].redacted == "the key is [secret] ok"
    assert not got[7].findings
    model = S.fit(df)
    assert model.report["recall"] > 0.95
    assert S.find(docs_of([]), scanner).count() == 0
    assert S.fit(docs_of([])).report["recall"] > 0.95


def test_query_on_whole_table(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    scanner = S.fit(docs)
    got = {r.doc_id: r for r in QUERIES["op12_secret_scan"](spark, d).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        base, spans = plain_spans(r.text, scanner)
        g = got[r.doc_id]
        assert (g.n_assign, g.n_access, g.n_hex) == tuple(sum(f[0] == k for f in base) for k in S.KINDS[:3])
        joined = [",".join(f"{k}:{a}:{b}" for k, a, b in x) for x in (base, spans)]
        assert g.base_sha256 == hashlib.sha256(joined[0].encode()).hexdigest() and g.spans == joined[1]
    assert sum(g.n_assign for g in got.values())
