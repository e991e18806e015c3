"""Toxicity by a weighted finite-state pattern grammar.

Five weighted transducers read the words of a clause, each the output of the
one before; each rewrites the words it knows and passes on all others. Their
composition is one machine, whose arcs are made as they are first reached:

* insult: an entry of a lexicon of words and word stems, learned from labelled
  texts, is written as an insult, by the entry's weight; more after a word of
  emphasis;
* threat: a threat word, or a fixed phrase of several words, is written as a
  threat, by its weight;
* negation: an insult or threat up to ``SCOPE`` words after a negation is
  written as a negated one;
* reported speech: after a reporting word (to the end of the clause) or an
  opening quote (to the closing one) it is written as a reported one;
* target: weighs what is left by its reading (plain, negated or reported;
  insult or threat) and by whether the clause names a target. As that may come
  later, the machine starts with either guess; the path whose guess holds is
  accepted.

The weight of an arc of the composition is the product of the arcs it is made
of, and a text's score comes from the sum over its clauses' paths, of which one
reading counts up to ``CAP`` units. The readings' weights and the bias are a
logistic regression on the labelled texts, so the score is the chance of label 1
given all matched clauses. Clauses without a hit are not read word by word.

Fitting uses at most about ``MAX_LABELLED`` labelled texts, the same ones every
time (those with the least hash of the id); lexicon counts come from a grouped
aggregation, and ``LEXICON`` entries at most go to the driver. Scoring reads
every text as a whole and shuffles nothing.

Edge cases: null text counts as empty, and a text without hits has the score
of the bias alone; labels that are null are ignored, of several labels of an
id the greatest holds; without labels (or without labels of both kinds)
the lexicon is empty and the readings keep their fixed weights; an empty table
gives an empty result. Very long texts are read clause by clause, as a whole.
Other columns play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_LABELLED = 20_000
LEXICON = 5_000
#: A word or stem enters the lexicon if this share of the texts with it is
#: toxic, and if that is as unlikely by chance as this G statistic says.
PRECISION, EVIDENCE = 0.8, 20.0
STEMS = range(3, 9)
SCOPE = 4
#: An insult counts so much more after a word of emphasis.
EMPHASIS = 1.25
#: Weight of a fixed threat word or phrase.
THREAT_WEIGHT = 3.0
#: More weight than this in one reading says no more.
CAP = 20.0

INSULT, THREAT, TARGET, NEGATION, REPORT, STRONG, OPEN, CLOSE = "ITYNRS“”"
#: Readings that the composed machine writes: of insults, then of threats.
READINGS = ("I", "i", "r", "T", "t", "q")
_PRIOR = dict(zip(READINGS, (1.0, 0.2, 0.3, 1.0, 0.2, 0.3)))

# Small word lists of the four languages (function words and common verbs).
WORDS = {
    THREAT: "kill hurt destroy murder töten umbringen verletzen tuer blesser frapper matar herir golpear",
    TARGET: "you your yours he she they them him her du dich dir ihr euch tu toi vous ils elles usted vosotros ellos",
    NEGATION: "not never no nor without nicht nie kein keine ohne ne pas jamais sans nunca sin",
    REPORT: "said says say told called calls wrote writes quoted claimed sagte sagt nannte schrieb dit écrit disait "
            "appelé dijo dice llamó escribió",
    STRONG: "utter complete total absolute totaler völliger kompletter parfait sacré completo maldito",
    OPEN: "“ „ «",
    CLOSE: "” » “",
}
PHRASES = ("watch your back", "make you pay", "you will regret this", "pass bloß auf", "tu vas le payer",
           "te vas a arrepentir")
_KNOWN = {w for ws in WORDS.values() for w in ws.split()} | {w for ph in PHRASES for w in ph.split()}
_END = re.compile(r"[.!?;,:\n()]")
_TOKEN = re.compile(r"\w+|[“”„«»]")
_OPENING = re.compile(r"\"(?=\w)")


# ---------------------------------------------------------- transducers
class Transducer:
    """Deterministic and weighted: (state, word in) -> (word out, weight, next
    state). A word without an arc is passed on by weight 1, to the state that
    ``otherwise`` gives (else the same)."""

    def __init__(self):
        self.arcs: dict = {}
        self.otherwise: dict = {}

    def step(self, state, word):
        return self.arcs.get((state, word)) or (word, 1.0, self.otherwise.get(state, state))

    def compose(self, other):
        return Composed(self, other)


class Composed(Transducer):
    """What ``second`` makes of the output of ``first``: states are pairs,
    weights multiply, and arcs are kept once they have been reached."""

    def __init__(self, first: Transducer, second: Transducer):
        super().__init__()
        self.first, self.second = first, second

    def step(self, state, word):
        arc = self.arcs.get((state, word))
        if arc is None:
            mid, u, a = self.first.step(state[0], word)
            out, v, b = self.second.step(state[1], mid)
            arc = self.arcs[state, word] = out, u * v, (a, b)
        return arc


def insult(entries: dict) -> Transducer:
    t = Transducer()
    for strong in (0, 1):
        for e, w in entries.items():
            t.arcs[strong, e] = INSULT, w * (EMPHASIS if strong else 1.0), 0
        for w in WORDS[STRONG].split():
            t.arcs[strong, w] = "", 1.0, 1
    t.otherwise[1] = 0
    return t


def threat(words: dict, phrases=PHRASES) -> Transducer:
    """States are the beginnings of phrases that the last words make."""
    t, whole = Transducer(), {tuple(p.split()) for p in phrases}
    begun = {p[:n] for p in whole for n in range(len(p))}
    for state in begun | {()}:
        for w in {w for p in whole for w in p}:
            ends = [(*state, w)[k:] for k in range(len(state) + 1)]
            if any(e in whole for e in ends):
                t.arcs[state, w] = THREAT, THREAT_WEIGHT, ()
            else:
                t.arcs[state, w] = w, 1.0, next((e for e in ends if e in begun), ())
        for w, weight in words.items():
            t.arcs[state, w] = THREAT, weight, ()
        t.otherwise[state] = ()
    return t


def negation(scope: int = SCOPE) -> Transducer:
    t = Transducer()
    for left in range(scope + 1):  # words that a negation still reaches
        t.otherwise[left] = max(left - 1, 0)
        if left:
            t.arcs[left, INSULT], t.arcs[left, THREAT] = ("i", 1.0, left - 1), ("t", 1.0, left - 1)
        for w in WORDS[NEGATION].split():
            t.arcs[left, w] = "", 1.0, scope
    return t


def reported() -> Transducer:
    t = Transducer()
    for said in (0, 1, 2):  # not, after a reporting word, inside quotes
        for w in WORDS[REPORT].split():
            t.arcs[said, w] = "", 1.0, max(said, 1)
        for w in (WORDS[CLOSE] if said == 2 else WORDS[OPEN]).split():
            t.arcs[said, w] = "", 1.0, 0 if said == 2 else 2
        if said:
            for w, out in (("I", "r"), ("i", "r"), ("T", "q"), ("t", "q")):
                t.arcs[said, w] = out, 1.0, said
    return t


def target(weights: np.ndarray) -> Transducer:
    """States (guess, named); a path holds if it ends with both equal."""
    t = Transducer()
    for guess in (0, 1):
        for named in (0, 1):
            for w in WORDS[TARGET].split():
                t.arcs[(guess, named), w] = "", 1.0, (guess, 1)
            for k, r in enumerate(READINGS):
                t.arcs[(guess, named), r] = r, float(weights[2 * k + guess]), (guess, named)
    return t


def read(machine: Composed, words: list) -> tuple[int, list]:
    """(whether a target is named, [(reading, weight)]) of a clause: the path
    whose guess holds."""
    for guess in (0, 1):
        state, said = (((((0, ()), 0), 0)), (guess, 0)), []
        for w in words:
            out, weight, state = machine.step(state, w)
            if out in READINGS:
                said.append((out, weight))
        if state[1] == (guess, guess):
            break
    return guess, said


# ---------------------------------------------------------------- model
@dataclass
class Model:
    stems: dict  # beginning of a word -> weight
    words: dict  # whole word -> weight
    threats: dict
    weights: np.ndarray  # by reading, without and with a target
    bias: float


class Matcher:
    """Finds the clauses of a text that hold a hit and reads them by the
    grammar with these weights of the readings (default: the model's)."""

    def __init__(self, model: Model, weights: np.ndarray | None = None):
        import ahocorasick
        self.model = model
        self.weights = model.weights if weights is None else weights
        self.entries = {**{(w, True): x for w, x in model.words.items()}, **{(s, False): x for s, x in model.stems.items()}}
        self.machine = insult(self.entries).compose(threat(model.threats)).compose(negation()).compose(
            reported()).compose(target(self.weights))
        self.find = ahocorasick.Automaton()
        for e in {*model.stems, *model.words, *model.threats, *(PHRASES if model.threats else ())}:
            self.find.add_word(e, (len(e), e not in model.stems))  # a stem, even if it is a word too
        if len(self.find):
            self.find.make_automaton()
        self.sizes = sorted({len(s) for s in model.stems})

    def _symbol(self, word: str):
        """What the machine reads for a word: itself if it is a threat, else
        its heaviest lexicon entry, else itself if any transducer knows it."""
        if word in self.model.threats:
            return word
        found = [e for e in ((word, True), *((word[:n], False) for n in self.sizes if n <= len(word)))
                 if e in self.entries]
        return max(found, key=self.entries.get) if found else word if word in _KNOWN else ""

    def features(self, text: str | None) -> np.ndarray:
        """Sum of the paths' weights by reading, without and with a target;
        the last is the number of matched clauses."""
        out = np.zeros(2 * len(READINGS) + 1)
        if not text or not len(self.find):
            return out
        low, done = text.lower(), -1
        for end, (size, whole) in self.find.iter(low):
            at = end + 1 - size
            if at < done or at and _is_word(low[at - 1]) or whole and end + 1 < len(low) and _is_word(low[end + 1]):
                continue
            start = max(low.rfind(c, max(done, 0), at) for c in ".!?;,:\n()") + 1
            start = max(start, done, 0)
            stop = _END.search(low, end + 1)
            done = stop.start() if stop else len(low)
            clause = _OPENING.sub(OPEN, low[start:done]).replace('"', CLOSE)
            named, said = read(self.machine, [self._symbol(w) for w in _TOKEN.findall(clause)])
            for reading, weight in said:
                out[2 * READINGS.index(reading) + named] += weight
            out[-1] += bool(said)
        return out

    def score(self, features: np.ndarray) -> float:
        x = self.model.bias + float(np.minimum(features[:-1], CAP * self.weights).sum())
        return 1 / (1 + np.exp(-min(max(x, -30.0), 30.0)))


def _is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def _sample(labels: DataFrame, id_col: str, label_col: str, most: int) -> DataFrame:
    """(id, label): about ``most`` labelled ids at most, by the least hash."""
    known = labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull()).groupBy(
        F.col(f"`{id_col}`").alias("l_id")).agg(F.max(F.col(f"`{label_col}`").cast("int")).alias("label"))
    n = known.count()
    share = min(1.0, most / max(n, 1))
    return known if share == 1 else known.where(F.pmod(F.xxhash64("l_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def _lexicon_counts(texts: DataFrame) -> DataFrame:
    """(entry, whole, toxic, clean): texts with a word, or with a word that
    begins so, by label."""
    def run(batches):
        counts: Counter = Counter()
        for b in batches:
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = set(re.findall(r"\w{3,40}", (text or "").lower()))
                found = {(w, True) for w in words} | {(w[:n], False) for w in words for n in STEMS if n <= len(w)}
                for f in found:
                    counts[f, label] += 1
                if len(counts) > 200_000:
                    yield made(counts)
                    counts.clear()
        if counts:
            yield made(counts)

    def made(counts):
        keys = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0][0] for k in keys]), pa.array([k[0][1] for k in keys]),
             pa.array([counts[k] if k[1] else 0 for k in keys], pa.int64()),
             pa.array([0 if k[1] else counts[k] for k in keys], pa.int64())],
            names=["entry", "whole", "toxic", "clean"])

    rows = texts.mapInArrow(run, "entry string, whole boolean, toxic bigint, clean bigint")
    return rows.groupBy("entry", "whole").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", most: int = MAX_LABELLED) -> Model:
    """Learn the lexicon and the weights of the readings from the texts of
    ``docs`` that ``labels`` (id, label) covers."""
    sample = _sample(labels, id_col, label_col, most)
    # bounded by ``most``, whatever the size of the tables
    texts = docs.join(F.broadcast(sample), F.col(f"`{id_col}`") == F.col("l_id")).select(
        F.col(f"`{text_col}`").alias("text"), "label")
    size = {r.label: r.n for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sum(n for k, n in size.items() if k), size.get(0, 0)
    empty = Model({}, {}, {w: THREAT_WEIGHT for w in WORDS[THREAT].split()},
                  np.repeat([_PRIOR[r] for r in READINGS], 2) * np.tile([1.0, 1.5], len(READINGS)),
                  float(np.log((toxic + 0.5) / (clean + 0.5))) if toxic + clean else -3.0)
    if not toxic or not clean:
        return empty
    rate = toxic / (toxic + clean)
    t, c = F.col("toxic"), F.col("clean")

    def part(x, n):
        return F.when(x > 0, x * F.log(x / (n * (t + c)))).otherwise(0.0)
    likely = 2 * (part(t, rate) + part(c, 1 - rate))
    weight = F.log((t + 0.1) / (c + 0.1)) - float(np.log(rate / (1 - rate)))
    rows = _lexicon_counts(texts).where((t >= PRECISION * (t + c)) & (likely >= EVIDENCE)).orderBy(
        likely.desc(), "entry", "whole").limit(LEXICON).select("entry", "whole", weight.alias("w")).collect()
    stems: dict = {}
    for r in sorted((r for r in rows if not r.whole), key=lambda r: len(r.entry)):
        if r.w > _shorter(stems, r.entry) + 1:  # else a shorter stem says it
            stems[r.entry] = r.w
    words = {r.entry: r.w for r in rows if r.whole and r.w > _shorter(stems, r.entry) + 1}
    model = Model(stems, words, empty.threats, empty.weights, empty.bias)
    x, y = _training_rows(texts, model)
    model.bias, model.weights = _regression(x, y, empty.weights / 2, float(np.log(rate / (1 - rate))) - 2)
    return model


def _shorter(stems: dict, entry: str) -> float:
    return max((stems[entry[:n]] for n in STEMS if entry[:n] in stems), default=-1.0)


def _training_rows(texts: DataFrame, model: Model):
    def run(batches):
        m = Matcher(model, np.ones(2 * len(READINGS)))
        for b in batches:
            rows = [m.features(t)[:-1].tolist() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), b.column(1)],
                                             names=["x", "y"])

    # texts with the same features and label are one row
    rows = texts.mapInArrow(run, "x array<double>, y int").groupBy("x", "y").agg(F.count("*").alias("n")).collect()
    x = np.minimum(np.array([r.x for r in rows]), CAP)
    return x, np.array([(r.y, r.n) for r in rows], float)


def _regression(x, yn, prior, bias, strength: float = 1.0):
    """Weighted logistic regression, pulled to ``prior``; Newton steps."""
    y, n = yn[:, 0], yn[:, 1]
    a = np.hstack([np.ones((len(x), 1)), x])
    w0 = np.concatenate(([bias], prior))
    pull = np.full(len(w0), strength)
    pull[0] = 1e-3
    w = w0.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (n * (p - y)) + pull * (w - w0)
        h = (a * (n * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ a + np.diag(pull)
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 2 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), np.maximum(w[1:], 0.0)


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with columns ``score`` (0 to 1) and ``matched`` (clauses with a
    hit); columns of those names are replaced."""
    keep = [c for c in df.columns if c.lower() not in ("score", "matched")]
    slim = df.select(F.col(f"`{text_col}`").alias("t"), F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in
                                                                  enumerate(keep) if c != text_col],
                                                                 F.lit(0).alias("none")).alias("row"))
    out = T.StructType([*slim.schema.fields, T.StructField("score", T.DoubleType()),
                        T.StructField("matched", T.LongType())])

    def run(batches):
        m = Matcher(model)
        for b in batches:
            f = [m.features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([m.score(x) for x in f], pa.float64()),
                 pa.array([int(x[-1]) for x in f], pa.int64())], names=["t", "row", "score", "matched"])

    done = slim.mapInArrow(run, out)
    return done.select(*[F.col("t").alias(c) if c == text_col else F.col(f"row.c{i}").alias(c)
                         for i, c in enumerate(keep)], "score", "matched")
