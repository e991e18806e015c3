"""Secret scans: base patterns, and a character convolutional network over
every candidate with its context.

Base findings are the matches of ``BASE``, per kind, leftmost and not
overlapping; they always stay. A candidate is a longest run of
``CANDIDATE``'s characters, without full stops at its ends, of ``LEAST``
characters or more with a letter and a digit. The network scores each one: its
characters and ``LEFT`` and ``RIGHT`` characters around it are embedded,
convolved (width 5), and pooled: the largest value of each filter left of it,
in it and right of it, and the mean in it; a logistic unit on these and on the
length gives the score. A candidate over the threshold of its make-up that
isn't inside base findings is a finding of kind ``model``.

Labelled findings to train on: candidates of at most ``SAMPLE`` documents
(least hashes of the text), ``LABELLED`` distinct ones of each label at most,
of 512 characters at most, labelled by whether a base finding covers them; and
``MADE`` made ones of each label: strings in the public formats of credentials,
and file names, hosts, versions, dates, phone and order numbers, both partly in
neutral surroundings so that the network can't go by these alone. They are
split by value: to train on, to calibrate, and held out. Scores are calibrated
by Platt's method. The threshold of a make-up (hexadecimal, letters and digits,
with other signs) keeps ``RECALL`` of its calibration secrets and is as high as
that allows, halfway (in log odds) to the highest harmless one below it.

What bounds memory: the labelled sample on the driver; in a task an Arrow batch
of texts, and ``STRETCH`` characters at a time of the network's values, however
long a candidate is. The network is a few thousand numbers.

Null and empty texts have no findings; repeated rows are scanned each; ids may
be null or repeated; an empty table gives an empty result (and a model of made
findings only). Only the id and the text are read, so other columns may have any
names. Positions are code points, end exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kind, pattern, group whose length counts, least length.
BASE = (
    ("assign", re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
#: Texts without a match of these have none of the above (for whole batches at once).
_MAYBE = {"assign": "(?i)passw|secret|token|api_?key", "access": "AKIA", "hex": "[0-9a-f]{24}"}
KINDS = ("assign", "access", "hex", "model")

LEAST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.-]{16,}={0,2}")
_MAYBE_CANDIDATE = "[A-Za-z0-9+/_.-]{16}"
LEFT, RIGHT = 24, 8
SAMPLE, LABELLED, MADE, LONGEST = 20_000, 1_000, 1_500, 512
RECALL = 0.99
STRETCH = 1 << 16
WIDTH, EMBEDDING, FILTERS = 5, 8, 16
_OTHER, _PAD, SYMBOLS = 128, 129, 130
MAKE_UPS = ("hexadecimal", "alphanumeric", "signs")


# ------------------------------------------------------------- candidates
def base_findings(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start, then kind."""
    out = []
    for kind, pattern, group, least in BASE:
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(out, key=lambda f: (f[1], KINDS.index(f[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        run = m.group()
        a, b = m.start() + len(run) - len(run.lstrip(".")), m.end() - len(run) + len(run.rstrip("."))
        if b - a >= LEAST and re.search("[0-9]", run) and re.search("[A-Za-z]", run):
            out.append((a, b))
    return out


def make_up(value: str) -> int:
    """Index into ``MAKE_UPS``."""
    return 0 if re.fullmatch("[0-9a-fA-F]+", value) else 1 if value.isalnum() else 2


@dataclass
class Findings:
    """Candidates with their surroundings as one array of symbols; three
    segments each: left, candidate, right (padding keeps them from being empty
    and from each other)."""
    symbols: np.ndarray
    start: np.ndarray  # of the segments, and the end
    length: np.ndarray  # of the candidates

    @classmethod
    def of(cls, parts: list[tuple[str, str, str]]) -> Findings:
        pad = np.full(WIDTH // 2, _PAD, np.uint8)
        pieces, size = [], []
        for left, value, right in parts:
            code = np.minimum(np.frombuffer((left + value + right).encode("utf-32-le", "replace"), "<u4"),
                              _OTHER).astype(np.uint8)
            pieces += [pad, code, pad]
            size += [len(left) + len(pad), len(value), len(right) + len(pad)]
        start = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        return cls(np.concatenate(pieces) if pieces else np.empty(0, np.uint8), start,
                   np.array([len(v) for _, v, _ in parts], np.int64))

    def __len__(self) -> int:
        return len(self.length)


# ---------------------------------------------------------------- network
def _parameters(rng) -> dict[str, np.ndarray]:
    return {"embedding": rng.normal(0, 0.5, (SYMBOLS, EMBEDDING)),
            "kernel": rng.normal(0, (WIDTH * EMBEDDING) ** -0.5, (WIDTH * EMBEDDING, FILTERS)),
            "segment": np.zeros((3, FILTERS)), "unit": rng.normal(0, 0.1, 4 * FILTERS + 1), "bias": np.zeros(1)}


def _padded(symbols: np.ndarray) -> np.ndarray:
    """With what a window at either end reaches: as if another candidate's padding stood there."""
    return np.pad(symbols, WIDTH // 2, constant_values=_PAD)


def _windows(x: np.ndarray) -> np.ndarray:
    """Rows of WIDTH neighbours, for all but the padding at the ends."""
    n = len(x) - WIDTH + 1
    return np.hstack([x[i:i + n] for i in range(WIDTH)])


def _pooled(largest: np.ndarray, total: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Features from each segment's largest values and the candidates' sums."""
    each = largest.reshape(-1, 3 * FILTERS)
    return np.hstack((each, total / length[:, None], np.log(length / 32)[:, None]))


def logits(p: dict[str, np.ndarray], f: Findings, stretch: int = STRETCH) -> np.ndarray:
    """The network's log odds; ``stretch`` positions at a time."""
    n, symbols = len(f), _padded(f.symbols)
    largest, total = np.zeros((3 * n, FILTERS)), np.zeros((n, FILTERS))
    for a in range(0, len(f.symbols), stretch):
        b = min(a + stretch, len(f.symbols))
        z = _windows(p["embedding"][symbols[a:b + WIDTH - 1]]) @ p["kernel"]
        first = int(np.searchsorted(f.start, a, "right")) - 1
        last = int(np.searchsorted(f.start, b, "left"))
        segments = np.arange(first, last)
        cut = np.maximum(f.start[segments], a) - a
        h = np.maximum(z + np.repeat(p["segment"][segments % 3], np.diff([*cut, b - a]), axis=0), 0)
        largest[segments] = np.maximum(largest[segments], np.maximum.reduceat(h, cut, axis=0))
        inner = segments % 3 == 1
        total[segments[inner] // 3] += np.add.reduceat(h, cut, axis=0)[inner]
    return _pooled(largest, total, f.length) @ p["unit"] + p["bias"] if n else np.zeros(0)


def gradient(p: dict[str, np.ndarray], f: Findings, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean log loss of a batch and its gradient."""
    symbols = _padded(f.symbols)
    windows = _windows(p["embedding"][symbols])
    size = np.diff(f.start)
    kind = np.repeat(np.arange(len(size)) % 3, size)
    place = np.repeat(np.arange(len(size)), size)
    z = windows @ p["kernel"] + p["segment"][kind]
    h = np.maximum(z, 0)
    largest = np.maximum.reduceat(h, f.start[:-1], axis=0)
    total = np.add.reduceat(h, f.start[:-1], axis=0)[1::3]
    features = _pooled(largest, total, f.length)
    s = features @ p["unit"] + p["bias"]
    loss = float(np.mean(np.logaddexp(0, s) - label * s))
    d = (1 / (1 + np.exp(-s)) - label) / len(label)
    back = np.outer(d, p["unit"])
    d_largest = back[:, :3 * FILTERS].reshape(-1, FILTERS)
    d_mean = back[:, 3 * FILTERS:4 * FILTERS] / f.length[:, None]
    dh = np.where(h == largest[place], d_largest[place], 0)
    inner = kind == 1
    dh[inner] += d_mean[place[inner] // 3]
    dz = np.where(z > 0, dh, 0)
    d_windows = dz @ p["kernel"].T
    dx = np.zeros((len(symbols), EMBEDDING))
    for i in range(WIDTH):
        dx[i:i + len(z)] += d_windows[:, i * EMBEDDING:(i + 1) * EMBEDDING]
    d_embedding = np.zeros_like(p["embedding"])
    np.add.at(d_embedding, symbols, dx)
    d_segment = np.zeros_like(p["segment"])
    np.add.at(d_segment, kind, dz)
    return loss, {"embedding": d_embedding, "kernel": windows.T @ dz, "segment": d_segment,
                  "unit": features.T @ d, "bias": np.array([d.sum()])}


def train(parts: list[tuple[str, str, str]], label: np.ndarray, epochs: int = 10, batch: int = 128,
          seed: int = 0) -> dict[str, np.ndarray]:
    """Adam on shuffled batches."""
    rng = np.random.default_rng(seed)
    p = _parameters(rng)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(parts))
        rate = 0.01 * (1 - epoch / epochs)
        for a in range(0, len(order), batch):
            some = order[a:a + batch]
            _, g = gradient(p, Findings.of([parts[i] for i in some]), label[some])
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return p


# ------------------------------------------------------- labelled findings
_LOW, _UP, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ALNUM = _LOW + _UP + _DIGITS
#: Public formats of credentials, as pieces of text and (alphabet, least, most).
CREDENTIALS = (
    ("ghp_", (_ALNUM, 36, 36)), ("xoxb-", (_DIGITS, 10, 12), "-", (_ALNUM, 24, 24)), ("sk_live_", (_ALNUM, 24, 32)),
    ("AKIA", (_UP + _DIGITS, 16, 16)), ("AIza", (_ALNUM + "-_", 35, 35)), ("glpat-", (_ALNUM + "-_", 20, 20)),
    ("eyJ", (_ALNUM, 17, 30), ".", (_ALNUM + "-_", 30, 60), ".", (_ALNUM + "-_", 27, 43)),
    ((_DIGITS + "abcdef", 24, 64),), ((_DIGITS + "ABCDEF", 24, 64),), ((_ALNUM + "+/", 38, 64), "="),
    ((_ALNUM + "+/", 40, 40),), ((_ALNUM, 20, 48),), ((_UP + _DIGITS, 20, 32),), ((_LOW + _DIGITS, 20, 40),),
)
#: Forms of harmless strings; w a word, d a number, y a date.
HARMLESS = ("w-w-w-d.w", "w_w_w_d", "ww.w.example.com/w/w-d.html", "wd.example.com", "www.w-w.org/w/d", "y_w_w.tar.gz",
            "yTd-d-d_w", "w-d.d.d-w.d", "w/w/w/w_d.py", "W-y-d-W", "img_y_d.jpeg", "wwwd.w.wwd", "W_W_W_d", "+d-d-d-wd",
            "isbn-d-d-d-d-w", "w.w.w.wd", "wd.w.example.org", "w-w-w-w-w-d", "WwWwWwd", "section-d.d.d-w",
            "w+w+w+w/d.d", "d-w-d-w-d-w", "wwwwwd")
SURROUNDINGS = {1: ('key = "', "auth: ", "Authorization: Bearer ", "export AWS_KEY=", "credential '", "pwd=", "login with "),
                0: ("see ", "file ", "http://", "mail to a.b@", "the release ", "version ", "page ")}


def made_findings(n: int, seed: int = 0) -> list[tuple[str, str, str, int]]:
    """(left, value, right, label): ``n`` of each label."""
    rng = np.random.default_rng(seed)

    def pick(xs):
        return xs[rng.integers(len(xs))]

    def drawn(alphabet, least, most):
        return "".join(alphabet[i] for i in rng.integers(len(alphabet), size=rng.integers(least, most + 1)))

    def word():
        return "".join(pick("bcdfghklmnprstvw") + pick("aeiou") for _ in range(rng.integers(1, 4))) + pick(("", "n", "r", "s"))

    def harmless():
        out = ""
        for c in pick(HARMLESS):
            out += (word() if c == "w" else word().capitalize() if c == "W" else str(rng.integers(10 ** rng.integers(1, 7)))
                    if c == "d" else f"20{rng.integers(10, 40)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}" if c == "y" else c)
        return out

    out = []
    for label in (0, 1):
        while sum(x[3] == label for x in out[-2 * n:]) < n:
            value = harmless() if not label else "".join(
                x if isinstance(x, str) else drawn(*x) for x in pick(CREDENTIALS))
            if candidates(f" {value} ") != [(1, 1 + len(value))]:
                continue
            left = " ".join(word() for _ in range(6)) + " "
            if rng.random() < 0.5:
                left += pick(SURROUNDINGS[label])
            right = pick((" ", ", ", ".\n", '" ', "' ")) + word() + " " + word()
            out.append((left[-LEFT:], value, right[:RIGHT], label))
    return out


def _surrounded(text: str, a: int, b: int) -> tuple[str, str, str]:
    return text[max(a - LEFT, 0):a], text[a:b], text[b:b + RIGHT]


def _inside(a: int, b: int, spans: list[tuple[str, int, int]]) -> bool:
    """Whether a..b is covered by the spans, sorted by start."""
    for _, i, j in spans:
        if i > a:
            return False
        a = max(a, j)
        if a >= b:
            return True
    return False


def corpus_findings(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE,
                    labelled: int = LABELLED) -> list[tuple[str, str, str, int]]:
    """Candidates of a sample of the texts, labelled by the base patterns."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    share = min(1.0, sample / max(texts.count(), 1))
    texts = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def run(batches):
        for b in batches:
            out = [], [], [], []
            col = b.column(0)
            for i in np.flatnonzero(pc.match_substring_regex(col, _MAYBE_CANDIDATE).fill_null(False)):
                text = col[i].as_py()
                known = base_findings(text)
                for x, y in candidates(text):
                    if y - x <= LONGEST:
                        for c, v in zip(out, (*_surrounded(text, x, y), int(_inside(x, y, known)))):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [pa.string()] * 3 + [pa.int32()])],
                                             names=["left", "value", "right", "label"])

    found = texts.mapInArrow(run, "left string, value string, right string, label int")
    found = found.groupBy("value").agg(F.min(F.struct("left", "right", "label")).alias("m"))
    found = found.select("m.left", "value", "m.right", "m.label")
    out = []
    for label in (0, 1):
        out += [tuple(r) for r in found.where(F.col("label") == label).orderBy(
            F.xxhash64("value"), "value").limit(labelled).collect()]
    return out


# ------------------------------------------------------------ calibration
def platt(s: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(a, b) of sigmoid(a s + b), by Newton steps on Platt's smoothed targets."""
    up, down = (label == 1).sum(), (label == 0).sum()
    target = np.where(label == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x, w = np.column_stack((s, np.ones(len(s)))), np.array([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (q - target)
        step = np.linalg.solve((x.T * (q * (1 - q))) @ x + 1e-6 * np.eye(2), g)
        w = w - step / max(1, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def threshold(score: np.ndarray, label: np.ndarray, recall: float = RECALL) -> float | None:
    """Log odds that keep ``recall`` of the secrets, as high as that allows:
    halfway from the least one kept to the highest harmless one below it."""
    secrets = np.sort(score[label == 1])
    if not len(secrets):
        return None
    least = secrets[int((1 - recall) * len(secrets) + 1e-9)]
    below = score[(label == 0) & (score < least)]
    return float((least + max(below.max(), least - 6)) / 2) if len(below) else float(least - 3)


@dataclass
class Scanner:
    parameters: dict[str, np.ndarray]
    calibration: tuple[float, float]
    thresholds: tuple[float, ...]  # log odds, by make-up
    report: dict[str, float] = field(default_factory=dict)

    def log_odds(self, parts: list[tuple[str, str, str]]) -> np.ndarray:
        a, b = self.calibration
        return a * logits(self.parameters, Findings.of(parts)) + b

    def accepted(self, parts: list[tuple[str, str, str]], odds: np.ndarray) -> np.ndarray:
        return odds >= np.array(self.thresholds)[[make_up(v) for _, v, _ in parts]] if parts else np.zeros(0, bool)


def fitted(findings: list[tuple[str, str, str, int]], recall: float = RECALL, seed: int = 0) -> Scanner:
    """Train, calibrate and measure on labelled findings, split by value."""
    import hashlib
    part = np.array([int(hashlib.sha256(f[1].encode()).hexdigest()[:8], 16) % 10 for f in findings])
    label = np.array([f[3] for f in findings])
    parts = [f[:3] for f in findings]

    def some(which):
        at = np.flatnonzero(which)
        return [parts[i] for i in at], label[at]
    p = train(*some(part < 6), seed=seed)
    check, check_label = some((part >= 6) & (part < 8))
    s = logits(p, Findings.of(check))
    scanner = Scanner(p, platt(s, check_label), ())
    odds = scanner.log_odds(check)
    kind = np.array([make_up(v) for _, v, _ in check])
    whole = threshold(odds, check_label, recall)
    each = [threshold(odds[kind == k], check_label[kind == k], recall) for k in range(len(MAKE_UPS))]
    scanner.thresholds = tuple(whole if t is None else t for t in each)
    held, held_label = some(part >= 8)
    got = scanner.accepted(held, scanner.log_odds(held))
    scanner.report = {"held_out": len(held), "recall": float(got[held_label == 1].mean()),
                      "false_flags": float(got[held_label == 0].mean())}
    return scanner


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE, labelled: int = LABELLED, made: int = MADE,
        recall: float = RECALL) -> Scanner:
    return fitted(corpus_findings(docs, text_col, sample, labelled) + made_findings(made), recall)


# ------------------------------------------------------------------- scan
def _scan(col: pa.Array, scanner: Scanner) -> dict[int, list[tuple[str, int, int, float]]]:
    """Findings of the texts of a batch that have any, by row."""
    def maybe(pattern):
        return np.asarray(pc.match_substring_regex(col, pattern).fill_null(False))
    known = np.logical_or.reduce([maybe(p) for p in _MAYBE.values()])
    likely = maybe(_MAYBE_CANDIDATE)
    out, rows, spans, parts = {}, [], [], []
    for i in np.flatnonzero(known | likely).tolist():
        text = col[i].as_py()
        base = base_findings(text) if known[i] else []
        out[i] = [(*f, 1.0) for f in base]
        for a, b in candidates(text) if likely[i] else ():
            if not _inside(a, b, base):
                rows.append(i)
                spans.append((a, b))
                parts.append(_surrounded(text, a, b))
    odds = scanner.log_odds(parts)
    for k in np.flatnonzero(scanner.accepted(parts, odds)).tolist():
        out[rows[k]].append(("model", *spans[k], float(1 / (1 + np.exp(-odds[k])))))
    return {i: sorted(f, key=lambda x: (x[1], KINDS.index(x[0]))) for i, f in out.items() if f}


def redacted(text: str, findings: list[tuple[str, int, int, float]]) -> str:
    """The text with each stretch of findings as ``[secret]``."""
    out, at, reach = [], 0, -1
    for _, a, b, _ in findings:
        if a > reach:
            out += [text[at:a], "[secret]"]
        reach = max(reach, b)
        at = reach
    return "".join(out) + text[at:]


FINDINGS = "array<struct<kind: string, start: int, end: int, score: double>>"


def find(df: DataFrame, scanner: Scanner, id_col: str = "doc_id", text_col: str = "text",
         redact: bool = False) -> DataFrame:
    """(id, findings) for every row, findings by start, then kind; with
    ``redact`` also the text without them."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        for b in batches:
            col = b.column(1)
            found = _scan(col, scanner)
            columns = [b.column(0), pa.array([[dict(zip(("kind", "start", "end", "score"), f)) for f in found.get(i, ())]
                                              for i in range(b.num_rows)], kind)]
            if redact:
                columns.append(pa.array([redacted(t.as_py(), found[i]) if i in found else t.as_py()
                                         for i, t in enumerate(col)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "findings", "redacted"][:len(columns)])

    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, f"id bigint, findings {FINDINGS}" + (", redacted string" if redact else ""))
