"""Class likelihoods of texts: multinomial models over hashed byte 3-grams or
hashed words, with A-Z in lower case. Counting and scoring are vectorised over
the bytes of many texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RollingHash, blocks, mix, text_buffer

BINS = 1 << 15
GRAMS, WORDS = "grams", "words"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.ones(256, bool)  # letters of any language in UTF-8
_LETTER[:128] = False
_LETTER[97:123] = True


def bins_of(data: np.ndarray, off: np.ndarray, kind: str):
    """(bin of each feature, features before each text): of the texts
    data[off[i]:off[i+1]]. A 3-gram counts if it holds a letter."""
    data = _LOWER[data]
    if kind == GRAMS:
        n = len(data) - 2
        if n <= 0:
            return np.empty(0, np.int64), np.zeros(len(off), np.int64)
        a, b, c = (data[i:i + n].astype(np.uint32) for i in range(3))
        code = ((a << np.uint32(16) | b << np.uint32(8) | c) * np.uint32(0x9E3779B1)) >> np.uint32(17)
        letter = _LETTER[data]
        ok = letter[:n] | letter[1:n + 1] | letter[2:n + 2]
        edge = off[1:-1]
        for k in (1, 2):  # 3-grams over the end of a text
            ok[edge[(edge >= k) & (edge - k < n)] - k] = False
        return code[ok].astype(np.int64), np.concatenate(([0], np.cumsum(ok)))[np.minimum(off, n)]
    space = np.concatenate(([True], _SPACE[data], [True]))
    start = ~space[1:-1] & space[:-2]
    start[off[:-1][off[:-1] < len(data)]] = ~_SPACE[data[off[:-1][off[:-1] < len(data)]]]
    end = ~space[1:-1] & space[2:]
    last = off[1:][off[1:] > 0] - 1
    end[last] = ~_SPACE[data[last]]
    a, z = np.flatnonzero(start), np.flatnonzero(end) + 1
    code = mix(RollingHash(data).at(a, z)) % np.uint64(BINS)
    return code.astype(np.int64), np.searchsorted(a, off)


def letters(col: pa.Array) -> np.ndarray:
    """Bytes of letters in each text."""
    data, off = text_buffer(col)
    total = np.concatenate(([0], np.cumsum(_LETTER[_LOWER[data]])))
    return total[off[1:]] - total[off[:-1]]


@dataclass
class TextModel:
    kind: str
    classes: list
    table: np.ndarray  # (class, bin): log probability

    def score(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(features of each text, (text, class) log likelihood)."""
        code, at = bins_of(*text_buffer(col), self.kind)
        out = np.empty((len(at) - 1, len(self.classes)))
        for k, row in enumerate(self.table):
            total = np.concatenate(([0.0], np.cumsum(row[code], dtype=np.float64)))
            out[:, k] = total[at[1:]] - total[at[:-1]]
        return np.diff(at), out


def counts(texts: DataFrame, kind: str) -> DataFrame:
    """(class, bin, n) of the texts (text, class)."""
    def run(batches):
        held: dict = {}
        for b in blocks(batches, "text", 2 << 20):
            code, at = bins_of(*text_buffer(b.column(0)), kind)
            label = np.asarray(b.column(1)).astype(np.int64)
            for c in np.unique(label).tolist():
                held.setdefault(c, np.zeros(BINS, np.int64))
                mine = np.repeat(label == c, np.diff(at))
                held[c] += np.bincount(code[mine], minlength=BINS)
        for c, n in held.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), c, np.int32)), pa.array(some), pa.array(n[some])],
                names=["class", "bin", "n"])

    rows = texts.select("text", "class").mapInArrow(run, "class int, bin bigint, n bigint")
    return rows.groupBy("class", "bin").agg(F.sum("n").alias("n"))


def fit(texts: DataFrame, classes: list, kind: str) -> TextModel:
    """A model of the texts (text, class: index into ``classes``); at most
    classes x ``BINS`` numbers go to the driver."""
    n = np.zeros((len(classes), BINS))
    for r in counts(texts, kind).collect():
        n[r["class"], r["bin"]] = r["n"]
    # a bin that a class lacks is as likely there as overall, times a little
    overall = (n.sum(axis=0) + 0.5) / (n.sum() + 0.5 * BINS)
    n = n + 200 * overall
    return TextModel(kind, classes, np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float32))
