"""Repeated byte strings by a logarithmic family of sparse suffix arrays.

Every byte that lies in a string of ``length`` bytes which also starts at
another place of the corpus (same text included) is marked. Strings never
cross texts, and all are judged on the input.

Sparse suffix arrays. Of the ``length - GRAM + 1`` starts of ``GRAM``-byte
strings inside a window of ``length`` bytes, the one with the least hash
(the leftmost of equals) is the window's anchor. The choice depends on the
window's bytes only, so equal windows have their anchor at the same offset,
and the suffixes at anchors (about one in ``length - GRAM`` / 2 bytes) hold
every match. All windows of one anchor are consecutive; together they are its
block, ``length`` bytes or more. A suffix is ordered by the hash of its first
``GRAM`` bytes, then by that of its block, which is all that telling long
matches from others needs.

Logarithmic family. ``Index.add`` sorts a batch of texts into an array of
(gram, block, places), written to the shared folder, and scans it at once
against every existing level by sort-merge joins on the gram: grams at several
places of the batch, or of the batch and a level, are matches, and the entries
of both sides that hold them are written down. Then levels of equal size merge:
sizes double, so a suffix is rewritten a logarithmic number of times. Two
places of a gram meet when the later of the two is added, so the matches
written down are all there are (``Index.matches``).

Blocks that occur several times are repeated as a whole. Grams that several
different blocks share are ends of matches: one block of each kind is fetched,
and equal windows are looked up among them, gram by gram in sorted order. A
gram whose different blocks may hold more than ``GROUP_BYTES`` (a block has
2 * length - gram bytes at most) goes another way, never by gram: one row per
window, counted by a grouped aggregation.

Scale: what is kept per anchor is a few numbers. Counts are combined before
shuffles; a common gram is joined by semi-joins, which make no pairs and which
adaptive execution splits. Equality is that of 64-bit hashes of the gram and of
the block or window. A Python worker holds arrays for ``READ_BYTES`` of text at a
time, however long the texts are (for the bytes above where blocks are compared),
so workers stay small beside the heap of their executor; blocks of common grams
are cut and spread out by one worker.

Edge cases: null text counts as empty; texts shorter than ``length`` bytes
keep every byte; texts over ``STRETCH`` bytes are read in stretches that
overlap by ``length`` - 1 bytes, so every window is in one of them, and in the
same ones whichever texts they are read with; rows that are equal in id and text
repeat each other; null and repeated ids are fine; an empty table gives an empty
result. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import RollingHash, blocks, drop, scratch, text_buffer

GRAM = 128
#: Bytes of different blocks of one gram that a task compares at once.
GROUP_BYTES = 1 << 20
#: Bytes of blocks of many grams that a task compares at once.
TOGETHER_BYTES = 512 << 10
#: Bytes of text that a task holds arrays for, of about 80 bytes for each.
READ_BYTES = 256 << 10
#: Batches that ``repeated`` makes of a table.
BATCHES = 4
#: Longer texts are read in stretches of so many bytes.
STRETCH = READ_BYTES

_PLACE_BITS = np.uint64(28)
_PLACE = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)


def _window_least(key: np.ndarray, w: int) -> np.ndarray:
    """Least of every ``w`` consecutive values."""
    n = len(key) - w + 1
    full = np.full(-(-len(key) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    full[:len(key)] = key
    rows = full.reshape(-1, w)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)[:n]
    behind = np.minimum.accumulate(rows, axis=1).reshape(-1)[w - 1:w - 1 + n]
    return np.minimum(ahead, behind)


def anchors(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Anchors of the texts data[off[i]:off[i+1]]: arrays (text, gram hash,
    block hash, first window start within the text, further window starts)."""
    long = np.flatnonzero(np.diff(off) >= length)
    if not len(long):
        e = np.empty(0, np.int64)
        return e, e, e, e, e
    rh = RollingHash(data)
    at = np.arange(len(data) - gram + 1)
    g = rh.at(at, at + gram)
    if len(g) > int(_PLACE):
        raise ValueError("more than 256 MB of texts at once")
    least = _window_least((g & ~_PLACE) | at.astype(np.uint64), length - gram + 1)
    inside = np.zeros(len(least) + 1, np.int8)
    inside[off[long]] += 1
    inside[off[long + 1] - length + 1] -= 1
    start = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    anchor = (least[start] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1))))
    last = np.concatenate((first[1:], [len(start)])) - 1
    s1, s2 = start[first], start[last]
    text = np.searchsorted(off, s1, side="right") - 1
    return (text, g[anchor[first]].view(np.int64), rh.at(s1, s2 + length).view(np.int64), s1 - off[text], s2 - s1)


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return df.select(F.xxhash64(i, t).alias("ka"), F.xxhash64(F.lit(1), t, i).alias("kb"), i.alias("id"),
                     t.alias("text"))


def suffixes(docs: DataFrame, length: int, gram: int, stretch: int = STRETCH) -> DataFrame:
    """(gram, block, ka, kb, at, more) of every anchor of keyed texts."""
    step = max(stretch - length + 1, length)  # windows that start in a stretch

    def parts(data, off):
        """(first text, bytes, offsets, start in the text): a text over
        ``stretch`` bytes by itself, in stretches, and those between together."""
        long = np.flatnonzero(np.diff(off) > stretch)
        edges = np.unique(np.concatenate(([0, len(off) - 1], long, long + 1)))
        for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if off[a + 1] - off[a] > stretch:
                for i in range(off[a], off[z], step):
                    d = data[i:min(i + step + length - 1, off[z])]
                    yield a, d, np.array([0, len(d)]), i - off[a]
            else:
                yield a, data[off[a]:off[z]], off[a:z + 1] - off[a], 0

    def run(batches):
        for b in blocks(batches, "text", READ_BYTES):
            for row, data, off, begin in parts(*text_buffer(b.column(2))):
                text, g, k, at, more = anchors(data, off, length, gram)
                if len(text):
                    ka, kb = (b.column(i).take(pa.array(row + text)) for i in (0, 1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g), pa.array(k), ka, kb, pa.array((at + begin).astype(np.int32)),
                         pa.array(more.astype(np.int32))], names=["gram", "block", "ka", "kb", "at", "more"])

    return docs.select("ka", "kb", "text").mapInArrow(
        run, "gram bigint, block bigint, ka bigint, kb bigint, at int, more int")


class Index:
    """A family of sorted arrays (gram, block, places), sizes doubling, and
    the matches that were found when its batches were added."""

    def __init__(self, spark, length: int, gram: int = GRAM, stretch: int = STRETCH):
        self.spark, self.length, self.gram, self.stretch = spark, length, gram, stretch
        self.levels: list[tuple[int, str]] = []  # (batches in it, path), largest first
        self.found: list[str] = []  # matches of each batch

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("gram bigint, block bigint, places bigint").parquet(*paths)

    def _write(self, rows: DataFrame, name: str) -> str:
        path = shared_dir(self.spark, name)
        rows.groupBy("gram", "block").agg(F.sum("places").alias("places")).sortWithinPartitions(
            "gram", "block").write.parquet(path)
        return path

    def add(self, docs: DataFrame) -> None:
        """Index a batch of keyed texts: scan its array against all levels,
        write down the matches, and merge levels of equal size."""
        new = self._write(suffixes(docs, self.length, self.gram, self.stretch).select(
            "gram", "block", F.lit(1).cast("long").alias("places")), "suffix-level")
        self.found.append(self._scan(new))
        size, below = 1, [new]
        while self.levels and self.levels[-1][0] == size:
            below.append(self.levels.pop()[1])
            size *= 2
        self.levels.append((size, self._write(self._read(below), "suffix-level") if below[1:] else new))
        if below[1:]:
            drop(self.spark, below)

    def close(self) -> None:
        """Delete what the index has in the shared folder."""
        drop(self.spark, [p for _, p in self.levels] + self.found)
        self.levels, self.found = [], []

    def _scan(self, path: str) -> str:
        """The entries, of the new array at ``path`` and of the levels, whose
        gram is in the new array and at several places of all these."""
        new = self._read([path])
        grams = new.groupBy("gram").agg(F.sum("places").alias("n"))
        shared, old = grams.where("n > 1").select("gram"), None
        if self.levels:
            old = self._read([p for _, p in self.levels]).join(grams.select("gram"), "gram", "left_semi")
            shared = shared.union(old.select("gram")).distinct()
        hits = new.join(shared, "gram", "left_semi")
        return self._write(hits.union(old) if old is not None else hits, "suffix-matches")

    def matches(self) -> DataFrame:
        """(gram, block, whole, blocks) of the grams at several places:
        whether the block is too, and how many different ones the gram has."""
        seen = self._read(self.found).groupBy("gram", "block").agg((F.max("places") > 1).alias("whole"))
        kinds = seen.groupBy(F.col("gram").alias("g")).agg(F.count("*").alias("blocks"))
        return seen.join(kinds, F.col("gram") == F.col("g")).select("gram", "block", "whole", "blocks")


def _fetched(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(gram, block, alone, bytes): blocks cut out of their texts, from rows
    (text, list of what to cut)."""
    for b in blocks(batches, "text", READ_BYTES):
        data, off = text_buffer(b.column(0))
        want = b.column(1)
        text = np.repeat(np.arange(b.num_rows), np.asarray(pc.list_value_length(want)))
        flat = want.flatten()
        gram, block, at, more, alone = (flat.field(i) for i in range(5))
        a = off[text] + np.asarray(at)
        z = a + np.asarray(more) + length
        cut = pa.array([data[i:j].tobytes() for i, j in zip(a.tolist(), z.tolist())], pa.binary())
        yield pa.RecordBatch.from_arrays([gram, block, alone, cut], names=["gram", "block", "alone", "bytes"])


def _windows(rows: pa.Table, length: int):
    """(row, start within its block, hash) of every window of the blocks."""
    data, off = text_buffer(rows.column("bytes"))
    n = np.diff(off) - length + 1
    row = np.repeat(np.arange(len(n)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    a = off[row] + start
    return row, start, RollingHash(data).at(a, a + length)


def _runs(gram, block, row, start) -> pa.RecordBatch:
    """Consecutive starts of a row as one (first, last)."""
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(row)])) - 1
    r = row[first]
    return pa.RecordBatch.from_arrays(
        [pa.array(gram[r]), pa.array(block[r]), pa.array(start[first]), pa.array(start[last])],
        names=["gram", "block", "first", "last"])


def _shared_windows(wanted: DataFrame, length: int) -> DataFrame:
    """(gram, block, first, last): runs of windows of blocks that are alone
    but share windows with other blocks of their gram; ``wanted`` has text and
    a list of what to cut."""
    def compare(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        row, start, w = _windows(rows, length)
        _, back, n = np.unique(w, return_inverse=True, return_counts=True)
        hit = (n[back] > 1) & np.asarray(rows.column("alone").combine_chunks().cast(pa.int8()))[row].astype(bool)
        if hit.any():
            yield _runs(np.asarray(rows.column("gram")), np.asarray(rows.column("block")), row[hit], start[hit])

    def run(batches):
        done, group, done_n, key = [], [], 0, None  # whole grams; the gram at hand
        for b in batches:
            if not b.num_rows:
                continue
            g = np.asarray(b.column(0))
            cut = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), b.num_rows]
            for a, z in zip(cut, cut[1:]):
                if key is not None and g[a] != key:
                    done, group = done + group, []
                    if done_n >= TOGETHER_BYTES:
                        yield from compare(done)
                        done, done_n = [], 0
                part = b.slice(a, z - a)
                key = g[a]
                group.append(part)
                done_n += int(pc.sum(pc.binary_length(part.column(3))).as_py())
        if done or group:
            yield from compare(done + group)

    return wanted.mapInArrow(
        lambda b: _fetched(b, length), "gram bigint, block bigint, alone boolean, bytes binary").repartition(
        "gram").sortWithinPartitions("gram").mapInArrow(run, "gram bigint, block bigint, first bigint, last bigint")


def _common_windows(wanted: DataFrame, length: int) -> DataFrame:
    """The same for grams of very many blocks: a row per window, counted."""
    def spread(batches):
        for b in blocks(_fetched(batches, length), "bytes", READ_BYTES):
            row, start, w = _windows(pa.Table.from_batches([b]), length)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(start), b.column(2).take(take),
                 pa.array(w.view(np.int64))], names=["gram", "block", "first", "alone", "window"])

    single = wanted.mapInArrow(spread, "gram bigint, block bigint, first bigint, alone boolean, window bigint")
    again = single.groupBy(F.col("window").alias("w")).agg(F.count("*").alias("n")).where("n > 1").select("w")
    return single.where("alone").join(again, F.col("window") == F.col("w")).select(
        "gram", "block", "first", F.col("first").alias("last"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n_bytes, spans, kept) of rows (id, text, sorted cuts)."""
    for b in blocks(batches, "text", READ_BYTES):
        size, spans, kept = [], [], []
        for t, c in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            raw = (t or "").encode()
            runs: list[list[int]] = []
            for x in c or ():
                if runs and x["start"] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], x["end"])
                else:
                    runs.append([x["start"], x["end"]])
            ends = [0, *(v for r in runs for v in r), len(raw)]
            size.append(len(raw))
            spans.append([{"start": a, "end": z} for a, z in runs])
            kept.append(b"".join(raw[ends[i]:ends[i + 1]] for i in range(0, len(ends), 2)))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(size, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
             pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])


def repeated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, gram: int = GRAM,
             batches: int = BATCHES, group_bytes: int = GROUP_BYTES, stretch: int = STRETCH) -> DataFrame:
    """(id, n_bytes, spans, kept) for every row of ``df``: ``spans`` the
    maximal runs (start, end) of repeated bytes, in order, ``kept`` the other
    bytes (binary: a cut may fall inside a character)."""
    if not 0 < gram <= length:
        raise ValueError("gram must be between 1 and length")
    docs = _keyed(df, id_col, text_col)
    index = Index(df.sparkSession, length, gram, stretch)
    for i in range(batches):
        index.add(docs.where(F.pmod(F.col("ka"), F.lit(batches)) == i))
    hits = index.matches().select(F.col("gram").alias("g"), F.col("block").alias("k"), "whole", "blocks")
    at = suffixes(docs, length, gram, stretch).join(hits, (F.col("gram") == F.col("g")) & (F.col("block") == F.col("k")))
    at = scratch(at.select("gram", "block", "ka", "kb", "at", "more", "whole", "blocks"), "suffix-places")
    index.close()  # what it found is in ``at``

    # one place of every block whose gram has several different blocks
    def ends(some) -> DataFrame:
        one = at.where("blocks > 1").where(some).groupBy("gram", "block").agg(
            F.min(F.struct("ka", "kb", "at", "more", (~F.col("whole")).alias("alone"))).alias("p"))
        want = one.select("p.ka", "p.kb", F.struct("gram", "block", "p.at", "p.more", "p.alone").alias("w")).groupBy(
            "ka", "kb").agg(F.collect_list("w").alias("want"))
        return docs.join(want, ["ka", "kb"]).select("text", "want")

    many = F.col("blocks") * (2 * length - gram) > group_bytes
    shared = scratch(_shared_windows(ends(~many), length).union(_common_windows(ends(many), length)),
                     "suffix-ends").select(F.col("gram").alias("g"), F.col("block").alias("k"), "first", "last")

    whole = at.where("whole").select("ka", "kb", F.col("at").alias("start"),
                                          (F.col("at") + F.col("more") + length).alias("end"))
    parts = at.where("NOT whole AND blocks > 1").join(
        shared, (F.col("gram") == F.col("g")) & (F.col("block") == F.col("k"))).select(
        "ka", "kb", (F.col("at") + F.col("first")).cast("int").alias("start"),
        (F.col("at") + F.col("last") + length).cast("int").alias("end"))
    cuts = whole.union(parts).groupBy("ka", "kb").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(
        "cuts"))
    out = docs.join(cuts, ["ka", "kb"], "left").select("id", "text", "cuts")

    kind = df.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    return out.mapInArrow(_kept, f"id {kind}, n_bytes bigint, spans array<struct<start:int,end:int>>, kept binary")
