"""Line de-duplication by a segment-partition edit join.

Lines are the parts of a text between line feeds, compared as UTF-8 bytes.
A line of ``copy_bytes`` or more that isn't blank (only white space) goes if the
same line occurs earlier. A line of ``min_bytes`` or more, blank or not, also
goes if its first occurrence follows that of a line within ``threshold`` byte
edits. Other lines always stay: blank ones under ``min_bytes``, and ones under
``copy_bytes`` (the same as ``min_bytes`` unless given). Earlier means by id (nulls
last), then by row, then by line number. Decisions are taken on the input, not
on what is left.

Segment partition (Li et al. 2011, "Pass-Join"): a line is cut into
``threshold`` + 1 even segments. Two lines within the threshold share one: a
segment of the shorter is a substring of the longer near the same place. Every
distinct line gives index rows (its length, segment number, segment) and probe
rows (for partner lengths up to ``threshold`` below its own, the substrings
that the multi-match-aware rule selects); rows are 64-bit keys and line
hashes, and only keys that meet an index row with a different line go on.
Their lines are fetched from the texts and verified: byte histograms first,
then a banded bit-parallel edit distance between what differs.

A pair is decided and counted once, in the unit of the first segment that it
shares. A unit gives one row per line, not per pair. A key with more than
``UNIT`` lines is cut into blocks and every pair of blocks is a unit. Copies of
a line are one line, combined inside tasks first, so frequent lines cost what
rare ones do. Places meet their line in a shuffle by line; those of the most common lines
(under ``COMMON_LINES`` of them) are dealt over shares, and the line goes to each.

Edge cases: null text has no lines and stays null; an empty text is one empty
line; rows equal in id and text repeat each other's lines, and the first of
them in line order keeps none of its lines only if an earlier row has them
(rows that are equal in every respect count as one place, so both keep them);
null ids come last; an empty table gives an empty result. Other columns are
kept, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, free_name, mix, RollingHash, scratch, text_buffer

THRESHOLD = 2
MIN_BYTES = 40
#: Lines of a key that one unit compares with each other.
UNIT = 2048
#: Lines with more places than this, and than their number over ``COMMON_LINES``,
#: are dealt over shares: fewer than ``COMMON_LINES`` lines at any size.
COMMON, COMMON_LINES = 10_000, 100_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def lines_of(data: np.ndarray, off: np.ndarray):
    """(text, number, start, end) of every line of the texts
    data[off[i]:off[i+1]]."""
    feed = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate((off[:-1], feed + 1)), kind="stable")
    end = np.sort(np.concatenate((feed, off[1:])), kind="stable")
    count = np.searchsorted(feed, off[1:]) - np.searchsorted(feed, off[:-1]) + 1
    text = np.repeat(np.arange(len(count)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return text, number, start, end


def _segment(length, i: int, parts: int):
    """Start and size of segment ``i`` of lines of that length: even, the
    longer ones last."""
    size, more = length // parts, length % parts
    longer = np.maximum(0, i - (parts - more))
    return i * size + longer, size + (i >= parts - more)


def _places(delta: int, i: int, t: int) -> range:
    """Where, relative to its place in a line ``delta`` shorter, segment ``i``
    has to be looked for."""
    return range(max(-i, delta - (t - i)), min(i, delta + (t - i)) + 1)


def _keys(rh: RollingHash, start, length, lid, t: int, shortest: int):
    """(key, tag) of index and probe rows; a tag is the line's hash with the
    last bit 0 on index rows, 1 on others."""
    keys, tags = [], []
    for delta in range(t + 1):
        partner = length - delta
        ok = partner >= shortest
        s, own, ids = start[ok], partner[ok], lid[ok]
        full = s + length[ok]
        for i in range(t + 1):
            at, size = _segment(own, i, t + 1)
            salt = mix(own.astype(np.uint64) * np.uint64(t + 1) + np.uint64(i))
            for shift in _places(delta, i, t):
                a = s + at + shift
                fits = (a >= s) & (a + size <= full)
                key = mix(rh.at(a[fits], (a + size)[fits]) * _ODD ^ salt[fits])
                keys.append(key - key % np.uint64(t + 2) + np.uint64(i))  # the segment can be read off the key
                tags.append(ids[fits] | np.uint64(not (delta == 0 and shift == 0)))
    return np.concatenate(keys), np.concatenate(tags)


def within(a: bytes, b: bytes, t: int) -> bool:
    """Is the edit distance at most ``t``? One bit vector per number of edits
    over the band of 2t + 1 diagonals, for what is left between common ends."""
    n = min(len(a), len(b))
    if abs(len(a) - len(b)) > t:
        return False
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    diff = np.flatnonzero(x[:n] != y[:n])
    head = int(diff[0]) if len(diff) else n
    diff = np.flatnonzero(x[len(a) - n:] != y[len(b) - n:])
    tail = min(n - 1 - int(diff[-1]) if len(diff) else n, n - head)
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    if min(len(a), len(b)) == 0:
        return max(len(a), len(b)) <= t
    where: dict[int, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (i + t)
    full = (1 << 2 * t + 1) - 1
    # bit k of at[e]: the first j - t + k bytes of a are within e edits of the first j of b
    at = [sum(1 << t + d for d in range(e + 1)) for e in range(t + 1)]
    for j, c in enumerate(b):
        match = where.get(c, 0) >> j & full
        new = [at[0] & match]
        for e in range(1, t + 1):
            new.append((at[e] & match | at[e - 1] | at[e - 1] >> 1 | new[e - 1] << 1) & full)
        at = new
        if not at[t]:
            return False
    return bool(at[t] >> t + len(a) - len(b) & 1)


def _meet(batches, unit: int):
    """Of rows (key, tag) sorted so: those of the keys that have an index row
    and another line, as (key, lid, index, block). ``block`` is -1, or numbers
    the blocks of ``unit`` lines of a key that has many."""
    names = ["key", "lid", "index", "block"]

    def made(k, tag, block):
        return pa.RecordBatch.from_arrays(
            [pa.array(k), pa.array((tag | np.uint64(1)).view(np.int64)), pa.array(tag & np.uint64(1) == 0),
             pa.array(np.full(len(k), block, np.int32))], names=names)

    def whole(k, tag):
        if len(k) < 2:
            return
        first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        size = np.diff(np.concatenate((first, [len(k)])))
        index = np.add.reduceat((tag & np.uint64(1) == 0).astype(np.int64), first)
        ok = np.repeat((size > 1) & (index > 0), size)
        if ok.any():
            yield made(k[ok], tag[ok], -1)

    k, tag = np.empty(0, np.int64), np.empty(0, np.uint64)  # the key at hand
    block, last = 0, None  # its blocks that have gone, and their last line
    for b in batches:
        if not b.num_rows:
            continue
        k = np.concatenate((k, np.asarray(b.column(0))))
        tag = np.concatenate((tag, np.asarray(b.column(1)).view(np.uint64)))
        new = np.concatenate(([True], (k[1:] != k[:-1]) | (tag[1:] >> np.uint64(1) != tag[:-1] >> np.uint64(1))))
        k, tag = k[new], tag[new]
        if block and last is not None and k[0] == last[0] and tag[0] >> np.uint64(1) == last[1] >> np.uint64(1):
            k, tag = k[1:], tag[1:]
        if not len(k):
            continue
        if block and k[0] != last[0]:
            block = 0
        cut = int(np.searchsorted(k, k[-1]))  # the last key may go on
        if cut:
            if block:
                end = int(np.searchsorted(k, k[0], side="right"))
                yield made(k[:end], tag[:end], block)
                block = 0
                yield from whole(k[end:cut], tag[end:cut])
            else:
                yield from whole(k[:cut], tag[:cut])
            k, tag = k[cut:], tag[cut:]
        while len(k) > unit:
            yield made(k[:unit], tag[:unit], block)
            last = k[unit - 1], tag[unit - 1]
            k, tag, block = k[unit:], tag[unit:], block + 1
    if block and len(k) and k[0] == last[0]:
        yield made(k, tag, block)
    else:
        yield from whole(k, tag)


def _verify(rows: list, segment: int, t: int, tally: dict) -> None:
    """Count the links of a unit whose key is of that segment. rows: (lid,
    index, block, line, order); tally: lid -> [links, is one earlier]."""
    n = len(rows)
    if n < 2:
        return
    size = np.array([len(r[3]) for r in rows])
    kinds = np.zeros((n, 32), np.int16)
    for i, r in enumerate(rows):
        kinds[i] = np.minimum(np.bincount(np.frombuffer(r[3], np.uint8) & 31, minlength=32), 30000)
    blocks_ = np.array([r[2] for r in rows])
    several = len(set(blocks_.tolist())) > 1  # two blocks: only pairs across
    lids = np.array([r[0] for r in rows])
    for i, (lid, index, block, line, order) in enumerate(rows):
        if not index:
            continue
        delta = size - size[i]
        ok = (delta >= 0) & (delta <= t) & ((delta > 0) | (lids > lid))
        if several:
            ok &= blocks_ != block
        cand = np.flatnonzero(ok)
        cand = cand[np.abs(kinds[cand] - kinds[i]).sum(axis=1) <= 2 * t]
        for j in cand.tolist():
            other = rows[j]
            if within(line, other[3], t) and first_shared(line, other[3], t) == segment:
                for (me, mine), (you, yours) in (((lid, order), (other[0], other[4])),
                                                 ((other[0], other[4]), (lid, order))):
                    kept = tally.setdefault(me, [0, False])
                    kept[0] += 1
                    kept[1] |= yours < mine


def first_shared(short: bytes, long: bytes, t: int) -> int:
    """The first segment of ``short`` that the join finds in ``long``."""
    delta = len(long) - len(short)
    for i in range(t + 1):
        at, size = _segment(len(short), i, t + 1)
        for shift in _places(delta, i, t):
            if at + shift >= 0 and long[at + shift:at + shift + size] == short[at:at + size]:
                return i
    return -1


def _unit_rows(batches):
    """(unit key, rows) of Arrow batches sorted by unit."""
    unit, held = None, []
    for b in batches:
        for u, *row in zip(*(c.to_pylist() for c in b.columns)):
            if u != unit and held:
                yield unit, held
                held = []
            unit = u
            held.append(row)
    if held:
        yield unit, held


def _order(first: dict) -> tuple:
    return first["none"], first["id"], first["ka"], first["kb"], first["number"]


def edit_links(docs: DataFrame, firsts: DataFrame, threshold: int, min_bytes: int, unit: int = UNIT) -> DataFrame:
    """(lid, links, earlier): lines with near lines, how many different ones,
    and whether one of them occurs earlier."""
    t = threshold

    def rows_of(batches):
        for b in blocks(batches, "text", 1 << 20):
            data, off = text_buffer(b.column(3))
            _, _, start, end = lines_of(data, off)
            keep = end - start >= min_bytes
            if not keep.any():
                continue
            start, end = start[keep], end[keep]
            rh = RollingHash(data)
            lid, one = np.unique(rh.at(start, end) & ~np.uint64(1), return_index=True)
            key, tag = _keys(rh, start[one], (end - start)[one], lid, t, min_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(tag.view(np.int64))],
                                             names=["key", "tag"])

    keyed = docs.select("ka", "kb", "id", "text").mapInArrow(rows_of, "key bigint, tag bigint")
    met = scratch(keyed.repartition("key").sortWithinPartitions("key", "tag").mapInArrow(
        lambda it: _meet(it, unit), "key bigint, lid bigint, index boolean, block int"), "line-keys")

    # the lines that met others, cut out of the texts of their first occurrence
    places = met.select("lid").distinct().join(firsts, "lid")
    want = places.groupBy(F.col("first.ka").alias("ka"), F.col("first.kb").alias("kb")).agg(
        F.collect_list(F.struct("lid", "first")).alias("want"))
    texts = docs.join(want, ["ka", "kb"]).select("ka", "kb", "id", "text", "row", "want").dropDuplicates(["ka", "kb"])

    order = firsts.schema["first"].dataType
    fetched_kind = T.StructType([T.StructField("l", T.LongType()), T.StructField("line", T.BinaryType()),
                                 T.StructField("first", order)])

    def fetch(batches):
        for b in batches:
            lid, line, first = [], [], []
            for text, ws in zip(b.column(3).to_pylist(), b.column(5).to_pylist()):
                parts = text.encode().split(b"\n")
                for w in ws:
                    lid.append(w["lid"])
                    line.append(parts[w["first"]["number"]])
                    first.append(w["first"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lid, pa.int64()), pa.array(line, pa.binary()),
                 pa.array(first, b.schema.field("want").type.value_type.field("first").type)],
                names=["l", "line", "first"])

    lines = texts.mapInArrow(fetch, fetched_kind)
    last = met.where("block >= 0").groupBy(F.col("key").alias("k")).agg(F.max("block").alias("last"))
    many = met.where("block >= 0").join(last, F.col("key") == F.col("k")).select(
        "key", "lid", "index", "block", F.explode(F.sequence(F.lit(0), "last")).alias("other"))
    many = many.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "key",
                       "lid", "index", "block")
    units = met.where("block < 0").select(F.col("key").alias("unit"), "key", "lid", "index", "block").union(many)
    units = units.join(lines, F.col("lid") == F.col("l")).select("unit", "key", "lid", "index", "block", "line",
                                                                 "first")

    def verify(batches):
        tally: dict = {}
        for _, rows in _unit_rows(batches):
            segment = (rows[0][0] % (1 << 64)) % (t + 2)
            _verify([(r[1], r[2], r[3], r[4], _order(r[5])) for r in rows], segment, t, tally)
            if len(tally) >= 1 << 16:
                yield _tallied(tally)
                tally = {}
        if tally:
            yield _tallied(tally)

    found = units.repartition("unit").sortWithinPartitions("unit").mapInArrow(
        verify, "lid bigint, links bigint, earlier boolean")
    return found.groupBy("lid").agg(F.sum("links").alias("links"), F.max("earlier").alias("earlier"))


def _tallied(tally: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(tally), pa.int64()), pa.array([v[0] for v in tally.values()], pa.int64()),
         pa.array([bool(v[1]) for v in tally.values()])], names=["lid", "links", "earlier"])


def _places_of_lines(docs: DataFrame, min_bytes: int, copy_bytes: int) -> DataFrame:
    """(lid, ka, kb, id, number) of every line of ``min_bytes`` or more, and of
    those of ``copy_bytes`` or more that aren't blank."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for b in blocks(batches, "text", 2 << 20):
            data, off = text_buffer(b.column(3))
            text, number, start, end = lines_of(data, off)
            ink = np.concatenate(([0], np.cumsum(~_BLANK[data])))
            keep = (end - start >= min_bytes) | (end - start >= copy_bytes) & (ink[end] > ink[start])
            if keep.any():
                take = pa.array(text[keep])
                lid = RollingHash(data).at(start[keep], end[keep]) | np.uint64(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lid.view(np.int64)), *(b.column(i).take(take) for i in range(3)),
                     pa.array(number[keep].astype(np.int32))], names=["lid", "ka", "kb", "id", "number"])

    return docs.select("ka", "kb", "id", "text").mapInArrow(
        run, f"lid bigint, ka bigint, kb bigint, id {kind}, number int")


def _with_lines(places: DataFrame, known: DataFrame, firsts: DataFrame) -> DataFrame:
    """``places`` with what is ``known`` of their line ``l``; the places of a
    common line are dealt over shares of about as many, by their row."""
    common = max(COMMON, (firsts.agg(F.sum("n")).first()[0] or 0) // COMMON_LINES)
    shares = F.broadcast(firsts.where(F.col("n") > common).select(  # COMMON_LINES rows at most
        F.col("lid").alias("c"), F.ceil(F.col("n") / common).alias("shares")))
    dealt = places.join(shares, F.col("lid") == F.col("c"), "left").withColumn(
        "share", F.coalesce(F.expr("pmod(ka, shares)"), F.lit(0).cast("long"))).drop("c", "shares")
    told = known.join(shares, F.col("l") == F.col("c"), "left").withColumn("s", F.explode(F.sequence(
        F.lit(0).cast("long"), F.coalesce("shares", F.lit(1).cast("long")) - 1))).drop("c", "shares")
    return dealt.join(told, (F.col("lid") == F.col("l")) & (F.col("share") == F.col("s")))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
                min_bytes: int = MIN_BYTES, unit: int = UNIT, copy_bytes: int | None = None) -> DataFrame:
    """``df`` with the repeated lines of column ``text_col`` taken out, and as
    the last column a struct ``lines_found`` (``free_name``) of n_lines,
    n_removed and n_links (links of the text's lines to different lines)."""
    if min_bytes < 2 * threshold + 1:
        raise ValueError("min_bytes must be over twice the threshold")
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rest = [c for c in df.columns if c != text_col]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rest)])
    docs = df.select(F.xxhash64(i, t).alias("ka"), F.xxhash64(F.lit(1), t, i).alias("kb"), i.alias("id"),
                     t.alias("text"), row.alias("row"))
    copy_bytes = min_bytes if copy_bytes is None else copy_bytes
    places = scratch(_places_of_lines(docs, min_bytes, copy_bytes), "lines")
    place = F.struct(F.isnull("id").alias("none"), "id", "ka", "kb", "number")
    firsts = scratch(places.groupBy("lid").agg(F.min(place).alias("first"), F.count("*").alias("n")), "line-firsts")
    near = edit_links(docs, firsts.select("lid", "first"), threshold, min_bytes, unit)
    known = firsts.join(near, "lid", "left").where("n > 1 OR links > 0").select(
        F.col("lid").alias("l"), "first", F.coalesce("links", F.lit(0).cast("long")).alias("links"),
        F.coalesce("earlier", F.lit(False)).alias("earlier"))
    here = _with_lines(places, known, firsts)
    first = (F.col("ka") == F.col("first.ka")) & (F.col("kb") == F.col("first.kb")) & (
        F.col("number") == F.col("first.number"))
    found = here.select("ka", "kb", F.struct("number", (~first | F.col("earlier")).alias("gone"), "links").alias(
        "f")).groupBy("ka", "kb").agg(F.collect_set("f").alias("found"))
    joined = docs.join(found, ["ka", "kb"], "left").select("ka", "kb", "id", "text", "row", "found")
    out = T.StructType([joined.schema["row"], T.StructField("text", T.StringType()),
                        *[T.StructField(c, T.LongType()) for c in ("n_lines", "n_removed", "n_links")]])

    def take_out(batches):
        for b in batches:
            texts, n_lines, n_removed, n_links = [], [], [], []
            for text, fs in zip(b.column(3).to_pylist(), b.column(5).to_pylist()):
                lines = text.split("\n") if text is not None else []
                gone = {f["number"] for f in fs or () if f["gone"]}
                texts.append("\n".join(x for k, x in enumerate(lines) if k not in gone) if text is not None else None)
                n_lines.append(len(lines))
                n_removed.append(len(gone))
                n_links.append(sum(f["links"] for f in fs or ()))
            yield pa.RecordBatch.from_arrays(
                [b.column(4), pa.array(texts, pa.string()),
                 *(pa.array(v, pa.int64()) for v in (n_lines, n_removed, n_links))],
                names=["row", "text", "n_lines", "n_removed", "n_links"])

    done = joined.mapInArrow(take_out, out)
    at = {c: F.col(f"row.c{k}") for k, c in enumerate(rest)}
    return done.select(*[F.col("text").alias(c) if c == text_col else at[c].alias(c) for c in df.columns],
                       F.struct("n_lines", "n_removed", "n_links").alias(free_name(df, "lines_found")))
