"""SimHash near-duplicates by a segment-popcount embedding.

``fingerprints``: 64-bit SimHash of word shingles. ``A-Z`` are lower-cased,
words are runs of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return; a shingle is ``shingle`` words joined by a space,
repeats included (fewer words: the whole sequence), hashed with XXH64 of its
UTF-8 bytes, seed 42. A bit is 1 if it is set in over half of the hashes. No
words: zero.

``near_links``: pairs of fingerprints that differ in at most ``bits`` bits.
A fingerprint is mapped to the popcounts of its 2-bit segments. Flipping a
bit changes one popcount by one, so the Manhattan distance of two embeddings
is at most the Hamming distance. The segments are cut into parts, so many
that two fingerprints within ``bits`` are at a Manhattan distance of at most
1 in one part. Each part is a grid of integer cells: a fingerprint goes to
its own cell and to those one step up in a coordinate, so that two cells one
step apart meet in the higher one. What meets is verified on all 64 bits.
Within a cell a search from fingerprint to fingerprint emits a spanning
forest of the verified links, not all pairs, so a large group of near copies
costs as many rows as it has members. A cell that a sample of the fingerprints
shows to have more than ``CELL`` members is laid out anew: its members are within
``bits`` in their other segments too, so these are cut into parts and get cells in
the same way, which deals one crowded cell over many tasks. The sample decides
the layout only; any choice of cells gives all links. A cell that has more than
``CELL`` members after that is cut into blocks, and every pair of blocks is a
unit of its own.

Edge cases: null text counts as empty; texts without words share fingerprint
zero and are linked like others; repeated rows share a component; a null id
is kept but never names a component unless the component has no other id; an
empty table gives an empty result. Other columns of the input play no part.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch
from .components import components

SEED = 42
#: Members of a grid cell that one unit of work compares with each other.
CELL = 16384
#: One of how many fingerprints the search for crowded cells looks at.
SAMPLE = 64
#: Bytes of a text whose words are split at once.
SPLIT_BYTES = 1 << 20

_SPACE = b" \t\n\r\x0b\x0c"


def _shares(raw: bytes, limit: int) -> Iterator[bytes]:
    """Cut at white space into shares of about ``limit`` bytes."""
    start = 0
    while len(raw) - start > limit:
        at = min((i for i in (raw.find(bytes([c]), start + limit) for c in _SPACE) if i >= 0), default=-1)
        if at < 0:
            break
        yield raw[start:at]
        start = at
    yield raw[start:]


def _bits_set(hashes: bytes) -> np.ndarray:
    """How many of the 8-byte big-endian hashes have each of the 64 bits."""
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    total = np.zeros(64, np.int64)
    for i in range(0, len(rows), 1 << 14):
        bits = np.unpackbits(rows[i:i + (1 << 14)], axis=1)
        total += bits.sum(axis=0, dtype=np.uint16)
    return total


def fingerprint(text: str | None, shingle: int, limit: int = SPLIT_BYTES) -> int:
    """Signed 64-bit fingerprint."""
    import xxhash
    digest = xxhash.xxh64_digest
    held: list[bytes] = []
    total, n = np.zeros(64, np.int64), 0
    for share in _shares((text or "").encode().lower(), limit):
        words = held + share.split()
        held = words
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        first = (end - size)[:len(words) - shingle + 1].tolist()
        total += _bits_set(b"".join([digest(joined[a:b], SEED) for a, b in zip(first, end[shingle - 1:].tolist())]))
        n += len(first)
        held = words[len(words) - shingle + 1:] if shingle > 1 else []
    if not n and held:
        total, n = _bits_set(digest(b" ".join(held), SEED)), 1
    return int(np.packbits(2 * total > n).view(">i8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): the id as it is, fp the signed 64-bit fingerprint."""
    slim = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in b.column(1).to_pylist()), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["id", "fp"])

    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, fp bigint")


def hex16(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ------------------------------------------------------------- linking
def _parts(bits: int, segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the parts that ``segments`` 2-bit segments are cut
    into, so that two fingerprints within ``bits`` are within 1 in one part."""
    parts = min(bits // 2 + 1, segments)
    edges = [round(segments * p / parts) for p in range(parts + 1)]
    return [(2 * a, 2 * (z - a)) for a, z in zip(edges, edges[1:])]


def _popcounts(fp: Column) -> Column:
    """The popcount of each 2-bit segment, in its place."""
    odd = F.lit(0x5555555555555555)
    next_bit = F.shiftrightunsigned(fp, 1)
    one = fp.bitwiseXOR(next_bit).bitwiseAND(odd)
    both = F.shiftleft(fp.bitwiseAND(next_bit).bitwiseAND(odd), 1)
    return one.bitwiseOR(both)


def _cells(fps: DataFrame, bits: int) -> DataFrame:
    """(cell, up, part, fp): a fingerprint's own grid cell in every part, and the
    cells one step up."""
    pairs = _popcounts(F.col("fp"))
    each = [_cells_of_part(p, pairs, lo, width) for p, (lo, width) in enumerate(_parts(bits, 32))]
    return fps.select(F.explode(F.concat(*each)).alias("c"), "fp").select("c.cell", "c.up", "c.part", "fp")


def _spread(fps: DataFrame, bits: int, cell: int, sample: int) -> DataFrame:
    """(cell, up, fp): ``_cells``, with the cells that have over ``cell``
    members by a sample divided by the popcounts of their other segments."""
    cells, parts = _cells(fps, bits), _parts(bits, 32)
    if len(parts) == 1:  # no other segments
        return cells.select("cell", "up", "fp")
    seen = _cells(fps.where(F.pmod(F.xxhash64("fp"), F.lit(sample)) == 0), bits).groupBy("cell").count()
    crowded = scratch(seen.where(F.col("count") * sample > cell).select(F.col("cell").alias("crowded")),
                      "simhash-crowded")
    rest = cells.join(crowded, F.col("cell") == F.col("crowded"), "left_anti").select("cell", "up", "fp")
    pairs = _popcounts(F.col("fp"))
    finer = F.lit(None)
    for p, (lo, width) in enumerate(parts):
        others = F.shiftrightunsigned(pairs, lo + width).bitwiseOR(F.shiftleft(pairs, 64 - lo - width))  # part p on top
        each = [_cells_of_part(q, others, *part) for q, part in enumerate(_parts(bits, 32 - width // 2))]
        finer = F.when(F.col("part") == p, F.concat(*each)).otherwise(finer)
    dealt = cells.join(crowded, F.col("cell") == F.col("crowded")).select("cell", "fp", F.explode(finer).alias("c"))
    return rest.union(dealt.select(F.xxhash64("cell", "c.part", "c.cell").alias("cell"), "c.up", "fp"))


def _cells_of_part(part: int, pairs: Column, lo: int, width: int) -> Column:
    """The cells (cell, up) of the segments in bits lo to lo + width."""
    mask = (1 << width) - 1
    vector = F.shiftrightunsigned(pairs, lo).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1))
    steps = F.array(*[F.lit(1 << s).cast("long") for s in range(0, width, 2)])

    def can_grow(s):  # a popcount below 2
        return vector.bitwiseAND(F.shiftleft(s, 1)) == 0

    def grown(s):
        return F.when(vector.bitwiseAND(s) == 0, vector.bitwiseXOR(s)).otherwise(
            vector.bitwiseXOR(s.bitwiseOR(F.shiftleft(s, 1))))

    def cell(c, i):
        return F.struct(F.xxhash64(F.lit(part), c).alias("cell"), (i > 0).alias("up"), F.lit(part).alias("part"))

    return F.transform(F.concat(F.array(vector), F.transform(F.filter(steps, can_grow), grown)), cell)


def _forest(members: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among ``members`` (unsigned, distinct)."""
    rest, left, right = members, [], []
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            node = front.pop()
            near = np.bitwise_count(rest ^ node) <= bits
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), node))
                right.append(found)
                front += list(found)
                rest = rest[~near]
    none = np.empty(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _groups(batches, limit: int):
    """Arrow batches (key, up, value), sorted so, as (keys, values, block) of
    whole keys that have a row that is not ``up``, many at a time, with block
    -1; a key with more than ``limit`` rows comes alone, in numbered blocks."""
    k, up, v, block, last = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64), 0, None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.concatenate((k, np.asarray(b.column(0))))
        up = np.concatenate((up, np.asarray(b.column(1).cast("int8")).astype(bool)))
        v = np.concatenate((v, np.asarray(b.column(2))))
        cut = int(np.searchsorted(k, k[-1]))  # the last key may go on
        if block and k[0] != last:
            block = 0
        if cut and block:
            end = int(np.searchsorted(k, k[0], side="right"))
            for a in range(0, end, limit):
                yield k[a:min(a + limit, end)], v[a:min(a + limit, end)], block + a // limit
            k, up, v, cut, block = k[end:], up[end:], v[end:], cut - end, 0
        if cut:
            keep = _met(k[:cut], up[:cut])
            yield k[:cut][keep], v[:cut][keep], -1
            k, up, v = k[cut:], up[cut:], v[cut:]
        while len(k) > limit:
            yield k[:limit], v[:limit], block
            last, block = k[0], block + 1
            k, up, v = k[limit:], up[limit:], v[limit:]
    if len(k):
        if block and k[0] == last:
            yield k, v, block
        else:
            keep = _met(k, up)
            yield k[keep], v[keep], -1


def _met(k: np.ndarray, up: np.ndarray) -> np.ndarray:
    """Rows of the keys with two rows or more and one that is not ``up`` (two
    that both are meet in another cell, if they are near)."""
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    size = np.diff(np.concatenate((first, [len(k)])))
    return np.repeat((size > 1) & ~up[first], size)


def _forests(k: np.ndarray, v: np.ndarray, bits: int, small: int = 12):
    """Links that connect what is near, key by key: small keys all at once,
    row against the next ones; larger keys one by one."""
    if not len(k):
        return v.view(np.uint64), v.view(np.uint64)
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    size = np.diff(np.concatenate((first, [len(k)])))
    left, right = [], []
    few = np.repeat(size <= small, size)
    ks, vs = k[few], v[few].view(np.uint64)
    for lag in range(1, min(small, len(ks))):
        near = (ks[lag:] == ks[:-lag]) & (np.bitwise_count(vs[lag:] ^ vs[:-lag]) <= bits)
        if near.any():
            left.append(vs[:-lag][near])
            right.append(vs[lag:][near])
    for a, n in zip(first[size > small].tolist(), size[size > small].tolist()):
        x, y = _forest(np.unique(v[a:a + n]).view(np.uint64), bits)
        left.append(x)
        right.append(y)
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def near_links(fps: DataFrame, bits: int = 3, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """(a, b): links between distinct fingerprints of column ``fp`` (bigint,
    distinct) that differ in at most ``bits`` bits; enough of them to connect
    what is linked."""
    cells = _spread(fps, bits, cell, sample).repartition("cell").sortWithinPartitions("cell", "up")

    def in_cells(batches):
        for key, rows, block in _groups(batches, cell):
            if block >= 0:  # kept for pairs of blocks
                yield _three(key, rows, np.full(len(rows), block))
            left, right = _forests(key, rows, bits)
            yield _three(left.view(np.int64), right.view(np.int64), np.full(len(left), -1))

    found = scratch(cells.mapInArrow(lambda it: _merged(in_cells(it)), "a bigint, b bigint, block bigint"),
                    "simhash-links")
    links = found.where("block < 0").select("a", "b")

    # pairs of blocks of the cells that have several
    large = found.where("block >= 0").select(F.col("a").alias("cell"), F.col("b").alias("fp"), "block")
    last = large.groupBy("cell").agg(F.max("block").alias("last"))
    pairs = large.join(last, "cell").select(
        "fp", "cell", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("other"), "block"
    ).where("other != block").select(
        F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
        F.lit(False).alias("up"), "fp")

    def in_units(batches):
        for key, rows, _ in _groups(batches, sys.maxsize):  # two blocks, never cut
            left, right = _forests(key, rows, bits)
            yield _three(left.view(np.int64), right.view(np.int64), np.full(len(left), -1))

    more = pairs.repartition("unit").sortWithinPartitions("unit").mapInArrow(
        lambda it: _merged(in_units(it)), "a bigint, b bigint, block bigint").select("a", "b")
    return links.union(more).distinct()


def _three(a, b, block) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(block.astype(np.int64))],
                                      names=["a", "b", "block"])


def _merged(batches: Iterator[pa.RecordBatch], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Fewer, larger batches."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    bits: int = 3) -> DataFrame:
    """(id, fp, component): a row per row of ``df``; component is the smallest
    id that can be reached over links of at most ``bits`` bits."""
    docs = scratch(fingerprints(df, id_col, text_col, shingle), "simhash-fp")
    groups = scratch(docs.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-groups")
    roots = components(near_links(groups.select("fp"), bits))
    member = groups.join(roots, groups.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "rep")
    named = member.join(member.groupBy("root").agg(F.min("rep").alias("component")), "root").select("fp", "component")
    return docs.join(named, "fp").select("id", "fp", "component")
