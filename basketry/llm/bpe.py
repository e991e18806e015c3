"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

``encode`` adds the token ids of a text column as packed little-endian
unsigned 32-bit integers, ``decode`` turns such a column back into the raw
bytes, ``ids`` unpacks it to an array. The split pattern and the path of the
rank file are parameters; the file must be readable at that path on every
executor (an installed package is).

Long texts are cut where the pattern always ends a match, so pieces encode
independently and their ids concatenate to those of the whole text: after a
non-white-space character and before white space (no alternative of the
pattern goes from the one to the other, and only a match of white space looks
at what follows it). A stretch without such a place is matched with the
pattern itself and its matches are encoded one by one.

Edge cases: null and empty text have no ids and decode to no bytes; repeated
rows are encoded each; an empty table gives an empty result. Columns of the
input are kept; an input column with the name of an output is replaced.
"""

from __future__ import annotations

import array
import base64
import functools
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks

#: Characters of a text that are encoded at once.
CHUNK_CHARS = 1 << 16

_SAFE = re.compile(r"(?<=\S)(?=[ \n\t\r])")


@functools.lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    import tiktoken
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, chunk: int = CHUNK_CHARS):
    """Cut ``text`` at safe places into pieces of about ``chunk`` characters."""
    start, n = 0, len(text)
    while n - start > chunk:
        m = _SAFE.search(text, start + chunk)
        if not m or m.start() >= n:
            break
        yield text[start:m.start()]
        start = m.start()
    if start < n:
        yield text[start:]


def _packed(ids: list[int]) -> bytes:
    a = array.array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


def encode_text(enc, pattern: str, text: str, chunk: int = CHUNK_CHARS) -> bytes:
    """The packed ids of ``text``."""
    out = []
    for piece in pieces(text, chunk):
        if len(piece) <= 4 * chunk:
            out.append(_packed(enc.encode_ordinary(piece)))
        else:  # no safe place for a long way
            import regex
            out += [_packed(enc._encode_single_piece(m.group())) for m in regex.finditer(pattern, piece)]
    return b"".join(out)


def _map_column(df: DataFrame, column: str, outs: list[str], make) -> DataFrame:
    """``df`` with binary columns ``outs`` = make()(value of ``column``); made
    in blocks of Arrow batches, other columns pass through."""
    replaced = {o.lower() for o in outs}
    keep = [c for c in df.columns if c.lower() not in replaced]
    slim = df.select(F.col(f"`{column}`").alias("__in"), *[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)])
    names = [f"__out{i}" for i in range(len(outs))]
    schema = T.StructType([*slim.schema.fields[1:], *[T.StructField(n, T.BinaryType()) for n in names]])

    def run(batches):
        f = make()
        for b in blocks(batches, "__in"):
            made = zip(*(f(v) for v in b.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *(pa.array(m, pa.binary()) for m in made)],
                                             names=[*b.schema.names[1:], *names])

    done = slim.mapInArrow(run, schema)
    return done.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)],
                       *[F.col(n).alias(o) for n, o in zip(names, outs)])


def _decoded(enc, ids: bytes) -> bytes:
    return enc.decode_bytes(np.frombuffer(ids, "<u4").tolist()) if ids else b""


def encode(df: DataFrame, rank_file: str, pattern: str, text: str = "text", out: str = "token_ids",
           decoded: str | None = None) -> DataFrame:
    """``df`` with the packed ids of column ``text`` in ``out`` and, if named,
    the bytes that they decode to in ``decoded`` (in the same pass)."""
    def make():
        enc = encoding(rank_file, pattern)

        def one(t):
            ids = encode_text(enc, pattern, t) if t else b""
            return (ids, _decoded(enc, ids)) if decoded else (ids,)
        return one
    return _map_column(df, text, [out, decoded] if decoded else [out], make)


def decode(df: DataFrame, rank_file: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the packed ids stand for in ``out``; they
    need not be valid UTF-8. Null ids decode to no bytes."""
    def make():
        enc = encoding(rank_file, pattern)
        return lambda b: (_decoded(enc, b),)
    return _map_column(df, ids, [out], make)


def n_tokens(ids: str = "token_ids") -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def ids(column: str = "token_ids") -> Column:
    """The packed ids as array<bigint>."""
    c, n = F.hex(F.col(column)), F.octet_length(column)
    return F.when(n > 0, F.transform(
        F.sequence(F.lit(1), n * 2 - 7, F.lit(8)),
        lambda i: F.conv(F.concat(*[F.substring(c, i + k, F.lit(2)) for k in (6, 4, 2, 0)]), 16, 10).cast("long"),
    )).otherwise(F.array().cast("array<bigint>"))
