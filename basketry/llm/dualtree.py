"""Ranked lexical search by dual trees: the ``k`` best documents of every item.

A term is a longest run of ASCII letters and digits and non-ASCII characters,
A-Z lower-cased. With N documents that have a term, L their terms, n a
document's terms, df the documents holding a term, tf its occurrences in the
document: a term weighs w = floor(1000 ln((2 N + 2) / (2 df + 1))), a document
has m = 10 + (90 n N) div L, and scores the sum of w times its coordinate
(10^9 tf) div (1000 tf + 8 m) over the item's terms, once each.

Index: one pass over the texts writes, per document, its length and the counts
of the terms that any item has (of all terms, where the items' terms are over
``VOCABULARY`` bytes). Document frequencies are counted on that table by Spark
and joined to the items' terms.

Search: items are dealt to blocks of bounded size (``item_blocks``), each with
a tree over its items; a task builds trees over chunks of its documents. Both
are made by bisection along the main direction of the members' coordinates
about their mean, so members of a node share terms; a node holds the largest
coordinate of its members for every term. The product of two nodes' maxima is
an upper bound of every score between them. A pair of nodes is dropped when it
is below the weakest kth score of the node's items (equal bounds stay, so ties
are decided by id); otherwise the item node and the document node are both
split, down to leaves, where scores are computed. All numbers are whole and
below 2^53, or else 64-bit integers, so bounds and scores are exact.

The weakest kth scores begin with those of ``SEED`` documents (least hashes of
the id), which are scores of real documents, so nothing that could be among the
best is lost; they rise with what a task finds. A task gives at most ``k``
documents an item, and none below those first scores. The ``k`` best are taken
per item and salt, then per item.

What bounds memory: a block's items (terms times items), a chunk's node maxima
(``CELLS`` numbers each), texts counted in pieces of ``PIECE`` bytes; to the
driver go the items of one block at a time.

Null texts have no term; documents without a term are none. Rows with one
item id are one item, with the terms of all. Each document row is a document of
its own, ids repeated or not; null ids come after all others among equals.
Items without a match have no rows; an empty table gives an empty result. Other
columns play no part, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import scratch, text_buffer

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Bytes of items' terms that a task may hold to leave out other terms.
VOCABULARY = 32 << 20
#: Numbers in the maxima of one side's nodes, items in a block at most.
CELLS, BLOCK_ITEMS = 1 << 22, 512
LEAF_ITEMS, LEAF_DOCS, CHUNK_LEAVES = 8, 32, 512
SEED = 8_192
PIECE = 4 << 20
_LAST = np.iinfo(np.int64).max
SALTS = 64


def count_terms(text: bytes, piece: int = PIECE) -> Counter:
    """Occurrences of each term; long texts in pieces that end between terms."""
    counts, at = Counter(), 0
    while at < len(text):
        end = min(at + piece, len(text))
        if end < len(text) and (m := TERM.match(text, end - 1)):
            end = m.end()
        counts.update(TERM.findall(text[at:end].lower()))
        at = end
    return counts


def _counted(df: DataFrame, id_col: str, text_col: str, keep: frozenset | None, piece: int) -> DataFrame:
    """(id, n, terms, tfs) of the rows that have a term; of ``keep`` only."""
    def run(batches):
        for b in batches:
            data, at = text_buffer(b.column(1))
            data, n, size, terms, tfs, rows = data.tobytes(), [], [0], [], [], []
            for r, (i, j) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                counts = count_terms(data[i:j], piece) if j > i else None
                if counts:
                    mine = counts.keys() if keep is None else counts.keys() & keep
                    rows.append(r)
                    n.append(counts.total())
                    terms.extend(mine)
                    tfs.extend(map(counts.__getitem__, mine))
                    size.append(len(terms))
            where = pa.array(size, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(where, pa.array(terms, pa.binary())),
                 pa.ListArray.from_arrays(where, pa.array(tfs, pa.int64()))], names=["id", "n", "terms", "tfs"])

    picked = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return picked.mapInArrow(run, "id bigint, n bigint, terms array<binary>, tfs array<bigint>")


# ------------------------------------------------------------------- trees
class Tree:
    """Nodes 0.. in breadth-first order over positions of ``order``; ``first``
    is a node's left child (the right one follows), 0 for leaves."""

    def __init__(self, order: np.ndarray, bounds: list[tuple[int, int]], first: list[int]):
        self.order, self.bounds, self.first = order, bounds, np.array(first, np.int64)

    @classmethod
    def build(cls, members: int, leaf: int, split) -> Tree:
        """``split(positions)`` puts positions in an order to be halved."""
        order, bounds, first, k = np.arange(members), [(0, members)], [0], 0
        while k < len(bounds):
            a, b = bounds[k]
            if b - a > leaf:
                order[a:b] = split(order[a:b])
                first[k], half = len(bounds), (a + b + 1) // 2
                bounds += [(a, half), (half, b)]
                first += [0, 0]
            k += 1
        return cls(order, bounds, first)

    def maxima(self, leaves: np.ndarray) -> np.ndarray:
        """All nodes' maxima from an array whose leaf rows are filled."""
        for k in range(len(self.bounds) - 1, -1, -1):
            if f := self.first[k]:
                np.maximum(leaves[f], leaves[f + 1], out=leaves[k])
        return leaves

    def leaf_of(self) -> np.ndarray:
        """Leaf of each position of ``order``."""
        out = np.empty(len(self.order), np.int64)
        for k, (a, b) in enumerate(self.bounds):
            if not self.first[k]:
                out[a:b] = k
        return out


class Sparse:
    """Rows of (column, value) with their cut along the main direction."""

    def __init__(self, start: np.ndarray, column: np.ndarray, value: np.ndarray, columns: int):
        self.start, self.column, self.value, self.columns = start, column, value, columns

    def rows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row's place in ``which``, column, value) of their entries."""
        size = self.start[which + 1] - self.start[which]
        at = np.repeat(self.start[which] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.repeat(np.arange(len(which)), size), self.column[at], self.value[at]

    def halved(self, which: np.ndarray, steps: int = 4) -> np.ndarray:
        """``which`` along the main direction of its rows about their mean."""
        row, column, value = self.rows(which)
        if not len(row):
            return which
        near, column = np.unique(column, return_inverse=True)
        value = value / max(value.max(), 1)
        along = np.cos(near * 2.399963)  # a fixed start
        for _ in range(steps):
            y = np.bincount(row, value * along[column], minlength=len(which))
            y -= y.mean()
            along = np.bincount(column, value * y[row], minlength=len(near))
            along /= np.abs(along).max() + 1e-300
        return which[np.argsort(np.bincount(row, value * along[column], minlength=len(which)), kind="stable")]


class Items:
    """A block of items: their tree, and the maxima of its nodes."""

    def __init__(self, items: list[tuple], k: int):
        self.k, self.vocabulary = k, sorted({t for _, ts, _ in items for t in ts})
        place = {t: i for i, t in enumerate(self.vocabulary)}
        start = np.cumsum([0, *(len(ts) for _, ts, _ in items)])
        sparse = Sparse(start, np.array([place[t] for _, ts, _ in items for t in ts], np.int64),
                        np.array([w for _, _, ws in items for w in ws], np.int64), len(place))
        self.tree = Tree.build(len(items), LEAF_ITEMS, sparse.halved)
        self.ids = [items[i][0] for i in self.tree.order]
        self.sparse = sparse
        #: A score is below the item's weights times 10^6.
        most = max((sum(ws) for _, _, ws in items), default=0) * 10 ** 6
        self.kind = np.float64 if most < 1 << 53 else np.int64
        self.floor = np.zeros(len(items), self.kind)

    def open(self) -> None:
        """Dense weights by (term, item) and the nodes' maxima, in a task."""
        item, column, value = self.sparse.rows(self.tree.order)
        self.weights = np.zeros((len(self.vocabulary), len(self.ids)), self.kind)
        self.weights[column, item] = value
        top = np.zeros((len(self.tree.bounds), len(self.vocabulary)), self.kind)
        for node, (a, b) in enumerate(self.tree.bounds):
            if not self.tree.first[node]:
                top[node] = self.weights[:, a:b].max(axis=1)
        self.top = np.ascontiguousarray(self.tree.maxima(top).T)
        self.terms = pa.array(self.vocabulary, pa.binary())


class Best:
    """The ``k`` best documents of each item of a block so far."""

    def __init__(self, items: Items):
        self.items, self.k = items, items.k
        n = len(items.ids)
        self.score = np.zeros((n, self.k), items.kind)
        self.doc = np.full((n, self.k), _LAST)
        self.weakest = np.array([self._least(a, b) for a, b in items.tree.bounds])
        self.pairs = self.leaves = 0

    def _least(self, a: int, b: int):
        """The weakest kth score of items a..b, at least 1: scores above 0 count."""
        return max(np.maximum(self.score[a:b, -1], self.items.floor[a:b]).min(), 1)

    def add(self, leaf: int, docs: np.ndarray, scores: np.ndarray) -> None:
        """Scores (document, item of the leaf)."""
        a, b = self.items.tree.bounds[leaf]
        change = False
        for j in np.flatnonzero(scores.max(axis=0) >= np.maximum(self.score[a:b, -1], 1)):
            mine = scores[:, j]
            some = np.flatnonzero(mine >= max(self.score[a + j, -1], self.items.floor[a + j], 1))
            if len(some):
                s, d = np.concatenate((self.score[a + j], mine[some])), np.concatenate((self.doc[a + j], docs[some]))
                first = np.lexsort((d, -s))[:self.k]
                self.score[a + j], self.doc[a + j], change = s[first], d[first], True
        if change:
            self.weakest[leaf] = self._least(a, b)

    def rise(self) -> None:
        """Carry the leaves' weakest scores up."""
        first = self.items.tree.first
        for node in range(len(first) - 1, -1, -1):
            if f := first[node]:
                self.weakest[node] = min(self.weakest[f], self.weakest[f + 1])

    def search(self, docs: np.ndarray, x: Sparse) -> None:
        """Take in a chunk of documents with coordinates ``x``."""
        items, first = self.items, self.items.tree.first
        tree = Tree.build(len(docs), LEAF_DOCS, x.halved)
        row, column, value = x.rows(tree.order)
        value = value.astype(items.kind)
        top = np.zeros((len(tree.bounds), len(items.vocabulary)), items.kind)
        np.maximum.at(top, (tree.leaf_of()[row], column), value)
        tree.maxima(top)
        cut = np.searchsorted(row, np.arange(len(docs) + 1))
        docs = docs[tree.order]
        root = np.zeros(1, np.int64)
        stack = [(0, root, top[0] @ items.top[:, root])]
        while stack:
            node, mine, bound = stack.pop()
            leaf = not tree.first[node]
            while True:  # split the item nodes: once, or down to leaves at a leaf of documents
                self.pairs += len(mine)
                mine = mine[bound >= self.weakest[mine]]
                inner = first[mine] > 0
                if leaf and not inner.any():
                    break
                mine = np.concatenate((mine[~inner], first[mine[inner]], first[mine[inner]] + 1))
                if not leaf:
                    break
                bound = top[node] @ items.top[:, mine]
            if not len(mine):
                continue
            if not leaf:  # split the documents, the likelier half first
                left = tree.first[node]
                bounds = top[left:left + 2] @ items.top[:, mine]
                most = (bounds / self.weakest[mine].astype(float)).max(axis=1)
                for side in ((0, 1) if most[1] > most[0] else (1, 0)):
                    stack.append((left + side, mine, bounds[side]))
                continue
            self.leaves += len(mine)
            a, b = tree.bounds[node]
            some = slice(cut[a], cut[b])
            kept, where = np.unique(row[some], return_index=True)
            spans = [items.tree.bounds[m] for m in mine]
            columns = np.concatenate([np.arange(i, j) for i, j in spans])
            part = items.weights[column[some][:, None], columns[None, :]] * value[some, None]
            scores = np.add.reduceat(part, where, axis=0)
            place = 0
            for m, (i, j) in zip(mine, spans):
                self.add(m, docs[kept], scores[:, place:place + j - i])
                place += j - i
            self.rise()


def coordinates(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m) for arrays of entries."""
    if len(n) and 90 * int(n.max()) * documents >= 1 << 63:
        m = np.array([10 + 90 * int(i) * documents // length for i in n], np.int64)
    else:
        m = 10 + 90 * n * documents // length
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _found(index: DataFrame, items: Items, documents: int, length: int) -> DataFrame:
    """(item, id, score): each task's best documents, item by its place."""
    leaves = max(4, min(CHUNK_LEAVES, CELLS // max(1, len(items.vocabulary))))

    def run(batches):
        items.open()
        best, waiting, held = Best(items), [], 0
        ids = items.terms

        def chunk(parts):
            t = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            doc = np.asarray(t.column(0).fill_null(_LAST))
            terms, tfs = t.column(2), t.column(3)
            size = np.diff(np.asarray(terms.offsets))
            at = pc.index_in(terms.flatten(), value_set=ids)
            here = np.asarray(at.is_valid())
            column = np.asarray(at.fill_null(0)).astype(np.int64)[here]
            row = np.repeat(np.arange(len(doc)), size)[here]
            x = coordinates(np.asarray(tfs.flatten())[here], np.asarray(t.column(1))[row], documents, length)
            some, place = np.unique(row, return_inverse=True)
            if len(some):
                start = np.searchsorted(place, np.arange(len(some) + 1))
                best.search(doc[some], Sparse(start, column, x, len(ids)))

        for b in batches:
            at = 0
            while at < b.num_rows:
                take = min(leaves * LEAF_DOCS - held, b.num_rows - at)
                waiting.append(b.slice(at, take))
                at, held = at + take, held + take
                if held == leaves * LEAF_DOCS:
                    chunk(waiting)
                    waiting, held = [], 0
        if held:
            chunk(waiting)
        item, place = np.nonzero(best.score > 0)
        doc = best.doc[item, place]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(doc, mask=doc == _LAST),
             pa.array(best.score[item, place].astype(np.int64))], names=["item", "id", "score"])

    return index.mapInArrow(run, "item int, id bigint, score bigint")


# ------------------------------------------------------------------- blocks
def item_blocks(classes: dict[int, int]) -> list[tuple[list[int], int]]:
    """(size classes, number of blocks): items of up to 2^c terms, dealt so
    that a block's items times its terms stay about ``2 * CELLS``. ``classes``:
    items per c. Neighbouring classes share blocks where one block holds all."""
    def most(c):
        return max(1, min(BLOCK_ITEMS, math.isqrt(2 * CELLS >> c) if 2 * CELLS >> c else 1))

    out: list[tuple[list[int], int]] = []
    for c in sorted(classes):
        if out and sum(classes[x] for x in out[-1][0]) + classes[c] <= most(c):
            out[-1][0].append(c)
        else:
            out.append(([c], 0))
    return [(cs, -(-sum(classes[c] for c in cs) // most(max(cs)))) for cs, _ in out]


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The k best per item, ranked: per item and salt first."""
    order = [F.desc("score"), F.col("id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    some = rows.withColumn("salt", salt).withColumn(
        "place", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("place") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(
        F.col("rank") <= k).select("item_id", "rank", "id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", doc_text: str = "text",
           item_id: str = "item_id", item_text: str = "text", vocabulary: int = VOCABULARY, seed: int = SEED,
           piece: int = PIECE) -> DataFrame:
    """(item_id, rank, id, score): the ``k`` best documents of each item."""
    spark = docs.sparkSession
    nothing = spark.createDataFrame([], "item_id bigint, rank int, id bigint, score bigint")
    wanted = _counted(items, item_id, item_text, None, piece).select(
        F.col("id").alias("item_id"), F.explode("terms").alias("term")).distinct()
    wanted = scratch(wanted, "search-items")
    terms = wanted.select("term").distinct()
    held = terms.agg(F.sum(F.octet_length("term") + 64)).first()[0]
    if held is None:
        return nothing
    keep = frozenset(bytes(r.term) for r in terms.collect()) if held <= vocabulary else None
    index = scratch(_counted(docs, doc_id, doc_text, keep, piece), "search-index")
    total = index.agg(F.count("*").alias("n"), F.sum("n").alias("length")).first()
    if not total.n:
        return nothing
    frequency = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * total.n + 2) / (2.0 * F.col("df") + 1)))
    weighted = wanted.join(frequency, "term").groupBy("item_id").agg(
        F.collect_list(F.struct("term", weight.alias("w"))).alias("terms"))
    weighted = scratch(weighted.withColumn("c", F.ceil(F.log2(F.size("terms"))).cast("int")), "search-weights")
    classes = {r.c: r.n for r in weighted.groupBy("c").agg(F.count("*").alias("n")).collect()}
    share = min(1.0, seed / total.n)
    sample = index.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    parts = []
    for cs, blocks in item_blocks(classes):
        for b in range(blocks):
            mine = weighted.where(F.col("c").isin(cs) & (F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)).collect()
            if not mine:
                continue
            block = Items([(r.item_id, [bytes(t.term) for t in r.terms], [t.w for t in r.terms]) for r in mine], k)
            if share < 1:
                first = _found(sample, block, total.n, total.length)
                last = first.withColumn("place", F.row_number().over(
                    Window.partitionBy("item").orderBy(F.desc("score")))).where(F.col("place") == k)
                for r in last.collect():  # a row per item of the block
                    block.floor[r.item] = r.score
            names = spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id bigint")
            parts.append(_found(index, block, total.n, total.length).join(names, "item").select(
                "item_id", "id", "score"))
            if len(parts) == 16:
                parts = [scratch(_union(parts), "search-found")]
    return _best(_union(parts), k) if parts else nothing


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out
