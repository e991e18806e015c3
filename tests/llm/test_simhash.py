import random
import re

import numpy as np
import pytest
import xxhash

from basketry.llm import simhash
from basketry.llm.components import components
from basketry.llm.queries import op2_simhash


def plain_fingerprint(text, k=3):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, bits=3):
    """fps: list of (id, unsigned fp)."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    v = np.array([f for _, f in fps], np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= bits):
            parent[find(i)] = find(i + 1 + int(j))
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f, least.get(find(i))) for i, (d, f) in enumerate(fps)), key=repr)


def got(df, **kw):
    return sorted(((r.id, r.fp & (1 << 64) - 1, r.component)
                   for r in simhash.near_duplicates(df, **kw).collect()), key=repr)


WORDS = "Alpha beta GAMMA delta épsilon zeta\xa0eta theta iota kappa".split(" ")


def make_texts(seed=3, n=60):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice(WORDS) for _ in range(rnd.choice([1, 2, 3, 60, 300]))) for _ in range(n)]
    near = []
    for t in base[:25]:
        w = t.split(" ")
        w[rnd.randrange(len(w))] = "changed"
        near.append("\t".join(w))
    return base + near + base[:5] + ["", None, " \n\x0b ", "a", "A"]


def test_fingerprint_matches_its_definition():
    for t in make_texts():
        for limit in (1 << 20, 50):
            assert simhash.fingerprint(t, 3, limit) & (1 << 64) - 1 == plain_fingerprint(t)


def test_edge_rows_ties_and_clashing_columns(docs_of):
    texts = make_texts()
    df = docs_of(texts).union(docs_of([(None, texts[0], None, None, None), (None, "", None, None, None),
                                       (None, "nothing like it at all", None, None, None)]))
    fps = [(i, plain_fingerprint(t)) for i, t in enumerate(texts)]
    fps += [(None, plain_fingerprint(t)) for t in (texts[0], "", "nothing like it at all")]
    assert got(df) == plain_components(fps)


def test_empty_table(docs_of):
    assert got(docs_of([])) == []


@pytest.mark.parametrize("bits,cell", [(0, 9), (1, 9), (3, 16384), (3, 7), (5, 9)])
def test_links_connect_what_is_near(spark, bits, cell):
    rnd = random.Random(bits)
    centre = rnd.getrandbits(64)
    fps = {rnd.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1, 1 << 63}
    for _ in range(120):  # a ball around one centre, and chains
        f = centre
        for b in rnd.sample(range(64), rnd.randrange(5)):
            f ^= 1 << b
        fps.add(f)
    for f in list(fps)[:60]:
        fps.add(f ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp bigint"), bits, cell)
    pairs = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in links.collect()]
    assert all(bin(a ^ b).count("1") <= bits for a, b in pairs)
    roots = {r.node: r.root for r in components(links).collect()}
    mine = {}
    for s, in signed:
        mine.setdefault(roots.get(s, s), set()).add(s & (1 << 64) - 1)
    want = {}
    for i, f, c in plain_components([(i, f) for i, f in enumerate(fps)], bits):
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_no_single_link_is_lost(spark):
    rnd = random.Random(11)
    pairs = []
    for k in range(1500):
        f = rnd.getrandbits(64)
        g = f
        for b in rnd.sample(range(64), k % 5):
            g ^= 1 << b
        pairs.append((f, g))
    fps = sorted({x for p in pairs for x in p})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    links = {frozenset((r.a & (1 << 64) - 1, r.b & (1 << 64) - 1)) for r in simhash.near_links(df).collect()}
    want = {frozenset(p) for k, p in enumerate(pairs) if 0 < k % 5 <= 3}
    assert want <= links and all(bin(a ^ b).count("1") <= 3 for a, b in map(tuple, links))


def test_large_group_gives_linear_links(spark):
    base = 0x0F0F123456789ABC
    fps = [(base ^ (1 << i) ^ (1 << j),) for i in range(40) for j in range(i)]
    assert simhash.near_links(spark.createDataFrame(fps, "fp bigint")).count() < 40 * len(fps)


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    chain = list(range(100, 160))
    edges = list(zip(chain, chain[1:])) + [(7, x) for x in range(1000, 1050)] + [(3, 3), (None, 4), (5, 6), (6, 5)]
    rnd.shuffle(edges)
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(roots[x] == 100 for x in chain) and all(roots[x] == 7 for x in range(1000, 1050))
    assert roots[5] == roots[6] == 5 and 4 not in roots


def test_query_on_whole_table(spark):
    d = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{d}/documents.parquet").collect()
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in texts])
    rows = op2_simhash(spark, d).collect()
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in rows), key=repr) == want
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in rows)
