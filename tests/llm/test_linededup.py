import random

import pytest

from basketry.llm import linededup
from basketry.llm.queries import op9_line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(last + (x != y), row[j] + 1, row[j + 1] + 1)
    return row[-1]


def plain(rows, t, least):
    """rows: distinct (id, text). -> [(id, text, n_lines, n_removed, n_links)]"""
    first = {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for k, (i, text) in enumerate(order):
        for n, line in enumerate((text or "").split("\n")):
            if len(line.encode()) >= least:
                first.setdefault(line, (k, n))
    links, earlier = {}, {}
    lines = sorted(first)
    for k, a in enumerate(lines):
        for b in lines[k + 1:]:
            if abs(len(a.encode()) - len(b.encode())) <= t and distance(a.encode(), b.encode()) <= t:
                for x, y in ((a, b), (b, a)):
                    links[x] = links.get(x, 0) + 1
                    earlier[x] = earlier.get(x, False) or first[y] < first[x]
    out = []
    for k, (i, text) in enumerate(order):
        parts = text.split("\n") if text is not None else []
        gone = [x in first and (first[x] != (k, n) or earlier.get(x, False)) for n, x in enumerate(parts)]
        out.append((i, "\n".join(x for x, g in zip(parts, gone) if not g) if text is not None else None, len(parts),
                    sum(gone), sum(links.get(x, 0) for x in parts)))
    return sorted(out, key=repr)


def got(df, **kw):
    return sorted(((r.doc_id, r.text, *r.lines_found) for r in linededup.dedup_lines(df, **kw).collect()), key=repr)


def test_edit_distance_in_a_band():
    rnd = random.Random(2)
    for _ in range(20_000):
        a = bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(9)))
        b = bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(9)))
        for t in (0, 1, 2, 3):
            assert linededup.within(a, b, t) == (distance(a, b) <= t), (a, b, t)


def edited(rnd, line, k):
    line = list(line)
    for _ in range(k):
        at = rnd.randrange(len(line))
        what = rnd.randrange(3)
        if what == 0:
            line[at] = rnd.choice("xyzé")
        elif what == 1 and len(line) > 1:
            del line[at]
        else:
            line.insert(at, rnd.choice("xyz"))
    return "".join(line)


def random_texts(seed, n=40):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcé ") for _ in range(rnd.choice([5, 12, 13, 20, 31]))) for _ in range(30)]
    texts = []
    for _ in range(n):
        texts.append("\n".join(edited(rnd, x, rnd.randrange(4)) if x and rnd.random() < .6 else x
                               for x in (rnd.choice(base) for _ in range(rnd.randrange(6)))))
    return [f"{i}\n{t}" for i, t in enumerate(texts)] + ["", None, "\n\n", base[0], base[0] + "\n" + base[0], "é" * 9]


@pytest.mark.parametrize("seed,t,unit", [(1, 2, 2048), (2, 1, 2048), (3, 0, 2048), (4, 3, 2048), (5, 2, 2), (6, 2, 3)])
def test_against_every_pair(docs_of, seed, t, unit):
    texts = random_texts(seed)
    want = plain(list(enumerate(texts)), t, 11)
    assert got(docs_of(texts), threshold=t, min_bytes=11, unit=unit) == want


def test_many_variants_of_one_line(docs_of):
    rnd = random.Random(9)
    line = "one line of text that many documents hold with small changes"
    texts = [edited(rnd, line, 1) for _ in range(120)]
    assert got(docs_of(texts), threshold=2, min_bytes=20, unit=16) == plain(list(enumerate(texts)), 2, 20)


def test_null_and_repeated_ids(docs_of):
    a, b = "the same line in all of them", "another line that is here too"
    rows = [(None, f"{a}\n{b}"), (7, a), (7, f"x\n{a}"), (9, b + "!"), (None, None)]
    got_ = got(docs_of([(*r, None, None, None) for r in rows]), threshold=2, min_bytes=10)
    kept = [r[1] for r in got_ if r[1] is not None]
    assert sum(a in k for k in kept) == 1 and sum(b in k for k in kept) == 1
    assert [r for r in got_ if r[0] == 9] == [(9, b + "!", 1, 0, 1)]
    assert [r[1] for r in got_ if r[0] is None] == ["", None] and len(got_) == 5


def test_extra_columns_stay(docs_of):
    df = docs_of(["a long enough line to count", "a long enough line to count"])
    out = linededup.dedup_lines(df, min_bytes=10)
    assert out.columns == [*df.columns, "lines_found"] and {r["key"] for r in out.collect()} == {"x"}


def test_empty_table(docs_of):
    assert got(docs_of([])) == []


def test_query_on_whole_table(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    rows = op9_line_dedup(spark, d).collect()
    assert len(rows) == len(docs)
    long = {x for r in docs for x in r.text.split("\n") if len(x.encode()) >= 40}
    kept = [x for r in rows for x in r.text.split("\n") if len(x.encode()) >= 40]
    assert len(kept) == len(set(kept)) and set(kept) <= long
    near = sum(a != b and linededup.within(a.encode(), b.encode(), 2) for a in kept for b in kept)
    assert near == 0
