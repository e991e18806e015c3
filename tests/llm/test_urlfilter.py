import random
import re

import pytest

from basketry.llm import urlfilter
from basketry.llm.queries import SQL, op4_url_rules

RULE = "host string, path string, action string"


def plain(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(h) + len(p), h, p, a) for h, p, a in rules if ("." + host).endswith("." + h) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[1] + best[2] if best else None, best[3] if best else default)


@pytest.mark.parametrize("slice_points", [20_000, 5])
def test_random_rules(spark, slice_points):
    rnd = random.Random(slice_points)
    hosts = ["org", "example.org", "a.example.org", "b.a.example.org", "xample.org", "com", "exa.com", "", "é.com"]
    paths = ["", "/", "/a", "/a/b", "/ab", "/a/b/c", "/é", "/z"]
    rules = sorted({(rnd.choice(hosts[:-2] + ["é.com"]), rnd.choice(paths)) for _ in range(25)})
    rules = [(h, p, rnd.choice(["allow", "block"])) for h, p in rules]
    urls = [f"{rnd.choice(['http', 'https', ''])}://{rnd.choice(['', 'www.', 'W.'])}{rnd.choice(hosts)}"
            f"{rnd.choice(paths)}{rnd.choice(['', '?q=/a', '#x', '/', '/y'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "a://b://c/d", "://", "http://org", "http://ORG/A", "http:// sp/\n/x"] * 2
    df = spark.createDataFrame([(i, u, "x", "y", "z") for i, u in enumerate(urls)],
                               "page_id bigint, url string, host string, rule string, key string")
    got = urlfilter.judge(df, spark.createDataFrame(rules, RULE), "page_id", slice_points=slice_points).collect()
    assert sorted(tuple(r) for r in got) == sorted((i, *plain(u, rules)) for i, u in enumerate(urls)) or \
        {r.id: tuple(r)[1:] for r in got} == {i: plain(u, rules) for i, u in enumerate(urls)}
    assert len(got) == len(urls)


def test_no_rules_null_rules_empty_table(spark):
    urls = spark.createDataFrame([(1, "http://a.org/x"), (None, None)], "page_id bigint, url string")
    none = spark.createDataFrame([(None, "/", "block"), ("a.org", None, "block")], RULE)
    for rules in (none, none.limit(0)):
        rows = urlfilter.judge(urls, rules, "page_id", default="review").collect()
        assert sorted((r.id, r.rule, r.verdict) for r in rows if r.id) == [(1, None, "review")] and len(rows) == 2
    assert urlfilter.judge(urls.limit(0), none, "page_id").count() == 0


def test_same_rule_twice_blocks(spark):
    rules = spark.createDataFrame([("a.org", "/", "allow"), ("A.org", "/", "block")], RULE)
    urls = spark.createDataFrame([(1, "http://a.org/x")], "page_id bigint, url string")
    assert urlfilter.judge(urls, rules, "page_id").first().verdict == "block"


def test_query_matches_sql(spark):
    import duckdb
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{d}/pages.parquet')")
    cols = "page_id, host, path, rule, verdict"
    want = con.execute(f"SELECT {cols} FROM ({SQL['op4_url_rules']}) ORDER BY page_id").fetchall()
    got = op4_url_rules(spark, d)
    assert [tuple(r) for r in got.select(*cols.split(", ")).orderBy("page_id").collect()] == want
    assert "Python" not in got._jdf.queryExecution().toString() and len({r[3] for r in want}) > 2
