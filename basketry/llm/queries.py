"""Named queries of the ten operators, with DuckDB SQL where SQL can say the
same. Each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, dualtree, langid, linededup, mixing, omh, secretscan, simhash, suffixindex, toxicity, urlfilter, whitening
from .common import bounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = bounded(fn)
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------ 1 toxicity
@query
def op1_toxicity(spark, sf_dir):
    """Score of every document; labels of every fifth id are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "matched")


# ------------------------------------------------------------- 2 SimHash
SIMHASH_SHINGLE, SIMHASH_BITS = 3, 3


@query
def op2_simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=SIMHASH_SHINGLE, bits=SIMHASH_BITS)
    return found.select(F.col("id").alias("doc_id"), simhash.hex16("fp").alias("fingerprint"),
                        F.col("component").alias("component_id"))


# ----------------------------------------------------------------- 3 BPE
def rank_file(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path of the rank file and its split pattern."""
    import public_tokenizers
    return public_tokenizers.path(name), public_tokenizers.PATTERN


@query
def op3_bpe(spark, sf_dir):
    """Ids and decoded bytes of every document, as digests."""
    ranks, pattern = rank_file()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, ranks, pattern, decoded="decoded")
    return coded.select("doc_id", bpe.n_tokens("token_ids").alias("n_tokens"),
                        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


# ------------------------------------------------------------ 4 URL rules
URL_RULES = [  # host, path, action
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query
def op4_url_rules(spark, sf_dir):
    """The rule and verdict of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules, "page_id").withColumnRenamed("id", "page_id")


SQL["op4_url_rules"] = """
WITH rules(r_host, r_path, action) AS (VALUES %s),
parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
places AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '%s', '%s') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
fits AS (
  SELECT p.page_id, p.host, p.path, r.r_host || r.r_path AS rule, r.action,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.r_host || r.r_path) DESC NULLS LAST) AS k
  FROM places p LEFT JOIN rules r
    ON ends_with('.' || p.host, '.' || r.r_host) AND starts_with(p.path, r.r_path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM fits WHERE k = 1""" % (
    ", ".join(str(r) for r in URL_RULES), urlfilter._UPPER, urlfilter._LOWER)


# ---------------------------------------------------- 5 fingerprints
@query
def op5_order_minhash(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    found = omh.fingerprint_pairs(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", omh.as_text("signature").alias("fingerprint"),
        omh.as_text("edited_signature").alias("edited_fingerprint"),
        omh.likeness("signature", "edited_signature").alias("near_edited"),
        omh.likeness("signature", "next_signature").alias("near_next"))


# --------------------------------------------------- 6 repeated passages
REPEAT_BYTES = 400


@query
def op6_suffix_index(spark, sf_dir):
    """What stays of every document without its repeated strings."""
    found = suffixindex.repeated(table(spark, sf_dir, "documents"), length=REPEAT_BYTES)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


# ------------------------------------------------------------- 7 mixing
@query
def op7_mixing(spark, sf_dir):
    """Domain posteriors, rate and copies of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = mixing.fit(docs, table(spark, sf_dir, "labels"), mixing.label_domain(), mixing.DOMAINS)
    found = mixing.mixed(docs, model, mixing.TARGETS, budget=mixing.BUDGET)
    shares = [F.col("mix.posterior")[i].alias(f"p_{d}") for i, d in enumerate(mixing.DOMAINS)]
    return found.select("doc_id", "mix.tokens", *shares, "mix.rate", "mix.copies")


# --------------------------------------------------- 8 nearest vectors
QUERY_STEP, NEAREST = 100, 10


@query
def op8_learned_partitions(spark, sf_dir):
    """The nearest rows of every hundredth vector."""
    found = ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % QUERY_STEP == 0, k=NEAREST)
    return found.withColumnRenamed("id", "vec_id")


# ----------------------------------------------------- 9 line de-duplication
#: Exact copies count from one byte on, edits in lines of LINE_BYTES or more.
LINE_EDITS, LINE_BYTES, LINE_COPY_BYTES = 2, 40, 1


@query
def op9_line_dedup(spark, sf_dir):
    """Every document without its repeated lines."""
    docs = table(spark, sf_dir, "documents")
    found = linededup.dedup_lines(docs, threshold=LINE_EDITS, min_bytes=LINE_BYTES, copy_bytes=LINE_COPY_BYTES)
    return found.select("doc_id", f"{found.columns[-1]}.*", F.sha2("text", 256).alias("kept_sha256"), "text")


# ------------------------------------------------------------ 10 language
@query
def op10_language_id(spark, sf_dir):
    """The language of every document and of every page."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = langid.fit(docs)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    none = F.lit(None).cast("long")
    return langid.identify_documents(docs, model).select("doc_id", none.alias("page_id"), "language.*").union(
        langid.identify_pages(pages, model).select(none, "page_id", "language.*"))


# ---------------------------------------------------------- 11 whitening
COMPONENTS, WHITEN_SCALE, WHITEN_OFFSET = 32, 64, 1_000_000


@query
def op11_whitening(spark, sf_dir):
    """Every vector along every component, with the component's share."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), COMPONENTS, scale=WHITEN_SCALE, offset=WHITEN_OFFSET)
    return found.withColumnRenamed("id", "vec_id")


# --------------------------------------------------------- 12 secret scans
def of_kinds(*kinds: str):
    return F.filter("findings", lambda f: f["kind"].isin(*kinds))


def spans_text(kinds: tuple[str, ...]):
    """kind:start:end of the findings of these kinds, comma-joined."""
    return F.array_join(F.transform(of_kinds(*kinds), lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


@query
def op12_secret_scan(spark, sf_dir):
    """Secrets of every document: base findings, and the network's."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secretscan.find(docs, secretscan.fit(docs))
    base = secretscan.KINDS[:3]
    counts = [F.size(of_kinds(k)).cast("long").alias(f"n_{k}") for k in base]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(spans_text(base), 256).alias("base_sha256"),
                        spans_text(secretscan.KINDS).alias("spans"))


# ------------------------------------------------- 13 ranked lexical search
@query
def op13_dual_tree(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    found = dualtree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=NEAREST)
    return found.withColumnRenamed("id", "doc_id")


_TERMS = (r"regexp_extract_all(translate(text, '%s', '%s'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')") % (urlfilter._UPPER, urlfilter._LOWER)
SQL["op13_dual_tree"] = f"""
WITH wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
held AS (SELECT r, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM held),
each_term AS (SELECT r, unnest(terms) AS term FROM held),
counted AS (SELECT r, term, count(*) AS tf FROM each_term WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * n_docs + 2)::DOUBLE / (2.0 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counted, total GROUP BY term, n_docs),
scored AS (
  SELECT item_id, r, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms))))) AS BIGINT)
           AS score
  FROM counted JOIN weights USING (term) JOIN wanted USING (term) JOIN held USING (r), total
  GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS "rank"
  FROM scored WHERE score > 0)
SELECT item_id, "rank", doc_id, score FROM ranked WHERE "rank" <= {NEAREST}"""
