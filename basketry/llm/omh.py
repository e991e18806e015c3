"""Document fingerprints by order MinHash, in DataFrame operations only.

After Marcais et al. 2019, "Locality-sensitive hashing for the edit distance":
the k-mers of a text are numbered by occurrence (the second "a b c" is another
element than the first), an order picks the least few of them, they are put
back in text order and hashed as a tuple. Two texts share a tuple if they share
its k-mers *and their order*, which is what edit distance, unlike Jaccard
similarity, asks for.

Symbols are words (runs of characters other than white space), a k-mer is
``K`` of them (a text with fewer words has one k-mer, all its words). An
element is a 36-bit hash of (36-bit hash of the k-mer, number); each of
``TUPLES`` orders hashes every element of the text anew, with the order's
number, and picks two: the least element, and the least of the reversed order.
Any two places of a random order give the same pair of elements with the same
probability, so this selects as the two least ones would, and both ends of all
orders are one pass of plain minima and maxima. A hash of 36 bits and 28 bits of
position share a number, so a minimum also brings the place that puts the picked
two back in text order (equal hashes: the earlier place at the low end, the later
at the high end).

K-mers are sorted once per text by array functions on the row; runs of equal
ones give the occurrence numbers. The elements are then exploded, a few orders at
a time (``GROUP``), into generated code that hashes and aggregates them. A fingerprint
is 16 bits of each tuple's hash, as hex; ``likeness`` is the share of equal ones.

``fingerprint_pairs`` compares each text with an edited one and with that of
the next row. Rows are dealt to buckets of neighbouring ids, with bounds from
approximate quantiles (``BUCKETS`` at most, so a bounded list); the next row is
a lead inside the bucket, and the first row of the next bucket for the last
one. Texts are shuffled once, to their buckets; everything after, aggregates by
row included, keeps that partitioning, so nothing else of their size moves.

Edge cases: null text counts as empty; texts without words share one
fingerprint; null ids come first; rows with equal ids are ordered by text; a
single row is its own next row; an empty table gives an empty result; a text is
one row of a task however long it is (2^28 words at most). Ids must be numbers.
Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K, TUPLES = 3, 64
#: Orders that one generated aggregate works on.
GROUP = 8
#: Rows that a bucket of neighbouring ids is meant to have, and how many
#: buckets there are at most.
BUCKET_ROWS, BUCKETS = 500, 16_384

_PLACE = (1 << 28) - 1


def elements(df: DataFrame, text: str, out: str, k: int = K) -> DataFrame:
    """``df`` with array column ``out``: a number for each k-mer of the text,
    hash above, place below (empty without words). Work columns begin with
    ``__``; each is read more than once, or the optimizer would write it into
    the function that reads it and compute it anew for every element."""
    kmer = ", ".join(f"get(__w, i + {j})" for j in range(k))
    bare = F.trim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))
    step = df.withColumn("__w", F.when(bare == "", F.array().cast("array<string>")).when(
        bare.isNotNull(), F.split(bare, r"\s+")))
    step = step.withColumn("__n", F.expr(f"greatest(size(__w) - {k - 1}, least(size(__w), 1))"))
    step = step.withColumn("__s", F.expr(
        f"CASE WHEN __n > 0 THEN sort_array(transform(sequence(0, __n - 1), "
        f"i -> (xxhash64({kmer}) & ~{_PLACE}L) | i)) ELSE cast(array() AS array<bigint>) END"))
    step = step.withColumn("__b", F.expr(
        "CASE WHEN __n > 0 THEN filter(sequence(0, __n - 1), j -> j = 0 OR "
        "shiftright(__s[j], 28) != shiftright(get(__s, j - 1), 28)) ELSE cast(array() AS array<int>) END"))

    def element(number, value="s"):
        return f"(xxhash64(shiftright({value}, 28), {number}) & ~{_PLACE}L) | ({value} & {_PLACE}L)"
    # where no k-mer repeats, all numbers are 0
    step = step.withColumn(out, F.expr(f"""
        CASE WHEN size(__b) = __n THEN transform(__s, s -> {element(0)})
          ELSE flatten(transform(__b, (b, q) -> transform(sequence(b, coalesce(get(__b, q + 1), __n) - 1),
            j -> {element("j - b", "__s[j]")}))) END"""))
    return step.drop("__w", "__n", "__s", "__b")


def _parts(df: DataFrame, by: list[str], carry: list[str], text: str, tuples: int, k: int) -> DataFrame:
    """(by, order, carry, part): a group of orders' tuples of each row; zeros
    without words. ``by`` tells the rows apart; ``carry`` are bigints."""
    rows = elements(df.select(*by, *carry, text), text, "__e", k)
    # explode_outer: for explode the optimizer adds a filter that computes the array anew
    rows = rows.select(*by, *carry, F.explode_outer("__e").alias("__v")).select(
        *by, *carry, "__v", F.explode(F.array(*[F.lit(g) for g in range(-(-tuples // GROUP))])).alias("order"))
    hashed, place = F.shiftright("__v", 28), F.col("__v").bitwiseAND(F.lit(_PLACE))
    keys = rows.select(*by, *carry, "order", *[
        F.xxhash64(hashed, F.col("order") * GROUP + j).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place).alias(f"__k{j}")
        for j in range(GROUP)])
    ends = keys.groupBy(*by, "order").agg(
        *[f(f"__k{j}").alias(f"__{n}{j}") for j in range(GROUP) for n, f in (("lo", F.min), ("hi", F.max))],
        *[F.max(c).alias(c) for c in carry])
    low, high = (F.array(*[f"__{n}{j}" for j in range(GROUP)]) for n in ("lo", "hi"))

    def both(a, b):
        x, y = F.shiftright(a, 28), F.shiftright(b, 28)
        early = a.bitwiseAND(F.lit(_PLACE)) < b.bitwiseAND(F.lit(_PLACE))
        pair = F.when(a == b, F.xxhash64(x)).when(early, F.xxhash64(x, y)).otherwise(F.xxhash64(y, x))
        return F.when(a.isNull(), F.lit(0).cast("long")).otherwise(pair.bitwiseAND(F.lit(65535)))
    return ends.select(*by, "order", *carry, F.zip_with(low, high, both).alias("part"))


def signatures(df: DataFrame, key: str = "key", text: str = "text", k: int = K, tuples: int = TUPLES) -> DataFrame:
    """(key, signature) of the rows (key, text): ``tuples`` numbers below
    2**16, zeros without words. Keys tell the rows apart."""
    whole = _parts(df, [key], [], text, tuples, k).groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("order", "part"))).alias("parts"))
    return whole.select(key, F.slice(F.flatten("parts.part"), 1, tuples).alias("signature"))


def as_text(signature: Column | str) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), 4, "0"))), "")


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of equal tuples of two signatures, 0 to 1."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return same.cast("double") / F.size(a)


def _bucket(df: DataFrame, id_col: str, rows: int) -> Column:
    """Number of the bucket of an id: how many bounds it has reached."""
    n = df.count()
    want = min(BUCKETS, max(1, -(-n // rows)))
    bounds = df.approxQuantile(id_col, [i / want for i in range(1, want)], 0.25 / want) if want > 1 else []
    bounds = sorted(set(bounds))
    size = 1 << max(len(bounds), 1).bit_length()
    table = F.array(*[F.lit(x) for x in [*bounds, *[float("inf")] * (size - len(bounds))]])
    steps = F.array(*[F.lit(size >> s) for s in range(1, size.bit_length())])
    found = F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        F.element_at(table, at + s) <= F.col(id_col).cast("double"), at + s).otherwise(at))
    return F.coalesce(found, F.lit(0))


def with_next(df: DataFrame, id_col: str, text_col: str, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows, borders): every row as (bucket, place, id, text, next_text), null
    text as empty, places counting from 1 in order of id and text; and each
    bucket's (b, border): the text that follows its last row."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    docs = docs.withColumn("bucket", _bucket(docs.select("id"), "id", bucket_rows))
    window = Window.partitionBy("bucket").orderBy(F.col("id").asc_nulls_first(), "text")
    rows = docs.withColumn("place", F.row_number().over(window)).withColumn("lead", F.lead("text").over(window))

    # the first row of the bucket that follows; after the last, of the first
    firsts = docs.groupBy("bucket").agg(F.min(F.struct(F.col("id").isNotNull(), "id", "text")).alias("first"))
    in_order = Window.orderBy("bucket")  # buckets: a bounded number of rows
    after = firsts.select("bucket").withColumn("after", F.coalesce(
        F.lead("bucket").over(in_order), F.min("bucket").over(in_order))).withColumnRenamed("bucket", "b")
    borders = after.join(firsts, F.col("after") == F.col("bucket")).select("b", F.col("first.text").alias("border"))
    return rows.join(borders, F.col("bucket") == F.col("b"), "left").select(
        "bucket", "place", "id", "text", F.coalesce("lead", "border").alias("next_text")), borders


def fingerprint_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(id, n_chars, edited_sha256, signature, edited_signature,
    next_signature) of every row: the edited text is the text with the last half
    (rounded down) of its characters replaced by as many of the next row's first
    ones, or all."""
    rows, borders = with_next(df, id_col, text_col, bucket_rows)
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.char_length("text") - half),
                      F.substring("next_text", F.lit(1), half))
    rows = rows.select("bucket", "place", "id", "text", edited.alias("edited"))
    # the digest as four numbers, which aggregate without leaving generated code
    digest = [F.conv(F.substring(F.sha2("edited", 256), 1 + 16 * i, 16), 16, -10).cast("long").alias(f"__d{i}")
              for i in range(4)]
    carry = ["id", "n_chars", "__d0", "__d1", "__d2", "__d3"]
    both = rows.select("bucket", "place", "id", F.char_length("text").cast("long").alias("n_chars"), *digest, F.explode(
        F.array(F.struct(F.lit(0).alias("which"), "text"), F.struct(F.lit(1).alias("which"), F.col("edited").alias(
            "text")))).alias("x")).select("bucket", "place", *carry, "x.which", "x.text")
    signed = _parts(both, ["bucket", "place", "which"], carry, "text", TUPLES, K).groupBy("bucket", "place").agg(
        F.sort_array(F.collect_list(F.struct("which", "order", "part"))).alias("parts"),
        *[F.max(c).alias(c) for c in carry])
    border = borders.join(signatures(borders, "b", "border"), "b").select(
        F.col("b").alias("c"), F.col("signature").alias("border_signature"))
    parts, groups = F.col("parts.part"), -(-TUPLES // GROUP)
    signed = signed.select(
        "bucket", "place", "id", "n_chars",
        F.concat(*[F.lower(F.lpad(F.hex(f"__d{i}"), 16, "0")) for i in range(4)]).alias("edited_sha256"),
        F.slice(F.flatten(F.slice(parts, 1, groups)), 1, TUPLES).alias("signature"),
        F.slice(F.flatten(F.slice(parts, groups + 1, groups)), 1, TUPLES).alias("edited_signature"))
    following = F.lead("signature").over(Window.partitionBy("bucket").orderBy("place"))
    return signed.withColumn("lead", following).join(border, F.col("bucket") == F.col("c"), "left").select(
        "id", "n_chars", "edited_sha256", "signature", "edited_signature",
        F.coalesce("lead", "border_signature").alias("next_signature"))
