"""URL rules by a sort-merge range join, in DataFrame operations only.

A rule is a host and a path prefix with an action; it fits the urls of its
host and of all subdomains whose path starts with its path, and of the rules
that fit a url the longest (host and path characters, then the host, then the
path) wins. In reversed-host order ("org.example.blog.") a rule's host is a
prefix of exactly the hosts that it covers, so it is an interval of the sorted
hosts; below one rule host, a rule's path is an interval of the sorted paths.
Prefix intervals are nested or disjoint. ``sweep`` sorts points and interval
starts together and carries along, as a running window value, the stack of
intervals open at the last start: whatever is open at a point was open there
too, so closed ones are dropped from that stack by a prefix test. One sweep
finds the rule hosts of every host, another one the rules of every path.

Scale: only distinct hosts and distinct (rule host, path) pairs are swept. A
group (all hosts; one rule host) with many points is dealt over slices of
about ``SLICE`` points, each with a copy of the group's intervals; a slice
has as many points as the group has intervals at least, so the copies never
outnumber the points by much. Nothing is collected or broadcast by hand.

Edge cases: a null url, or one without "://", has an empty host and path and
no rule; rules with a null host or path are ignored; of rules with the same
host and path, "block" wins over "allow" (the greater action); repeated urls
are judged each; an empty table or no rules give every url the default.
Other columns of the input play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Points of a group that one slice sweeps.
SLICE = 20_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column | str) -> Column:
    """From after the first "://" up to "/", "?", "#" or the end; A-Z in
    lower case; empty for null or no "://"."""
    rest = _after_scheme(F.col(url) if isinstance(url, str) else url)
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column | str) -> Column:
    """What follows the host, up to "?", "#" or the end; else empty."""
    rest = _after_scheme(F.col(url) if isinstance(url, str) else url)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column | str) -> Column:
    """Reversed labels, each followed by a point: "org.example."."""
    host = F.col(host) if isinstance(host, str) else host
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def sweep(points: DataFrame, intervals: DataFrame, group: str, slice_points: int = SLICE) -> DataFrame:
    """For every distinct (``group``, key) of ``points`` the prefixes that are
    open there: columns group, key and ``open``, an array of the keys of
    ``intervals`` (distinct (group, key)) that are prefixes of the point's
    key, shortest first. Points of groups without intervals are left out."""
    points = points.select(group, "key").distinct()
    # the stack at the start of each interval: its own key and the shorter ones around it
    a = intervals.select(F.col(group).alias("g"), F.col("key").alias("inner"), F.explode(
        F.sequence(F.lit(0), F.length("key"))).alias("n"))
    a = a.select("g", "inner", F.substring("inner", F.lit(1), F.col("n")).alias("outer"))
    stacks = a.join(intervals.select(F.col(group).alias("g2"), F.col("key").alias("outer2")),
                    (F.col("g") == F.col("g2")) & (F.col("outer") == F.col("outer2")), "left_semi")
    stacks = stacks.groupBy("g", "inner").agg(F.array_sort(F.collect_list("outer")).alias("stack"))

    many = points.groupBy(F.col(group).alias("g")).agg(F.count("*").alias("points"))
    many = many.join(intervals.groupBy(F.col(group).alias("g")).agg(F.count("*").alias("starts")), "g")
    slices = many.select(F.col("g").alias("gs"), F.ceil(F.col("points") / F.greatest(
        F.lit(slice_points).cast("long"), "starts")).cast("int").alias("slices"))
    starts = stacks.join(slices, F.col("g") == F.col("gs")).select(
        "g", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
        F.col("inner").alias("key"), F.lit(0).alias("kind"), "stack")
    dealt = points.join(slices, F.col(group) == F.col("gs")).select(
        F.col(group).alias("g"), F.pmod(F.hash("key"), "slices").alias("slice"), "key", F.lit(1).alias("kind"),
        F.lit(None).cast("array<string>").alias("stack"))
    order = Window.partitionBy("g", "slice").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = starts.union(dealt).withColumn("stack", F.last("stack", ignorenulls=True).over(order))
    return swept.where("kind = 1").select(
        F.col("g").alias(group), "key",
        F.filter(F.coalesce("stack", F.array().cast("array<string>")),
                 lambda s: F.startswith(F.col("key"), s)).alias("open"))


def judge(urls: DataFrame, rules: DataFrame, id_col: str, url_col: str = "url", default: str = "allow",
          slice_points: int = SLICE) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``urls``. ``rules``
    has columns host, path and action; ``rule`` is host and path of the one
    that decided, null if none fits, and ``verdict`` its action, else
    ``default``."""
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy(
        F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path")).agg(
        F.max("action").alias("action")).withColumn("scope", host_key("r_host"))
    u = urls.select(F.col(f"`{id_col}`").alias("id"), host_of(F.col(f"`{url_col}`")).alias("host"),
                    path_of(F.col(f"`{url_col}`")).alias("path"))
    places = u.select("host", "path").distinct()
    # one group of all hosts; taken from the key, as an equality of literals
    # would be planned as a nested-loop join
    everywhere = F.substring("key", 1, 0).alias("all")
    scopes = sweep(places.select(host_key("host").alias("key")).select(everywhere, "key"),
                   rules.select(F.col("scope").alias("key")).distinct().select(everywhere, "key"), "all", slice_points)
    scopes = scopes.select(F.col("key").alias("hk"), F.explode("open").alias("scope"))
    covered = places.join(scopes, host_key("host") == F.col("hk")).select("host", "path", "scope")
    paths = sweep(covered.select("scope", F.col("path").alias("key")),
                  rules.select("scope", F.col("r_path").alias("key")), "scope", slice_points)
    top = paths.where(F.size("open") > 0).select(
        F.col("scope").alias("p_scope"), F.col("key").alias("p_path"), F.element_at("open", -1).alias("p_rule"))
    fits = covered.join(top, (F.col("scope") == F.col("p_scope")) & (F.col("path") == F.col("p_path"))).join(
        rules.withColumnRenamed("scope", "r_scope"),
        (F.col("p_scope") == F.col("r_scope")) & (F.col("p_rule") == F.col("r_path")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("r_host") + F.length("r_path")).alias("n"), F.col("r_host"), F.col("r_path"),
        F.col("action"))).alias("best"))
    return u.join(best, ["host", "path"], "left").select(
        "id", "host", "path", F.concat("best.r_host", "best.r_path").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"))
