"""URL filters by a sorted sweep over reversed-host keys (DataFrame only).

A host ``www.example.com`` becomes the key ``com.example.www.``; a rule host
then covers exactly the keys that start with its own key, an interval
``[key, key with its last '.' replaced by '/')``.  Intervals of different rule
hosts are nested or disjoint, so at any key the rules in force form a stack.
The stack changes only at interval ends; the stack at each end is derived from
the rules alone, and one ordered pass over ends and urls carries the last seen
stack forward to each url.

Scale: urls are dealt over ``lanes`` by a hash of their id, so one host with a
third of all pages is spread evenly; every lane gets all interval ends (rules
times lanes rows, two per rule host).  One shuffle of (id, host, path); the
window streams over its sorted partition and keeps only the current stack.

Rules: a rule fits its host and every subdomain when the url's path starts
with the rule's path; the longest host + path text wins, ties by the longer
host.  The same host and path with two verdicts: ``block`` wins.  A rule with
an empty host fits every url that has a host or not; a null rule host or path
counts as empty.  Urls that are null or have no ``://`` get an empty host and
path and the default verdict unless an empty-host rule fits.  Repeated ids
give one row each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import UPPER, lanes, table

URL_PARTS = "://([^/?#]*)([^?#]*)"

# fixed values of the registered query
QUERY_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"),
               ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """Reversed labels, each followed by '.'; the empty host has the empty key."""
    turned = F.array_join(F.reverse(F.split(host, "\\.")), ".")
    return F.when(host == "", F.lit("")).otherwise(F.concat(turned, F.lit(".")))


def interval_ends(rules: DataFrame) -> DataFrame:
    """(key, stack) at each point where the stack of active rules changes."""
    r = rules.select(F.coalesce(lower_ascii(F.col("host")), F.lit("")).alias("host"),
                     F.coalesce(F.col("path"), F.lit("")).alias("path"), "verdict")
    r = (r.groupBy("host", "path").agg(F.max(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("b"),
                                       F.max("verdict").alias("v"))
         .select("host", "path", F.when(F.col("b") == 1, "block").otherwise(F.col("v")).alias("verdict")))
    entry = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
                     F.concat("host", "path").alias("rule"), "path", "verdict")
    own = r.groupBy("host").agg(F.collect_list(entry).alias("own"))
    # all suffixes of a host by whole labels, itself and the empty host included
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels) + 1),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    chain = own.select("host", F.explode(F.array_distinct(suffixes)).alias("up"))
    chain = chain.join(own.select(F.col("host").alias("up"), F.col("own").alias("rules")), "up")
    stacks = chain.groupBy("host").agg(
        F.array_sort(F.flatten(F.collect_list("rules"))).alias("opened"),
        F.array_sort(F.flatten(F.collect_list(F.when(F.col("up") != F.col("host"), F.col("rules"))))).alias("closed"))
    key = host_key(F.col("host"))
    opens = stacks.select(key.alias("key"), F.col("opened").alias("stack"))
    closes = stacks.filter("host <> ''").select(F.regexp_replace(key, "\\.$", "/").alias("key"),
                                                F.col("closed").alias("stack"))
    return opens.unionByName(closes)


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", n_lanes: int | None = None) -> DataFrame:
    """One row per page: id, host, path, rule (or null), verdict."""
    n = n_lanes or lanes(pages.sparkSession, 3)
    url = F.col(url_col)
    p = pages.select(F.col(id_col).alias("id"), url_host(url).alias("host"), url_path(url).alias("path"))
    ends = interval_ends(rules)
    kind = ends.schema["stack"].dataType
    events = p.select(F.pmod(F.xxhash64("id", "host", "path"), F.lit(n)).cast("int").alias("lane"),
                      host_key(F.col("host")).alias("key"), F.lit(1).alias("is_page"),
                      F.lit(None).cast(kind).alias("stack"), "id", "host", "path")
    marks = ends.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("lane"), "key", F.lit(0).alias("is_page"),
                        "stack", *[F.lit(None).cast(p.schema[c].dataType).alias(c) for c in ("id", "host", "path")])
    sweep = (Window.partitionBy("lane").orderBy("key", "is_page")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = (events.unionByName(marks).withColumn("active", F.last("stack", ignorenulls=True).over(sweep))
             .filter("is_page = 1"))
    fits = F.filter("active", lambda r: F.col("path").startswith(r["path"]))
    top = F.try_element_at(fits, F.lit(-1))
    return swept.select(F.col("id").alias(id_col), "host", "path", top["rule"].alias("rule"),
                        F.coalesce(top["verdict"], F.lit(default)).alias("verdict"))


def op10_url_filters(spark, sf_dir) -> DataFrame:
    rules = spark.sql(f"VALUES {', '.join(map(str, QUERY_RULES))} AS r(host, path, verdict)")
    return url_filter(table(spark, sf_dir, "pages", "page_id", "url"), rules)


SQL = f"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '{URL_PARTS}', 1), ''), '{UPPER}', '{UPPER.lower()}') AS host,
         coalesce(regexp_extract(url, '{URL_PARTS}', 2), '') AS path
  FROM pages),
r(rhost, rpath, rverdict) AS (VALUES {", ".join(str(x) for x in QUERY_RULES)}),
m AS (
  SELECT p.page_id, p.host, p.path, r.*,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(rhost) + length(rpath) DESC, length(rhost) DESC) AS k
  FROM p LEFT JOIN r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(rverdict, 'allow') AS verdict FROM m WHERE k = 1
"""
