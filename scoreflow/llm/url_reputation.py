"""Empirical-Bayes host reputation for URL filtering.

Labelled page outcomes are counted per host.  A beta-binomial prior is passed down the levels
suffix -> registered domain -> host: each unit's rate is shrunk towards its parent's posterior
mean, with a prior strength per level estimated from the data by the method of moments and limited by
what is known of the parent itself (a strength m under a parent worth s labels counts as m*s/(m+s)).  A host is
blocked when the lower bound of its posterior bad rate exceeds the limit, so hosts with few labels
are judged by their domain and suffix.  Explicit allow / block rules override the estimate.

Defined results: a null url, or one without ``://``, has an empty host and path and is judged like
any other host (the host ''); null page ids and repeated rows are kept as they are; an unlabelled
host takes its domain's estimate, and with no labels at all the rate is 0.5 and nothing is blocked;
an empty table gives an empty result.  Only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import ascii_lower, table

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: The rules of the query, (verdict, rule host, rule path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

Z = 1.645
MAX_BAD_RATE = 0.3
RHO_MIN, RHO_MAX = 0.001, 0.5


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def domain_of(host: Column) -> Column:
    """The last two labels."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    """The last label."""
    return F.substring_index(host, ".", -1)


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest rule whose host equals or contains ``host`` and whose path starts ``path``."""
    out = F.lit(None).cast("string")
    for _, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        hit = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(hit, F.lit(h + p)).otherwise(out)
    return out


def _strength(units: DataFrame) -> float:
    """Prior strength of a level from (n, k, mu) rows: the intra-class correlation rho of the
    beta-binomial by the method of moments, as 1 / rho - 1.  One row reaches the driver."""
    r = units.agg(
        F.sum((F.col("k") - F.col("n") * F.col("mu")) ** 2 / (F.col("mu") * (1 - F.col("mu")))).alias("q"),
        F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1)).alias("m")).collect()[0]
    if not r["m"]:
        return 1 / RHO_MAX - 1
    rho = min(max((r["q"] - r["n"]) / r["m"], RHO_MIN), RHO_MAX)
    return 1 / rho - 1


def host_reputation(hosts: DataFrame, z: float = Z) -> DataFrame:
    """``hosts``: one row per host with ``n`` labelled and ``k`` bad pages (0, 0 when unlabelled).
    Returns host, n, k, bad_rate (posterior mean) and bad_low (lower posterior bound)."""
    hosts = hosts.select("host", domain_of(F.col("host")).alias("domain"), "n", "k")
    domains = hosts.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k")) \
        .withColumn("suffix", suffix_of(F.col("domain")))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).collect()[0]
    root = ((total["k"] or 0) + 0.5) / ((total["n"] or 0) + 1.0)

    def shrunk(units: DataFrame) -> DataFrame:
        """Units with mu and worth of their parent -> mean and worth of their own."""
        m = _strength(units.where("n > 0"))
        prior = F.lit(m) * F.col("worth") / (F.lit(m) + F.col("worth"))
        return units.withColumn("mean", (F.col("k") + prior * F.col("mu")) / (F.col("n") + prior)) \
            .withColumn("own", F.col("n") + prior)

    def under(parents: DataFrame, key: str) -> DataFrame:
        return parents.select(key, F.col("mean").alias("mu"), F.col("own").alias("worth"))

    suffixes = shrunk(suffixes.withColumn("mu", F.lit(root)).withColumn("worth", F.lit((total["n"] or 0) + 1.0)))
    domains = shrunk(domains.join(under(suffixes, "suffix"), "suffix"))
    hosts = shrunk(hosts.join(under(domains, "domain"), "domain"))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("own") + 1))
    return hosts.select("host", "n", "k", F.round("mean", 6).alias("bad_rate"),
                        F.round(F.col("mean") - z * spread, 6).alias("bad_low"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url",
               key_col: str = "key", rules=RULES, max_bad_rate: float = MAX_BAD_RATE) -> DataFrame:
    """``outcomes``: (key_col, bad 0/1) labels of pages; ``pages`` holds the same key.  Repeated
    labels of one key count once (bad if any says so)."""
    p = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                     path_of(F.col(url_col)).alias("path"), F.col(key_col).alias("_key"))
    o = outcomes.where(F.col(key_col).isNotNull() & F.col("bad").isNotNull()) \
        .groupBy(F.col(key_col).alias("_key")).agg(F.max(F.col("bad").cast("int")).alias("_bad"))
    counted = p.join(o, "_key", "left").groupBy("host").agg(
        F.count("_bad").alias("n"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("k"))
    rep = host_reputation(counted)
    judged = p.join(rep, "host", "left").withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.when(F.col("bad_low") > max_bad_rate, F.lit("block")).otherwise(F.lit("allow"))
    for kind in ("allow", "block"):
        mine = [h + q for k, h, q in rules if k == kind]
        verdict = F.when(F.col("rule").isin(mine), F.lit(kind)).otherwise(verdict)
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"),
                         F.col("n").alias("labelled"), F.col("k").alias("bad"), "bad_rate", "bad_low")


#: The document that a page shows stands in its url after the language folder.
DOC_KEY = r"://[^/?#]*/[a-z]{2}/([0-9]{1,18})"


def op1_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ``pages`` url judged; a page's outcome is the label of the document it shows (bad: toxic
    or of low quality)."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.expr(f"try_cast(regexp_extract(url, '{DOC_KEY}', 1) as bigint)").alias("key"))
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("key"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    return judge_urls(pages, labels)


ORACLE = rf"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{PARTS}', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '{PARTS}', 2), '') AS path,
         try_cast(regexp_extract(url, '{DOC_KEY}', 1) AS BIGINT) AS key
  FROM pages),
o AS (SELECT doc_id AS key, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels
      WHERE doc_id IS NOT NULL AND (toxic = 1 OR quality = 0) IS NOT NULL GROUP BY 1),
h AS (SELECT host, regexp_extract(host, '([^.]*\.)?[^.]*$') AS domain,
             count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS k
      FROM p LEFT JOIN o USING (key) GROUP BY 1, 2),
d AS (SELECT domain, regexp_extract(domain, '[^.]*$') AS suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM d GROUP BY 1),
g AS (SELECT (coalesce(sum(k), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1.0::DOUBLE) AS mu, coalesce(sum(n), 0) + 1.0::DOUBLE AS worth FROM s),
ms AS (SELECT 1 / greatest(least(coalesce((sum((k - n * mu) ** 2 / (mu * (1 - mu))) - sum(n)) / nullif(sum(n * (n - 1)), 0), 0.5::DOUBLE), 0.5::DOUBLE), 0.001::DOUBLE) - 1 AS m FROM s, g WHERE n > 0),
s1 AS (SELECT s.*, mu, m * worth / (m + worth) AS prior FROM s, g, ms),
s2 AS (SELECT suffix, (k + prior * mu) / (n + prior) AS mean, n + prior AS own FROM s1),
d1 AS (SELECT d.*, s2.mean AS mu, s2.own AS worth FROM d JOIN s2 USING (suffix)),
md AS (SELECT 1 / greatest(least(coalesce((sum((k - n * mu) ** 2 / (mu * (1 - mu))) - sum(n)) / nullif(sum(n * (n - 1)), 0), 0.5::DOUBLE), 0.5::DOUBLE), 0.001::DOUBLE) - 1 AS m FROM d1 WHERE n > 0),
d1p AS (SELECT d1.*, m * worth / (m + worth) AS prior FROM d1, md),
d2 AS (SELECT domain, (k + prior * mu) / (n + prior) AS mean, n + prior AS own FROM d1p),
h1 AS (SELECT h.*, d2.mean AS mu, d2.own AS worth FROM h JOIN d2 USING (domain)),
mh AS (SELECT 1 / greatest(least(coalesce((sum((k - n * mu) ** 2 / (mu * (1 - mu))) - sum(n)) / nullif(sum(n * (n - 1)), 0), 0.5::DOUBLE), 0.5::DOUBLE), 0.001::DOUBLE) - 1 AS m FROM h1 WHERE n > 0),
hp AS (SELECT h1.*, m * worth / (m + worth) AS prior FROM h1, mh),
r AS (SELECT host, n, k, (k + prior * mu) / (n + prior) AS mean, n + prior AS own FROM hp),
j AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule,
    n AS labelled, k AS bad, round(mean, 6) AS bad_rate,
    round(mean - {Z} * sqrt(mean * (1 - mean) / (own + 1)), 6) AS bad_low
  FROM p JOIN r USING (host))
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block'
       WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
       WHEN bad_low > {MAX_BAD_RATE} THEN 'block' ELSE 'allow' END AS verdict,
  labelled, bad, bad_rate, bad_low
FROM j
"""
