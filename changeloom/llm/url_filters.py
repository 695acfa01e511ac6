"""URL filters by host-suffix and path-prefix expressions, in DataFrame operations only.

A rule names a host and a path; it fits that host and all its subdomains when the URL's path starts with the rule's path.
Each distinct URL is expanded into (host suffix) x (path prefix) expressions, as a digest each. The join is an equi-join on the
first hex digits of the digest; the full digest is confirmed afterwards, and the longest fitting rule (host and path together,
ties to the larger rule text, then block before allow) decides.

Cases: a null URL or one without ``://`` has an empty host and path and gets the default verdict; a rule with an empty host or null
parts fits nothing; repeated URLs are judged once and keep all their rows; equal rules count once; an empty table gives an
empty result; other columns of the pages, whatever their names, don't take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import spread_join, table

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """From the first :// to the next / ? # or the end, A-Z in lower case."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    raw = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.when(has, F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    return F.when(has, F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def _after_scheme(url: Column) -> Column:
    return F.substr(url, F.instr(url, "://") + F.lit(3))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """Distinct URLs of ``pages`` that some rule fits, as (url, rule, verdict).

    rules: host, path, action. Path prefixes are taken at the lengths that occur among the rules (a rule's path may end
    anywhere), and only for the hosts' suffixes at label boundaries. The lengths come as scalar subqueries over the rules.
    """
    known = (
        rules.select("host", "path", "action")
        .where(F.col("host") != "")
        .where(F.col("path").isNotNull() & F.col("action").isNotNull())
        .distinct()
        .withColumn("digest", _digest(F.col("host"), F.col("path")))
        .withColumn("short", F.substr("digest", F.lit(1), F.lit(PREFIX_DIGITS)))
        .withColumn("rank", F.struct((F.length("host") + F.length("path")).alias("n"), F.concat("host", "path").alias("rule"), F.col("action")))
    )
    lengths = known.agg(F.collect_set(F.length("path")).alias("lengths"), F.max(F.size(F.split("host", r"\."))).alias("labels"))
    urls = pages.select(F.col(url).alias("url")).where(F.col("url").isNotNull()).distinct()
    parts = urls.select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p")).where(F.col("h") != "")
    expanded = (
        parts.withColumn("lengths", lengths.select("lengths").scalar())
        .withColumn("labels", F.coalesce(lengths.select("labels").scalar(), F.lit(1)))
        .withColumn("label", F.split("h", r"\.", -1))
        .withColumn("n_labels", F.size("label"))
        .withColumn("suffixes", F.transform(F.sequence(F.lit(1), F.least(F.col("n_labels"), F.col("labels"))), lambda k: F.array_join(F.slice(F.col("label"), F.col("n_labels") - k + 1, k), ".")))
        .withColumn("prefixes", F.array_distinct(F.transform(F.filter("lengths", lambda k: k <= F.length("p")), lambda k: F.substr(F.col("p"), F.lit(1), k))))
        .select("url", F.explode("suffixes").alias("host"), "prefixes")
        .select("url", "host", F.explode("prefixes").alias("path"))
        .withColumn("digest", _digest(F.col("host"), F.col("path")))
        .withColumn("short", F.substr("digest", F.lit(1), F.lit(PREFIX_DIGITS)))
    )
    # short digests meet few rules each, but the rule of a top domain meets most urls: its digest is dealt to many tasks
    rules_of = known.groupBy("short").agg(F.collect_list(F.struct("digest", "rank")).alias("rules"))
    met = spread_join(expanded.select("url", "digest", "short"), rules_of, "short")
    confirmed = F.filter("rules", lambda r: r["digest"] == F.col("digest"))
    best = met.select("url", F.explode(confirmed).alias("r")).groupBy("url").agg(F.max("r.rank").alias("best"))
    return best.select("url", F.col("best.rule").alias("rule"), F.col("best.action").alias("verdict"))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, action string")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    verdicts = judge(pages, rule_table(spark))
    return spread_join(pages, verdicts, "url").select(  # a url, or none, may be on a third of all pages
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")
    )


ORACLE = r"""
WITH rules(host, path, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (SELECT page_id,
        CASE WHEN strpos(url, '://') > 0 THEN lower(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*')) ELSE '' END AS host,
        CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
        row_number() OVER () AS rid FROM pages),
m AS (SELECT p.rid, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.action, length(r.host || r.path)) AS action
      FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY p.rid)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.action, 'allow') AS verdict FROM p LEFT JOIN m USING (rid)
"""
