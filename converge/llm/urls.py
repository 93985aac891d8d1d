"""URL filter: rules of hosts and paths, and for the rest the reputation of the host by empirical Bayes.

Labelled pages are outcomes, good or bad, of their hosts. A host's share of good pages has a beta prior whose mean is what is
known of its registered domain, that of a domain what is known of its suffix, and that of a suffix what is known of all
pages. How strong the prior of a level is, in pages, follows from how much the shares of its nodes differ beyond chance (a
moment estimate of the beta-binomial's correlation). So a host with many outcomes is judged by them, one with none by its
domain. A page goes if even the upper bound of its host's share of good pages is too low.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from converge.llm import common

#: Rules of the registered query, host and path in one text, and what each does.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: So many rules at most are part of the expression; more are joined to the hosts.
INLINE = 64
#: Suffixes of several labels under which domains are registered; a single label is always one. Fixed values.
SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")
#: A page goes below this share of good pages, which the bound so many deviations above the mean must reach.
LEAST_GOOD, DEVIATIONS = 0.5, 1.2816
#: Bounds on the strength of a prior, in pages.
WEAKEST, STRONGEST = 0.5, 1000.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, in small letters; empty without."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The suffix of the host and one label before it; a number address, or a host that is a suffix, is its own domain."""
    bare = _bare(host)
    labels = F.when(F.substring_index(bare, ".", -2).isin(*suffixes), 3).otherwise(2)
    return F.when(_number(bare), bare).when(labels == 3, F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The public suffix of the host; empty for a number address."""
    bare = _bare(host)
    two = F.substring_index(bare, ".", -2)
    return F.when(_number(bare), F.lit("")).when(two.isin(*suffixes), two).otherwise(F.substring_index(bare, ".", -1))


def _bare(host: Column) -> Column:
    """The host without a user before it and a port behind it."""
    return F.regexp_replace(F.substring_index(host, "@", -1), r":[0-9]*$", "")


def _number(bare: Column) -> Column:
    return bare.rlike(r"^[0-9.]+$") | bare.startswith("[")


def _split(rule: str) -> tuple[str, str]:
    host, _, path = rule.partition("/")
    return host.translate(str.maketrans(_UPPER, _LOWER)), f"/{path}"


def _inline(rules: Sequence[tuple[str, str]]) -> Column:
    """rule and verdict of the longest rule that fits host and path, else null."""
    out = None
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        host, path = _split(rule)
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """rule_host, rule_path, rule, verdict."""
    return spark.createDataFrame([(*_split(rule), rule, verdict) for rule, verdict in rules], "rule_host string, rule_path string, rule string, verdict string")


def _tallied(pages: DataFrame) -> DataFrame:
    return pages.groupBy("host").agg(F.count("*").alias("pages"))


def _joined(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """pages with rule and verdict, where rules are a table of any size.

    A host has as many suffixes as the longest rule host has labels, so no more are looked up. What its rules are is found
    once for each host; a page goes through those of its host, the longest first.
    """
    labels = rules.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 0
    hosts = common.written(_tallied(pages))
    by_host = rules.groupBy("rule_host").agg(F.collect_list(F.struct((-F.length("rule")).alias("least"), "rule_path", "rule", "verdict")).alias("own"))
    ends = hosts.select("host", F.explode(F.array_distinct(F.array(*[F.substring_index("host", ".", -k) for k in range(1, labels + 1)]))).alias("rule_host")) if labels else hosts.select("host", F.col("host").alias("rule_host"))
    fitting = ends.join(by_host, "rule_host").groupBy("host").agg(F.array_sort(F.flatten(F.collect_list("own"))).alias("own"))
    table = common.written(hosts.join(fitting, "host"))
    first = F.get(F.filter("own", lambda r: F.startswith(F.col("path"), r["rule_path"])), F.lit(0))
    spread = common.spread_join(pages, table, "host", "pages")
    return spread.select(*pages.columns, F.struct(first["rule"].alias("rule"), first["verdict"].alias("verdict")).alias("_found"))


def judged_by_rules(pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame) -> DataFrame:
    """pages (host, path and others) with rule and verdict of the longest rule that fits; null where none does."""
    if isinstance(rules, DataFrame):
        found = _joined(pages, rules)
    elif len(rules) > INLINE:
        found = _joined(pages, rule_table(pages.sparkSession, rules))
    else:
        found = pages.withColumn("_found", _inline(rules))
    return found.select(*pages.columns, F.col("_found.rule").alias("rule"), F.col("_found.verdict").alias("verdict"))


def _strength(nodes: DataFrame) -> float:
    """Pages that the prior of a level weighs: from the nodes' shares around their parents', of parents with several nodes.

    The mean of n (share - p)^2 is p (1 - p) (1 + (n - 1) r), where r is the correlation of pages of one node, and the
    strength is 1 / r - 1.
    """
    spread = F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("p"), F.lit(2.0))
    chance = F.col("p") * (1 - F.col("p"))
    known = nodes.where((F.col("n") > 0) & (F.col("siblings") > 1)).select(F.sum(spread - chance).alias("over"), F.sum((F.col("n") - 1) * chance).alias("scale")).first()
    if not known["scale"]:
        return WEAKEST
    r = known["over"] / known["scale"]
    return round(min(STRONGEST, max(WEAKEST, 1 / r - 1)) if r > 0 else STRONGEST, 6)


def _below(nodes: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """nodes with p, the mean of their parent, joined by `key`; a parent may have any number of nodes."""
    known = parents.select(F.col("node").alias(key), F.col("mean").alias("p"), "children", "siblings_below").withColumnRenamed("siblings_below", "siblings")
    return common.spread_join(nodes, known, key, "children")


def reputations(hosts: DataFrame, suffixes: Sequence[str] = SUFFIXES, deviations: float = DEVIATIONS) -> DataFrame:
    """host, pages, n, good (given: its pages, its outcomes, and the good ones of these), then mean, low and high.

    mean is that of the beta posterior of the host's share of good pages, low and high are so many of its standard deviations
    away, within 0 and 1. A host without outcomes has the prior that its domain gives.
    """
    leaves = common.written(hosts.select("*", domain_of(F.col("host"), suffixes).alias("domain"), suffix_of(F.col("host"), suffixes).alias("suffix")))
    summed = [F.sum("n").alias("n"), F.sum("good").alias("good"), F.count("*").alias("children"), F.count_if(F.col("n") > 0).alias("siblings_below")]
    domains = common.written(leaves.groupBy(F.col("domain").alias("node"), "suffix").agg(*summed))
    tops = common.written(domains.groupBy(F.col("suffix").alias("node")).agg(*summed))
    root = tops.agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.count_if(F.col("n") > 0).alias("siblings")).first()
    mean = ((root["good"] or 0) + 1) / ((root["n"] or 0) + 2)
    tops = tops.withColumn("p", F.lit(mean)).withColumn("siblings", F.lit(root["siblings"]))
    tops = common.written(tops.withColumn("mean", _mean(_strength(tops))).drop("p", "siblings"))
    domains = common.written(_below(domains, tops, "suffix"))
    domains = common.written(domains.withColumn("mean", _mean(_strength(domains))).drop("p", "siblings"))
    leaves = common.written(_below(leaves, domains, "domain"))
    strength = _strength(leaves)
    leaves = leaves.withColumn("mean", _mean(strength))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + strength + 1))
    return leaves.select("host", "pages", "n", "good", "mean", F.greatest(F.lit(0.0), F.col("mean") - deviations * deviation).alias("low"), F.least(F.lit(1.0), F.col("mean") + deviations * deviation).alias("high"))


def _mean(strength: float) -> Column:
    return (F.col("good") + strength * F.col("p")) / (F.col("n") + strength)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame = RULES, outcomes: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", suffixes: Sequence[str] = SUFFIXES, least_good: float = LEAST_GOOD, deviations: float = DEVIATIONS) -> DataFrame:
    """One row per page: id, host, path, rule, verdict (allow or block), and high, the bound of its host.

    outcomes: url and good (boolean), labelled pages; by default the pages that a rule judges, allowed ones being good. A rule
    fits its host and all hosts below it if the path starts with the rule's, letter by letter; the longest wins, and decides.
    A null url, or one without ://, has an empty host and path, which is judged as a host of its own, without outcomes by the
    mean of all pages. Repeated rows and null ids stay rows of their own. Without outcomes all pages that no rule judges stay.
    An empty table gives an empty result; other columns are ignored.
    """
    url = F.col(url_col)
    parsed = pages.select(F.col(id_col).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = common.written(judged_by_rules(parsed, rules).withColumnRenamed("verdict", "_ruled"))
    if outcomes is None:
        hosts = ruled.groupBy("host").agg(F.count("*").alias("pages"), F.count("_ruled").alias("n"), F.count_if(F.col("_ruled") == "allow").alias("good"))
    else:
        told = outcomes.select(host_of(F.col("url")).alias("host"), F.col("good").cast("boolean").alias("_good")).where("_good is not null")
        both = ruled.select("host", F.lit(None).cast("boolean").alias("_good"), F.lit(1).alias("_page")).unionByName(told.withColumn("_page", F.lit(0)))
        hosts = both.groupBy("host").agg(F.sum("_page").alias("pages"), F.count("_good").alias("n"), F.count_if("_good").alias("good"))
    known = common.written(reputations(hosts, suffixes, deviations).select("host", "pages", "high"))
    found = common.spread_join(ruled, known, "host", "pages")
    verdict = F.coalesce("_ruled", F.when(F.col("high") < least_good, "block").otherwise("allow"))
    return found.select(F.col("_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "high")


def _strength_sql(nodes: str) -> str:
    over, scale = "sum(n * pow(good / n - p, 2) - p * (1 - p))", "sum((n - 1) * p * (1 - p))"
    return f"""(SELECT CASE WHEN coalesce({scale}, 0) = 0 THEN {WEAKEST}::DOUBLE WHEN {over} / {scale} > 0
        THEN round(least({STRONGEST}::DOUBLE, greatest({WEAKEST}::DOUBLE, {scale} / {over} - 1)), 6) ELSE {STRONGEST}::DOUBLE END
        FROM {nodes} WHERE n > 0 AND siblings > 1)"""


def _sql() -> str:
    rules = ", ".join(f"('{rule}', '{_split(rule)[0]}', '{_split(rule)[1]}', '{verdict}')" for rule, verdict in RULES)
    two = ", ".join(f"'{s}'" for s in SUFFIXES)
    mean = "(good + m * p) / (n + m)"
    return rf"""
WITH rules(rule, rule_host, rule_path, verdict) AS (VALUES {rules}),
parsed AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT p.page_id, p.host, p.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS ruled
  FROM parsed p LEFT JOIN rules r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
  GROUP BY ALL),
hosts AS (
  SELECT host, regexp_replace(split_part(host, '@', -1), ':[0-9]*$', '') AS bare, count(ruled) AS n, count(*) FILTER (ruled = 'allow') AS good
  FROM ruled GROUP BY host),
named AS (
  SELECT host, n, good, regexp_matches(bare, '^[0-9.]+$') OR starts_with(bare, '[') AS number, bare, string_split(bare, '.') AS labels,
         array_to_string(list_slice(labels, -2, -1), '.') AS last_two, last_two IN ({two}) AS long
  FROM hosts),
leaves AS (
  SELECT host, n, good, CASE WHEN number THEN bare WHEN long THEN array_to_string(list_slice(labels, -3, -1), '.') ELSE last_two END AS domain,
         CASE WHEN number THEN '' WHEN long THEN last_two ELSE labels[-1] END AS suffix
  FROM named),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good, count(*) FILTER (n > 0) AS below FROM leaves GROUP BY ALL),
tops AS (SELECT suffix, sum(n) AS n, sum(good) AS good, count(*) FILTER (n > 0) AS below FROM domains GROUP BY ALL),
tops_p AS (SELECT *, (sum(good) OVER () + 1)::DOUBLE / (sum(n) OVER () + 2) AS p, count(*) FILTER (n > 0) OVER () AS siblings FROM tops),
tops_m AS (SELECT suffix, below, {mean} AS mean FROM tops_p, (SELECT {_strength_sql("tops_p")} AS m)),
domains_p AS (SELECT d.*, t.mean AS p, t.below AS siblings FROM domains d JOIN tops_m t USING (suffix)),
domains_m AS (SELECT domain, below, {mean} AS mean FROM domains_p, (SELECT {_strength_sql("domains_p")} AS m)),
leaves_p AS (SELECT l.*, d.mean AS p, d.below AS siblings FROM leaves l JOIN domains_m d USING (domain)),
leaves_m AS (SELECT host, n, m, {mean} AS mean FROM leaves_p, (SELECT {_strength_sql("leaves_p")} AS m)),
bounds AS (SELECT host, least(1, mean + {DEVIATIONS}::DOUBLE * sqrt(mean * (1 - mean) / (n + m + 1))) AS high FROM leaves_m)
SELECT page_id, r.host, path, rule, coalesce(ruled, CASE WHEN high < {LEAST_GOOD}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r JOIN bounds b ON r.host = b.host
"""


SQL = _sql()
