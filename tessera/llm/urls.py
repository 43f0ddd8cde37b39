"""URL filters: explicit host and path rules, then empirical-Bayes host reputation.

Labelled pages are counted per host. A host's rate of bad pages is shrunk
towards its registered domain's, the domain's towards its suffix's, and the
suffix's towards the overall rate, each by a beta prior whose strength is
fitted to the spread of the rates at that level (method of moments of the
beta-binomial). A host is blocked when even the lower posterior bound of its
rate is above the threshold, so a few bad pages alone don't block it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import free_name, table

#: Verdict, host and path of each rule.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: Suffixes of several labels under which names are registered: the common ones, not the whole public list.
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "edu.au", "gov.au", "co.nz", "org.nz", "co.jp", "or.jp", "ne.jp", "ac.jp", "co.kr",
    "co.in", "org.in", "com.br", "org.br", "com.cn", "net.cn", "org.cn", "com.hk", "com.tw", "com.sg", "com.my", "co.id", "co.th", "com.tr", "com.mx",
    "com.ar", "com.co", "co.za", "co.il",
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as ``host/path`` text, and its verdict; null where none fits."""
    name = verdict = None
    for kind, at, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        name = F.when(fits, at + start) if name is None else name.when(fits, at + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return name, verdict


def registered(host: Column, suffixes=SUFFIXES) -> tuple[Column, Column]:
    """The registered domain and its suffix: the longest of ``suffixes`` that the host ends with, else its last label, and the label before it."""
    domain, suffix = F.substring_index(host, ".", -2), F.regexp_extract(host, r"([^.]+)$", 1)
    for n in sorted({s.count(".") + 1 for s in suffixes}):
        last = F.substring_index(host, ".", -n)
        listed = last.isin([s for s in suffixes if s.count(".") + 1 == n])
        domain, suffix = F.when(listed, F.substring_index(host, ".", -n - 1)).otherwise(domain), F.when(listed, last).otherwise(suffix)
    return domain, suffix


def _strength(counts: DataFrame, least: float, most: float) -> DataFrame:
    """One row: the prior's strength from groups of (bad, n), between ``least`` and ``most``."""
    sums = counts.filter("n > 0").agg(
        F.sum("bad").alias("b"), F.sum("n").alias("t"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * F.col("n")).alias("t2"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("b2"),
    )
    m = F.try_divide(F.col("b"), F.col("t"))
    spread = F.col("b2") - F.col("t") * m * m - (F.col("k") - 1) * m * (1 - m)
    room = m * (1 - m) * (F.col("t") - F.try_divide(F.col("t2"), F.col("t")) - (F.col("k") - 1))
    alike = F.try_divide(spread, room)
    return sums.select(F.when(alike > 0, F.greatest(F.lit(least), F.least(F.lit(most), 1 / alike - 1))).otherwise(F.lit(most)).alias("strength"))


def reputation(outcomes: DataFrame, least: float = 2.0, most: float = 200.0, z: float = 1.645, suffixes=SUFFIXES) -> DataFrame:
    """Per host of ``outcomes`` (host, bad 0/1/null): ``mean`` and ``bound`` of its posterior bad rate.

    Unlabelled hosts get the domain's rate with the prior's width. The
    registered domain is the suffix and the label before it, the suffix one of
    ``suffixes`` or the last label; a name that is a suffix is its own domain.
    The bound is ``z`` standard deviations of the beta posterior below its
    mean, a normal approximation of the quantile. Hosts are
    pre-aggregated, so a hot host is one row from each task; hosts, domains
    and suffixes are joined as tables and nothing is collected.
    """
    domain, suffix = registered(F.col("host"), suffixes)
    hosts = outcomes.groupBy("host").agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count("bad").alias("n"))
    hosts = hosts.withColumn("domain", domain).withColumn("suffix", suffix)
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    suffixes = domains.groupBy("suffix").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    overall = suffixes.agg(F.coalesce(F.try_divide(F.sum("bad"), F.sum("n")), F.lit(0.0)).alias("mean"))

    def shrunk(level: DataFrame, above: DataFrame, keys: list[str]) -> DataFrame:
        # the strength and the overall rate are tables of one row each
        own = level.join(F.broadcast(_strength(level, least, most)), F.lit(True))
        upper = above.select(*keys, F.col("mean").alias("prior"))
        both = own.join(upper, keys) if keys else own.join(F.broadcast(upper), F.lit(True))
        weight = F.col("strength") + F.col("n")
        return both.withColumn("mean", (F.col("strength") * F.col("prior") + F.col("bad")) / weight).withColumn("weight", weight)

    by_suffix = shrunk(suffixes, overall, [])
    by_domain = shrunk(domains, by_suffix, ["suffix"])
    by_host = shrunk(hosts, by_domain.drop("suffix"), ["domain"])
    width = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return by_host.select("host", "bad", "n", "mean", (F.col("mean") - z * width).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, threshold: float = 0.5, url: str = "url", rules=RULES, **how) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced.

    ``outcomes`` has (host, bad). A page that no rule fits is blocked if its
    host's bound is above ``threshold``. Null urls and urls without ``://``
    have an empty host and path and are judged as that host; hosts not in
    ``outcomes`` are allowed. Repeated rows are judged alike, an empty table
    gives an empty table, other columns stay, whatever they are called.
    """
    own = pages.drop("host", "path", "rule", "verdict")
    bad = free_name(own, "_bad_host")
    known = reputation(outcomes, **how).filter(F.col("bound") > threshold).select(F.col("host").alias(bad))
    own = own.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    found = own.join(known, F.col("host") == F.col(bad), "left")
    by_method = F.when(F.col(bad).isNotNull(), "block").otherwise("allow")
    return found.withColumn("rule", name).withColumn("verdict", F.coalesce(verdict, by_method)).drop(bad)


def labelled_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) of every page; bad is null where the page's document isn't labelled.

    A page shows the document whose number is the first in its path; a page is
    bad if that document's quality is 0. Repeated labels of a document count once, the worst.
    """
    number = F.regexp_extract(path_of(F.col("url")), "([0-9]+)", 1)
    own = pages.select(host_of(F.col("url")).alias("host"), number.try_cast("bigint").alias("shown"))
    marks = labels.groupBy(F.col("doc_id").alias("_doc")).agg((1 - F.min("quality")).alias("bad"))
    return own.join(marks, F.col("shown") == F.col("_doc"), "left").select("host", "bad")


def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by its host's reputation."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = labelled_outcomes(pages, table(spark, sf_dir, "labels"))
    return judge(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


#: The same on DuckDB.
OP9_SQL = r"""
WITH split AS (
  SELECT page_id, url, strpos(coalesce(url, ''), '://') AS at,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1) AS raw_host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), p AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path,
         try_cast(regexp_extract(path, '([0-9]+)', 1) AS BIGINT) AS shown
  FROM split
), marks AS (SELECT doc_id, 1 - min(quality) AS bad FROM labels GROUP BY doc_id),
hosts AS (
  SELECT host, CASE WHEN len(string_split(host, '.')) > 2 THEN array_to_string(string_split(host, '.')[-2:], '.') ELSE host END AS domain,
         regexp_extract(host, '([^.]+)$', 1) AS suffix, coalesce(sum(bad), 0)::DOUBLE AS bad, count(bad)::DOUBLE AS n
  FROM p LEFT JOIN marks ON shown = doc_id GROUP BY host
), domains AS (SELECT domain, suffix, sum(bad) AS bad, sum(n) AS n FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(bad) AS bad, sum(n) AS n FROM domains GROUP BY suffix),
levels AS (
  SELECT 1 AS level, bad, n FROM suffixes UNION ALL SELECT 2, bad, n FROM domains UNION ALL SELECT 3, bad, n FROM hosts
), sums AS (
  SELECT level, sum(bad) / sum(n) AS m, sum(n) AS t, count(*) AS k, sum(n * n) AS t2, sum(bad * bad / n) AS b2
  FROM levels WHERE n > 0 GROUP BY level
), fitted AS (
  SELECT level, (b2 - t * m * m - (k - 1) * m * (1 - m)) / nullif(m * (1 - m) * (t - t2 / t - (k - 1)), 0) AS alike FROM sums
), strength AS (
  SELECT l.level, coalesce(max(CASE WHEN alike > 0 THEN greatest(2.0, least(200.0, 1 / alike - 1)) END), 200.0) AS s
  FROM (SELECT unnest([1, 2, 3]) AS level) l LEFT JOIN fitted USING (level) GROUP BY l.level
), overall AS (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0) AS mean FROM suffixes),
by_suffix AS (
  SELECT suffix, (s * mean + bad) / (s + n) AS mean FROM suffixes, overall, strength WHERE level = 1
), by_domain AS (
  SELECT d.domain, (s * b.mean + d.bad) / (s + d.n) AS mean FROM domains d JOIN by_suffix b USING (suffix), strength WHERE level = 2
), by_host AS (
  SELECT h.host, (s * b.mean + h.bad) / (s + h.n) AS mean, s + h.n AS weight FROM hosts h JOIN by_domain b USING (domain), strength WHERE level = 3
), verdicts AS (
  SELECT host, CASE WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS own FROM by_host
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' ELSE own END AS verdict
FROM ruled JOIN verdicts USING (host)
"""
