"""URL filters: a rule list first, then an empirical-Bayes reputation of the host.

Pages that the rules decide are the labelled outcomes (1 = block), and so are pages with an outcome of the caller's.
Beta-binomial priors pass from all pages to the suffix, to the registered domain, to the host; the strength of the
prior at each level is the method-of-moments estimate over the level's groups. A page without a rule is blocked if the
lower posterior bound of its host's block rate passes one half; the bound is the normal approximation of the beta
distribution's quantile (mean less Z standard deviations). Groups go without user, port and closing dot; the suffix is
one of SUFFIXES or else the last label, the registered domain has one label more; an IP address is its own domain and
suffix.

Defined results: a null url or one without `://` has empty host and path, belongs to the group of the
empty host and gets the method's verdict; repeated rows each count; with no labelled page nothing is
blocked by the method; an empty table gives an empty result; other columns are ignored. Groups are aggregated before
the shuffle, levels above from the written table of hosts, and the verdict comes back by a join that may be split, so
one host may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronocell.llm.common import durable

#: Fixed values: (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Public suffixes of two labels under which names are registered. Others count by their last label.
SUFFIXES = (
    "ac.at", "ac.jp", "ac.kr", "ac.nz", "ac.uk", "ac.za", "co.at", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th", "co.uk",
    "co.za", "com.ar", "com.au", "com.bd", "com.br", "com.cn", "com.co", "com.eg", "com.es", "com.gr", "com.hk", "com.mx", "com.my", "com.ng", "com.pe",
    "com.ph", "com.pk", "com.pl", "com.pt", "com.sa", "com.sg", "com.tr", "com.tw", "com.ua", "com.ve", "com.vn", "edu.au", "edu.br", "edu.cn", "edu.tw",
    "gob.es", "gob.mx", "gov.au", "gov.br", "gov.cn", "gov.in", "gov.uk", "gv.at", "ltd.uk", "me.uk", "ne.jp", "net.au", "net.br", "net.cn", "net.nz",
    "net.uk", "nhs.uk", "nom.es", "or.at", "or.jp", "or.kr", "org.au", "org.br", "org.cn", "org.es", "org.il", "org.in", "org.mx", "org.nz", "org.pl",
    "org.tw", "org.uk", "org.za", "plc.uk", "sch.uk",
)
Z = 1.645
LEAST, MOST = 1.0, 1000.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, both null without one."""
    text = verdict = None
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, h + p) if text is None else text.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return text, verdict


_SUFFIX = "(?:" + "|".join(x.replace(".", r"\.") for x in SUFFIXES) + r"|[^.]*)"
SITE = r"^.*@|:[0-9]*\z|\.\z"  # what is no part of a group's name
ADDRESS = r"^[0-9.]+\z|^\["


def suffix_of(site: Column) -> Column:
    return F.when(site.rlike(ADDRESS), site).otherwise(F.regexp_extract(site, rf"(?:^|\.)({_SUFFIX})\z", 1))


def domain_of(site: Column) -> Column:
    found = F.regexp_extract(site, rf"(?:^|\.)([^.]+\.{_SUFFIX})\z", 1)
    return F.when(site.rlike(ADDRESS) | (found == ""), site).otherwise(found)


def _strength(groups: DataFrame) -> tuple[float, float]:
    """The prior's mean and strength from groups (n, bad)."""
    g = groups.where("n > 0")
    s = g.agg(F.sum("bad").cast("double").alias("b"), F.sum("n").cast("double").alias("a"), F.sum(F.col("n").cast("double") * F.col("n")).alias("a2"), F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")).alias("q"), F.count(F.lit(1)).cast("double").alias("c"))
    m = F.coalesce(F.try_divide(F.col("b"), F.col("a")), F.lit(0.0))
    spread = F.col("q") - F.col("a") * m * m  # between the groups, weighted by n
    var = m * (1 - m)
    # E[spread] = var * ((c - 1) + rho * (a - a2 / a - (c - 1))), rho = 1 / (k + 1)
    rho = F.try_divide(F.try_divide(spread, var) - (F.col("c") - 1), F.col("a") - F.try_divide(F.col("a2"), F.col("a")) - (F.col("c") - 1))
    k = F.when(rho > 0, 1 / rho - 1).otherwise(F.lit(MOST))
    return tuple(s.select(m, F.least(F.lit(MOST), F.greatest(F.lit(LEAST), F.coalesce(k, F.lit(MOST))))).first())


def judge(pages: DataFrame, rules=RULES, z: float = Z, outcomes: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, bound for every page. outcomes: (page_id, bad 0 or 1) of pages without a rule; of several the worst holds."""
    p = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    p = p.withColumn("rule", rule).withColumn("ruled", verdict)
    bad = (F.col("ruled") == "block").cast("int")
    if outcomes is not None:
        told = outcomes.groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("told"))
        seen = p.join(told, "page_id", "left").select("host", F.coalesce(bad, "told").alias("bad"))
    else:
        seen = p.select("host", bad.alias("bad"))
    hosts = seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    site = F.regexp_replace("host", SITE, "")
    hosts = durable(hosts.select("host", "n", "bad", domain_of(site).alias("domain"), suffix_of(site).alias("suffix")))
    domains = durable(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    suffixes = durable(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))

    def shrunk(groups: DataFrame, prior: Column | None = None) -> tuple[Column, Column]:
        m, k = _strength(groups)
        return (F.col("bad") + k * (F.lit(m) if prior is None else prior)) / (F.col("n") + k), F.col("n") + k

    s = suffixes.select("suffix", shrunk(suffixes)[0].alias("of_suffix"))
    d = domains.join(s, "suffix").select("domain", shrunk(domains, F.col("of_suffix"))[0].alias("of_domain"))
    mean, a = shrunk(hosts, F.col("of_domain"))
    h = hosts.join(d, "domain").select(F.col("host").alias("of"), mean.alias("mean"), a.alias("a"))
    h = durable(h.select("of", (F.col("mean") - F.lit(z) * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("a") + 1))).alias("bound")))
    out = p.join(h, F.col("host") == F.col("of"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("bound") > 0.5, "block").otherwise("allow")).alias("verdict"), "bound")


def _oracle() -> str:
    case = lambda what: "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v if what else h + p}'" for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))) + " END"
    strength = lambda t: f"""(SELECT m, least({MOST}, greatest({LEAST}, coalesce(CASE WHEN rho > 0 THEN 1 / rho - 1 ELSE {MOST} END, {MOST}))) AS k FROM (
      SELECT m, ((q - a * m * m) / nullif(m * (1 - m), 0) - (c - 1)) / nullif(a - a2 / nullif(a, 0) - (c - 1), 0) AS rho FROM (
      SELECT *, coalesce(b / nullif(a, 0), 0.0) AS m FROM (SELECT sum(bad)::DOUBLE AS b, sum(n)::DOUBLE AS a, sum(n::DOUBLE * n) AS a2, sum(bad::DOUBLE * bad / n) AS q, count(*)::DOUBLE AS c FROM {t} WHERE n > 0))))"""  # noqa: E731
    return rf"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
p AS (SELECT *, {case(0)} AS rule, {case(1)} AS v FROM u),
g0 AS (SELECT host, count(v) AS n, count(*) FILTER (v = 'block') AS bad, regexp_replace(host, '{SITE}', '', 'g') AS site FROM p GROUP BY host),
h0 AS (SELECT host, n, bad, CASE WHEN regexp_matches(site, '{ADDRESS}') THEN site ELSE regexp_extract(site, '(?:^|\.)({_SUFFIX})\z', 1) END AS suffix,
              CASE WHEN regexp_matches(site, '{ADDRESS}') OR NOT regexp_matches(site, '(?:^|\.)([^.]+\.{_SUFFIX})\z') THEN site ELSE regexp_extract(site, '(?:^|\.)([^.]+\.{_SUFFIX})\z', 1) END AS domain FROM g0),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h0 GROUP BY ALL),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d0 GROUP BY ALL),
s AS (SELECT suffix, (bad + k * m) / (n + k) AS ps FROM s0, {strength("s0")}),
d AS (SELECT domain, (bad + k * ps) / (n + k) AS pd FROM d0 JOIN s USING (suffix), {strength("d0")}),
h AS (SELECT host, n + k AS a, (bad + k * pd) / (n + k) AS ph FROM h0 JOIN d USING (domain), {strength("h0")})
SELECT page_id, p.host, path, rule, coalesce(v, CASE WHEN ph - {Z} * sqrt(ph * (1 - ph) / (a + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN h ON p.host = h.host
"""


ORACLE = _oracle()
