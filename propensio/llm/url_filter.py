"""URL filter: fixed rules first, then an empirical-Bayes reputation of the host.

Labelled page outcomes (1 bad, 0 good) are counted per host. The bad rate of each
registered domain is shrunk towards its suffix, and the host's towards its domain:
at each level the children of all parents give one beta-binomial strength (method of
moments), a child's prior is Beta(strength * parent mean, strength * (1 - parent mean)). A
page that no rule fits is blocked when the lower posterior bound of its host's bad
rate, mean - z * sd, exceeds ``max_bad``; hosts never seen take their domain's or suffix's prior.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#``
or the end. Null urls and urls without ``://`` have both empty; they match no rule and
share one empty host. The registered domain is the last two labels (three when the last two are in
``multi_suffixes``), the suffix is the rest of the domain after its first label; for ports and
user names nothing is special. Null outcomes are ignored, repeated rows count each time, empty
tables give empty results. All shuffles carry partial counts or page keys; html is never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensio.session import materialize

#: (host suffix, path prefix, verdict)
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
MULTI_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz", "co.za", "com.cn")
Z, MAX_BAD = 1.645, 0.5


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` and ``path``."""
    at = F.locate("://", F.col(url_col))
    rest = F.when(at > 0, F.expr(f"substring(`{url_col}`, locate('://', `{url_col}`) + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).withColumn("path", path)


def with_rule(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Add ``rule`` (host and path of the longest rule that fits, else null) and ``rule_verdict``."""
    ordered = sorted(RULES if rules is None else rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in reversed(ordered):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def with_domain(hosts: DataFrame, multi_suffixes: tuple[str, ...] = MULTI_SUFFIXES) -> DataFrame:
    """Add ``domain`` and ``suffix`` of ``host``."""
    two = F.substring_index("host", ".", -2)
    domain = F.when(two.isin(list(multi_suffixes)), F.substring_index("host", ".", -3)).otherwise(two)
    out = hosts.withColumn("domain", domain)
    return out.withColumn("suffix", F.when(F.instr("domain", ".") > 0, F.expr("substring(domain, instr(domain, '.') + 1)")).otherwise(F.col("domain")))


def _strength(children: DataFrame) -> DataFrame:
    """One row ``s``: beta-binomial strength of children (bad, n) about their parent mean ``m``.

    E[(bad/n - m)^2] = m (1 - m) (1/n + (1 - 1/n) / (1 + s)) summed with weights n; s is kept in 1 .. 10,000.
    """
    sums = children.where("n > 0 and m > 0 and m < 1").agg(
        F.sum(F.expr("n * (bad / n - m) * (bad / n - m)")).alias("d"),
        F.sum(F.expr("m * (1 - m)")).alias("v1"),
        F.sum(F.expr("m * (1 - m) * (n - 1)")).alias("vn"),
    )
    rho = F.expr("(d - v1) / nullif(vn, 0D)")
    return sums.select(F.coalesce(F.greatest(F.lit(1.0), F.least(F.lit(10000.0), F.when(rho > 0, 1 / rho - 1).otherwise(10000.0))), F.lit(10.0)).alias("s"))


def host_reputation(outcomes: DataFrame, hosts: DataFrame, multi_suffixes: tuple[str, ...] = MULTI_SUFFIXES) -> DataFrame:
    """``host, n, mean, lower`` of every host in ``hosts``.

    ``outcomes`` has ``host`` and ``bad`` (0, 1 or null), one row per labelled page.
    """
    counted = outcomes.where("bad in (0, 1)").groupBy("host").agg(F.sum("bad").cast("double").alias("bad"), F.count("*").cast("double").alias("n"))
    known = with_domain(hosts.select("host").distinct().join(counted, "host", "left").na.fill(0.0, ["bad", "n"]), multi_suffixes)
    # every level is read several times (sums, strength, posterior), so it is written once
    known = materialize(known, "hosts")
    domains = materialize(known.groupBy("suffix", "domain").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    whole = suffixes.agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("m"))
    with_m = materialize(suffixes.crossJoin(F.broadcast(whole)), "suffixes")  # one row beside each
    suffixes = with_m.crossJoin(F.broadcast(_strength(with_m))).select("suffix", F.expr("(bad + s * m) / (n + s)").alias("m"))
    with_m = materialize(domains.join(suffixes, "suffix"), "domain-priors")
    domains = with_m.crossJoin(F.broadcast(_strength(with_m))).select("domain", F.expr("(bad + s * m) / (n + s)").alias("m"))
    with_m = materialize(known.join(domains, "domain"), "host-priors")
    post = with_m.crossJoin(F.broadcast(_strength(with_m))).withColumn("a", F.expr("bad + s * m")).withColumn("b", F.expr("n - bad + s * (1 - m)"))
    mean = F.expr("a / (a + b)")
    return post.select("host", "n", mean.alias("mean"), (mean - Z * F.sqrt(mean * (1 - mean) / (F.col("a") + F.col("b") + 1))).alias("lower"))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]] | None = None, max_bad: float = MAX_BAD,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """Per page: id, host, path, rule, verdict and the reputation columns.

    ``outcomes``: ``id_col`` and ``bad`` (1 bad, 0 good). Its repeated rows for one page count each time.
    """
    thin = with_rule(with_host_and_path(pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))), rules).drop("url")
    thin = materialize(thin, "page-hosts")
    labelled = thin.join(outcomes.select(F.col(id_col).alias("id"), F.col("bad").cast("int").alias("bad")), "id").select("host", "bad")
    reputation = host_reputation(labelled, thin)
    verdict = F.coalesce("rule_verdict", F.when(F.col("lower") > max_bad, "block").otherwise("allow"))
    return thin.join(reputation, "host", "left").select(
        F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), F.round("mean", 6).alias("bad_rate"), F.round("lower", 6).alias("bad_rate_low")
    )
