"""URL filters: rules, and the reputation of hosts by empirical Bayes, in DataFrame expressions only.

Reputation is the rate of bad outcomes among a host's labelled pages.  Most hosts have few, so rates are shrunk: the rate of
all pages is the prior mean of the public suffixes, a suffix's posterior mean that of its registered domains, a domain's
that of its hosts.  How strongly each level is held to the one above is estimated from the spread of that level's rates
(moments of the beta-binomial law).  A host is blocked when its rate is bad with confidence: the lower bound of its
posterior exceeds the limit.  A host nobody labelled has its domain's posterior.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footlight.operators.skew import lookup_join
from footlight.session import materialise

# Public suffixes of two labels that are often met; any other suffix is the last label.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.hk",
    "com.mx", "com.sg", "com.tr", "com.tw", "gov.au", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk",
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a URL; both empty where it is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does.  ``rules`` are (verdict, ``host/path``) pairs.

    A rule fits its host and all subdomains when the path starts with its path.  Equal lengths: the first listed.
    """
    fitting = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        its_host, slash, its_path = rule.partition("/")
        own = (host == its_host) | host.endswith(f".{its_host}")
        fitting.append((own & path.startswith(slash + its_path), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for fits, found in reversed(fitting):
        out = F.when(fits, found).otherwise(out)
    return out


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    """Public suffix and registered domain of a host; addresses in digits and single labels are their own."""
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    labels = F.split(bare, r"\.")
    n = F.size(labels)
    two = F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), ".")
    width = F.when(two.isin(*TWO_LABEL_SUFFIXES), 2).otherwise(1)
    take = lambda k: F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), k), ".")
    address = bare.rlike(r"^[0-9]+(\.[0-9]+){3}$") | bare.startswith("[")
    return F.when(address, bare).otherwise(take(width)), F.when(address, bare).otherwise(take(width + F.lit(1)))


def _shrunk(level: DataFrame) -> DataFrame:
    """Adds posterior ``a`` and ``b`` to (.., n, bad, prior), ``prior`` being the mean expected from the level above.

    The correlation of outcomes inside an entity, 1 / (strength + 1), comes from the weighted squared deviations of the rates
    from their priors beyond what chance explains; it is held between 0.001 and 0.9.
    """
    spread = F.col("prior") * (1 - F.col("prior"))
    some = (F.col("n") > 0) & (spread > 0)
    beyond = F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2) / spread - 1 / F.col("n")
    x, y = level.agg(F.sum(F.when(some, F.col("n") * beyond)), F.sum(F.when(some, F.col("n") - 1))).first()
    strength = 1 / min(max(x / y if x is not None and y else 0.001, 0.001), 0.9) - 1
    a = F.lit(strength) * F.col("prior") + F.col("bad")
    b = F.lit(strength) * (1 - F.col("prior")) + F.col("n") - F.col("bad")
    return level.withColumns({"a": a, "b": b})


def reputations(pages: DataFrame, z: float = 1.645) -> DataFrame:
    """(host, n_pages, n, bad, rate, low) from (host, bad): posterior mean and lower bound of the rate of bad outcomes.

    ``bad`` is 1, 0 or null (not labelled).  Counts are combined before they are shuffled, so hot hosts are one row.
    """
    counts = pages.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    suffix, domain = suffix_and_domain(F.col("host"))
    hosts = materialise(counts.withColumns({"suffix": suffix, "domain": domain}), "hosts")

    def rolled(table: DataFrame, *keys: str) -> DataFrame:
        return table.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("members"))

    domains = materialise(rolled(hosts, "suffix", "domain"), "domains")
    suffixes = rolled(domains, "suffix")
    # A clean or empty table still has a rate between 0 and 1.
    bad, n = domains.agg(F.sum("bad"), F.sum("n")).first()
    overall = ((bad or 0) + 0.5) / ((n or 0) + 1.0)
    mean = F.col("a") / (F.col("a") + F.col("b"))
    suffixes = _shrunk(suffixes.withColumn("prior", F.lit(overall))).select("suffix", mean.alias("prior"), F.col("members").alias("m"))
    suffixes = materialise(suffixes, "suffix_rates")
    domains = _shrunk(materialise(lookup_join(domains, suffixes, ["suffix"], weight="m"), "domain_counts"))
    domains = materialise(domains.select("domain", mean.alias("prior"), F.col("members").alias("m")), "domain_rates")
    hosts = _shrunk(materialise(lookup_join(hosts, domains, ["domain"], weight="m"), "host_counts"))
    total = F.col("a") + F.col("b")
    deviation = F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))
    return hosts.select("host", "n_pages", "n", "bad", mean.alias("rate"), F.greatest(mean - z * deviation, F.lit(0.0)).alias("low"))


def judge_pages(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]],
    id_column: str = "page_id",
    url_column: str = "url",
    limit: float = 0.5,
    z: float = 1.645,
) -> DataFrame:
    """(<id>, host, path, rule, verdict, rate, low) for every row of ``pages``.

    The rule decides where one fits; elsewhere the page is blocked when the bound ``low`` of its host exceeds ``limit``.
    ``outcomes`` holds (id, bad) of the labelled rows, ``id`` being the first number of the path, the document that a page shows;
    repeated ids count as bad if any row does.  Rows with null, broken or repeated URLs are judged like all others.
    """
    host, path = host_and_path(F.col(url_column).cast("string"))
    rows = pages.select(F.col(id_column).alias("page"), host.alias("host"), path.alias("path"))
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]+)', 1) as bigint)")
    known = outcomes.dropna(subset=["id", "bad"]).groupBy("id").agg(F.max("bad").cast("long").alias("bad"))
    rows = rows.withColumn("id", number)
    weights = rows.where(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    known = materialise(known.join(weights, "id"), "outcomes")
    labelled = materialise(lookup_join(rows, known, ["id"], weight="n").drop("id", "n"), "labelled_pages")
    found = materialise(reputations(labelled.select("host", "bad"), z).select("host", "rate", "low", F.col("n_pages").alias("w")), "reputations")
    judged = lookup_join(labelled.drop("bad"), found, ["host"], weight="w")
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("low") > limit, "block").otherwise("allow")
    return judged.withColumn("_r", rule).select(
        F.col("page").alias(id_column), "host", "path", F.col("_r.rule").alias("rule"), F.coalesce("_r.verdict", own).alias("verdict"), "rate", "low"
    )
