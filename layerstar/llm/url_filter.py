"""URL rules and empirical-Bayes host reputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerstar.llm.common import stage

#: A host is blocked when its rate of bad outcomes is above MAX_BAD with a certainty of Z
#: standard deviations (1.645: 95 %).
MAX_BAD, Z = 0.25, 1.645
#: Bounds of the correlation of outcomes inside a group; a prior weighs as much as
#: 1 / correlation - 1 outcomes.
LEAST_RHO, MOST_RHO = 0.001, 0.5

LEVELS = ("suffix", "domain", "host")

#: Suffixes of two labels below which sites are registered, the common ones of the
#: public list (fixed values); others can be given.
SUFFIXES = ("ac.jp", "ac.uk", "co.id", "co.il", "co.in", "co.jp", "co.kr", "co.nz", "co.th", "co.uk", "co.za", "com.ar", "com.au",
            "com.br", "com.cn", "com.co", "com.hk", "com.mx", "com.my", "com.pl", "com.sg", "com.tr", "com.tw", "com.ua",
            "edu.au", "edu.cn", "go.jp", "gov.au", "gov.br", "gov.uk", "ne.jp", "net.au", "net.br", "net.cn", "or.jp",
            "or.kr", "org.au", "org.br", "org.cn", "org.nz", "org.uk", "org.za")
#: The suffix of numeric addresses, which have no labels; no host can hold a ``#``.
ADDRESS = "#address"


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest fitting rule, NULL without one.

    A rule such as ``example.com/en/`` fits its host and all subdomains where the
    path starts with the rule's.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def suffix_and_domain(host: Column, suffixes: Sequence[str] = SUFFIXES) -> list[Column]:
    """Suffix and registered domain of a host, without user part, port and final dots.

    The suffix is the last label, or the last two where they are one of
    ``suffixes``; the domain has one label more.  A numeric address is a domain of its
    own below ADDRESS.
    """
    name = F.regexp_replace(F.regexp_replace(F.substring_index(host, "@", -1), r":[0-9]*\z", ""), r"\.+\z", "")
    numeric = name.startswith("[") | name.rlike(r"\A[0-9]{1,3}(\.[0-9]{1,3}){3}\z")
    two = F.substring_index(name, ".", -2)
    wide = two.isin(*suffixes) if suffixes else F.lit(False)
    suffix = F.when(numeric, F.lit(ADDRESS)).when(wide, two).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(numeric, name).when(wide, F.substring_index(name, ".", -3)).otherwise(two)
    return [suffix.alias("suffix"), domain.alias("domain")]


def host_reputation(outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Shrunken bad rates by level from (host, bad).

    Returns (level, name, n, bad, mean, a, b, lower): the counts of each suffix, registered domain
    and host, the posterior mean of its bad rate, the posterior beta's parameters
    and its lower bound at Z standard deviations; level ``all`` (one row) has the
    overall rate.  A suffix is shrunk towards the overall rate, a domain towards
    its suffix's mean, a host towards its domain's.  The weight of each level's
    prior comes from the beta-binomial moments: the spread of the groups' rates
    around their priors beyond what chance alone would give.

    ``unseen`` is the lower bound of a host without outcomes of which this group is
    the nearest that has some: the group's mean less Z standard deviations of the group's
    own rate and of the levels between it and the host together.

    Outcomes are summed per host before they are shuffled.  Rows with a NULL
    ``bad`` are no outcomes; a NULL host counts as the empty one.
    """
    hosts = (outcomes.filter("bad is not null").groupBy(F.coalesce("host", F.lit("")).alias("host"))
             .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col("bad").cast("double")).alias("bad")))
    hosts = stage(hosts.select("host", *suffix_and_domain(F.col("host"), suffixes), "n", "bad"), "host-outcomes")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # one row; without outcomes nothing is known against any host
    overall = total.select(F.lit("all").alias("level"), F.lit("").alias("name"), F.coalesce("n", F.lit(0.0)).alias("n"),
                           F.coalesce("bad", F.lit(0.0)).alias("bad"),
                           F.coalesce(F.col("bad") / F.col("n"), F.lit(0.0)).alias("mean"))
    out, correlations, parents, above = [], [], overall.select("mean"), None
    for level in LEVELS:
        keys = [level] if above is None else [above, level]
        groups = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if above is None:
            prior = groups.withColumn("prior", F.lit(overall.first()["mean"]))
        else:
            prior = groups.join(parents.select(F.col("name").alias(above), F.col("mean").alias("prior")), above)
        # sum of n (r - p)^2 / (p (1 - p)) is expected to be the sum of 1 + (n - 1) rho
        spread = F.col("prior") * (1 - F.col("prior"))
        q = F.sum(F.when(spread > 0, F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2) / spread)
                  .otherwise(F.lit(1.0)))
        moments = prior.agg((q - F.count(F.lit(1))).alias("excess"), F.sum(F.col("n") - 1).alias("pairs")).first()
        rho = (moments["excess"] or 0.0) / moments["pairs"] if moments["pairs"] else 0.0
        rho = min(max(rho, LEAST_RHO), MOST_RHO)
        weight = 1 / rho - 1
        a, b = F.col("bad") + weight * F.col("prior"), F.col("n") - F.col("bad") + weight * (1 - F.col("prior"))
        post = (prior.withColumn("a", a).withColumn("b", b).withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))
                .withColumn("weight", F.lit(weight)))
        post = stage(post.select(F.lit(level).alias("level"), F.col(level).alias("name"), "n", "bad", "mean", "a", "b",
                                 "weight", lower_bound(F.col("a"), F.col("b")).alias("lower")), f"reputation-{level}")
        out.append(post)
        correlations.append(rho)
        parents, above = post, level
    overall = overall.select("*", *[F.lit(None).cast("double").alias(c) for c in ("a", "b", "weight", "lower")])
    result = overall.withColumn("unseen", unseen_bound(F.col("mean"), F.col("n"), correlations))
    for k, post in enumerate(out):
        result = result.unionByName(post.withColumn(
            "unseen", unseen_bound(F.col("mean"), F.col("a") + F.col("b"), correlations[k + 1:])))
    return result


def lower_bound(a: Column, b: Column) -> Column:
    """Lower bound of a beta posterior by its mean and standard deviation."""
    mean = a / (a + b)
    return mean - F.lit(Z) * F.sqrt(mean * (1 - mean) / (a + b + 1))


def unseen_bound(mean: Column, size: Column, correlations: Sequence[float]) -> Column:
    """Lower bound of a rate below a group of this mean and beta size (a + b).

    ``correlations`` are those of the levels in between.  Variances add up: that of the
    group's rate, and at each level the correlation's share of what is left of mean (1 - mean).
    """
    left = F.lit(1.0) - 1 / (size + 1)
    for rho in correlations:
        left = left * F.lit(1 - rho)
    return mean - F.lit(Z) * F.sqrt(mean * (1 - mean) * (1 - left))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id",
               url_col: str = "url", suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Judge every URL: by the longest fitting rule, else by its host's reputation.

    ``outcomes`` is (id_col, bad): 1 for a page known to be bad, 0 for a good
    one.  Returns one row per page: ``id_col``, ``host``, ``path``, ``rule``,
    ``verdict`` (``allow`` or ``block``) and ``lower``, the least bad rate that its
    host's posterior leaves likely.  A host is blocked where that exceeds MAX_BAD.
    ``suffixes`` are those of two labels.  A host without outcomes has the bound that its registered domain leaves a host unseen
    so far, without outcomes there its suffix's, else the overall one.

    A NULL URL or one without ``://`` has an empty host and path.  Pages of a NULL
    id are judged as well; ids that repeat get every outcome of theirs.  Empty
    tables give an empty result, or no reputation.  Other columns are ignored.
    """
    host, path = host_and_path(url_col)
    judged = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    known = outcomes.select(F.col(id_col).alias("_id"), F.col("bad"))
    labelled = judged.select("_id", "host").join(known, "_id").select("host", "bad")
    known = host_reputation(labelled, suffixes)
    # level by level over the distinct hosts: pages are joined once, on their host
    names = judged.select("host").distinct().select("host", *suffix_and_domain(F.col("host"), suffixes))
    for level in LEVELS:
        names = names.join(known.filter(F.col("level") == level).select(
            F.col("name").alias(level), F.col("unseen").alias(f"_{level}")), level, "left")
    overall = known.filter("level = 'all'").first()["unseen"]
    names = names.select("host", F.coalesce("_host", "_domain", "_suffix", F.lit(overall)).alias("lower"))
    names = stage(names, "host-verdicts")
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("lower") > MAX_BAD, F.lit("block")).otherwise(F.lit("allow"))
    return (judged.join(names, "host", "left").withColumn("_rule", rule)
            .select(F.col("_id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"),
                    F.coalesce("_rule.verdict", by_host).alias("verdict"), "lower"))
