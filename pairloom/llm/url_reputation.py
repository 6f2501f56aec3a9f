"""URL filter by empirical-Bayes host reputation, after explicit rules.

Labelled page outcomes are counted per host. A host's rate of good pages is shrunk to the
rate of its registered domain, that to the rate of the public suffix, that to the rate of
all pages: at every level the parent's posterior mean is the mean of a beta prior, whose
strength is fitted to the children's overdispersion (beta-binomial moments). A host is
blocked when even the upper bound of its posterior lies under `min_good`; so a host that is
unknown or rarely seen follows its domain and is kept unless there is proof against it.

Only DataFrame functions are used. Counts are combined before each shuffle, and the rows
of a host that holds a large share of the pages meet its verdict by a bounded broadcast.

Defined cases: a null URL or one without `://` has an empty host and path, and the empty
host is judged like any other. Rules need no labels. Null outcomes are no observation;
several labels of a page count separately; repeated pages are judged separately, and their
outcomes count for each. Without any outcome all hosts have mean 0.5 and are allowed.
Columns of the input other than the id, URL and outcome are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import Scratch, ascii_lower, lookup

TWO_PART_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz")
DEFAULT_STRENGTH = 10.0
STRENGTHS = (1.0, 10_000.0)


def host_of(url: Column) -> Column:
    start = F.locate("://", url)
    rest = F.substring(url, start + 3, F.length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.coalesce(F.when(start > 0, ascii_lower(host)), F.lit(""))


def path_of(url: Column) -> Column:
    start = F.locate("://", url)
    rest = F.substring(url, start + 3, F.length(url))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.when(start > 0, path), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label, or the last two where those form a known suffix."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_PART_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The public suffix and one label more."""
    two = F.substring_index(host, ".", -2)
    return F.when(
        two.isin(*TWO_PART_SUFFIXES), F.substring_index(host, ".", -3)
    ).otherwise(two)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """`(rule, verdict)` of the longest rule `host/path-prefix` that fits; null if none.

    A rule fits its host and every subdomain, if the path starts with the rule's.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        rule_host, _, rest = rule.partition("/")
        rule_host = rule_host.lower()
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        found = F.when(
            fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        ).otherwise(found)
    return found


def _moments(children: DataFrame, parents: DataFrame, key: str) -> float:
    """Prior strength of a level: how little the children's rates differ from the parent's
    beyond binomial noise, from `rho = (sum n (p - m)^2 / m(1 - m) - J) / sum (n - 1)`."""
    parents = parents.select(key, ((F.col("good") + 0.5) / (F.col("n") + 1)).alias("m"))
    p, n, m = F.col("good") / F.col("n"), F.col("n"), F.col("m")
    row = (
        children.filter("n > 0")
        .join(parents, key)
        .agg(
            F.sum(n * (p - m) * (p - m) / (m * (1 - m))).alias("spread"),
            F.count(n).alias("children"),
            F.sum(n - 1).alias("pairs"),
        )
        .first()
    )
    if not row.pairs:
        return DEFAULT_STRENGTH
    rho = (row.spread - row.children) / row.pairs
    strength = 1 / rho - 1 if rho > 0 else STRENGTHS[1]
    return min(max(strength, STRENGTHS[0]), STRENGTHS[1])


def reputation(pages: DataFrame, outcomes: DataFrame, z: float, scratch: Scratch) -> DataFrame:
    """`(host, pages, n, good, mean, lower, upper)` for every host of `pages(id, host)`;
    `outcomes` is `(id, good)` with 0 or 1. `z` is the width of the bound in deviations."""
    labelled = outcomes.filter("id is not null and good is not null").groupBy("id").agg(
        F.count("good").alias("n"), F.sum("good").alias("good")
    )
    hosts = (
        pages.join(labelled, "id", "left")
        .groupBy("host")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        )
        .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
        .withColumn("root", F.lit(0))
    )
    hosts = scratch.write(hosts, "hosts")

    def level(*keys: str) -> DataFrame:
        return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))

    domains, suffixes, root = level("domain", "suffix"), level("suffix", "root"), level("root")

    def shrunk(children: DataFrame, parents: DataFrame, key: str, strength: float) -> DataFrame:
        a = F.col("good") + strength * F.col("prior")
        prior = parents.select(key, F.col("mean").alias("prior"))
        return children.join(prior, key).withColumns(
            {"mean": a / (F.col("n") + strength), "weight": F.col("n") + F.lit(strength)}
        )

    strengths = (
        _moments(suffixes, root, "root"),
        _moments(domains, suffixes, "suffix"),
        _moments(hosts, domains, "domain"),
    )
    top = root.select("root", ((F.col("good") + 1) / (F.col("n") + 2)).alias("mean"))
    by_suffix = shrunk(suffixes, top, "root", strengths[0])
    by_domain = shrunk(domains, by_suffix, "suffix", strengths[1])
    by_host = shrunk(hosts, by_domain, "domain", strengths[2])
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return by_host.select(
        "host",
        "pages",
        "n",
        "good",
        "mean",
        F.greatest(F.col("mean") - z * deviation, F.lit(0.0)).alias("lower"),
        F.least(F.col("mean") + z * deviation, F.lit(1.0)).alias("upper"),
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    min_good: float = 0.5,
    z: float = 1.645,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """`(page_id, host, path, rule, verdict, mean, upper)` for every row of `pages`.

    `outcomes` is `(id, good)`. `rules` are `(host/path-prefix, verdict)`, few enough to
    be written as one expression. Hosts are blocked if `upper < min_good`.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    url = F.col(url_col)
    parts = pages.select(
        F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    known = reputation(parts.select("id", "host"), outcomes, z, scratch)
    known = scratch.write(known, "reputation")
    rule = matched_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("upper") < min_good, "block").otherwise("allow")
    return lookup(parts, known, "host", "pages").withColumn("matched", rule).select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("matched.rule").alias("rule"),
        F.coalesce("matched.verdict", by_method).alias("verdict"),
        "mean",
        "upper",
    )
