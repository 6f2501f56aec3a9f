import math

import pytest
from pyspark.sql import functions as F

from pairloom.llm import queries, url_reputation as urls
from tests.llm.helpers import rows_of

SCHEMA = "page_id long, url string, html string, host string, id int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "clash", 0) for r in rows], SCHEMA).repartition(3)


def outcomes(spark, rows):
    return spark.createDataFrame(rows, "id long, good long")


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:cut], rest[cut:]
    cut = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path[:cut]


URLS = [
    "http://A.Example.com/en/7?x#y", "https://example.com", "https://b.example.com/en/70", "ftp://x/y",
    "http://org/es/", "http://a.org/es/1", "http://forg/es/1", "no scheme", "", None, "://", "http://?q",
    "http://ÄB.net/de/8", "http://example.net/de/81#a", "http://example.net/de", "http://u@h:80/p?q/r#s",
    "a://b://c/d", "http://x.com/\nen/", "HTTP://EXAMPLE.COM/EN/7", "http://com/en/", "http://a.b.co.uk/p",
]


def test_parts_and_rules(spark):
    table = pages(spark, list(enumerate(URLS)))
    found = urls.judge_urls(table, outcomes(spark, []), queries.URL_RULES)
    rules = sorted(queries.URL_RULES, key=lambda r: -len(r[0]))
    wanted = []
    for i, url in enumerate(URLS):
        host, path = split(url)
        fits = [
            (r, v) for r, v in rules
            for h, p in [r.split("/", 1)]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)
        ]
        rule, verdict = fits[0] if fits else (None, "allow")
        wanted.append((i, host, path, rule, verdict))
    assert rows_of(found, "page_id", "host", "path", "rule", "verdict") == wanted


def test_registered_domain_and_suffix(spark):
    hosts = ["a.b.example.com", "example.com", "com", "x.co.uk", "y.x.co.uk", "co.uk", ""]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    found = df.select(urls.domain_of(F.col("h")), urls.suffix_of(F.col("h"))).collect()
    assert [tuple(r) for r in found] == [
        ("example.com", "com"), ("example.com", "com"), ("com", "com"),
        ("x.co.uk", "co.uk"), ("x.co.uk", "co.uk"), ("co.uk", "co.uk"), ("", ""),
    ]


def labelled(spark):
    """A bad host among good ones of its domain, a bad domain, and hosts without labels."""
    rows, marks = [], []

    def add(host, n, good, labels=True):
        for k in range(n):
            rows.append((len(rows), f"http://{host}/{k}"))
            if labels:
                marks.append((len(rows) - 1, int(k < good)))

    add("good.site.com", 60, 57)
    add("fine.site.com", 40, 38)
    add("bad.site.com", 40, 1)
    for k in range(6):
        add(f"h{k}.spam.net", 20, 0)
    add("new.spam.net", 3, 0, labels=False)
    add("new.site.com", 3, 0, labels=False)
    add("once.site.com", 1, 0)
    return rows, marks


def test_hosts_are_blocked_on_proof_only(spark):
    rows, marks = labelled(spark)
    found = urls.judge_urls(pages(spark, rows), outcomes(spark, marks))
    verdicts = dict(found.select("host", "verdict").distinct().collect())
    assert verdicts == {
        "good.site.com": "allow", "fine.site.com": "allow", "bad.site.com": "block",
        **{f"h{k}.spam.net": "block" for k in range(6)},
        "new.spam.net": "block", "new.site.com": "allow", "once.site.com": "allow",
    }


def brute_force(rows, marks, z):
    hosts, host_of = {}, {}
    for i, url in rows:
        host_of[i] = host = split(url)[0]
        hosts.setdefault(host, [0, 0])
    for i, good in marks:
        hosts[host_of[i]][0] += 1
        hosts[host_of[i]][1] += good
    up = {h: ".".join(h.split(".")[-2:]) for h in hosts}
    domains, suffixes = {}, {}
    for h, (n, k) in hosts.items():
        for table, key in ((domains, up[h]), (suffixes, up[h].split(".")[-1])):
            a, b = table.get(key, (0, 0))
            table[key] = (a + n, b + k)
    root = (sum(n for n, _ in hosts.values()), sum(k for _, k in hosts.values()))

    def strength(children, parent_of):
        spread = pairs = count = 0
        for c, (n, k) in children.items():
            if n:
                pn, pk = parent_of(c)
                m = (pk + 0.5) / (pn + 1)
                spread += n * (k / n - m) ** 2 / (m * (1 - m))
                pairs, count = pairs + n - 1, count + 1
        rho = (spread - count) / pairs
        return min(max(1 / rho - 1 if rho > 0 else 1e4, 1), 1e4)

    suffix = lambda d: d.split(".")[-1]
    s0 = strength(suffixes, lambda s: root)
    s1 = strength(domains, lambda d: suffixes[suffix(d)])
    s2 = strength(hosts, lambda h: domains[up[h]])
    shrink = lambda row, s, prior: (row[1] + s * prior) / (row[0] + s)
    top = (root[1] + 1) / (root[0] + 2)
    by_suffix = {s: shrink(r, s0, top) for s, r in suffixes.items()}
    by_domain = {d: shrink(r, s1, by_suffix[suffix(d)]) for d, r in domains.items()}
    out = {}
    for h, row in hosts.items():
        m = shrink(row, s2, by_domain[up[h]])
        out[h] = (m, min(m + z * math.sqrt(m * (1 - m) / (row[0] + s2 + 1)), 1))
    return out


def test_posteriors_equal_brute_force(spark):
    rows, marks = labelled(spark)
    found = urls.judge_urls(pages(spark, rows), outcomes(spark, marks)).select("host", "mean", "upper")
    wanted = brute_force(rows, marks, 1.645)
    for host, mean, upper in found.distinct().collect():
        assert (mean, upper) == pytest.approx(wanted[host], rel=1e-9)


def test_awkward_tables(spark):
    table = pages(spark, [(1, "http://a.com/x"), (1, "http://a.com/x"), (None, None), (2, "http://b.com")])
    marks = outcomes(spark, [(1, None), (None, 1), (1, 0), (1, 1), (9, 1)])
    found = urls.judge_urls(table, marks)
    assert rows_of(found, "page_id", "verdict") == [
        (1, "allow"), (1, "allow"), (2, "allow"), (None, "allow"),
    ]
    assert urls.judge_urls(table.limit(0), marks).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.op2_url_reputation(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
