"""URL rules and host reputations against plain Python."""

import math
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from starloom.llm import queries, url_filters
from starloom.llm.url_filters import Policy

SF = "/root/testdata/sf0.001"
COLUMNS = ["page_id", "host", "path", "rule", "verdict"]

ODD_URLS = [
    None,
    "",
    "no scheme/at all",
    "http://",
    "http:///en/only-a-path",
    "HTTP://WWW.Example.NET/en/1",
    "http://example.net",
    "http://example.net?x=/en/",
    "http://notexample.net/en/1",
    "http://a.b.example.com/de/9#x",
    "http://example.com/DE/9",
    "http://org/fr/1",
    "http://x.org/fr",
    "http://x.org/fr/?y",
    "http://É.Ñ.org/fr/é",
    "ftp://u:p@host.example.com:8080/de/1",
    "x://a/b://c/d",
    "http://a.net/line\nbreak/1",
    "http://a.net/" + "long/" * 50_000,
]


def split(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not found:
        return "", ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]), found[2]


def ruled(host, path):
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    fits = []
    for rule in rules:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(rule)
    rule = max(fits, key=len, default=None)
    return rule, rules.get(rule)


def bounds(hosts, policy):
    """Lower bound by host from {host: (n, bad)}, level by level with exact sums of rounded terms."""

    def grouped(counts, cut):
        out = {}
        for h, (n, k) in counts.items():
            a, b = out.get(cut(h), (0, 0))
            out[cut(h)] = (a + n, b + k)
        return out

    def level(counts, mean):
        term = lambda x: Fraction(round(x, 9)).limit_denominator(10**9)
        seen = float(sum(term((k - n * mean[g]) ** 2) for g, (n, k) in counts.items()))
        chance = float(sum(term(n * mean[g] * (1 - mean[g])) for g, (n, k) in counts.items()))
        pairs = float(sum(term(n * (n - 1) * mean[g] * (1 - mean[g])) for g, (n, k) in counts.items()))
        share = (seen - chance) / pairs if pairs > 0 else policy.most_correlation
        s = 1 / max(policy.least_correlation, min(policy.most_correlation, share)) - 1
        return {g: (s * mean[g] + k, s * (1 - mean[g]) + n - k) for g, (n, k) in counts.items()}

    real = {h: c for h, c in hosts.items() if h}
    domains = grouped(real, lambda h: ".".join(h.split(".")[-2:]))
    suffixes = grouped(domains, lambda d: d.split(".")[-1])
    n, k = (sum(c[i] for c in suffixes.values()) for i in (0, 1))
    rate = lambda level: {g: a / (a + b) for g, (a, b) in level.items()}
    tops = rate(level(suffixes, dict.fromkeys(suffixes, (k + 1) / (n + 2))))
    middle = rate(level(domains, {d: tops[d.split(".")[-1]] for d in domains}))
    leaves = level(real, {h: middle[".".join(h.split(".")[-2:])] for h in real})
    return {h: a / (a + b) - policy.z * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) for h, (a, b) in leaves.items()}


def test_odd_urls(spark):
    rows = [(i, u, i, "x") for i, u in enumerate(ODD_URLS)] + [(5, ODD_URLS[5], 5, None), (None, "http://q.example.org/en/1", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host long, rule string").withColumn("page", F.col("host")).repartition(3)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = url_filters.judged(pages, url_filters.outcomes(pages, labels, F.col("page_id")))
    got = out.select("page.page_id", "page.url", "host", "path", "rule", "verdict").collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = split(r["url"])
        rule, verdict = ruled(host, path)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), r["page_id"]


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert url_filters.judged(pages, url_filters.outcomes(pages, labels, F.col("page_id"))).count() == 0


@pytest.mark.parametrize("limit", [0.5, 0.2])
def test_reputations_equal_plain_ones(spark, limit):
    """Hosts with no, few and many outcomes; a third of all pages on one host; labels null, repeated and contradicting."""
    rows, marks = [], []
    for i in range(900):
        host = "hot.bad.org" if i % 3 == 0 else f"h{i % 17}.d{i % 5}.{'com' if i % 2 else 'org'}" if i % 50 else ""
        rows.append((i, f"http://{host}/en/{i}"))
        quality = 0 if (i % 3 == 0 and i % 4) or i % 5 == 3 else 1
        if i % 7:
            marks.append((i, quality, None))
        if i % 11 == 0:
            marks += [(i, 1, 1), (i, None, None)]
    marks.append((None, 0, 1))
    rows += rows[:40]
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(4)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    known = {}
    for d, q, t in marks:
        if d is not None and (q is not None or t is not None):
            known[d] = known.get(d, False) or q == 0 or t == 1
    hosts, shown = {}, {(split(u)[0], i) for i, u in rows}
    for h, i in shown:
        n, k = hosts.get(h, (0, 0))
        hosts[h] = (n + (i in known), k + known.get(i, False))
    policy = Policy(limit=limit)
    want = bounds(hosts, policy)
    out = url_filters.judged(pages, url_filters.outcomes(pages, labels, F.col("page_id")), policy=policy).collect()
    assert len(out) == len(rows)
    for r in out:
        n, k = hosts[r["host"]]
        assert (r["n_labelled"], r["n_bad"]) == (n, k)
        if r["host"]:
            assert abs(r["bad_bound"] - want[r["host"]]) < 1e-5
        rule, verdict = ruled(r["host"], r["path"])
        assert r["verdict"] == (verdict or ("block" if r["bad_bound"] > limit else "allow"))
    blocked = {r["host"] for r in out if r["rule"] is None and r["verdict"] == "block"}
    assert "hot.bad.org" in blocked and len(blocked) < len(hosts) / 2


def test_one_bad_page_does_not_block_a_host(spark):
    hosts = spark.createDataFrame([("a.x.com", 1, 1), ("b.x.com", 30, 3), ("c.y.com", 30, 4), ("d.y.com", 200, 190)], "host string, n long, bad long")
    got = {r["host"]: r["bound"] for r in url_filters.reputation(hosts).collect()}
    assert got["a.x.com"] < 0.5 < got["d.y.com"] and got["b.x.com"] < 0.2


def test_query_reads_every_page(spark):
    rows = queries.QUERIES["op11_url_reputation"](spark, SF).collect()
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        host, path = split(pages[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        assert (r["rule"], r["verdict"])[: 2 if r["rule"] else 1] == ruled(host, path)[: 2 if r["rule"] else 1]
