import math

from pyspark.sql import functions as F

from parcelmart.llm.hosts import domain_and_suffix, reputations, symbol_heavy, url_verdicts
from parcelmart.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, bad int"


def cut(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = min((rest.split(c)[0] for c in "/?#"), key=len)
    path = rest[len(host):]
    path = min((path.split(c)[0] for c in "?#"), key=len)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = []
    for rule, verdict in URL_RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = ["http://A.Example.ORG/es/1?x#y", "https://example.org/en/12", "https://example.org/en/2", "ftp://x.com/fr/", "http://x.com/de/a#b",
        "http://badorg/es/", "http://org/", "http://org", "no scheme/com/de/", None, "", "://", "http://", "http://h.net?q=/com/de/",
        "http://É.Com/de/1", "http://a.net/x://b.org/es/", "http://u@h.co.uk:80/p/", "http://x.com#/de/", "http://notexample.org/es/"]


def test_parts_and_rules(spark):
    rows = [(i, u, 0) for i, u in enumerate(URLS)] + [(0, URLS[0], 0), (None, "http://q.net/a", None)]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS host", "1 AS n", "2 AS mean")
    got = url_verdicts(pages, F.col("bad"), URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = cut(dict((i, u) for i, u, _ in rows)[r.page_id])
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")


def test_posterior_by_hand(spark):
    counts = {"a.bad.net": (40, 39), "b.bad.net": (1, 1), "c.good.net": (50, 1), "d.good.net": (1, 1), "x.one.org": (30, 3), "y.two.org": (20, 18)}
    rows = [(h, int(i < bad)) for h, (n, bad) in counts.items() for i in range(n)]
    got = {r.host: r for r in reputations(spark.createDataFrame(rows + [("a.bad.net", None)], "host string, bad int")).collect()}

    def level(groups):
        spread = sum(n * (b / n - p) ** 2 for n, b, p in groups.values())
        rho = (spread - sum(p * (1 - p) for _, _, p in groups.values())) / sum((n - 1) * p * (1 - p) for n, _, p in groups.values())
        k = 1 / min(max(rho, 0.01), 0.9) - 1
        return {g: (b + p * k, n - b + (1 - p) * k) for g, (n, b, p) in groups.items()}

    def pool(up, prior):
        out = {}
        for h, (n, b) in counts.items():
            was = out.get(up(h), (0, 0, 0))
            out[up(h)] = (was[0] + n, was[1] + b, prior(h))
        return out

    total = (sum(b for _, b in counts.values()) + 1) / (sum(n for n, _ in counts.values()) + 2)
    mean = lambda ab: ab[0] / sum(ab)
    suffixes = level(pool(lambda h: h.split(".")[-1], lambda h: total))
    domains = level(pool(lambda h: h.split(".", 1)[1], lambda h: mean(suffixes[h.split(".")[-1]])))
    hosts = level(pool(lambda h: h, lambda h: mean(domains[h.split(".", 1)[1]])))
    for h, (a, b) in hosts.items():
        lower = a / (a + b) - 1.64 * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
        assert abs(got[h].lower - lower) < 1e-9 and got[h].blocked == (lower > 0.5)
    assert got["a.bad.net"].blocked and got["b.bad.net"].mean > got["d.good.net"].mean and not got["d.good.net"].blocked


def test_suffixes_outcomes_and_empty_tables(spark):
    one = spark.createDataFrame([("a.b.co.uk", "<p a='##'>## word</p>"), ("host", "<b>plain</b> text"), ("", None)], "h string, t string")
    domain, suffix = domain_and_suffix(F.col("h"))
    assert [tuple(r) for r in one.select(domain, suffix, symbol_heavy(F.col("t"))).collect()] == [
        ("b.co.uk", "co.uk", 1), ("host", "host", 0), ("", "", None)]
    assert url_verdicts(spark.createDataFrame([], SCHEMA), F.col("bad"), URL_RULES).collect() == []
    blind = spark.createDataFrame([(1, "http://a.net/", None)], SCHEMA)
    assert [r.verdict for r in url_verdicts(blind, F.col("bad"), URL_RULES).collect()] == ["allow"]
