"""URL filters against rules applied one by one, and reputations against the same formulas in plain Python."""

from __future__ import annotations

import math
import random
import re

import pytest

from converge.llm import common, urls


def split(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")


def ruled(host, path, rules):
    fits = []
    for rule, verdict in rules:
        rule_host, _, rest = rule.partition("/")
        if (host == rule_host or host.endswith(f".{rule_host}")) and path.startswith(f"/{rest}"):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def pages(n=600, seed=3):
    r = random.Random(seed)
    names = [f"h{k}" for k in range(9)]
    hosts = [f"{a}.{b}" for a in names for b in ("example.org", "example.com", "example.net", "other.com", "shop.co.uk")] + ["example.org", "org", "notexample.org", "10.0.0.1", "Example.ORG:8080", "user@x.com"]
    made = [f"https://{r.choice(hosts) if r.random() < 0.7 else 'hot.example.com'}/{r.choice(['en', 'es', 'fr', 'de'])}/{r.randrange(30)}{r.choice(['', '?q=http://a/', '#top', '/'])}" for _ in range(n)]
    odd = [None, "", "no scheme", "x://", "http://ORG", "http://org/", "http://a.org?x=/es/", "http://ÀB.org/", "redirect?u=http://b.com/de/1", "http://" + "a." * 5000 + "com/fr/" + "x" * 100_000, "http://line.org/a\nb?c"]
    return list(enumerate([*made, *odd]))


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(pages(), "page_id long, url string")


def test_rules(table):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(table).collect()}
    for i, url in pages():
        host, path = split(url)
        rule, verdict = ruled(host, path, urls.RULES)
        assert got[i][:3] == (host, path, rule) and got[i][3] in (verdict, *(["allow", "block"] if verdict is None else [])), url


def test_many_rules_are_joined_and_say_the_same(table, monkeypatch):
    r = random.Random(1)
    rules = [*urls.RULES, *((f"h{r.randrange(9)}.example.{r.choice(['org', 'com'])}/{r.choice(['en', 'fr', ''])}/{k}", r.choice(["allow", "block"])) for k in range(200))]
    wanted = {i: ruled(*split(u), rules) for i, u in pages()}
    monkeypatch.setattr(common, "HOT_SHARE", 5)
    got = {x.page_id: (x.rule, x.verdict) for x in urls.judged_by_rules(table.select("page_id", urls.host_of(table.url).alias("host"), urls.path_of(table.url).alias("path")), rules).collect()}
    assert got == wanted


def plain_high(hosts):
    """host -> bound, from host -> (n, good)."""

    def names(host):
        bare = re.sub(r":[0-9]*$", "", host.rsplit("@", 1)[-1])
        if re.fullmatch(r"[0-9.]+", bare) or bare.startswith("["):
            return bare, ""
        labels = bare.split(".")
        two = ".".join(labels[-2:])
        return (".".join(labels[-3:]), two) if two in urls.SUFFIXES else (two, labels[-1])

    def summed(children, parent):
        out = {}
        for c, (n, good) in children.items():
            a = out.setdefault(parent[c], [0, 0, 0])
            a[0], a[1], a[2] = a[0] + n, a[1] + good, a[2] + (n > 0)
        return out

    def level(nodes, p, siblings):
        known = [(n, g, p[k]) for k, (n, g) in nodes.items() if n and siblings[k] > 1]
        over = sum(n * (g / n - q) ** 2 - q * (1 - q) for n, g, q in known)
        scale = sum((n - 1) * q * (1 - q) for n, g, q in known)
        m = urls.WEAKEST if not scale else urls.STRONGEST if over <= 0 else round(min(urls.STRONGEST, max(urls.WEAKEST, scale / over - 1)), 6)
        return m, {k: (g + m * p[k]) / (n + m) for k, (n, g) in nodes.items()}

    domain = {h: names(h)[0] for h in hosts}
    suffix = {names(h)[0]: names(h)[1] for h in hosts}
    domains = summed(hosts, domain)
    tops = summed({d: v[:2] for d, v in domains.items()}, suffix)
    n, good = sum(v[0] for v in tops.values()), sum(v[1] for v in tops.values())
    _, top_mean = level({k: v[:2] for k, v in tops.items()}, dict.fromkeys(tops, (good + 1) / (n + 2)), dict.fromkeys(tops, sum(v[0] > 0 for v in tops.values())))
    _, domain_mean = level({k: v[:2] for k, v in domains.items()}, {d: top_mean[suffix[d]] for d in domains}, {d: tops[suffix[d]][2] for d in domains})
    m, mean = level(hosts, {h: domain_mean[domain[h]] for h in hosts}, {h: domains[domain[h]][2] for h in hosts})
    return {h: min(1, mean[h] + urls.DEVIATIONS * math.sqrt(mean[h] * (1 - mean[h]) / (hosts[h][0] + m + 1))) for h in hosts}


@pytest.mark.parametrize("share", [5, 500])
def test_reputations(table, share, monkeypatch):
    monkeypatch.setattr(common, "HOT_SHARE", share)
    hosts = {}
    for _, u in pages():
        host, path = split(u)
        verdict = ruled(host, path, urls.RULES)[1]
        n, good = hosts.get(host, (0, 0))
        hosts[host] = (n + (verdict is not None), good + (verdict == "allow"))
    wanted = plain_high(hosts)
    got = urls.judge(table).collect()
    assert len(got) == len(pages()) and all(abs(r.high - wanted[r.host]) < 1e-9 for r in got)
    assert all(r.verdict == ("block" if wanted[r.host] < urls.LEAST_GOOD else "allow") for r in got if r.rule is None)


def test_hosts_shrink_towards_their_domain(spark):
    good = {"a.good.com": (40, 39), "b.good.com": (40, 38), "a.bad.com": (40, 2), "b.bad.com": (40, 1), "c.bad.com": (1, 1)}
    outcomes = spark.createDataFrame([(f"http://{h}/x", k < g) for h, (n, g) in good.items() for k in range(n)] + [("http://a.bad.com/", None)], "url string, good boolean")
    new = spark.createDataFrame([(1, "http://new.good.com/"), (2, "http://new.bad.com/"), (3, "http://c.bad.com/"), (4, "http://elsewhere.net/")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge(new, rules=(), outcomes=outcomes).collect()}
    assert got == {1: "allow", 2: "block", 3: "block", 4: "allow"}


def test_odd_pages(spark):
    rows = [(None, None, 1), (None, None, 1), (3, "http://a.com/de/x", 2), (3, "http://a.com/de/x", 2), (4, "http://a.com/x", 3)]
    odd = spark.createDataFrame(rows, "page_id long, url string, host long").selectExpr("*", "1 AS _id", "2 AS rule", "3 AS pages", "4 AS high")
    got = sorted(((r.page_id, r.host, r.rule, r.verdict) for r in urls.judge(odd).collect()), key=repr)
    assert got == sorted([(None, "", None, "allow"), (None, "", None, "allow"), (3, "a.com", "com/de/", "block"), (3, "a.com", "com/de/", "block"), (4, "a.com", None, "block")], key=repr)
    assert urls.judge(odd.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge(odd, rules=()).collect()} == {"allow"}
