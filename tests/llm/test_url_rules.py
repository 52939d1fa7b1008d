from __future__ import annotations

import random
import re
import time
from itertools import combinations

import pytest

from creditloom.llm import url_rules

PAGE = "page_id long, url string, html string, host int"


def plain_split(url):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not match:
        return "", ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in match[1])
    return host, match[2]


def plain_rule(host, path):
    best = None
    for kind, own, start in url_rules.RULES:
        if (host == own or host.endswith("." + own)) and path.startswith(start):
            if best is None or len(own + start) > len(best[1]):
                best = (kind, own + start)
    return best


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "http://NET/x", "http://sub.net/",
    "http://example.net/en/1", "https://a.example.net/en/", "http://a.example.net/en", "http://org/fr/",
    "http://x.org/fr/1?q#f", "http://x.org/frx", "http://notexample.com/de/", "http://example.com/de/1",
    "http://EXAMPLE.com/de/", "ftp://É.net/ü", "http://a/b://c.net/", "http://h.net?x://y", "http://h.net#/",
    "http://h.org:80/fr/", "http://u@h.net/\nx",
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, None, 3) for i, u in enumerate(URLS)], PAGE)
    got = {r.page_id: r for r in url_rules.filter_urls(pages).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = plain_split(url)
        rule = plain_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule[1] if rule else None), url
        if rule:
            assert got[i].verdict == rule[0]


def corpus():
    """Seven hosts under five ends; most pages that a rule blocks, and some that no rule
    judges, have a ``/win/prize`` path."""
    urls = []
    for i in range(600):
        end = ["net", "example.net", "example.com", "example.org", "else.com"][i // 4 % 5]
        host, path = f"h{i % 7}.{end}", f"/{['en', 'de', 'fr'][i // 20 % 3]}/"
        rule = plain_rule(host, path)
        spam = i % 6 != 0 if rule and rule[0] == "block" else not rule and i % 2 == 0
        words = "win/prize" if spam else ["good", "news", "blog"][i % 3]
        urls.append(f"http://{host}{path}{words}/{i}" + ("?ref=x" if spam else ""))
    return urls


def tokens_of(spark, urls):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([(i, u, None, 3) for i, u in enumerate(urls)], PAGE)
    url = F.col("url")
    parts = url_rules.tokens(url, url_rules.host_of(url), url_rules.path_of(url))
    found = pages.select("page_id", parts.alias("t")).collect()
    return pages, {r.page_id: r.t for r in found}


def plain_verdicts(rows, support, confidence, hosts):
    """Every combination of up to all tokens, counted outright."""
    known = set(url_rules.restated(url_rules.RULES))
    judged = [(frozenset(tokens) - known, kind, host) for tokens, kind, host in rows if kind]
    total = len(judged)
    count = {}
    for tokens, kind, host in judged:
        for size in range(1, len(tokens) + 1):
            for some in combinations(sorted(tokens), size):
                seen = count.setdefault(some, [0, 0, set()])
                seen[0] += 1
                if kind == "block":
                    seen[1] += 1
                    seen[2].add(host)
    common = {k[0] for k, v in count.items() if len(k) == 1 and v[0] >= url_rules.COMMON * total}
    found = [
        set(k)
        for k, (n, blocked, where) in count.items()
        if blocked >= support * total
        and blocked / n >= confidence
        and len(where) >= hosts
        and not common & set(k)
    ]
    return ["block" if any(r <= set(t) for r in found) else "allow" for t, _, _ in rows]


def check_against_all_combinations(spark, urls, support, confidence, hosts):
    pages, tokens = tokens_of(spark, urls)
    split = [plain_split(u) for u in urls]
    kinds = [plain_rule(*s) for s in split]
    rows = [(tokens[i], k and k[0], split[i][0]) for i, k in enumerate(kinds)]
    want = plain_verdicts(rows, support, confidence, hosts)
    result = url_rules.filter_urls(
        pages, min_support=support, min_confidence=confidence, min_hosts=hosts
    )
    got = {r.page_id: r.verdict for r in result.collect()}
    assert got == {i: k[0] if k else want[i] for i, k in enumerate(kinds)}
    return {got[i] for i, k in enumerate(kinds) if not k}


@pytest.mark.parametrize("support,confidence,hosts", [(0.05, 0.9, 3), (0.02, 0.95, 5), (0.05, 0.9, 99)])
def test_mined_combinations(spark, support, confidence, hosts):
    verdicts = check_against_all_combinations(spark, corpus(), support, confidence, hosts)
    assert verdicts == ({"allow"} if hosts == 99 else {"block", "allow"})


@pytest.mark.parametrize("seed", range(3))
def test_mined_combinations_of_random_urls(spark, seed):
    draw = random.Random(seed)
    urls = []
    for i in range(150):
        host = f"{draw.choice('abc')}.{draw.choice(['net', 'example.com', 'org', 'else.com'])}"
        words = draw.sample(["x", "y", "z", "de", "fr"], draw.randrange(4))
        urls.append(f"http://{host}/{'/'.join(words)}" + draw.choice(["", "?k=1", "?l=2&k=3"]))
    check_against_all_combinations(spark, urls, 0.03, 0.6, 2)


def test_words_that_always_come_together(spark):
    """Thirty words shared by half of the pages are one item, and any of them tells."""
    shared = "/".join(f"w{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(30))
    hosts = [f"h{i % 9}" for i in range(400)]
    urls = [f"http://{h}.net/{shared if i % 2 else 'other'}/x" for i, h in enumerate(hosts)]
    urls += [f"http://{h}.org/fr/{'other'}/y" for h in hosts]
    urls += ["http://new.place/wba/z", "http://new.place/wzz/z"]
    pages = spark.createDataFrame([(i, u, None, 3) for i, u in enumerate(urls)], PAGE)
    start = time.time()
    got = {r.page_id: r.verdict for r in url_rules.filter_urls(pages).collect()}
    assert time.time() - start < 60
    assert [got[len(urls) - 2], got[len(urls) - 1]] == ["block", "allow"]


def test_a_rule_is_not_restated(spark):
    """That all judged .com pages are blocked says nothing of other .com pages."""
    urls = [f"http://{'abcd'[i % 4]}.example.com/de/{i}" for i in range(40)]
    urls += [f"http://{'abcd'[i % 4]}.org/fr/{i}" for i in range(40)]
    urls += [f"http://{'abcd'[i % 4]}.other.com/de/{i}" for i in range(20)]
    pages = spark.createDataFrame([(i, u, None, 3) for i, u in enumerate(urls)], PAGE)
    got = {r.page_id: r.verdict for r in url_rules.filter_urls(pages).collect()}
    assert {got[i] for i in range(80, 100)} == {"allow"}


def test_empty_and_repeated(spark):
    none = spark.createDataFrame([], PAGE)
    assert url_rules.filter_urls(none).collect() == []
    rows = spark.createDataFrame([(1, "http://a.org/x", None, 1)] * 3, PAGE)
    assert [r.verdict for r in url_rules.filter_urls(rows).collect()] == ["allow"] * 3
