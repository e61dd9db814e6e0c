import re
from collections import Counter, defaultdict

import pytest

from flowmart.llm import urls

LINK = '<a class="x" href="{}">t</a>'


def split(url):
    if url is None or "://" not in url:
        return "", ""
    host, rest = re.match(r"([^/?#]*)(.*)", url.split("://", 1)[1], re.S).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match("[^?#]*", rest, re.S)[0]


def rule(host, path):
    best = None
    for verdict, text in urls.RULES:
        name, _, tail = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail) and (best is None or len(text) > len(best[1])):
            best = verdict, text
    return best


def rank(edges, seeds, rounds=200):
    total = sum(seeds.values())
    outs = defaultdict(float)
    for (s, _), n in edges.items():
        outs[s] += n
    ranks = dict(seeds)
    for _ in range(rounds if total else 0):
        got = defaultdict(float)
        for (s, d), n in edges.items():
            got[d] += 0.85 * ranks.get(s, 0) * n / outs[s]
        again = 1 - sum(got.values()) / total
        ranks = {h: got.get(h, 0) + seeds.get(h, 0) * again for h in {*got, *seeds}}
    return ranks


def by_hand(pages):
    edges, allowed, blocked = Counter(), Counter(), Counter()
    for _, url, html in pages:
        host, path = split(url)
        for target in re.findall(r'href="(?:https?:)?//([^/?#"]+)', html or ""):
            if host and target.lower() != host:
                edges[host, target.lower()] += 1
        found = rule(host, path)
        if host and found:
            (allowed if found[0] == "allow" else blocked)[host] += 1
    trust, distrust = rank(edges, allowed), rank(Counter({(d, s): n for (s, d), n in edges.items()}), blocked)
    out = []
    for key, url, _ in pages:
        host, path = split(url)
        found, t, d = rule(host, path), trust.get(host, 0), distrust.get(host, 0)
        out.append((str(key), host, path, found and found[1], found[0] if found else ("block" if d > 0 and d >= 0.6 * (t + d) else "allow")))
    return sorted(out, key=str)


PAGES = [
    (1, "http://good.org/a", LINK.format("http://friend.net/x") + LINK.format("/own") + LINK.format("//good.org/y")),
    (2, "https://Friend.NET?q=://x", LINK.format("http://far.net/")), (3, "http://far.net#top", None), (4, "http://bad.com/de/1", "<p>no links</p>"),
    (5, "http://farm.net/x/?y", LINK.format("http://bad.com/de/2") * 5), (6, "http://farm2.net/", LINK.format("https://FARM.net/x")),
    (7, None, LINK.format("http://bad.com/")), (8, "no scheme", ""), (9, "http://a.example.org/es/1", ""), (10, "http://example.org/en/12", ""),
    (11, "http://notexample.org/en/1", ""), (12, "http://org", ""), (13, "http://x.com/fr/", LINK.format("http://lost.net/")), (14, "http://x.com/en/", ""),
    (15, "http://lost.net/", ""), (15, "http://lost.net/", ""), (None, "http:///path", ""), (16, "://h/p\nq", ""), (17, "http://mixed.net/", LINK.format("http://bad.com/") + LINK.format("http://good.org/")),
]


def test_judge_equals_plain_python(spark):
    df = spark.createDataFrame([(*p, "own", "own", 1.0) for p in PAGES], "page_id long, url string, html string, host string, rule string, rank double")
    got = urls.judge(df).collect()
    assert sorted([(str(r.page_id), r.host, r.path, r.rule, r.verdict) for r in got], key=str) == by_hand(PAGES)
    verdict = {r.page_id: r.verdict for r in got}
    assert verdict[5] == verdict[6] == "block" and verdict[2] == verdict[3] == "allow"


def test_rank_of_a_hub(spark):
    edges = {(f"h{i}", "hub"): 1 for i in range(50)} | {("hub", "h0"): 3, ("a", "b"): 1, ("b", "a"): 2}
    seeds = {"h1": 2.0, "a": 1.0}
    df = spark.createDataFrame([(s, d, n) for (s, d), n in edges.items()], "src string, dst string, n long")
    got = {r.host: r["rank"] for r in urls.page_rank(df, spark.createDataFrame(list(seeds.items()), "host string, weight double")).collect()}
    want = {h: v for h, v in rank(edges, seeds).items()}
    assert set(got) == set(want) and all(abs(got[h] - want[h]) < 1e-4 for h in want) and abs(sum(got.values()) - 3) < 1e-6


def test_empty(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_ranks_that_still_change_are_not_taken(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 1)], "src string, dst string, n long").coalesce(1)
    with pytest.raises(RuntimeError):
        urls.page_rank(edges, spark.createDataFrame([("a", 1)], "host string, weight long"), rounds=2)
