"""The template tree against a plain version that grows it in memory."""

import math
import re
from collections import defaultdict

import pytest
from llm_fixtures import SF_DIR  # noqa: F401

from kilnwatt.llm import urls
from kilnwatt.llm.queries import QUERIES


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path, rules):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.name), r.verdict == "block"), default=None)
    return (best.name, best.verdict) if best else (None, None)


def shape(path, depth):
    if not path:
        return ()
    parts = path[1:].split("/")
    named = ["{l}" if len(s) > 64 else re.sub("[0-9]+", "{n}", re.sub("[0-9A-Fa-f-]{16,}", "{h}", s)) for s in parts[:depth]]
    return (*named, "**") if len(parts) > depth else tuple(named)


def grow(rows, level, out, tree):
    """rows: (segments, label, at); out[at] is the template so far."""
    kids = defaultdict(list)
    for r in rows:
        if len(r[0]) > level:
            kids[r[0][level]].append(r)
    if not kids:
        return
    fan, total = len(kids), sum(map(len, kids.values()))
    if fan > tree.children or (fan >= tree.few and total < tree.repeats * fan):
        groups = [("*", list(kids))]
    else:
        stats = {}
        for s, held in kids.items():
            n = len(held)
            following = [r[0][level + 1] if len(r[0]) > level + 1 else None for r in held]
            counts = [sum(r[1] == "block" for r in held), sum(r[1] == "allow" for r in held), sum(f is None for f in following), sum(f is not None and f.startswith("{") for f in following)]
            stats[s] = (*[c / n for c in counts], n)
        order = sorted(kids, key=lambda s: (*stats[s][:4], s))
        members = [[order[0]]]
        for before, s in zip(order, order[1:]):
            bound = (0.5 * math.log(2 / tree.alpha)) ** 0.5 * (1 / math.sqrt(stats[s][4]) + 1 / math.sqrt(stats[before][4]))
            if any(abs(x - y) > bound for x, y in zip(stats[s][:4], stats[before][:4])):
                members.append([])
            members[-1].append(s)
        groups = [("{" + "|".join(sorted(m)) + "}" if len(m) > 1 else m[0], m) for m in members]
    for part, held in groups:
        below = [r for s in held for r in kids[s]]
        for r in below:
            out[r[2]] += "/" + part
        grow(below, level + 1, out, tree)


def brute(pages, rules=urls.RULES, tree=urls.Tree()):
    found = []
    for page_id, url in pages:
        host, path = parsed(url)
        found.append((page_id, host, path, *rule_of(host, path, rules)))
    template = [""] * len(found)
    hosts = defaultdict(list)
    for at, (_, host, path, _, verdict) in enumerate(found):
        hosts[host].append((shape(path, tree.depth), verdict, at))
    for rows in hosts.values():
        grow(rows, 0, template, tree)
    labels = defaultdict(lambda: [0, 0])
    for at, (_, host, _, _, verdict) in enumerate(found):
        if verdict:
            labels[host, template[at]][verdict == "block"] += 1
    out = []
    for at, (page_id, host, path, name, verdict) in enumerate(found):
        allowed, blocked = labels[host, template[at]]
        share = (blocked + tree.weight / 2) / (allowed + blocked + tree.weight)
        out.append((page_id, host, path, name, verdict or ("block" if share >= tree.reject else "allow"), template[at], round(share, 9)))
    return out


def check(df, want):
    got = [(*r[:6], round(r[6], 9)) for r in df.collect()]
    key = lambda r: [(x is None, x) for x in r]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_query(spark):
    sf_dir = SF_DIR.replace("sf0.001", "sf0.01")
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    got = QUERIES["op11_url_filter"](spark, sf_dir)
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    check(got, brute(pages))


ODD = [
    (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.COM"), (6, "x://com/"), (7, "x://a.com?q=/en/"), (8, "x://WWW.Example.COM/en/a#b"),
    (9, "x://m.www.example.com/en/"), (10, "x://notexample.com/en/"), (11, "x://a.net/es/1"), (12, "x://net/fr/"), (13, "x://a.net/es"), (14, "x://É.net/ES/1"),
    (15, "x://deep.org/" + "a/" * 40 + "b"), (16, "x://long.org/" + "y" * 100_000), (None, "x://a.net/fr/2"), (17, "x://a.net/es/1"), (17, "x://a.net/es/1"),
    (18, "a://b://c.com/d"), (19, "x://hex.org/0123456789abcdef0123/1.html"), (20, "x://nl\n.com/a\nb?c"),
]


@pytest.mark.parametrize("tree", [urls.Tree(), urls.Tree(depth=2, children=3, few=2, repeats=1.5, weight=0.5)])
def test_odd_urls(spark, tree):
    """Nulls, no scheme, repeated rows and ids, deep and long paths, variable places, branches alike and not."""
    pages = list(ODD)
    for i in range(60):
        pages.append((100 + i, f"https://shop.example.org/{['news', 'item', 'spam'][i % 3]}/{'abcdefghij'[i % 10] * 3}-title/{i}"))
        pages.append((200 + i, f"https://blog.net/{['es', 'fr', 'es', 'pt'][i % 4]}/{i}"))
        pages.append((300 + i, f"https://blog.net/tags/{chr(97 + i % 26)}{chr(97 + i // 26)}q/x"))
    df = spark.createDataFrame([(i, u, "<html>", "x", "y") for i, u in pages], "page_id long, url string, html string, host string, template string")
    check(urls.judged(df, tree=tree), brute(pages, tree=tree))


def test_rules_alone(spark):
    """Of two rules with one name the block wins; without rules no template is rejected; an empty table has no rows."""
    df = spark.createDataFrame([(1, "x://a.org/b")], "page_id long, url string")
    both = (urls.Rule("allow", "a.org", "/"), urls.Rule("block", "a.org", "/"))
    assert [(r.rule, r.verdict) for r in urls.judged(df, both).collect()] == [("a.org/", "block")]
    assert [(r.rule, r.verdict) for r in urls.judged(df, ()).collect()] == [(None, "allow")]
    assert urls.judged(df.limit(0)).collect() == []


def test_unlabelled_urls_of_a_bad_template(spark):
    """Labels cover some urls of a template; the others follow, and a template of good urls stays."""
    pages = [(i, f"x://h.org/{'bad' if i % 2 else 'good'}/{i}") for i in range(200)]
    rules = [urls.Rule("block", "h.org", f"/bad/{d}") for d in "13579"] + [urls.Rule("allow", "h.org", f"/good/{d}") for d in "2468"]
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judged(spark.createDataFrame(pages, "page_id long, url string"), rules).collect()}
    assert all(got[i][1] == ("block" if i % 2 else "allow") for i, _ in pages)
    assert sum(rule is None for rule, _ in got.values()) > 0
