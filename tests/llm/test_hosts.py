import re
import string
from collections import Counter, defaultdict

import pytest

from gaugeworks.llm import hosts

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
URLS = [
    (1, "https://a.org/x", None), (2, "HTTPS://Sub.EXAMPLE.org/es/1?q=/en/", ""), (3, "http://example.org/en/1", None), (4, "http://example.org/en/12#x", None),
    (5, "http://badexample.org/es/", None), (6, "http://shop.com/fr/a", '<a href="http://x.net/p">x</a><a HREF=//y.net>y</a><a href="/rel">r</a>'),
    (7, "http://spam.com/de/", '<a href="http://x.net/">x</a>'), (8, "http://x.net/", '<a href="https://spam.com/de/">bad</a>'), (9, "http://y.net", "<a href='http://spam.com'>s</a>"),
    (10, None, "<a href='http://spam.com'>s</a>"), (11, "no scheme/org/", None), (12, "http://org/", None), (13, "http://a.org", None), (14, "x://y://z.org/fr", None),
    (15, "http://w.net\n/fr/", None), (1, "https://a.org/x", None), (None, "http://shop.com/en/", None), (16, "http://spam.com/en/", None), (17, "http://com/fr/", None), (18, "http://z.net", "<a href='http://spam.com'>s</a>"),
]


def brute(rows):
    parsed = []
    for i, url, html in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        h, p = (m[1].translate(LOW), m[2]) if m else ("", "")
        best = max(((len(n + s), n + s, v) for v, n, s in hosts.RULES if (h == n or h.endswith("." + n)) and p.startswith(s)), default=(0, None, None))
        links = [(x if "://" in x else "http:" + x) for x in re.findall(hosts.LINK, html or "")]
        parsed.append((i, h, p, best[1], best[2], [re.match(r"(?s).*?://([^/?#]*)", x)[1].translate(LOW) for x in links if "://" in x]))
    edges, good, bad = Counter(), Counter(), Counter()
    for _, h, _, _, v, to in parsed:
        edges.update((h, t) for t in to if h and t and t != h)
        if v and h:
            (good if v == "allow" else bad)[h] += 1
    seed = {h: (good[h] / (good[h] + bad[h]), bad[h] / (good[h] + bad[h])) for h in good | bad}
    out, into = Counter(), Counter()
    for (a, b), w in edges.items():
        out[a] += w
        into[b] += w
    rank, d = dict(seed), hosts.DAMPING
    for _ in range(200):
        new = defaultdict(lambda: [0.0, 0.0])
        for h, (t, x) in seed.items():
            new[h][0] += t * (1 - d)
            new[h][1] += x * (1 - d)
        for (a, b), w in edges.items():
            if a in rank:
                new[b][0] += rank[a][0] * w / out[a] * d
            if b in rank:
                new[a][1] += rank[b][1] * w / into[b] * d
        rank = {h: tuple(v) for h, v in new.items()}
    result = []
    for i, h, p, rule, verdict, _ in parsed:
        t, x = rank.get(h, (0, 0))
        result.append((i, h, p, rule, verdict or ("block" if bad[h] and not good[h] or x > 0 and x >= hosts.THRESHOLD * (t + x) else "allow"), t, x))
    return result


def test_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, h, "clash") for i, u, h in URLS], "page_id long, url string, html string, host string")
    found = sorted((tuple(r) for r in hosts.judged(pages).collect()), key=str)
    expected = sorted(brute(URLS), key=str)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    assert [r[5:] for r in found] == [pytest.approx(r[5:], rel=1e-4, abs=1e-7) for r in expected]
    verdicts = {r[0]: r[4] for r in found}
    assert verdicts[16] == verdicts[18] == "block" and verdicts[11] == "allow"


def check(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = {r.page_id: r for r in hosts.judged(pages, still=1e-2).collect()}
    assert {i: r.verdict for i, r in found.items()} == {r[0]: r[4] for r in brute(rows)}
    return found


def test_a_chain_of_hosts_towards_a_blocked_seed(spark):
    """Thirty hosts, each linking to the next one; the last one has a blocked page only."""
    rows = [(i, f"http://h{i}.net/", f"<a href='http://h{i + 1}.net/'>x</a>") for i in range(30)] + [(30, "http://h30.net/", "<a href='http://bad.com/'>x</a>"), (31, "http://bad.com/de/", "")]
    found = check(spark, rows)
    assert all(found[i].verdict == "block" and found[i].distrust > 0 for i in range(32))


def test_one_large_seed_takes_no_distrust_from_others(spark):
    """A blocked host with most of all pages; what links to another blocked host is as suspect as before."""
    rows = [(i, f"http://big.com/de/{i}", "") for i in range(300)] + [(1000, "http://small.com/de/", ""), (1001, "http://fan.net/", "<a href='http://small.com/'>x</a>"),
            (1002, "http://good.org/", "<a href='http://other.net/'>x</a>"), (1003, "http://other.net/", ""), (1004, "http://big.com/", ""), (1005, "http://small.com/", "")]
    found = check(spark, rows)
    assert [found[i].verdict for i in (1001, 1002, 1003, 1004, 1005)] == ["block", "allow", "allow", "block", "block"]


def test_links_in_a_circle_and_a_hub(spark):
    rows = [(i, f"http://c{i}.net/", f"<a href='http://c{(i + 1) % 9}.net/'>x</a><a href='http://hub.com/'>h</a>") for i in range(9)]
    rows += [(100 + i, f"http://m{i}.net/", "<a href='http://hub.com/'>h</a>") for i in range(200)] + [(999, "http://hub.com/de/", "<a href='http://c3.net/'>x</a>"), (998, "http://hub.com/fr/", "")]
    rows += [(997, "http://long.net/", "<a href='http://hub.com/x'>h</a> " * 3000)]
    check(spark, rows)


def test_empty(spark):
    assert hosts.judged(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
