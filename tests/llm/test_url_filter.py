import math
import re
from collections import Counter, defaultdict

from brandbook.llm import url_filter as U

RULES = U.RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else (None, None)


def brute(urls, order):
    rows = [(*split(u), *rule_of(*split(u))) for u in urls]
    texts = Counter(((h + p), v) for h, p, _, v in rows)
    counts = {v: [defaultdict(Counter) for _ in range(order + 1)] for v in ("allow", "block")}
    symbols = set()
    grams = lambda t: [(U.START * order + t + U.STOP)[i : i + order + 1] for i in range(len(t) + 1)]
    for (t, v), n in texts.items():
        for g in grams(t):
            symbols.add(g[-1])
            if v:
                for j in range(order + 1):
                    counts[v][j][g[order - j : order]][g[-1]] += n

    def p(v, g):
        q = 1 / len(symbols)
        for j in range(order + 1):
            seen = counts[v][j].get(g[order - j : order])
            if seen:
                q = (seen[g[-1]] + len(seen) * q) / (sum(seen.values()) + len(seen))
        return q

    score = {t: sum(round((math.log(p("allow", g)) - math.log(p("block", g))) * U.SCALE) for g in grams(t)) / (len(t) + 1) for t, _ in texts}
    stat = {}
    for v in ("allow", "block"):
        xs = [(score[t], n) for (t, w), n in texts.items() if w == v]
        total = sum(n for _, n in xs)
        if total:
            mean = sum(x * n for x, n in xs) / total
            stat[v] = mean, max(0, sum(x * x * n for x, n in xs) / total - mean**2) ** 0.5
    cut = 0
    if len(stat) == 2:
        (ma, da), (mr, dr) = stat["allow"], stat["block"]
        cut = round((ma * dr + mr * da) / (da + dr) if da + dr else (ma + mr) / 2, 3)
    return [(h, p, r, v or ("allow" if score[h + p] >= cut else "block")) for h, p, r, v in rows]


URLS = [
    "http://A.Example.com/en/1?x", "https://www.example.com/en/2", "http://www.example.com/fr/", "http://notexample.com/en/", "http://example.com", "ftp://b.net/es/x#y", "http://b.net/fr/", "http://b.net/en/7",
    "http://c.org/en/8/", "no scheme", None, "", "http://", "http:///path", "http://Ünï.ORG/é?q", "http://b.net/en/7", "http://com/x", "https://k.org/" + "long/" * 400, "x://y://z/com/",
]


def test_against_brute_force(spark):
    frame = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    for order in (4, 1):
        got = {r.page_id: tuple(r)[1:5] for r in U.judge(frame, order=order).collect()}
        assert [got[i] for i in range(len(URLS))] == brute(URLS, order)


def test_small_cases(spark):
    frame = spark.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/")], "page_id long, url string")
    assert [r.verdict for r in U.judge(frame).collect()] == ["allow", "allow"]
    assert U.judge(frame.limit(0)).count() == 0


def test_no_python_in_plan(spark):
    frame = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert "Python" not in U.judge(frame)._jdf.queryExecution().toString()
