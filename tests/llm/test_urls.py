"""URL rules and character models against plain Python."""

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import functions as F

from attestra.llm import url_filter as U

ODD = [
    None, "", "no scheme", "http://", "HTTP://EXAMPLE.COM/en/x", "http://a.com", "http://a.com/", "http://a.com?x=/y", "http://com/", "http://xcom/", "https://www.Example.com/en/1?a=://b.net/es/", "http://example.com/EN/1",
    "http://sub.example.com/en/", "http://www.example.com/en", "ftp://b.net/es/#f", "x://b.net/fr/ü/\U0001f600", "://net/fr/", "http://a.b.net/de/" + "long/" * 3000, "http://ÄÖ.com/x", "http://a.com:80/x",
]
SAMPLE = [f"http://h{i % 7}.{d}/{p}/{i * 37 % 101}" for i in range(60) for d, p in (("example.com", "en"), ("www.example.com", "en"), ("shop.net", "fr"), ("shop.org", "fr"), ("x.com", "de"), ("y.org", "en"))]


def parts(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain(urls):
    """host, path, rule and verdict of each url, and its difference."""
    rows = []
    for u in urls:
        host, path = parts(u)
        fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rows.append((host, path, max(fits) if fits else None, host + path if u and "://" in u else u or ""))
    held = [hashlib.md5(t.encode()).hexdigest()[0] in U.HELD for *_, t in rows]
    grams = {"allow": Counter(), "block": Counter()}
    for (*_, best, t), h in zip(rows, held, strict=True):
        if best and not h:
            s = U._EDGE * U.ORDER + t + U._EDGE
            for k in range(U.ORDER, len(s)):
                for n in range(1, U.ORDER + 2):
                    grams[best[2]][s[k + 1 - n : k + 1]] += 1
    after = {v: (Counter(), Counter()) for v in grams}
    for v, own in grams.items():
        for g, n in own.items():
            after[v][0][g[:-1], len(g)] += n
            after[v][1][g[:-1], len(g)] += 1

    def log(v, w):
        p = 1 / U.ALPHABET
        for n in range(1, U.ORDER + 2):
            g = w[-n:]
            total, kinds = after[v][0][g[:-1], n], after[v][1][g[:-1], n]
            if total:
                p = (grams[v][g] + kinds * p) / (total + kinds)
        return math.log(p)

    def difference(t):
        s = U._EDGE * U.ORDER + t + U._EDGE
        each = [round((log("allow", w) - log("block", w)) * 1e6) for w in (s[k : k + U.ORDER + 1] for k in range(len(t) + 1))]
        return sum(each) / len(each) / 1e6

    d = [difference(t) for *_, t in rows]
    bins = Counter((min(max(math.floor(x * U.BINS), -U.REACH), U.REACH), r[2][2]) for x, r, h in zip(d, rows, held, strict=True) if r[2] and h)
    total = {v: sum(n for (_, w), n in bins.items() if w == v) for v in grams}
    cut = 0.0
    if all(total.values()):
        gain = {b: round(sum(n for (c, v), n in bins.items() if v == "block" and c < b) / total["block"] - sum(n for (c, v), n in bins.items() if v == "allow" and c < b) / total["allow"], 9) for b, _ in bins}
        order = sorted(gain)
        middle = {b: (order[k - 1] + 1 + b) / 2 if k else b for k, b in enumerate(order)}
        cut = min((-gain[b], abs(m), m) for b, m in middle.items())[2] / U.BINS
    return [(h, p, b[1] if b else None, b[2] if b else "block" if x < cut else "allow") for (h, p, b, _), x in zip(rows, d, strict=True)], [x - cut for x in d]


def test_against_plain(spark):
    urls = SAMPLE + ODD + ODD[4:8]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r["page_id"]: r for r in U.judge_urls(pages).collect()}
    want, margins = plain(urls)
    assert {i: (r["host"], r["path"], r["rule"], r["verdict"]) for i, r in got.items()} == dict(enumerate(want))
    assert all(abs(got[i]["margin"] - m) < 1e-5 for i, m in enumerate(margins))
    assert {v for _, _, rule, v in want if rule is None} == {"allow", "block"}
    assert all(got[i]["by_rule"] == (w[2] is not None) for i, w in enumerate(want))


def test_learns_what_rules_tell(spark):
    """Of hosts that only differ in words of the path, those like rejected ones are rejected."""
    words = ["win", "bet", "pill"], ["news", "blog", "shop"]
    urls = [f"http://s{i}.net/es/{words[0][i % 3]}/{words[0][i % 2]}{i}" for i in range(150)] + [f"http://s{i}.com/es/{words[1][i % 3]}/{words[1][i % 2]}{i}" for i in range(150)]
    new = [f"http://t{i}.org/es/{w}/{w}{i}" for i in range(20) for w in ("win", "pill", "news", "shop")]
    rows = U.judge_urls(spark.createDataFrame(list(enumerate(urls + new)), "page_id long, url string")).where("rule is null")
    right = rows.select(((F.col("verdict") == "block") == F.col("path").rlike("win|bet|pill")).alias("r")).agg(F.avg(F.col("r").cast("int"))).first()[0]
    assert right > 0.95


def test_rows(spark):
    page = "page_id string, url string, host int, a int"
    rows = U.judge_urls(spark.createDataFrame([("x", "http://a.com/1", 1, 2), ("x", "http://a.com/1", 1, 2), (None, "http://b.org/1", 1, 2)], page)).collect()
    assert sorted((str(r["page_id"]), r["verdict"], r["rule"]) for r in rows) == [("None", "allow", None), ("x", "allow", "com/"), ("x", "allow", "com/")] or len(rows) == 3
    assert {r["verdict"] for r in rows} == {"allow"}
    blocked = U.judge_urls(spark.createDataFrame([("x", "http://a.net/fr/1", 1, 2), ("y", "http://b.org/1", 1, 2)], page)).collect()
    assert {r["verdict"] for r in blocked} == {"block"}
    none = U.judge_urls(spark.createDataFrame([("y", "http://b.org/1", 1, 2)], page), rules=[]).collect()
    assert [(r["verdict"], r["rule"]) for r in none] == [("allow", None)]
    assert U.judge_urls(spark.createDataFrame([], page)).count() == 0
