import re

import numpy as np

import __spark_entry__ as entry
from tessera.llm import urls

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(LOW)
    fit = [(h, p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, key=lambda r: len(r[0] + r[1]), default=(None, "", None))
    return host, path, best[0] and best[0] + best[1], best[2]


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1?x=1#y", "x://example.org/es", "http://example.org/en/12",
        "http://example.org/en/2", "http://notexample.org/es/", "https://a.com/fr/", "https://com/de/x", "https://a.com?q=/fr/",
        "https://a.com#/de/", "ftp://u@h:1/p://q", "http://ÄB.COM/De/", "http://a.com/fr/" + "z" * 100_000, "http://x.org", "://com/fr/"]


def test_parts_rules_and_verdicts(spark):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(1, "http://a.com/x", "h"), (None, "http://a.com/x", "h")],
                               "page_id long, url string, host string")
    w = urls.fit(urls.default_labels(spark))
    got = urls.judge(df, w).collect()
    assert len(got) == len(URLS) + 2
    for g in got:
        if g.page_id is None or g.page_id == 1 and g.host:
            continue
        host, path, rule, verdict = brute(URLS[g.page_id])
        assert (g.host, g.path, g.rule) == (host, path, rule)
        assert g.verdict == (verdict or ("block" if g.score >= 0.5 else "allow"))
        assert abs(g.score - 1 / (1 + np.exp(-urls._margins(w, [host], [path])[0]))) < 1e-9
    assert urls.judge(df.limit(0), w).count() == 0


def test_classifier(spark):
    w = urls.fit(urls.default_labels(spark))
    d = spark.createDataFrame([(0, "http://pills-cheap.other.test/buy-now"), (1, "https://www.city-library.test/en/history"),
                               (2, "http://casino-free.test/bonus"), (3, "https://blog.physics.test/en/notes")], "page_id long, url string")
    assert [r.verdict for r in urls.judge(d, w).orderBy("page_id").collect()] == ["block", "allow", "block", "allow"]
    one = spark.createDataFrame([("http://a/b", 1), (None, 0), ("http://c", None)], "url string, unwanted int")
    assert {r.verdict for r in urls.judge(d, urls.fit(one)).collect()} == {"block"}
    assert not urls.fit(one.limit(0)).any()


def test_held_out_accuracy(spark):
    rows = [(u, 0) for u in urls.KEEP] + [(u, 1) for u in urls.UNWANTED]
    right = 0
    for k in range(6):
        w = urls.fit(spark.createDataFrame([r for i, r in enumerate(rows) if i % 6 != k], "url string, unwanted int"))
        for u, y in rows[k::6]:
            h, p = brute(u)[:2]
            right += (urls._margins(w, [h], [p])[0] >= 0) == y
    assert right / len(rows) > 0.7


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.url for r in spark.read.parquet(sf + "/pages.parquet").collect()}
    got = entry.queries()["op6_url_filter"](spark, sf).collect()
    assert len(got) == len(pages)
    for g in got:
        host, path, rule, verdict = brute(pages[g.page_id])
        assert (g.host, g.path, g.rule) == (host, path, rule) and (verdict is None or g.verdict == verdict)
