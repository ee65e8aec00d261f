import math
import random
from collections import Counter

from pyspark.sql import functions as F

from quillspark.llm import urls

URLS = [
    (1, "http://a.example.net/en/1?x=1#y"), (2, "https://EXAMPLE.com/de/"), (3, "https://x.example.com/de"), (4, "http://b.org/fr/2"), (5, "http://net/"), (6, "http://mynet"),
    (7, None), (8, "nothing"), (9, "http://"), (10, "ftp://h?q=://z.net/"), (11, "http://cheap-pills.example.com/en/12345"), (11, "http://cheap-pills.example.com/en/12345"), (12, "http://é.net#f"), (13, "a://b://c.net/"),
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for rule, verdict in urls.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return (host, path, *(best or (None, None)))


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame(URLS, "page_id long, url string")
    want = [(i, *brute(u)) for i, u in URLS]
    cols = ["page_id", "host", "path", "rule", "rule_verdict"]
    got = [tuple(r) for r in urls.with_rules(df).select(*cols).orderBy("page_id").collect()]
    assert got == want
    placed = df.withColumn("host", urls.host_of(F.col("url"))).withColumn("path", urls.path_of(F.col("url")))
    assert [tuple(r) for r in urls._joined(placed, urls.RULES).select(*cols).orderBy("page_id").collect()] == want


def test_verdicts(spark):
    hosts = ["news", "blog", "shop"] * 40
    rows = [(i, f"http://{h}{i}.example.com/en/{i}") for i, h in enumerate(hosts)] + [(500 + i, f"http://cheap-pills.example.com/en/{i}") for i in range(30)] + [(i + 900, u) for i, u in URLS]
    out = urls.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert len(out) == len(rows) and {r.verdict for r in out} == {"allow", "block"}
    assert all(r.verdict == "block" for r in out if 500 <= r.page_id < 530)
    assert sum(r.verdict == "allow" for r in out if r.page_id < 120) > 115
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judged(empty).count() == 0


def test_urls_without_a_label_are_judged_by_their_shape(spark):
    """A tenth of the spam has no seed term, so nothing marks it; its shape is that of the marked rest."""
    r = random.Random(1)
    spam = lambda i, seed: f"http://{seed}{r.randrange(10**6)}-{r.randrange(10**6)}-offers.example.com/a/b/c/{i}?q=1&p=2&z={i}"
    rows = [(i, spam(i, "spam" if i % 10 else "mail")) for i in range(600)]
    rows += [(1000 + i, f"https://{r.choice(['news', 'blog', 'town', 'river'])}.example.org/{r.choice('xyz')}{i}.html") for i in range(600)]
    out = {x.page_id: x.verdict for x in urls.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    hidden = [i for i in range(600) if i % 10 == 0]
    assert sum(out[i] == "block" for i in hidden) > 0.9 * len(hidden)
    assert sum(out[1000 + i] == "allow" for i in range(600)) > 580


def test_entropy_and_long_urls(spark):
    hosts = ["", "a", "aab", "a.b-c.example", "é" * 5 + "x", "ab" * 50_000]
    rows = spark.createDataFrame([(h,) for h in hosts], "h string").select("h", urls._entropy(F.col("h")).alias("e")).collect()
    for row in rows:
        want = -sum(c / len(row.h) * math.log2(c / len(row.h)) for c in Counter(row.h).values())
        assert abs(row.e - want) < 1e-9
    clash = spark.createDataFrame([(1, "http://" + "a." * 50_000 + "net/x", "h", "r", 1.0), (None, "http://x.net/", None, "r", 2.0), (None, "http://x.net/", None, "r", 2.0)], "page_id long, url string, host string, rule string, fold double")
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in urls.judged(clash).collect()) == [(0, "net/", "block"), (0, "net/", "block"), (1, "net/", "block")]
