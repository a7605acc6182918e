import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import topk_search, url_filters
from pairloom.llm.queries import URL_RULES


def brute(rows, k=10):
    """Best of (id, vector) rows for queries whose id 100 divides."""
    whole = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out, queries = [], {}
    for i, v in whole:
        if i % 100 == 0:
            queries[i] = min(v, queries.get(i, v))
    for q, v in queries.items():
        pairs = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole
                       if i != q and len(w) == len(v))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(pairs)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,block_rows", [(64, 3), (4096, 2048)])
def test_exact_results(spark, shard_rows, block_rows):
    rng = np.random.default_rng(shard_rows)
    rows = [(int(i), rng.normal(size=8).astype(np.float32).tolist()) for i in range(700)]
    same = rows[5][1]
    rows += [(1000 + i, same) for i in range(300)]                  # ties to smaller ids
    rows += [(2000, None), (2001, []), (2002, [1.0] * 7 + [None]), (2100, [float("nan")] * 8),
             (2200, [float("inf")] * 8), (None, same), (300, same), (700, [0.0] * 8),
             (2300, [1.0, 2.0]), (2301, [3.0, -1.0]), (2302, [2e5, 1e5])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn(
        "score", F.lit("x")).withColumn("shard", F.lit(1))
    found = topk_search.search(frame, F.col("vec_id") % 100 == 0, shard_rows=shard_rows,
                               block_rows=block_rows)
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_large_components(spark):
    rows = [(i, [float(x)] * 2) for i, x in enumerate((1e6, -1e6, 3e5, 0, 2e6))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = topk_search.search(frame, F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_pruning_leaves_out_balls():
    rng = np.random.default_rng(4)
    vectors = np.concatenate([rng.normal(c, 0.1, (128, 4)) for c in (-9, -3, 3, 9)]) * 100
    tree = topk_search.BallTree(np.arange(512), np.floor(vectors).astype(np.int64))
    seen = []
    plain = tree.scores
    tree.scores = lambda q, rows: seen.append(len(rows)) or plain(q, rows)
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    tree.search(np.full((1, 4), 500), np.array([-1]), 10, np.array([low]), np.array([high]))
    assert sum(seen) < 512


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk_search.search(frame, F.col("vec_id") % 100 == 0).count() == 0


URLS = ["https://WWW.Example.com/en/1?x#y", "http://a.www.example.com/en/", "x://net/es/1",
        "http://b.net/fr/", "http://b.net/de/", "http://c.org", "http://c.org/x", "no scheme",
        None, "", "://", "http://notcom/", "http://x.notnet/es/", "ftp://u@h.com:80/p://q",
        "http://com/a", "http://EXAMPLE.COM/en/", "http://é.com/en/", "http://h.com?q/x",
        "http://h.net/es", "https://" + "a." * 500 + "net/fr/" + "p" * 5000, "http://x.co.uk/"]


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host.translate(lower), path


def rule(host, path):
    fits = []
    for r in URL_RULES:
        name, _, rest = r.text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(r.text), r.text, r.verdict))
    return max(fits)[1:] if fits else (None, None)


def test_hosts_paths_and_rules(spark):
    frame = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string").withColumns(
        {c: F.lit("x") for c in ("host", "path", "rule", "mean", "n", "bad")})
    for row in url_filters.judge(frame, URL_RULES).collect():
        host, path = parsed(URLS[row.page_id])
        text, verdict = rule(host, path)
        assert (row.host, row.path, row.rule) == (host, path, text)
        assert row.verdict == verdict if text else row.verdict in ("allow", "block")


def reference_reputations(outcomes):
    """The hierarchy in plain Python."""
    def names(host):
        parts = host.split(".")
        wide = ".".join(parts[-2:]) in url_filters.WIDE_SUFFIXES
        return ".".join(parts[-1 - wide:]), ".".join(parts[-2 - wide:])
    n, bad = Counter(), Counter()
    for host, blocked in outcomes:
        n[host] += blocked is not None
        bad[host] += bool(blocked)
    hosts = {h for h, _ in outcomes}
    total = sum(n.values()) + 1
    mean = (sum(bad.values()) + 0.5) / total
    above = {(): (mean, (mean * (1 - mean) / (total + 1)) ** 0.5)}
    levels = [lambda h: (names(h)[0],), lambda h: names(h), lambda h: (*names(h), h)]
    for level in levels:
        groups = {}
        for h in hosts:
            g = groups.setdefault(level(h), [0, 0])
            g[0] += n[h]
            g[1] += bad[h]
        used = [(g, *v, *above[g[:-1]]) for g, v in groups.items() if v[0]]
        room = sum(m * (1 - m) * (c - 1) for _, c, _, m, _ in used)
        excess = sum(c * (b / c - m) ** 2 - m * (1 - m) for _, c, b, m, _ in used)
        rho = min(max(excess / room if room else 0.5, 1e-3), 0.9)
        found = {}
        for g, (c, b) in groups.items():
            m, s = above[g[:-1]]
            worth = max(m * (1 - m) / (s * s + m * (1 - m) * rho) - 1,
                        url_filters.LEAST_STRENGTH)
            x, y = worth * m + b, worth * (1 - m) + c - b
            found[g] = (x / (x + y), (x * y / ((x + y) ** 2 * (x + y + 1))) ** 0.5)
        above.update(found)
    return {h: above[(*names(h), h)] for h in hosts}


def test_reputations(spark):
    rng = random.Random(5)
    outcomes = []
    for d in range(12):
        share = rng.random()
        for h in range(4):
            host = f"h{h}.d{d}.{rng.choice(['com', 'net', 'co.uk'])}"
            outcomes += [(host, rng.choice([None, rng.random() < share]))
                         for _ in range(rng.randrange(1, 60))]
    outcomes += [("new.org", None), ("", None), ("bad.net", True)] + [("worst.net", True)] * 50
    frame = spark.createDataFrame(outcomes, "host string, blocked boolean")
    found = {r.host: (r["mean"], r.spread) for r in url_filters.reputations(frame).collect()}
    want = reference_reputations(outcomes)
    assert found.keys() == want.keys()
    for host, values in want.items():
        assert found[host] == pytest.approx(values, rel=1e-9)
    mean, spread = found["worst.net"]
    assert mean - url_filters.BOUND * spread > url_filters.LIMIT
    assert found["bad.net"][0] < mean and found["new.org"][1] > spread


def test_suffixes_are_a_parameter(spark):
    hosts = ["a.one.gov.uk", "two.gov.uk", "gov.uk", "x.y.city.area.jp", "y.area.jp", "plain.org",
             "org", ""]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")

    def split(*wide):
        found = url_filters.suffix_and_domain(F.col("host"), *wide)
        return {r.host: (r.suffix, r.domain) for r in frame.select(
            "host", found[0].alias("suffix"), found[1].alias("domain")).collect()}
    wide = split(["gov.uk", "area.jp", "city.area.jp"])
    assert wide["a.one.gov.uk"] == ("gov.uk", "one.gov.uk")
    assert wide["two.gov.uk"] == ("gov.uk", "two.gov.uk")
    assert wide["gov.uk"] == ("gov.uk", "gov.uk")
    assert wide["x.y.city.area.jp"] == ("city.area.jp", "y.city.area.jp")
    assert wide["y.area.jp"] == ("area.jp", "y.area.jp")
    assert wide["plain.org"] == ("org", "plain.org")
    assert wide["org"] == ("org", "org") and wide[""] == ("", "")
    assert split()["a.one.gov.uk"] == split([])["a.one.gov.uk"] == ("uk", "gov.uk")

    # Of two sites below a wide suffix, one that is blocked says nothing much of the other.
    outcomes = [("one.gov.uk", True)] * 40 + [(f"h{i}.gov.uk", False) for i in range(40)]
    outcomes += [("two.gov.uk", None)]
    seen = spark.createDataFrame(outcomes, "host string, blocked boolean")
    means = [{r.host: r["mean"] for r in url_filters.reputations(seen, names).collect()}["two.gov.uk"]
             for names in ([], ["gov.uk"])]
    assert means[0] != means[1] and all(0 < m < 1 for m in means)


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filters.judge(none, URL_RULES).count() == 0
    assert url_filters.judge(spark.createDataFrame(
        [(1, "http://a.org/")], "page_id bigint, url string"), []).first().verdict == "allow"
