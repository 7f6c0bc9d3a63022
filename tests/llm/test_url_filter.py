from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plaintide.llm import url_filter as uf
from plaintide.llm.queries import op12_url_filter
from tests.conftest import SF_DIR


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host) :]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path, rules):
    fitting = []
    for rule in rules:
        own, start = rule.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            fitting.append((len(rule), len(own), rule))
    return max(fitting)[2] if fitting else None


def plain_margin(forest, row):
    total = forest.base
    for splits, leaves in forest.trees:
        node = 1
        while node in splits:
            feature, threshold = splits[node]
            node = 2 * node + (row[feature] > threshold)
        total += leaves.get(node, 0.0)
    return total


def labelled(spark, rows):
    frame = spark.createDataFrame(rows, "url string, label int")
    host, path = uf.host_and_path(F.col("url"))
    return frame.withColumns({"host": host, "path": path})


def made(r, spam):
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(4, 9)))
    if spam:
        host = f"{word()}-{r.randint(100, 99999)}-{word()}.{r.choice(['biz', 'top', 'com'])}"
        return f"http://{host}/{word()}?{'&'.join(f'{word()}={r.randint(0, 10**9)}' for _ in range(r.randint(2, 6)))}"
    return f"https://www.{word()}.{r.choice(['org', 'edu', 'com'])}/{word()}/{word()}.html"


URLS = [
    None, "", "no scheme", "http://", "http://Example.COM", "http://a.example.com/en/x", "http://www.example.com/en/", "http://x.www.example.com/en/1",
    "https://n.net/es/?q=1", "https://n.net/es", "https://n.net?x=/fr/", "https://n.net#/fr/", "ftp://net/fr/a#b", "x://y://com/", "http://com", "http://notcom/",
    "http://a.com:80/", "http://É.NET/fr/", "http://u@h.org/a?b=c&d=e#f", "http://a.com/" + "y" * 100_000, "http://a.com/\nb", "http://.com/",
]


def test_rules(spark):
    rules = uf.RULES | {"b.com/x": "block", "com/xyzx": "allow"}
    urls = URLS + ["http://b.com/xyzx", "http://b.com/x"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for row in uf.url_filter(frame.withColumns({"host": F.lit("h"), "rule": F.lit(1), "label": F.lit(2)}), rules).collect():
        host, path = plain_parts(urls[row.page_id])
        rule = plain_rule(host, path, rules)
        assert (row.host, row.path, row.rule) == (host, path, rule), urls[row.page_id]
        assert row.verdict == (rules[rule] if rule else "block" if row.score > 0.5 else "allow")


def test_table(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()}
    rows = op12_url_filter(spark, SF_DIR).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for row in rows:
        host, path = plain_parts(pages[row.page_id])
        rule = plain_rule(host, path, uf.RULES)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == (uf.RULES[rule] if rule else "block" if row.score > 0.5 else "allow")
    assert {r.verdict for r in rows} == {"allow", "block"}


def test_features(spark):
    frame = labelled(spark, [(u, 0) for u in URLS])
    shares = {"top": ({"com": 0.25}, 0.5), "site": ({"example.com": 0.75}, 0.125)}
    for row in uf.lexical(frame, shares).collect():
        url, (host, path) = row.url or "", plain_parts(row.url)
        found = re.search(r"\?([^#]*)", url)
        query = found.group(1) if found else ""
        bits = Counter(c for c in url.translate({c: c + 32 for c in range(65, 91)}) if c in uf.ENTROPY_OF)
        total = sum(bits.values())
        assert row.url_length == len(url) and row.depth == path.count("/") and row.query_length == len(query)
        assert row.parameters == (query.count("&") + 1 if query else 0) and row.labels == (host.count(".") + 1 if host else 0)
        assert row.digit_ratio == pytest.approx(sum(c in "0123456789" for c in url) / max(len(url), 1), abs=1e-6)
        assert row.entropy == pytest.approx(sum(n / total * math.log2(total / n) for n in bits.values()), abs=2e-6)
        assert row.top_share == (0.25 if host.split(".")[-1] == "com" else 0.5)
        assert row.site_share == (0.75 if ".".join(host.split(".")[-2:]) == "example.com" else 0.125)


def plain_tree(rows, cuts, forest, depth):
    """One tree grown in plain Python, by the same sums."""
    p = [1 / (1 + math.exp(-plain_margin(forest, r))) for r in rows]
    g = [math.floor(abs(x - r["label"]) * uf.UNIT + 0.5) * (1 if x >= r["label"] else -1) for x, r in zip(p, rows, strict=True)]
    h = [math.floor(x * (1 - x) * uf.UNIT + 0.5) for x in p]
    node, splits, leaves = [1] * len(rows), {}, {}
    for level in range(depth):
        for n in sorted(set(node)):
            if n < 1 << level:
                continue
            mine = [i for i, k in enumerate(node) if k == n]
            all_g, all_h = sum(g[i] for i in mine), sum(h[i] for i in mine)
            best = None
            for feature in uf.FEATURES:
                for cut, value in enumerate(cuts[feature]):
                    left = [i for i in mine if rows[i][feature] <= value]
                    if not any(sum(c < rows[i][feature] for c in cuts[feature]) == cut for i in mine):
                        continue
                    lg, lh = sum(g[i] for i in left), sum(h[i] for i in left)
                    a, b, c, d = (x / uf.UNIT for x in (lg, lh, all_g, all_h))
                    if b < uf.LEAST_HESSIAN or d - b < uf.LEAST_HESSIAN:
                        continue
                    gain = round(a * a / (b + 1) + (c - a) ** 2 / (d - b + 1) - c * c / (d + 1), 6)
                    if gain > 1e-6 and (best is None or (gain, feature, -cut) > best[0]):
                        best = (gain, feature, -cut), value, lg, lh
            if best:
                splits[n] = best[0][1], value_of(best)
                for child, cg, ch in ((2 * n, best[2], best[3]), (2 * n + 1, all_g - best[2], all_h - best[3])):
                    leaves[child] = round(-uf.RATE * cg / (ch + uf.RIDGE * uf.UNIT), 9)
        for i, r in enumerate(rows):
            if node[i] in splits:
                feature, threshold = splits[node[i]]
                node[i] = 2 * node[i] + (r[feature] > threshold)
    return splits, leaves


def value_of(best):
    return best[1]


def test_training_against_a_plain_one(spark):
    r = random.Random(12)
    rows = [(made(r, i % 3 == 0), int(i % 3 == 0)) for i in range(300)]
    frame = labelled(spark, rows)
    forest = uf.trained(frame, trees=3)
    features = [x.asDict() for x in uf.lexical(frame.distinct(), forest.shares).collect()]
    cuts = uf.cut_points(uf.lexical(frame.distinct(), forest.shares), uf.BINS)
    plain = uf.Forest(forest.base, forest.shares)
    for tree in forest.trees:
        splits, leaves = plain_tree(features, cuts, plain, uf.DEPTH)
        assert splits == tree[0] and leaves == pytest.approx(tree[1], abs=1e-6)
        plain.trees.append(tree)
    for row in uf.scored(frame, forest).join(uf.lexical(frame, forest.shares).drop("label", "host", "path"), "url").collect():
        assert row.score == pytest.approx(1 / (1 + math.exp(-plain_margin(forest, row.asDict()))))


def test_held_out_urls(spark):
    r = random.Random(120)
    rows = [(made(r, i % 2 == 0), int(i % 2 == 0)) for i in range(1200)]
    forest = uf.trained(labelled(spark, rows[:900]), trees=5)
    found = uf.scored(labelled(spark, rows[900:]), forest).collect()
    assert sum((row.score > 0.5) == (row.label == 1) for row in found) / len(found) > 0.95


def test_few_labels(spark):
    frame = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (None, "http://b.net/es/1")], "page_id long, url string")
    assert {r.verdict for r in uf.url_filter(frame, {}).collect()} == {"allow"}
    assert [r.verdict for r in uf.url_filter(frame, {"net/es/": "block"}).orderBy("host").collect()] == ["block"] * 3
    assert uf.url_filter(frame.limit(0), uf.RULES).collect() == []
