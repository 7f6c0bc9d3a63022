"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for all other URLs.

DataFrame and SQL functions only, also for training:

1. Rules. A rule ``host/path`` fits its host and all subdomains if the URL's path starts with ``/path``; the longest
   fitting rule decides (of equal lengths the one with the longer host). Rules are a list of the caller's and become
   one expression.
2. Features. Lengths, depth, digit ratio, character entropy, parameters, hyphens, labels, and for the last one
   and two labels of the host the smoothed share of blocked URLs among labelled ones.
3. Training. Of the distinct labelled URLs, SAMPLE with the least hash are kept, so each step below works on a
   bounded table. Every feature is cut into BINS quantile bins. A tree grows level by level: one aggregate sums
   gradient and hessian per (node, feature, bin), running sums give every split's gain, and the best split per node,
   2**level rows at most, comes back to the driver. Gradients are whole numbers of 2**-20, so sums, and with them the
   trees, do not depend on the order of rows.
4. Scoring. The trees are one nested CASE per tree over the features, within whole-stage code: no shuffle.

Without a labelled URL every score is 0.5 and the verdict allow; with labels of one class it is that class. Null URLs
and URLs without ``://`` have an empty host and path and the features of that. Suffixes with fewer than SUPPORT
labelled URLs count as unseen, which bounds their table by SAMPLE / SUPPORT. Rows are judged each; labels of one URL
that differ count once each. Extra columns are not read.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaintide.llm.shared import stored

SAMPLE, SUPPORT = 20_000, 20
TREES, DEPTH, BINS = 12, 3, 16
RATE, RIDGE, LEAST_HESSIAN = 0.4, 1.0, 1.0
UNIT = 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENTROPY_OF = "abcdefghijklmnopqrstuvwxyz0123456789-._/?&=%#:"
FEATURES = [
    "url_length", "host_length", "path_length", "query_length", "depth", "labels", "hyphens", "digit_ratio",
    "entropy", "host_entropy", "parameters", "longest_label", "top_share", "site_share",
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def fits(rule: str, host: Column, path: Column) -> Column:
    own, _, start = rule.partition("/")
    return ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(f"/{start}"))


def decided(rules: dict[str, str], host: Column, path: Column) -> tuple[Column, Column]:
    """The rule that decides and its verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text in sorted(rules, key=lambda r: (len(r), len(r.partition("/")[0]), r)):
        here = fits(text, host, path)
        rule, verdict = F.when(here, F.lit(text)).otherwise(rule), F.when(here, F.lit(rules[text])).otherwise(verdict)
    return rule, verdict


def count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among these."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def entropy(text: Column) -> Column:
    """Bits per character of the common URL characters in ``text``, A-Z taken as a-z."""
    low = F.translate(text, UPPER, LOWER)
    total = F.greatest(count_of(low, ENTROPY_OF), F.lit(1)).cast("double")
    counts = F.transform(F.array(*map(F.lit, ENTROPY_OF)), lambda c: F.length(low) - F.length(F.replace(low, c, F.lit(""))))
    bits = F.aggregate(counts, F.lit(0.0), lambda sum, n: sum + F.when(n > 0, n * F.log2(total / n)).otherwise(0.0))
    return F.round(bits / total, 6)


def suffixes(host: Column) -> tuple[Column, Column]:
    """The last label and the last two labels of a host."""
    return F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)


def lexical(urls: DataFrame, shares: dict[str, tuple[dict[str, float], float]]) -> DataFrame:
    """``urls`` (url, host, path, …) with the columns FEATURES; ``shares`` has the known suffixes and the share of others."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    top, site = suffixes(host)
    length = F.length(url)
    columns = {
        "url_length": length, "host_length": F.length(host), "path_length": F.length(path), "query_length": F.length(query),
        "depth": count_of(path, "/"), "labels": F.when(host == "", 0).otherwise(count_of(host, ".") + 1), "hyphens": count_of(host, "-"),
        "digit_ratio": F.round(count_of(url, "0123456789") / F.greatest(length, F.lit(1)), 6),
        "entropy": entropy(url), "host_entropy": entropy(host),
        "parameters": F.when(query == "", 0).otherwise(count_of(query, "&") + 1),
        "longest_label": F.array_max(F.transform(F.split(host, r"\."), F.length)),
        "top_share": known_share(top, *shares["top"]), "site_share": known_share(site, *shares["site"]),
    }
    return urls.select("*", *[columns[name].cast("double").alias(name) for name in FEATURES])


def known_share(suffix: Column, known: dict[str, float], other: float) -> Column:
    if not known:
        return F.lit(other)
    table = F.map_from_arrays(F.array(*map(F.lit, known)), F.array(*map(F.lit, known.values())))
    return F.coalesce(F.try_element_at(table, suffix), F.lit(other))


def suffix_shares(labelled: DataFrame, support: int) -> dict[str, tuple[dict[str, float], float]]:
    """Smoothed share of label 1 by suffix, for suffixes with ``support`` labelled URLs; at most sample / support each."""
    whole = labelled.agg(F.sum("label").alias("ones"), F.count("*").alias("n")).first()
    other = (whole.ones + 1) / (whole.n + 2) if whole.n else 0.5
    shares = {}
    for name, suffix in zip(("top", "site"), suffixes(F.col("host")), strict=True):
        counts = labelled.groupBy(suffix.alias("suffix")).agg(F.sum("label").alias("ones"), F.count("*").alias("n"))
        rows = counts.filter(F.col("n") >= support).orderBy("suffix").collect()
        shares[name] = {r.suffix: round((r.ones + 4 * other) / (r.n + 4), 9) for r in rows}, round(other, 9)
    return shares


class Forest:
    """Boosted trees as SQL: a margin, positive for label 1."""

    def __init__(self, base: float, shares: dict[str, tuple[dict[str, float], float]]) -> None:
        self.base, self.shares = base, shares
        #: A tree has, for each inner node in heap order from 1, (feature, threshold), and a value for each leaf.
        self.trees: list[tuple[dict[int, tuple[str, float]], dict[int, float]]] = []

    def tree_sql(self, tree: tuple[dict[int, tuple[str, float]], dict[int, float]], node: int = 1) -> str:
        splits, leaves = tree
        if node not in splits:
            return f"{leaves.get(node, 0.0)!r}D"
        feature, threshold = splits[node]
        low, high = self.tree_sql(tree, 2 * node), self.tree_sql(tree, 2 * node + 1)
        return f"CASE WHEN {feature} <= {threshold!r}D THEN {low} ELSE {high} END"

    def margin_sql(self) -> str:
        return " + ".join([f"{self.base!r}D", *map(self.tree_sql, self.trees)])

    def node_sql(self, splits: dict[int, tuple[str, float]], node: int = 1) -> str:
        """The node a row has reached."""
        if node not in splits:
            return str(node)
        feature, threshold = splits[node]
        return f"CASE WHEN {feature} <= {threshold!r}D THEN {self.node_sql(splits, 2 * node)} ELSE {self.node_sql(splits, 2 * node + 1)} END"


def cut_points(sample: DataFrame, bins: int) -> dict[str, list[float]]:
    """Quantiles of each feature, the greatest value left out, as nothing lies above it."""
    quantiles = [i / bins for i in range(bins + 1)]
    row = sample.agg(*[F.percentile(name, F.array(*map(F.lit, quantiles))).alias(name) for name in FEATURES]).first()
    return {name: sorted({round(v, 6) for v in row[name][1:-1] if v < row[name][-1]}) for name in FEATURES}


def binned(features: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """``features`` with (feature, cut) pairs: the number of cut points below the row's value, for features with any."""

    def pair(name: str) -> Column:
        below = F.size(F.filter(F.array(*map(F.lit, cuts[name])), lambda c: c < F.col(name)))
        return F.struct(F.lit(name).alias("feature"), below.alias("cut"))

    pairs = [pair(name) for name in FEATURES if cuts[name]]
    return features.withColumn("pairs", F.array(*pairs) if pairs else F.expr("CAST(array() AS array<struct<feature string, cut int>>)"))


def split_sums(sample: DataFrame, forest: Forest, splits: dict[int, tuple[str, float]], level: int) -> DataFrame:
    """(node, feature, cut, g, h, all_g, all_h) for the open nodes: sums left of each cut and of the node, in units."""
    p = f"(1D / (1D + exp(-({forest.margin_sql()}))))"
    rows = sample.select(
        F.expr(forest.node_sql(splits)).alias("node"),
        F.expr(f"CAST(round(({p} - label) * {UNIT}) AS BIGINT)").alias("g"),
        F.expr(f"CAST(round({p} * (1D - {p}) * {UNIT}) AS BIGINT)").alias("h"),
        "pairs",
    ).filter(F.col("node") >= 1 << level)
    rows = rows.select("node", "g", "h", F.inline("pairs"))
    sums = rows.groupBy("node", "feature", "cut").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    up = Window.partitionBy("node", "feature").orderBy("cut")
    whole = Window.partitionBy("node", "feature")
    return sums.select("node", "feature", "cut", *[F.sum(c).over(up).alias(c) for c in "gh"], *[F.sum(c).over(whole).alias(f"all_{c}") for c in "gh"])


def gain(g: Column, h: Column) -> Column:
    return g * g / (h + RIDGE)


def grown(sample: DataFrame, cuts: dict[str, list[float]], forest: Forest, depth: int) -> tuple[dict[int, tuple[str, float]], dict[int, float]]:
    """The next tree: at most 2**level rows reach the driver for each level."""
    splits: dict[int, tuple[str, float]] = {}
    leaves: dict[int, float] = {}
    for level in range(depth):
        sums = split_sums(sample, forest, splits, level)
        g, h, all_g, all_h = (F.col(c) / F.lit(float(UNIT)) for c in ("g", "h", "all_g", "all_h"))
        more = F.when((h >= LEAST_HESSIAN) & (all_h - h >= LEAST_HESSIAN), gain(g, h) + gain(all_g - g, all_h - h) - gain(all_g, all_h))
        best = F.max(F.struct(F.round(F.coalesce(more, F.lit(-1.0)), 6).alias("gain"), "feature", (-F.col("cut")).alias("cut"), "g", "h", "all_g", "all_h"))
        rows = sums.groupBy("node").agg(best.alias("best")).orderBy("node").collect()
        for node, top in rows:
            if top.gain > 1e-6:
                splits[node] = top.feature, cuts[top.feature][-top.cut]
                for child, child_g, child_h in ((2 * node, top.g, top.h), (2 * node + 1, top.all_g - top.g, top.all_h - top.h)):
                    leaves[child] = round(-RATE * child_g / (child_h + RIDGE * UNIT), 9)
        if not any(top.gain > 1e-6 for _, top in rows):
            break
    return splits, leaves


def trained(labelled: DataFrame, sample: int = SAMPLE, support: int = SUPPORT, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Forest:
    """Trees for ``labelled`` (url, host, path, label), label 1 being what the margin is positive for."""
    distinct = labelled.select("url", "host", "path", "label").distinct()
    some = stored(distinct.orderBy(F.xxhash64("url"), "url", "label").limit(sample), "labelled")
    shares = suffix_shares(some, support)
    counts = some.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("ones")).first()
    if counts.ones in (0, counts.n):
        certain = 0.0 if not counts.n else 20.0 if counts.ones else -20.0
        return Forest(certain, shares)
    forest = Forest(round(math.log(counts.ones / (counts.n - counts.ones)), 9), shares)
    features = stored(lexical(some, shares).select("label", *FEATURES), "features")
    cuts = cut_points(features, bins)
    features = stored(binned(features, cuts), "binned")
    for _ in range(trees):
        tree = grown(features, cuts, forest, depth)
        if not tree[0]:
            break
        forest.trees.append(tree)
    return forest


def scored(urls: DataFrame, forest: Forest) -> DataFrame:
    """``urls`` (url, host, path, …) with ``score``, the probability of label 1."""
    found = lexical(urls, forest.shares).withColumn("score", F.expr(f"1D / (1D + exp(-({forest.margin_sql()})))"))
    return found.drop(*FEATURES)


def url_filter(pages: DataFrame, rules: dict[str, str], id: str = "page_id", url: str = "url", sample: int = SAMPLE) -> DataFrame:
    """One row per page: id, host, path, rule, verdict (allow or block), score.

    URLs with a rule are the labelled ones; the score is the trees' for every URL, the verdict the rule's where there is one.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(F.col(id).alias("id"), F.col(url).alias("url")).withColumns({"host": host, "path": path})
    rule, verdict = decided(rules, F.col("host"), F.col("path"))
    judged = parsed.withColumns({"rule": rule, "by_rule": verdict})
    labelled = judged.filter("by_rule is not null").withColumn("label", (F.col("by_rule") == "block").cast("int"))
    found = scored(judged, trained(labelled, sample))
    verdict = F.coalesce("by_rule", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return found.select(F.col("id").alias(id), "host", "path", "rule", verdict.alias("verdict"), "score")


#: The rules of the registered query. Fixed values.
RULES: dict[str, str] = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}
