"""Relevance order: an inverted index over narratives, kept up by loads, and BM25 with bounds for the best k.

The score of a record for a query is the sum over the query's different terms of

    ln(1 + (N - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean length))

with N records that have a text, df of them with the term, tf its occurrences. Terms are runs of letters and
digits in lower case. Scores are rounded to nine decimals, and equal ones are ordered by key.

The index is a set of load folders. A load writes the postings of its own records, dealt over buckets by term, and the
earlier versions of its records that no longer count. A search reads the buckets of its terms only and leaves
out those versions by an anti join; what a load writes follows the load, what a search reads follows its terms. A
folder counts from the moment its marker is there; loads must take turns. Nothing merges the folders: start a new
index where replaced versions have grown.

For the best k, terms come in the order of their greatest possible share. Once the k-th best score of the first ones
exceeds what the others could add together, a record with none of the first terms cannot get in, and the
postings of the others are needed for the records in reach only. Terms that are in most records add least, and their
postings are the longest.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintide.operators.merge_on_read import DONE, new_step, steps
from plaintide.operators.upsert import RANGE, key_range, latest_per_key, require_key
from plaintide.schemas import KEY
from plaintide.sources.files import create_new

TEXT = "complaint_what_happened"
K1, B = 1.2, 0.75
BUCKETS = 64
SLACK = 1e-6
DIGITS = 9

POSTINGS = f"{KEY} bigint, term string, tf bigint, length bigint, bucket int"
LENGTHS = f"{KEY} bigint, length bigint, {RANGE} bigint"
DEAD = f"{KEY} bigint, step string, length bigint"
SCORED = f"{KEY} bigint, score double"


@dataclass(frozen=True)
class Term:
    """A term of a query in the live index: weight, and the greatest share of a score it can have."""

    text: str
    weight: float
    bound: float


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def bucket_of(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def stored(spark: SparkSession, location: str, names: list[str], part: str, schema: str) -> DataFrame:
    """One part of some load folders, with the folder's name as `step`."""
    rows = [spark.read.schema(schema).parquet(f"{location}/{n}/{part}").withColumn("step", F.lit(n)) for n in names]
    empty = spark.createDataFrame([], schema).withColumn("step", F.lit(""))
    return reduce(DataFrame.unionByName, rows) if rows else empty


def replaced(spark: SparkSession, location: str, names: list[str]) -> DataFrame:
    """(key, step, length) of the versions that later loads replaced."""
    rows = [spark.read.schema(DEAD).parquet(f"{location}/{n}/dead") for n in names]
    return reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], DEAD)


def update(rows: DataFrame, location: str, text: str = TEXT) -> None:
    """Index a load of records; of equal keys the latest extraction counts, and it replaces what earlier loads had.

    A record whose text is NULL or has no terms leaves the index. A NULL key fails the load. The words of a record are
    kept (memory and disk) for its length and its postings, so the rows are made and shuffled once.
    """
    spark = rows.sparkSession
    names, name = steps(spark, location), new_step(spark, location)
    folder = f"{location}/{name}"
    latest = latest_per_key(require_key(rows)).select(KEY, words(F.col(text)).alias("words"))
    found = latest.select(KEY, "words", F.coalesce(F.array_size("words"), F.lit(0)).cast("long").alias("length"))
    found = found.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found.select(KEY, "length", key_range().alias(RANGE)).write.partitionBy(RANGE).parquet(f"{folder}/lengths")
        own = found.select(KEY, "length", F.explode("words").alias("term")).groupBy(KEY, "term", "length")
        postings = own.agg(F.count(F.lit(1)).alias("tf")).withColumn("bucket", bucket_of(F.col("term")))
        # Spark deals the buckets and splits one that a frequent term makes large.
        dealt = postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term")
        dealt.write.partitionBy("bucket").parquet(f"{folder}/postings")
    finally:
        found.unpersist()

    mine = spark.read.schema(LENGTHS).parquet(f"{folder}/lengths").select(RANGE, KEY)
    before = stored(spark, location, names, "lengths", LENGTHS).join(replaced(spark, location, names), [KEY, "step"], "left_anti")
    before.join(mine, [RANGE, KEY], "left_semi").select(KEY, "step", "length").write.parquet(f"{folder}/dead")
    create_new(spark, f"{folder}/{DONE}")


def live_postings(spark: SparkSession, location: str, query: str) -> DataFrame:
    """Postings of a query's terms that count; buckets of other terms are not read."""
    names = steps(spark, location)
    asked = spark.range(1).select(F.explode(F.array_distinct(words(F.lit(query)))).alias("term"))
    terms = asked.select("term", bucket_of(F.col("term")).alias("bucket")).collect()
    if not terms or not names:
        return spark.createDataFrame([], POSTINGS)
    rows = stored(spark, location, names, "postings", POSTINGS)
    rows = rows.filter(F.col("bucket").isin([t.bucket for t in terms]) & F.col("term").isin([t.term for t in terms]))
    return rows.join(replaced(spark, location, names), [KEY, "step"], "left_anti").drop("step")


def corpus(spark: SparkSession, location: str) -> tuple[int, int]:
    """Live records with a text, and their terms together."""
    names = steps(spark, location)
    sums = [F.count(F.when(F.col("length") > 0, 1)), F.coalesce(F.sum("length"), F.lit(0))]
    every = stored(spark, location, names, "lengths", LENGTHS).agg(*sums).first()
    gone = replaced(spark, location, names).agg(*sums).first()
    return every[0] - gone[0], every[1] - gone[1]


def saturated(tf: Column, length: Column, mean: float) -> Column:
    norm = F.lit(1 - B) + F.lit(B) * length / F.lit(mean)
    return tf * F.lit(K1 + 1) / (tf + F.lit(K1) * norm)


def weighed(postings: DataFrame, n: int, mean: float) -> list[Term]:
    """The terms that occur, the greatest bound first: one row per term of the query reaches the driver."""
    share = F.max(saturated(F.col("tf"), F.col("length"), mean))
    found = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), share.alias("share")).collect()
    weights = {r.term: (math.log(1 + (n - r.df + 0.5) / (r.df + 0.5)), r.share) for r in found}
    return sorted((Term(t, w, w * s) for t, (w, s) in weights.items()), key=lambda t: (-t.bound, t.text))


def scored(postings: DataFrame, terms: list[Term], mean: float) -> DataFrame:
    """(key, share of the score) of each posting of some terms."""
    weight = reduce(lambda rest, t: F.when(F.col("term") == t.text, F.lit(t.weight)).otherwise(rest), terms, F.lit(0.0))
    own = postings.filter(F.col("term").isin([t.text for t in terms]))
    return own.select(KEY, (weight * saturated(F.col("tf"), F.col("length"), mean)).alias("share"))


def summed(shares: DataFrame) -> DataFrame:
    return shares.groupBy(KEY).agg(F.round(F.sum("share"), DIGITS).alias("score"))


def needed(postings: DataFrame, terms: list[Term], mean: float, k: int) -> tuple[int, float]:
    """How many terms, greatest bound first, a record must have one of to be among the best k; and the score to beat."""
    for first in range(1, len(terms)):
        best = summed(scored(postings, terms[:first], mean)).orderBy(F.desc("score")).limit(k).agg(F.count("score"), F.min("score")).first()
        if best[0] == k and best[1] > sum(t.bound for t in terms[first:]) + SLACK:
            return first, best[1]
    return len(terms), 0.0


def search(spark: SparkSession, location: str, query: str, k: int | None = None, ascending: bool = False) -> DataFrame:
    """(key, score) of the records that have a term of the query: the best first, or the least with `ascending`.

    With `k` only the best k. A query without terms, or whose terms do not occur, finds nothing.
    """
    postings = live_postings(spark, location, query)
    n, total = corpus(spark, location)
    mean = total / n if n else 1.0
    terms = weighed(postings, n, mean)
    if not terms:
        return spark.createDataFrame([], SCORED)
    order = [F.asc("score") if ascending else F.desc("score"), F.col(KEY)]
    if k is None or ascending:
        every = summed(scored(postings, terms, mean)).orderBy(order)
        return every if k is None else every.limit(k)
    first, least = needed(postings, terms, mean, k)
    shares = scored(postings, terms[:first], mean)
    if first < len(terms):
        rest = terms[first:]
        reach = F.col("score") + F.lit(sum(t.bound for t in rest) + SLACK) >= F.lit(least)
        near = summed(shares).filter(reach).select(KEY)
        shares = shares.unionByName(scored(postings, rest, mean)).join(near, KEY, "left_semi")
    return summed(shares).orderBy(order).limit(k)


def sort_relevance(rows: DataFrame, location: str, query: str, ascending: bool = False) -> DataFrame:
    """The records that match a query with their `score`, in the order of relevance."""
    found = search(rows.sparkSession, location, query, ascending=ascending)
    score = F.col("score")
    return rows.join(found, KEY).orderBy(score.asc() if ascending else score.desc(), KEY)
