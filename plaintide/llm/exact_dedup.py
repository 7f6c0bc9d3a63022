"""Exact dedup by an extendible-hash index on shared files; DataFrame functions only.

1. Fingerprints: every document's 64-bit hash, SHA-256, code points and slice go to a shared table, without text.
2. Directory: a histogram of distinct hashes by their leading bits drives the doubling. It starts with one
   bucket; while a bucket holds more than ``capacity`` distinct hashes, the directory doubles and the bucket is
   split by its next bit. Buckets deeper than the histogram stay whole: their owner spills, nothing is dropped.
3. Owners: the entries, one per (hash, SHA-256, slice), are written by bucket, so that an owner's files hold
   ranges of hashes. Entries of one hash form its chain.
4. Bytes: only texts of chains with more than one document are grouped by their bytes, within a slice first.
   A group of copies meets as one text per slice, so a hot group is neither one task nor many pairs.

Equal text means equal after deleting ``[\\x20\\x09-\\x0D]``; null counts as empty, so null and empty texts are
one group. The row with most code points, then the smallest id (null ids last), stays. Rows that share an id
and a text are one document: they count in ``group_size`` each and share the decision. An empty table gives an
empty result; extra columns are not looked at, and their names cannot clash as only id and text are selected.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintide.llm.shared import slice_of, spread_totals, stored

CAPACITY = 1 << 14
BITS = 20
WHITE = " \t\n\x0b\x0c\r"


def squeezed(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    for white in WHITE:
        text = F.replace(text, F.lit(white), F.lit(""))
    return text


def leading(hash64: Column, bits: int) -> Column:
    """The first bits of a hash as a number."""
    return F.shiftrightunsigned(hash64, 64 - bits) if bits else F.lit(0).cast("long")


def directory(hashes: DataFrame, capacity: int = CAPACITY, bits: int = BITS) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) for every slot, and the global depth, over the ``h`` column after all doublings.

    A slot is the first *global depth* bits of a hash; a bucket of a smaller depth owns several slots. The
    histogram has 2**bits rows at most and the directory no more.
    """
    first_bits = leading(F.col("h"), bits).alias("fine")
    histogram = stored(hashes.select("h").distinct().groupBy(first_bits).agg(F.count("*").alias("n")), "histogram")
    full = histogram.agg(F.sum("n").alias("n")).select(F.lit(0).cast("long").alias("prefix"), "n")
    depth, final = 0, []
    while True:
        over = (F.col("n") > capacity) if depth < bits else F.lit(False)
        final.append(full.filter(~over).withColumn("depth", F.lit(depth)))
        split = full.filter(over)
        if depth == bits or split.isEmpty():
            break
        depth += 1
        children = histogram.groupBy(F.shiftright("fine", bits - depth).alias("prefix")).agg(F.sum("n").alias("n"))
        parents = split.select(F.col("prefix").alias("parent"))
        full = stored(children.join(parents, F.shiftright("prefix", 1) == F.col("parent"), "left_semi"), "split")
    buckets = functools.reduce(DataFrame.unionByName, final).select(
        "depth",
        F.expr(f"prefix * shiftleft(1L, {depth} - depth)").alias("bucket"),
        F.expr(f"shiftleft(1L, {depth} - depth)").alias("width"),
    )
    slots = F.explode(F.sequence(F.col("bucket"), F.col("bucket") + F.col("width") - 1)).alias("slot")
    return stored(buckets.select("bucket", "depth", slots), "directory"), depth


def index(fingerprints: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Entries (bucket, h, sha, slice, n, best) stored by bucket; a bucket lies in one owner's files."""
    entries = fingerprints.groupBy("h", "sha", "slice").agg(
        F.count("*").alias("n"), F.max(F.struct("points", "order")).alias("best")
    )
    slots, depth = directory(fingerprints, capacity)
    owned = entries.withColumn("slot", leading(F.col("h"), depth)).join(slots, "slot").drop("slot", "depth")
    return stored(owned.repartition("bucket").sortWithinPartitions("bucket", "h", "sha"), "index")


def confirmed(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """(h, sha, links): how many different byte strings stand behind each hash pair of a chain.

    ``texts`` has (h, slice, squeezed). Only chains of more than one document are looked at.
    """
    chains = entries.groupBy("bucket", "h").agg(F.sum("n").alias("n")).filter("n > 1").select("bucket", "h")
    slices = entries.join(chains, ["bucket", "h"], "left_semi").select("h", "slice").distinct()
    suspects = texts.join(slices.hint("shuffle_hash"), ["h", "slice"], "left_semi")
    strings = suspects.groupBy("h", "slice", "squeezed").agg(F.count("*").alias("n"))
    strings = strings.groupBy("h", "squeezed").agg(F.sum("n").alias("n"))
    return strings.groupBy("h", F.sha2(F.col("squeezed").cast("binary"), 256).alias("sha")).agg(
        F.count("*").alias("links"), F.sum("n").alias("copies")
    )


def exact_dedup(documents: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    plain = documents.select(
        F.col(id).alias("id"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("points"), squeezed(F.col(text)).alias("squeezed")
    ).withColumns({"h": F.xxhash64("squeezed"), "slice": slice_of("id")})
    fingerprints = stored(
        plain.select("id", "h", "slice", "points", F.sha2(F.col("squeezed").cast("binary"), 256).alias("sha"), F.bitwise_not("id").alias("order")),
        "fingerprints",
    )
    entries = index(fingerprints, capacity)
    totals = spread_totals(entries, ["h", "sha"], {"n": F.sum("n"), "best": F.max("best")})
    proof = confirmed(plain.select("h", "slice", "squeezed"), entries)
    groups = totals.join(proof, ["h", "sha"], "left").withColumn(
        "n",
        F.when((F.col("n") == 1) | ((F.col("links") == 1) & (F.col("copies") == F.col("n"))), F.col("n")).otherwise(
            F.raise_error(F.lit("two texts share xxhash64 and SHA-256")).cast("long")
        ),
    )
    keep = F.bitwise_not("best.order")
    return fingerprints.join(groups.select("h", "sha", "slice", "n", keep.alias("keep_id")), ["h", "sha", "slice"]).select(
        F.col("id").alias(id),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
