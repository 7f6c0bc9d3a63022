"""MinHash near-dedup with HyperMinHash registers.

1. Sketches. A document's set is its distinct ``words``-word shingles as 64-bit hashes. Its 128 registers keep,
   per bucket, the leading zeros of the smallest hash and the ten bits after its first one. Large sets use one
   hash and deal the shingles over the buckets; sets below ``SPARSE`` shingles, which would leave buckets empty,
   hash every shingle anew for each register. Sets near the border get both kinds, so two sets that can reach
   the threshold always have a kind in common.
2. Copies of one word sequence, by its SHA-256, are one node from here on.
3. Bands of four registers (64 bits, as they are stored) are the buckets in which candidates meet. At a
   similarity of 0.85 all 32 bands miss with a probability of 6e-11, at 0.8 of 5e-8.
4. Stars. In each bucket all nodes are compared with one leader, the node that shares most buckets with others.
   Nodes found linked become one component; buckets with several components get a further leader. What is
   still untested after STARS rounds is compared in blocks, component against component, so the pairs
   inside a large group of copies are never made; a block returns a forest of the links it finds.
5. A candidate's similarity is estimated from the registers, corrected for chance collisions; below the
   threshold by more than six standard errors it goes. All others are confirmed on the full sets, first by
   hashes, and those that pass by the shingles' words.

Rows whose id is null are returned with a null component and are kept; rows that share an id are one document.
Null, empty and white texts have an empty set and are linked with nothing. Words are ``[^\\x20\\x09-\\x0D]+`` with
A-Z lower-cased; a text with fewer words than a shingle is one shingle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintide.llm.blocks import LOWER, U64, WHITE, SpanHash, Words, blocks, mixed, runs
from plaintide.llm.components import components
from plaintide.llm.shared import ship_package, slice_of, stored

REGISTERS, BAND, MANTISSA = 128, 4, 10
EMPTY = 65535
SPARSE = 256
SEEDS = np.random.default_rng(4).integers(0, 1 << 64, REGISTERS, dtype=U64)
STARS = 2
ERRORS = 6
SIDE = 512

SKETCH = pa.schema(
    [
        ("id", pa.int64()),
        ("key", pa.binary()),
        ("n", pa.int64()),
        ("sparse", pa.list_(pa.int64())),
        ("dense", pa.list_(pa.int64())),
    ]
)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document of a block, and where each document's begin."""
    lower = LOWER[data]
    found = Words(data, offsets)
    sequence = SpanHash(SpanHash.of_bytes(lower).spans(found.start, found.end))
    starts = runs(found.offsets, words)
    short = np.flatnonzero((found.counts > 0) & (found.counts < words))
    first = np.concatenate([starts, found.offsets[short]])
    last = np.concatenate([starts + words, found.offsets[short + 1]])
    order = np.argsort(first, kind="stable")
    first, last = first[order], last[order]
    hashes = sequence.spans(first, last)
    begin = np.searchsorted(first, found.offsets)
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[begin[:-1][begin[:-1] < len(hashes)]] = True
    return hashes[new], np.concatenate([[0], np.cumsum(new)])[begin]


def codes(value: np.ndarray) -> np.ndarray:
    """Leading zeros and the mantissa bits below the first one of 64-bit values, in 16 bits."""
    top = value >> U64(12)
    zeros = 52 - np.frexp(top.astype(np.float64))[1].astype(np.int64)
    bits = ((top << zeros.astype(U64)) >> U64(51 - MANTISSA)) & U64((1 << MANTISSA) - 1)
    return ((zeros << MANTISSA) + bits.astype(np.int64)).astype(np.uint16)


def dense_registers(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One hash dealt over the buckets by its first bits; the hashes of a set are sorted, so the first is least."""
    docs = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    cell = docs * REGISTERS + (hashes >> U64(64 - 7)).astype(np.int64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    out = np.full((len(begin) - 1) * REGISTERS, EMPTY, np.uint16)
    out[cell[first]] = codes(hashes[first] << U64(7))
    return out.reshape(-1, REGISTERS)


def sparse_registers(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of its own for each register; every set has an element."""
    out = np.empty((len(begin) - 1, REGISTERS), np.uint16)
    for register, seed in enumerate(SEEDS):
        out[:, register] = codes(np.minimum.reduceat(mixed(hashes ^ seed), begin[:-1]))
    return out


def chosen(hashes: np.ndarray, begin: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of some documents only."""
    sizes = np.diff(begin)
    return hashes[np.repeat(which, sizes)], np.concatenate([[0], np.cumsum(sizes[which])])


def lists(registers: np.ndarray, which: np.ndarray) -> pa.Array:
    """A list of bands for the documents chosen, null for the others."""
    per = REGISTERS // BAND
    flat = np.ascontiguousarray(registers).view(np.int64).ravel()
    offsets = np.concatenate([[0], np.cumsum(np.where(which, per, 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(flat), mask=pa.array(~which))


def sketcher(words: int, percent: int):
    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in blocks(batch, "text"):
                hashes, begin = shingle_sets(data, offsets, words)
                sizes = np.diff(begin)
                few, many = (sizes > 0) & (sizes * percent <= SPARSE * 100), sizes > SPARSE
                yield pa.record_batch(
                    [
                        batch.column(batch.schema.get_field_index("id"))[rows],
                        pa.array(sequence_keys(data, offsets), pa.binary()),
                        pa.array(sizes),
                        lists(sparse_registers(*chosen(hashes, begin, few)), few),
                        lists(dense_registers(*chosen(hashes, begin, many)), many),
                    ],
                    schema=SKETCH,
                )

    return sketches


def sequence_keys(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """SHA-256 of each document's word sequence: words lower-cased and joined by one space."""
    lower = LOWER[data]
    white = WHITE[data]
    lower[white] = 32
    kept = ~white
    kept[1:] |= ~white[:-1]
    kept[offsets[:-1][np.diff(offsets) > 0]] &= ~white[offsets[:-1][np.diff(offsets) > 0]]
    ends = np.concatenate([[0], np.cumsum(kept)])[offsets].tolist()
    raw = lower[kept].tobytes()
    return [hashlib.sha256(raw[a:b].rstrip(b" ")).digest() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def text_shingles(text: bytes, words: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves, for the confirmation of links."""
    found = text.lower().split()
    return set(zip(*(found[i:] for i in range(words)), strict=False)) if len(found) >= words else {tuple(found)} if found else set()


def same_enough(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def alike(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of register rows, and the number of registers it rests on.

    Two different smallest hashes get one code with a chance of about 0.72 * 2**-MANTISSA * pq, p and q being
    the sets' shares of their common size.
    """
    used = ((a != EMPTY) | (b != EMPTY)).sum(-1)
    same = ((a == b) & (a != EMPTY)).sum(-1)
    total = np.maximum(size_a + size_b, 1.0)
    chance = 0.72 * 2.0**-MANTISSA * (size_a / total) * (size_b / total)
    return (same / np.maximum(used, 1) - chance) / (1 - chance), used


def promising(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    estimate, used = alike(a, b, size_a, size_b)
    t = percent / 100
    return estimate >= t - ERRORS * np.sqrt(t * (1 - t) / np.maximum(used, 1))


def register_rows(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).view(np.uint16)


def estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, kind) whose registers allow the threshold. b may be hot; its registers are dealt by slice."""
    mine = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sparse").alias("s_a"), F.col("dense").alias("d_a"))
    theirs = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sparse").alias("s_b"), F.col("dense").alias("d_b"))
    pairs = pairs.withColumn("slice", slice_of("a"))
    spread = pairs.select("b", "slice").distinct().join(theirs, "b")
    met = pairs.join(mine, "a").join(spread, ["b", "slice"]).select(
        "a", "b", "n_a", "n_b",
        F.when(F.col("kind") == 0, F.col("s_a")).otherwise(F.col("d_a")).alias("r_a"),
        F.when(F.col("kind") == 0, F.col("s_b")).otherwise(F.col("d_b")).alias("r_b"),
    )

    def kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                ok = promising(register_rows(f.r_a), register_rows(f.r_b), f.n_a.to_numpy(), f.n_b.to_numpy(), percent)
                yield f.loc[ok, ["a", "b"]]

    return met.mapInPandas(kept, "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold on their full sets.

    The text of b stands before those of its partners, for each slice of them, and the rows stream by: a task
    holds one batch and one set, however many partners b has.
    """
    pairs = pairs.withColumn("slice", slice_of("a"))
    heads = pairs.select("b", "slice").distinct().join(texts.withColumnRenamed("node", "b"), "b")
    heads = heads.select("b", "slice", F.lit(None).cast("long").alias("a"), "text")
    rest = pairs.join(texts.withColumnRenamed("node", "a"), "a").select("b", "slice", "a", "text")
    rows = heads.unionByName(rest).repartition("b", "slice").sortWithinPartitions("b", "slice", F.col("a").asc_nulls_first())

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, head, first, whole = None, np.empty(0, U64), b"", None
        for batch in batches:
            b_ids, a_ids = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            good_a, good_b = [], []
            for rows, data, offsets in blocks(batch, "text"):
                hashes, begin = shingle_sets(data, offsets, words)
                for i, row in enumerate(range(rows.start, rows.stop)):
                    mine = hashes[begin[i] : begin[i + 1]]
                    text = data[offsets[i] : offsets[i + 1]]
                    if a_ids[row] is None:
                        own, head, first, whole = b_ids[row], mine, text.tobytes(), None
                    elif b_ids[row] == own:
                        small, large = (mine, head) if len(mine) < len(head) else (head, mine)
                        at = np.minimum(np.searchsorted(large, small), max(len(large) - 1, 0))
                        both = int((large[at] == small).sum()) if len(small) else 0
                        if both and 100 * both >= percent * (len(mine) + len(head) - both):
                            whole = text_shingles(first, words) if whole is None else whole
                            if not same_enough(whole, text_shingles(text.tobytes(), words), percent):
                                continue
                            good_a.append(a_ids[row])
                            good_b.append(own)
            yield pa.record_batch([pa.array(good_a, pa.int64()), pa.array(good_b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(linked, "a long, b long")


def members(nodes: DataFrame) -> DataFrame:
    """(key, kind, node, n) of every bucket with two nodes at least."""
    each = nodes.select("node", "n", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("sparse").alias("bands")),
        F.struct(F.lit(1).alias("kind"), F.col("dense").alias("bands")),
    )).alias("sketch")).select("node", "n", "sketch.kind", F.posexplode("sketch.bands").alias("band", "value"))
    vacant = np.full(BAND, EMPTY, np.uint16).view(np.int64)[0]
    each = each.filter(F.col("value") != int(vacant)).select(F.xxhash64("kind", "band", "value").alias("key"), "kind", "band", "node", "n")
    shared = each.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    return stored(each.join(shared, "key"), "members")


def sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def star_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Every member with its bucket's leader: of the open members, the one that shares most with others.

    ``buckets`` has (key, kind, node, n, size, component, leading): ``leading`` marks who may lead.
    """
    score = buckets.groupBy("node").agg(F.sum("size").alias("score"))
    ranked = buckets.filter("leading").select("key", "node", "n", "component").join(score, "node")
    leaders = ranked.groupBy("key").agg(F.max(F.struct("score", F.bitwise_not("node").alias("order"), "n", "component")).alias("top"))
    leaders = leaders.select("key", F.bitwise_not("top.order").alias("b"), F.col("top.n").alias("n_b"), F.col("top.component").alias("c_b"))
    pairs = buckets.select("key", "kind", F.col("node").alias("a"), "n", "component").join(leaders, "key")
    return pairs.filter((F.col("component") != F.col("c_b")) & sizes_allow(F.col("n"), F.col("n_b"), percent)).groupBy("a", "b").agg(F.min("kind").alias("kind"))


def block_links(buckets: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between all components of a bucket, found in tasks of SIDE by SIDE members on their full sets.

    The largest component of a bucket is not compared with itself: its blocks meet the blocks of the others,
    and the others meet each other. A pair is looked at in the first band that it shares. A task returns a
    forest of its links, so no more rows than it has members, however many pairs are alike.
    """
    counts = buckets.groupBy("key", "component").agg(F.count("*").alias("m"))
    whole = counts.groupBy("key").agg(F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("all"))
    whole = whole.select("key", F.col("top.component").alias("main"), F.ceil(F.col("top.m") / SIDE).alias("wide"),
                         F.greatest(F.ceil((F.col("all") - F.col("top.m")) / SIDE), F.lit(1)).alias("long"))
    rows = buckets.join(whole, "key").join(nodes.select("node", "sparse", "dense").join(texts, "node"), "node")
    mine = F.xxhash64("node")
    is_main = F.col("component") == F.col("main")
    block = F.when(is_main, F.pmod(mine, F.col("wide"))).otherwise(F.pmod(mine, F.col("long")))
    across = F.transform(F.sequence(F.lit(0).cast("long"), F.col("long") - 1), lambda j: F.struct(F.lit(0).alias("part"), F.col("block").alias("x"), j.alias("y")))
    down = F.transform(F.sequence(F.lit(0).cast("long"), F.col("wide") - 1), lambda i: F.struct(F.lit(0).alias("part"), i.alias("x"), F.col("block").alias("y")))
    among = F.transform(F.sequence(F.lit(0).cast("long"), F.col("long") - 1), lambda j: F.struct(F.lit(1).alias("part"), F.least(j, "block").alias("x"), F.greatest(j, "block").alias("y")))
    rows = rows.withColumn("block", block).withColumn("task", F.explode(F.when(is_main, across).otherwise(F.concat(down, among))))
    rows = rows.select("task.part", "node", "n", "component", "band", is_main.alias("first"), "text", "key", "task.x", "task.y",
                       F.when(F.col("kind") == 0, F.col("sparse")).otherwise(F.col("dense")).alias("r"))

    def linked(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("node", ignore_index=True)
        first = f["first"].to_numpy()
        pairs = candidates(f, np.flatnonzero(first if f.part.iloc[0] == 0 else ~first), np.flatnonzero(~first), percent)
        return pd.DataFrame(forest(f, pairs, words, percent), columns=["a", "b"])

    return rows.groupBy("key", "part", "x", "y").applyInPandas(linked, "a long, b long")


def candidates(f: pd.DataFrame, left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, np.ndarray]]:
    """For each row of the left the rows of the right that may be linked with it and were not met before."""
    if not len(left) or not len(right):
        return []
    bands = np.stack(f.r.to_numpy())
    registers, sizes, owners, band = bands.view(np.uint16), f.n.to_numpy(), f.component.to_numpy(), int(f.band.iloc[0])
    vacant = int(np.full(BAND, EMPTY, np.uint16).view(np.int64)[0])
    found = []
    for i in left:
        rest = right[owners[right] != owners[i]]
        rest = rest[np.minimum(sizes[rest], sizes[i]) * 100 >= np.maximum(sizes[rest], sizes[i]) * percent]
        before = (bands[rest, :band] == bands[i, :band]) & (bands[i, :band] != vacant)
        rest = rest[~before.any(1)]
        rest = rest[promising(registers[i][None, :], registers[rest], np.float64(sizes[i]), sizes[rest], percent)]
        if len(rest):
            found.append((int(i), rest))
    return found


def forest(f: pd.DataFrame, pairs: list[tuple[int, np.ndarray]], words: int, percent: int) -> list[tuple[int, int]]:
    """Of the pairs that reach the threshold on their full sets, as many as join what was apart."""
    if not pairs:
        return []
    rows = np.unique(np.concatenate([np.append(r, i) for i, r in pairs]))
    batch = pa.record_batch([pa.array(f.text.iloc[rows].tolist(), pa.string())], names=["text"])
    parts = [shingle_sets(data, offsets, words) for _, data, offsets in blocks(batch, "text")]
    sizes = np.concatenate([np.diff(begin) for _, begin in parts])
    _, ids = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    place = {int(r): k for k, r in enumerate(rows)}
    nodes, owner = f.node.to_numpy(), dict(enumerate(f.component.tolist()))
    above: dict[int, int] = {}

    def root(c: int) -> int:
        while c in above:
            c = above[c]
        return c

    mask, links, shown = np.zeros(len(ids) + 1, bool), [], f.text
    for i, others in pairs:
        own = ids[begin[place[i]] : begin[place[i] + 1]]
        mask[own] = True
        at = np.array([place[int(o)] for o in others])
        hits = np.concatenate([[0], np.cumsum(mask[ids])])
        both = hits[begin[at + 1]] - hits[begin[at]]
        mask[own] = False
        for o in others[100 * both >= percent * (len(own) + sizes[at] - both)]:
            low, high = sorted((root(owner[i]), root(owner[int(o)])))
            if low != high and same_enough(text_shingles(shown.iloc[i].encode(), words), text_shingles(shown.iloc[int(o)].encode(), words), percent):
                above[high] = low
                links.append((int(max(nodes[i], nodes[o])), int(min(nodes[i], nodes[o]))))
    return links


def near_links(nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, component) of all nodes that are linked with another."""
    buckets = members(nodes)
    involved = buckets.select("node").distinct()
    texts = stored(texts.join(involved.hint("shuffle_hash"), "node", "left_semi"), "texts")
    edges, labels = None, None
    for star in range(STARS + 1):
        if labels is None:
            open_ = buckets.withColumn("component", F.col("node")).withColumn("leading", F.lit(True))
        else:
            now = buckets.filter("size > 2").join(labels, "node", "left")
            now = stored(now.withColumn("component", F.coalesce("component", "node")), "buckets")
            several = now.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
            counts = now.groupBy("key", "component").agg(F.count("*").alias("m")).groupBy("key").agg(F.max(F.struct("m", "component")).alias("top"))
            open_ = now.join(several.select("key"), "key", "left_semi").join(counts.select("key", F.col("top.component").alias("main")), "key")
            open_ = stored(open_.withColumn("leading", F.col("component") != F.col("main")).drop("main"), "open")
            if open_.isEmpty():
                break
        if star < STARS:
            pairs = estimated(star_pairs(open_, percent), nodes, percent)
            if edges is not None:
                pairs = pairs.join(edges, ["a", "b"], "left_anti")
            fresh = verified(pairs, texts, words, percent)
        else:
            fresh = block_links(open_, nodes, texts, words, percent)
        fresh = stored(fresh.select("a", "b"), "links")
        edges = fresh if edges is None else edges.unionByName(fresh)
        labels = components(edges)
    return labels


def near_dedup(documents: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    ship_package(documents.sparkSession)
    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    sketches = stored(rows.mapInArrow(sketcher(words, percent), "id long, key binary, n long, sparse array<long>, dense array<long>"), "sketches")
    named = sketches.filter("id is not null and n > 0")
    nodes = named.groupBy("key").agg(F.min(F.struct("id", "n", "sparse", "dense")).alias("s"))
    nodes = stored(nodes.select("key", F.col("s.id").alias("node"), "s.n", "s.sparse", "s.dense"), "nodes")
    labels = near_links(nodes.drop("key"), rows.select(F.col("id").alias("node"), "text"), words, percent)
    of_key = nodes.select("key", "node").join(labels, "node", "left").select("key", F.coalesce("component", "node").alias("component"))
    slim = sketches.select("id", "key", "n", slice_of("id").alias("slice"))
    spread = slim.select("key", "slice").distinct().join(of_key, "key")
    found = slim.join(spread, ["key", "slice"], "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")))
    return found.select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == component)).alias("kept"),
    )
