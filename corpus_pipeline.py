"""The corpus pipeline: quality, exact copies, near copies, repeated passages, packing.

Each stage takes all documents that its predecessor kept, as (spark, docs, sf_dir), and is written as Parquet and
read again before the next. All but the last return the columns of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plaintide.llm.exact_dedup import exact_dedup, squeezed
from plaintide.llm.hyperminhash import near_dedup
from plaintide.llm.packing import pack
from plaintide.llm.quality_classifier import fit, scored
from plaintide.llm.shared import stored
from plaintide.llm.suffix_dedup import removed_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows and bytes of one batch between Spark and Python; a batch is held several times over on both sides.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def in_small_batches(stage: Stage) -> Stage:
    """The stage, its Python work fed in bounded batches; the settings stay with the session, as the stage's rows are made later."""

    @functools.wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BATCH.items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return bounded


def with_key(docs: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """The rows whose key is a ``_key`` of kept, with it."""
    return docs.withColumn("_key", key).join(kept.hint("shuffle_hash"), "_key", "left_semi")


@in_small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of one half or more."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).filter("score >= 0.5").select("row.*")


@in_small_batches
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of each group of copies that is kept; of rows that share its id, the longest text's, then least hash's.

    Rows that agree in id and text are one document here; the near stage leaves one of them.
    """

    def key(id: str, sha256: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col(id).cast("string"), F.lit("")), sha256)

    kept = exact_dedup(docs).filter("kept").select(key("doc_id", F.col("text_sha256")).alias("_key")).distinct()
    rows = with_key(docs, key("doc_id", F.sha2(squeezed(F.col("text")).cast("binary"), 256)), kept)
    text = F.coalesce("text", F.lit(""))
    best = Window.partitionBy("_key").orderBy(F.length(text).desc(), F.xxhash64(text))
    return rows.withColumn("_rank", F.rank().over(best)).filter("_rank = 1").select(*docs.columns)


@in_small_batches
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that is linked on five-word shingles at a similarity of 0.8: the least id, null last.

    A document is an id and a text, named by a hash of both, so a null or shared id joins no other text.
    """
    name = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.coalesce("text", F.lit("")))
    named = docs.select(name.alias("_key"), "doc_id", "text")
    decisions = near_dedup(named, id="_key", words=5, percent=80).select("_key", "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "_key")
    members = decisions.distinct().join(named.select("_key", "doc_id").distinct(), "_key")
    kept = members.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first._key").alias("_key"))
    one = Window.partitionBy("_key").orderBy(*docs.columns)
    return with_key(docs, name, kept).withColumn("_row", F.row_number().over(one)).filter("_row = 1").select(*docs.columns)


@in_small_batches
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings of 200 bytes that occur more than once; n_chars follows a changed text."""
    rest = removed_repeats(docs).select(F.col("id").alias("_id"), F.col("mark").alias("_mark"), "rest").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_mark"))
    joined = docs.join(rest.hint("shuffle_hash"), same, "left")
    changed = F.col("_mark").isNotNull()
    text = F.when(changed, F.col("rest")).otherwise(F.col("text"))
    chars = F.when(changed, F.length("rest").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return joined.withColumns({"text": text, "n_chars": chars}).select(*docs.columns)


@in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids (little-endian 32-bit), sequence and offset."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("suffix_dedup", passages),
    ("packing", packing),
]

#: Classifier, sketches and packing are not SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
