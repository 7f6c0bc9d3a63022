"""One query per operator over its whole table, with production parameters, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintide.llm.alignment import align, linked_counts
from plaintide.llm.exact_dedup import exact_dedup
from plaintide.llm.hyperminhash import near_dedup
from plaintide.llm.line_dedup import line_dedup
from plaintide.llm.packing import pack
from plaintide.llm.quality_classifier import quality_scores
from plaintide.llm.quality_rules import quality_rules
from plaintide.llm.sentencepiece_codec import decode, encode
from plaintide.llm.shared import stored
from plaintide.llm.spelling import spelling_variants, vocabulary
from plaintide.llm.suffix_dedup import suffix_dedup
from plaintide.llm.token_counts import token_counts
from plaintide.llm.url_filter import RULES, url_filter
from plaintide.llm.warc import archived, payload_report

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_report(archived(spark.read.parquet(f"{sf_dir}/pages.parquet"), payloads=False, every=True))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir), words=3, percent=85)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to, as digests."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = decode(encode(documents(spark, sf_dir), model), model)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group texts are digested before the rows are stored for the second pass."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(F.lit(""))
    aligned = align(documents(spark, sf_dir), *paths).withColumn("groups_sha256", digest).drop("groups")
    return linked_counts(stored(aligned, "aligned"), *paths)


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(vocabulary(documents(spark, sf_dir), delete_every=31))


def queries() -> dict[str, Query]:
    return {
        "op1_warc": op1_warc,
        "op2_packing": op2_packing,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_near_dedup": op4_near_dedup,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_token_counts": op6_token_counts,
        "op7_quality_rules": op7_quality_rules,
        "op8_line_dedup": op8_line_dedup,
        "op9_sentencepiece": op9_sentencepiece,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_alignment": op11_alignment,
        "op12_url_filter": op12_url_filter,
        "op13_spelling": op13_spelling,
    }


ORACLE = {
    "op1_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (
            SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)""",
    "op3_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS squeezed
            FROM documents),
        g AS (
            SELECT squeezed, count(*) AS group_size,
                   first(doc_id ORDER BY points DESC, doc_id) AS keep_id
            FROM d GROUP BY squeezed)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(squeezed) AS text_sha256
        FROM d JOIN g USING (squeezed)""",
    "op8_line_dedup": r"""
        WITH s AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
            FROM documents),
        k AS (
            SELECT doc_id, place, line,
                   translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM s),
        often AS (
            SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        m AS (
            SELECT doc_id, place, line, last IS NOT NULL AND doc_id <> last AS gone
            FROM k LEFT JOIN often USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
