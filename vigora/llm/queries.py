"""Queries of the corpus problems, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigora.llm import mixing, neardup, splitting, stuffing, tokens
from vigora.sources.tables import table

#: Similarity, words of a sequence and least words of problem 3.
ALIKE = {"threshold": 0.6, "width": 3, "min_words": 60}


def buckets(docs: DataFrame) -> int:
    """Buckets of hashed keys: some 20,000 rows of input each, read from the files' footers."""
    return max(12, docs.count() // 20_000)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "chunk").select("id", "texto")
    return neardup.similar_pairs(docs, "id", "texto", **ALIKE, buckets=buckets(docs))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "chunk").select("id", "texto")
    return neardup.similar_groups(docs, "id", "texto", **ALIKE, buckets=buckets(docs))


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.oversized(table(spark, d, "chunk").select("id", "texto").distinct(), "id", "texto")


def p4_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Per oversized text the MD5 of its pieces joined without their overlaps, and whether all pieces keep the limit and the overlap."""
    return splitting.rejoined(p4_pieces(spark, d), "id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.oversized(table(spark, d, "chunk"), "id", "texto").select("id").distinct()


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_texts(table(spark, d, "documents").select("doc_id", "text"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "source_target"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.report(p8_mix(spark, d), table(spark, d, "source_target"))


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return stuffing.spam_pages(docs, buckets(docs))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_scores(spark, d).where("spam").select("doc_id").distinct()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p3_found, p3_groups, p4_found, p4_pieces, p4_roundtrip, p7_ids, p8_mix, p8_shares, p9_found, p9_scores)}

ORACLE: dict[str, str] = {
    "p4_roundtrip": r"""
        WITH t AS (SELECT DISTINCT id, regexp_replace(regexp_replace(regexp_replace(texto, '^[ \t\n\r\x{00a0}]+|[ \t\n\r\x{00a0}]+$', '', 'g'),
          '[ \t\x{00a0}]*[\n\r][ \t\n\r\x{00a0}]*', chr(10), 'g'), '[ \t\x{00a0}]+', ' ', 'g') AS whole FROM chunk WHERE id IS NOT NULL)
        SELECT id, md5(whole) AS whole, true AS kept FROM t WHERE length(whole) > 2400
    """,
    "p4_found": r"""
        SELECT DISTINCT id FROM chunk
        WHERE length(regexp_replace(regexp_replace(texto, '[ \t\n\r\x{00a0}]+', ' ', 'g'), '^ | $', '', 'g')) > 2400
    """,
}
