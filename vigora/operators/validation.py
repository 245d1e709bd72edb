"""Data-quality checks over units and their metadata, each a table of what fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigora.operators.catalogs import distinct_norms
from vigora.operators.metadata import slug
from vigora.operators.retrieval import last_delivered


def unit_counts(chunks: DataFrame) -> DataFrame:
    units = last_delivered(chunks).withColumn("slug", F.substring_index("id", "--", 1))
    return units.groupBy("slug").agg(F.count("*").alias("units"), F.count_if(F.coalesce("vigente", F.lit(False))).alias("current"))


def counts_against_meta(chunks: DataFrame, metas: DataFrame) -> DataFrame:
    """``(slug, units, said, current, said_current)`` of norms whose counts differ from their metadata (null says nothing)."""
    said = distinct_norms(metas).select(
        slug(F.col("identificador")).alias("slug"),
        F.coalesce("n_artigos", "n_itens").cast("bigint").alias("said"),
        F.coalesce("n_artigos_vigentes", "n_itens_vigentes").cast("bigint").alias("said_current"),
    )
    both = unit_counts(chunks).join(said, "slug")
    return both.where((F.col("units") != F.col("said")) | (F.col("current") != F.col("said_current")))


def repeated_ids(chunks: DataFrame) -> DataFrame:
    return chunks.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def broken_json(raw: DataFrame, body: str = "body") -> DataFrame:
    return raw.where(F.try_parse_json(body).isNull()).drop(body)


def front_matter_differs(docs: DataFrame, metas: DataFrame) -> DataFrame:
    """Documents (``slug, markdown``) whose front matter names another identifier than their metadata."""
    said = F.regexp_extract("markdown", r"(?m)^identificador: \"(.*)\"$", 1)
    known = distinct_norms(metas).select(slug(F.col("identificador")).alias("slug"), "identificador")
    return docs.join(known, "slug").where(said != F.col("identificador")).select("slug", said.alias("said"), "identificador")


def missing_annexes(chunks: DataFrame, annexes: DataFrame) -> DataFrame:
    """``(slug, csv)`` named by a unit but not held."""
    named = chunks.select(F.substring_index("id", "--", 1).alias("slug"), F.explode("anexos").alias("csv")).where("csv IS NOT NULL AND csv <> ''").distinct()
    return named.join(annexes.select("slug", "csv").distinct(), ["slug", "csv"], "left_anti")


def mojibake(c: Column) -> Column:
    """UTF-8 read as Latin-1: a capital a with tilde or circumflex before a sign of the upper half."""
    return c.rlike(r"[ÃÂ][\x{80}-\x{bf}]")


def sanity(metas: DataFrame, least: int = 1) -> DataFrame:
    """``(identificador, problem)``: null number or year, too few units."""
    norms = distinct_norms(metas)
    n = F.coalesce("n_artigos", "n_itens")
    problems = F.array_compact(F.array(F.when(F.col("numero").isNull(), "no number"), F.when(F.col("ano").isNull(), "no year"), F.when(n < least, "few units")))
    return norms.select("identificador", F.explode(problems).alias("problem"))


def annex_leaks(lines: DataFrame, units: DataFrame, least: int = 20) -> DataFrame:
    """``(doc_id, annex_lines, leaked)``: of a document's distinct annex lines of ``least`` characters (``lines`` as told by the law dialect), how many also stand in a unit."""
    skipped = lines.where((F.col("kind") == "skipped") & (F.length("line") >= least)).select("doc_id", "line").distinct()
    said = units.select("doc_id", F.explode(F.split("texto", "\n", -1)).alias("line")).distinct().withColumn("_leaked", F.lit(1))
    both = skipped.join(said, ["doc_id", "line"], "left")
    return both.groupBy("doc_id").agg(F.count("*").alias("annex_lines"), F.count("_leaked").alias("leaked"))
