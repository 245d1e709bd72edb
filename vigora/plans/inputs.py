"""Documents put together from the test tables, in the form in which the document pipeline reads them: rows of pages.

A page of a law is the divisions of a unit's path and the unit's text, in order of article, earlier wordings first; the
tables of an annex stand behind every tenth article under a line ``ANEXO n``; the first page declares the norm. A page
of an accounting norm is the unit's section, its appendix and its text; a wording of a revised norm that holds carries
its mark of revision, every other item of an appendix the appendix's letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigora.operators import annexes as A
from vigora.operators import catalogs as C
from vigora.operators import metadata as M
from vigora.operators.retrieval import last_delivered
from vigora.sources.tables import table

#: Room for suffixes and earlier wordings between two units.
STEP = 1_000_000_000
NAMES = (("LC", "LEI COMPLEMENTAR"), ("Lei", "LEI"), ("Decreto", "DECRETO"), ("IN RFB", "INSTRUÇÃO NORMATIVA RFB"), ("Ato Conjunto", "ATO CONJUNTO"), ("SC Cosit", "SOLUÇÃO DE CONSULTA COSIT"))


def norms(spark: SparkSession, d: str) -> DataFrame:
    return C.distinct_norms(table(spark, d, "norm_meta")).withColumn("slug", M.slug(F.col("identificador")))


def _place(kind: str) -> tuple[Column, Column, Column]:
    """Number, place within the norm and number of the earlier wording of a unit, from its id."""
    part = lambda i: F.regexp_extract("id", rf"--{kind}-(\d+)(?:-?([a-z]))?(?:--anterior-(\d+))?$", i)
    number, earlier = F.nullif(part(1), F.lit("")).cast("bigint"), F.nullif(part(3), F.lit("")).cast("bigint")
    letter = F.when(part(2) != "", F.ascii(part(2)) - 96).otherwise(0)
    return number, number * STEP + letter * 10_000_000 + F.coalesce(earlier, F.lit(9_999_999)), earlier


def law_heads(spark: SparkSession, d: str) -> DataFrame:
    """``(slug, text)``: the declaring line and the summary of each law; norms without number or year have none."""
    name = F.upper("tipo")
    for tipo, shown in reversed(NAMES):
        name = F.when(F.col("tipo") == tipo, shown).otherwise(name)
    dotted = F.regexp_replace("numero", r"^(\d+)(\d{3})$", "$1.$2")
    line = F.concat(name, F.lit(" Nº "), dotted, F.lit(", DE 1º DE MARÇO DE "), F.col("ano"))
    held = norms(spark, d).where("tipo <> 'CPC'")
    return held.select("slug", F.concat(line, F.lit("\n\n"), F.coalesce("ementa", F.lit(""))).alias("text")).where("text IS NOT NULL")


def law_pages(spark: SparkSession, d: str) -> DataFrame:
    """``(doc_id, page_no, text)`` of the laws, ``doc_id`` being the norm's slug."""
    units = last_delivered(table(spark, d, "chunk").select("id", "path", "texto", "artigo", "loaded_at")).where("id LIKE '%--art-%'")
    _, place, _ = _place("art")
    parts = F.split(F.coalesce("path", F.lit("")), " > ", -1)
    head = F.nullif(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "\n"), F.lit(""))
    slug = F.substring_index("id", "--", 1)
    articles = units.select(slug.alias("doc_id"), place.alias("page_no"), F.concat_ws("\n", head, "texto").alias("text")).where("page_no IS NOT NULL")
    first = law_heads(spark, d).select(F.col("slug").alias("doc_id"), F.lit(0).cast("bigint").alias("page_no"), "text")
    rows = A.distinct_rows(table(spark, d, "annex_cell"))
    tables = rows.groupBy("slug", "csv").agg(F.array_sort(F.collect_list(F.struct("row_no", F.array_join("cells", " ").alias("t")))).alias("l"))
    number = F.regexp_extract("csv", r"(\d+)", 1).cast("bigint")
    text = F.concat(F.lit("ANEXO "), number, F.lit("\n"), F.array_join(F.transform("l", lambda x: x["t"]), "\n"))
    annexes = tables.select(F.col("slug").alias("doc_id"), (number * 10 * STEP + STEP - 1).alias("page_no"), text.alias("text"))
    annexes = annexes.where("page_no IS NOT NULL AND doc_id NOT LIKE 'cpc-%'")
    return first.unionByName(articles).unionByName(annexes)


def accounting_heads(spark: SparkSession, d: str) -> DataFrame:
    """``(slug, text)``: header, title and correlation of each accounting norm; every third one in the form of an NBC TG."""
    title = F.when(F.col("numero").cast("bigint") % 2 == 0, F.col("titulo")).otherwise(F.upper("titulo"))
    cpc = F.concat_ws("\n", F.concat(F.lit("PRONUNCIAMENTO TÉCNICO "), "identificador"), title,
                      F.concat(F.lit("Correlação às Normas Internacionais de Contabilidade – "), "correlacao_ifrs"))
    about = F.regexp_replace("ementa", "^Dispõe", "dispõe")
    nbc = F.concat_ws("\n", F.concat(F.lit("NBC TG "), "numero", F.lit(" – "), F.upper("titulo")),
                      F.concat(F.lit("Aprova a NBC TG "), "numero", F.lit(", que "), about))
    held = norms(spark, d).where("tipo = 'CPC' AND numero IS NOT NULL")
    return held.select("slug", F.when(F.col("numero").cast("bigint") % 3 == 0, nbc).otherwise(cpc).alias("text"))


def accounting_pages(spark: SparkSession, d: str) -> DataFrame:
    """``(doc_id, page_no, text)`` of the accounting norms, ``doc_id`` being the norm's slug."""
    units = last_delivered(table(spark, d, "chunk").select("id", "texto", "secao", "apendice", "revisao", "loaded_at")).where("id LIKE '%--item-%'")
    number, place, earlier = _place("item")
    mark = F.when(earlier.isNull() & F.col("revisao").startswith("R"), F.concat(F.lit(" (Alterado pela Revisão CPC "), "revisao", F.lit(")"))).otherwise("")
    lettered = F.when(F.col("apendice").isNotNull() & (number % 2 == 1), F.concat("apendice", "texto")).otherwise(F.col("texto"))
    text = F.concat_ws("\n\n", "secao", F.concat(F.lit("APÊNDICE "), "apendice"), F.concat(lettered, mark))
    far = F.coalesce(F.ascii("apendice").cast("bigint"), F.lit(0)) * (1_000_000 * STEP)
    items = units.select(F.substring_index("id", "--", 1).alias("doc_id"), (far + place).alias("page_no"), text.alias("text")).where("page_no IS NOT NULL")
    first = accounting_heads(spark, d).select(F.col("slug").alias("doc_id"), F.lit(0).cast("bigint").alias("page_no"), "text")
    return first.unionByName(items)


def accounting_openings(spark: SparkSession, d: str) -> DataFrame:
    """``(slug, text)``: header of each accounting norm, then the line ``OBJETIVO`` and its first two items."""
    units = last_delivered(table(spark, d, "chunk").select("id", "texto", "apendice", "loaded_at")).where("id LIKE '%--item-%' AND apendice IS NULL")
    number, place, earlier = _place("item")
    firsts = units.where(earlier.isNull() & number.isin(1, 2) & F.col("texto").isNotNull()).select(F.substring_index("id", "--", 1).alias("slug"), place.alias("at"), "texto")
    items = firsts.groupBy("slug").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "texto"))), lambda x: x["texto"]), "\n").alias("items"))
    both = accounting_heads(spark, d).join(items, "slug", "left")
    return both.select("slug", F.concat_ws("\n", "text", F.lit("OBJETIVO"), "items").alias("text"))
