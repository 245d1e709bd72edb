"""Rendering units and metadata as Markdown lines; order is a column, texts are gathered per document only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigora.operators import dialect as D
from vigora.operators import metadata as M
from vigora.operators import structure as S
from vigora.operators.annexes import fit, markdown_head, routing


def quoted(c: Column) -> Column:
    """A string as JSON text."""
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"^\{\"v\":((?s:.*))\}$", 1)


def front_matter(metas: DataFrame, keys: Sequence[str] = ("identificador", "tipo", "numero", "ano", "fonte_arquivo", "sha256_16", "ementa")) -> Column:
    """``key: "value"`` lines of the non-empty values between rules."""
    lines = [F.when(F.coalesce(F.col(k), F.lit("")) != "", F.concat(F.lit(f"{k}: "), quoted(F.col(k)))) for k in keys if k in metas.columns]
    return F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"))


def annex_index(rows: DataFrame) -> DataFrame:
    """``(slug, csv, line)``: a list entry per annex with its rows, its page (a column ``page``, if there is one) and its first six headers."""
    page = F.min("page") if "page" in rows.columns else F.lit(None).cast("int")
    tables = rows.groupBy("slug", "csv").agg(F.count("*").alias("n"), F.min_by("header", "row_no").alias("header"), page.alias("page"))
    heads = F.when(F.size("header") > 0, F.array_join(F.slice("header", 1, 6), ", ")).otherwise("—")
    number = F.regexp_extract("csv", r"([^_]*)\.csv$", 1)
    size = F.concat(F.lit("("), "n", F.lit(" linhas"), F.coalesce(F.concat(F.lit(" · p. "), "page"), F.lit("")), F.lit(")"))
    line = F.concat(F.lit("- **Anexo "), number, F.lit("** "), size, F.lit(" → `anexos/"), "csv", F.lit("`  \n  Colunas: "), heads)
    return tables.select("slug", "csv", line.alias("line"))


def inline_tables(rows: DataFrame) -> DataFrame:
    """``(slug, csv, markdown)`` of the tables that are too small for a file of their own (``rows`` of these tables)."""
    page = F.min("page") if "page" in rows.columns else F.lit(None).cast("int")
    line = F.concat(F.lit("| "), F.array_join(fit(F.col("cells"), F.col("header")), " | "), F.lit(" |"))
    tables = rows.groupBy("slug", "csv").agg(
        F.min_by("header", "row_no").alias("header"), page.alias("page"), F.array_sort(F.collect_list(F.struct("row_no", line.alias("t")))).alias("l")
    )
    place = F.coalesce(F.concat(F.lit("> Tabela (p. "), "page", F.lit("):\n")), F.lit("> Tabela:\n"))
    body = F.concat_ws("\n", markdown_head(F.col("header")), F.array_join(F.transform("l", lambda x: x["t"]), "\n"))
    return tables.select("slug", "csv", F.concat(F.lit("\n"), place, F.lit("\n"), body).alias("markdown"))


def crumb_level(part: Column) -> Column:
    word = F.upper(F.regexp_extract(part, rf"^{D.S}*({D.NOT_S}+)", 1))
    levels = F.create_map(*[F.lit(x) for pair in D.LEVELS.items() for x in pair])
    return F.least(F.coalesce(F.try_element_at(levels, word), F.lit(D.OTHER_LEVEL)) + 1, F.lit(6))


def headings(units: DataFrame, path: str = "breadcrumb") -> DataFrame:
    """Adds ``headings``: the parts of a unit's breadcrumb behind those it shares with the unit before, as Markdown."""
    order = W.partitionBy("doc_id").orderBy("pos")
    parts = F.filter(F.split(path, " > ", -1), lambda p: p != "")
    marked = units.withColumn("_p", parts).withColumn("_q", F.coalesce(F.lag("_p").over(order), F.array().cast("array<string>")))
    same = F.transform("_p", lambda p, i: F.coalesce(F.get("_q", i) == p, F.lit(False)))
    shared = F.coalesce(F.array_position(same, False) - 1, F.size("_p"))
    shared = F.when(shared < 0, F.size("_p")).otherwise(shared).cast("int")
    fresh = F.when(F.size("_p") > shared, F.slice("_p", shared + 1, F.size("_p") - shared)).otherwise(F.array().cast("array<string>"))
    lines = F.transform(fresh, lambda p: F.concat(F.repeat(F.lit("#"), crumb_level(p)), F.lit(" "), p))
    return marked.withColumn("headings", F.array_join(lines, "\n")).drop("_p", "_q")


def section_changes(units: DataFrame) -> DataFrame:
    """Adds ``heading``: the section where it differs from the item before, else null."""
    order = W.partitionBy("doc_id").orderBy("pos")
    return units.withColumn("heading", F.when(~F.lag("secao").over(order).eqNullSafe(F.col("secao")), F.col("secao")))


def unit_markdown(units: DataFrame) -> DataFrame:
    """``(doc_id, pos, markdown)``: headings, anchor and body of each unit of the law dialect."""
    body = S.with_subunits(units, F.col("texto"))
    body = headings(body.withColumn("_b", S.body_markdown(F.col("caput"), F.col("units"))))
    anchor = F.concat(F.lit("<a id=\""), anchor_of(), F.lit("\"></a>\n"))
    shown = S.display(F.col("numero"))
    old = F.concat(F.lit("> _(Art. "), shown, F.lit(" — redação anterior, superada)_  \n> "), F.col("_b"))
    text = F.when(F.col("vigente"), F.concat(F.lit("**Art. "), shown, F.lit(".** "), F.col("_b"))).otherwise(old)
    head = F.when(F.col("headings") != "", F.concat(F.lit("\n"), F.col("headings"), F.lit("\n"))).otherwise("")
    return body.select("doc_id", "pos", F.concat(head, F.lit("\n"), anchor, F.trim(text)).alias("markdown"))


def anchor_of() -> Column:
    return F.regexp_replace(S.unit_id(F.lit(""), F.concat(F.lit("art-"), F.col("numero")), F.col("anterior")), "^--", "")


def items_markdown(units: DataFrame) -> DataFrame:
    """``(doc_id, pos, markdown)``: section heading, anchor and body of each unit of the accounting dialect."""
    body = section_changes(units).withColumn("_b", S.item_markdown(F.col("texto"), F.col("alineas"), F.col("subitens")))
    anchor = F.regexp_replace(S.unit_id(F.lit(""), S.item_ref(F.col("numero")), F.col("anterior")), "^--", "")
    old = F.concat(F.lit("> _(Item "), "numero", F.lit(" — redação anterior, superada por revisão)_  \n> "), "_b")
    text = F.when(F.col("vigente"), F.concat(F.lit("**"), "numero", F.lit(".** "), "_b")).otherwise(old)
    head = F.when(F.col("heading").isNotNull(), F.concat(F.lit("\n## "), "heading", F.lit("\n\n"))).otherwise("")
    return body.select("doc_id", "pos", F.concat(head, F.lit('\n<a id="'), anchor, F.lit('"></a>\n'), S.strip(text)).alias("markdown"))


LAW_KEYS = ("identificador", "tipo", "numero", "ano", "fonte_arquivo", "sha256_16", "ementa")
ACCOUNTING_KEYS = ("identificador", "tipo", "numero", "revisao", "titulo", "correlacao_ifrs", "fonte_arquivo", "sha256_16", "ementa")


def document_rows(metas: DataFrame, units: DataFrame, annexes: DataFrame, keys: Sequence[str] = LAW_KEYS) -> DataFrame:
    """``(doc_id, part, place, markdown)``: whole documents as rows in order of ``part`` and ``place``; joined by line feeds they are the text.

    Parts: 0 front matter, title, correlation and summary; 1 annex index; 2 units (``units`` has ``doc_id, pos, markdown``);
    3 small tables. ``metas`` has a ``slug``, ``annexes`` the rows of all tables; a document is never gathered in one row.
    """
    quote = lambda c, lead="": F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f"> {lead}"), F.col(c), F.lit("\n")))
    titled = F.concat(F.lit(" — "), F.coalesce("titulo", "identificador")) if "titulo" in keys else F.lit("")
    named = [quote("correlacao_ifrs", "**Correlação:** ")] if "correlacao_ifrs" in keys else []
    top = F.concat_ws("\n", F.concat(front_matter(metas, keys), F.lit("\n")), F.concat(F.lit("# "), "identificador", titled, F.lit("\n")), *named, quote("ementa"))
    row = lambda part, at, markdown: (F.lit(part).alias("part"), at.alias("place"), markdown.alias("markdown"))
    heads = metas.select(F.col("slug").alias("doc_id"), *row(0, F.lit("0"), top))
    known = annexes.join(metas.select("slug"), "slug", "left_semi")
    routes = routing(known).select("slug", "csv", "to_csv")
    listed = annex_index(known).join(routes.where("to_csv"), ["slug", "csv"])
    title = listed.select("slug").distinct().select(F.col("slug").alias("doc_id"), *row(1, F.lit(""), F.lit("## Anexos e tabelas\n")))
    index = listed.select(F.col("slug").alias("doc_id"), *row(1, F.col("csv"), F.col("line")))
    order = F.format_string("%012d", F.col("pos"))
    body = units.join(metas.select(F.col("slug").alias("doc_id")), "doc_id", "left_semi").select("doc_id", *row(2, order, F.col("markdown")))
    small = known.join(routes.where("NOT to_csv"), ["slug", "csv"], "left_semi")
    tables = inline_tables(small).select(F.col("slug").alias("doc_id"), *row(3, F.col("csv"), F.col("markdown")))
    return heads.unionByName(title).unionByName(index).unionByName(body).unionByName(tables)


def _with_norm(units: DataFrame, metas: DataFrame, annexes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Units with the columns of their norm and the sorted names of its annexes (as many as the norm has tables)."""
    held = annexes.where("csv IS NOT NULL").groupBy("slug").agg(F.array_sort(F.collect_set("csv")).alias("anexos"))
    known = metas.select("slug", *columns).join(held, "slug", "left")
    both = units.join(known, units["doc_id"] == known["slug"], "left")
    return both.withColumn("anexos", F.coalesce("anexos", F.array().cast("array<string>")))


def law_records(units: DataFrame, metas: DataFrame, annexes: DataFrame) -> DataFrame:
    """Chunk records of laws: id, norm, path, current or not, text with its number, notes, references, annexes, source."""
    both = _with_norm(units, metas, annexes, ("identificador", "tipo", "fonte_arquivo"))
    parts = S.with_subunits(both.withColumnRenamed("refs", "_refs"), F.col("texto"))
    shown = F.concat(F.lit("Art. "), S.display(F.col("numero")))
    text = S.strip(F.concat(shown, F.lit(". "), S.body_text(F.col("caput"), F.col("units"))))
    return parts.select(
        S.unit_id(F.col("doc_id"), F.concat(F.lit("art-"), F.col("numero")), F.col("anterior")).alias("id"), F.col("identificador").alias("norma"), "tipo",
        F.concat_ws(" > ", F.nullif("breadcrumb", F.lit("")), shown).alias("path"), F.col("numero").alias("artigo"), "vigente", text.alias("texto"),
        F.col("notas").alias("notas_vigencia"), F.col("_refs").alias("refs"), "anexos", F.col("fonte_arquivo").alias("fonte"),
    )


def accounting_records(units: DataFrame, metas: DataFrame, annexes: DataFrame) -> DataFrame:
    """Chunk records of accounting norms; ids are not unique where several wordings of an item hold (``doc_id, pos`` is the key)."""
    both = _with_norm(units, metas, annexes, ("identificador", "tipo", "fonte_arquivo", F.col("numero").alias("numero_norma"), "revisao", "correlacao_ifrs"))
    text = S.strip(F.concat(F.lit("Item "), F.col("numero"), F.lit(". "), S.item_text(F.col("texto"), F.col("alineas"), F.col("subitens"))))
    return both.select(
        S.unit_id(F.col("doc_id"), S.item_ref(F.col("numero")), F.col("anterior")).alias("id"), "doc_id", "pos", F.col("identificador").alias("norma"), "tipo", "numero_norma",
        "revisao", "correlacao_ifrs", F.concat("secao", F.lit(" > Item "), "numero").alias("path"), "secao", F.col("numero").alias("item"), "apendice", "vigente",
        text.alias("texto"), F.col("notas").alias("notas_vigencia"), "refs", "anexos", F.col("fonte_arquivo").alias("fonte"),
    )


def law_meta(pages: DataFrame, heads: DataFrame, units: DataFrame, annexes: DataFrame) -> DataFrame:
    """``(doc_id, tipo, numero, ano, ementa, n_*)``: what a law's head declares and what its units count up to.

    ``heads`` has ``(doc_id, text)``, the raw text of the first pages; documents without a head have only counts.
    """
    counts = units.groupBy("doc_id").agg(
        F.count("*").alias("n_artigos"), F.count_if("vigente").alias("n_artigos_vigentes"), F.count_if(~F.col("vigente")).alias("n_redacoes_anteriores")
    )
    told = heads.select("doc_id", M.identity(F.col("text")).alias("e"), M.summary(F.col("text")).alias("ementa"))
    return _counted(pages, annexes).join(told, "doc_id", "left").join(counts, "doc_id", "left").select(
        "doc_id", "e.tipo", "e.numero", "e.ano", M.norm_id(F.col("e.tipo"), F.col("e.numero"), F.col("e.ano"), F.col("doc_id")).alias("identificador"), "ementa",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_artigos", "n_artigos_vigentes", "n_redacoes_anteriores", "n_anexos_csv")], "n_paginas",
    )


def accounting_meta(pages: DataFrame, heads: DataFrame, counts: DataFrame, annexes: DataFrame) -> DataFrame:
    """``(doc_id, tipo, numero, revisao, titulo, correlacao_ifrs, identificador, ementa, dir_slug, id_slug, n_*, secoes)``."""
    told = heads.select(
        "doc_id", M.accounting_header(F.col("text")).alias("h"), M.title(F.col("text")).alias("titulo"), M.ifrs(F.col("text")).alias("correlacao_ifrs"),
        M.accounting_summary(F.col("text")).alias("ementa"),
    )
    named = told.select("*", M.accounting_slugs(F.col("h")).alias("s"), M.accounting_id(F.col("h")).alias("identificador"))
    both = _counted(pages, annexes).join(named, "doc_id", "left").join(counts, "doc_id", "left")
    n = [c for c in counts.columns if c.startswith("n_")]
    return both.select(
        "doc_id", "h.tipo", "h.numero", "h.revisao", "titulo", "correlacao_ifrs", F.coalesce("identificador", "doc_id").alias("identificador"), "ementa", "s.dir_slug", "s.id_slug",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in n], "secoes", F.coalesce("n_anexos_csv", F.lit(0)).alias("n_anexos_csv"), "n_paginas",
    )


def _counted(pages: DataFrame, annexes: DataFrame) -> DataFrame:
    csvs = annexes.where("csv IS NOT NULL").groupBy(F.col("slug").alias("doc_id")).agg(F.count_distinct("csv").alias("n_anexos_csv"))
    return pages.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n_paginas")).join(csvs, "doc_id", "left")
