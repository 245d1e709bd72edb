"""Lines to hierarchical units, in two dialects, and which wording of a unit is current.

All state that a reader would carry down a document (open unit, breadcrumb, annex mode, section) is a
last-value or running-sum window over one order of lines, so a document is exchanged once for the whole
parse; supersession and counters reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigora.operators import dialect as D
from vigora.operators.lines import ci, split_lines, strip


def in_order(column: Column) -> Column:
    """``column`` over the lines of a document up to this one; the one window that all state shares."""
    return column.over(W.partitionBy("doc_id").orderBy("line_no"))


def numbered_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, line_no, line)`` of documents that are one text, lines stripped; those of a null id are left out.

    Documents of several pages come as the same rows from ``lines.clean_lines``.
    """
    placed = docs.where(F.col("doc_id").isNotNull())
    return placed.select("doc_id", F.posexplode(split_lines("text")).alias("line_no", "raw")).select("doc_id", "line_no", strip("raw").alias("line"))


def classify_law(lines: DataFrame) -> DataFrame:
    """Adds ``kind``: annex, division, article, body, blank, or skipped (within an annex); ``number`` and ``rest`` of an article."""
    line = F.col("line")
    head = line.startswith("Art") & line.rlike(D.ARTICLE)
    told = lines.select(
        "*",
        F.when(ci(line, D.ANNEX), "annex").when(ci(line, D.DIVISION), "division").when(head, "article").alias("_h"),
    )
    rest = strip(F.regexp_extract(line, D.ARTICLE, 2))
    seen = told.withColumn("rest", F.when(F.col("_h") == "article", rest))
    mode = in_order(F.last(F.when(F.col("_h") == "annex", 1).when(F.col("_h").isNotNull(), 0), ignorenulls=True))
    kind = (
        F.when(F.col("_h") == "annex", "annex")
        .when(F.coalesce(mode, F.lit(0)) == 1, "skipped")
        .when(line == "", "blank")
        .when((F.col("_h") == "division") & (F.length("line") < 120), "division")
        .when((F.col("_h") == "article") & ~F.col("rest").rlike(D.REF_TAIL), "article")
        .otherwise("body")
    )
    number = F.when(F.col("kind") == "article", plain_number(F.regexp_extract("line", D.ARTICLE, 1)))
    return seen.withColumn("kind", kind).drop("_h").withColumn("number", number)


def level_of(line: Column) -> Column:
    """Level of a division by its first word, 3 for an unknown spelling."""
    word = F.upper(F.regexp_extract(line, f"(?iu){D.DIVISION}", 1))
    levels = F.create_map(*[F.lit(x) for pair in D.LEVELS.items() for x in pair])
    return F.coalesce(F.get(F.array(F.try_element_at(levels, word)), F.lit(0)), F.lit(D.OTHER_LEVEL))


def plain_number(number: Column) -> Column:
    return strip(F.regexp_replace(number, "[ºo]", ""))


def display(number: Column) -> Column:
    """1 -> 1º, 9 -> 9º, 10 -> 10, 3-A -> 3º-A."""
    digits, suffix = F.regexp_extract(number, r"^(\d+)(-[A-Z])?$", 1), F.regexp_extract(number, r"^(\d+)(-[A-Z])?$", 2)
    ordinal = F.when(F.length(F.ltrim(digits, F.lit("0"))) <= 1, "º").otherwise("")
    return F.when(digits == "", number).otherwise(F.concat(digits, ordinal, suffix))


def notes(text: Column, pattern: str = D.NOTE) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))


def refs(text: Column, own: Column) -> Column:
    """Distinct ``art-N`` named in a text, but for its own, sorted as strings."""
    found = F.transform(F.regexp_extract_all(text, F.lit(f"(?iu){D.REF}"), F.lit(1)), lambda n: F.concat(F.lit("art-"), plain_number(n)))
    return F.array_sort(F.array_distinct(F.filter(found, lambda r: r != F.concat(F.lit("art-"), own))))


def law_units(lines: DataFrame) -> DataFrame:
    """``(doc_id, pos, numero, breadcrumb, texto, notas, refs, vigente, anterior)``: one row per article of rows of lines."""
    lines = classify_law(lines)
    level = F.when(F.col("kind") == "division", level_of(F.col("line")))
    crumbs = [
        in_order(F.last(F.when(level == k, F.struct(F.col("line_no").alias("at"), F.col("line").alias("t"))), ignorenulls=True))
        for k in range(1, 6)
    ]
    state = lines.select(
        "*",
        in_order(F.sum((F.col("kind") == "article").cast("int"))).alias("pos"),
        in_order(F.last(F.when(F.col("kind") == "article", 1).when(F.col("kind").isin("division", "annex"), 0), ignorenulls=True)).alias("open"),
        *[c.alias(f"c{k}") for k, c in enumerate(crumbs, 1)],
    )
    held = state.where((F.col("open") == 1) & F.col("kind").isin("article", "body", "blank"))
    above = lambda k: F.greatest(*[F.coalesce(F.col(f"c{j}.at"), F.lit(-1)) for j in range(1, k)], F.lit(-1), F.lit(-1))
    crumb = F.concat_ws(" > ", *[F.when(F.col(f"c{k}.at") > above(k), F.col(f"c{k}.t")) for k in range(1, 6)])
    head = F.col("kind") == "article"
    text = F.when(head, F.col("rest")).otherwise(F.col("line"))
    units = held.groupBy("doc_id", "pos").agg(
        F.max("number").alias("numero"),
        F.max(F.when(head, crumb)).alias("breadcrumb"),
        F.array_sort(F.collect_list(F.struct("line_no", text.alias("t")))).alias("l"),
    )
    joined = units.select("doc_id", "pos", "numero", "breadcrumb", strip(F.array_join(F.transform("l", lambda x: x["t"]), "\n")).alias("texto"))
    full = joined.select("*", notes(F.col("texto")).alias("notas"), refs(F.col("texto"), F.col("numero")).alias("refs"))
    return supersede(full, ["doc_id", "numero"], (F.size("notas") > 0).cast("int"))


def supersede(units: DataFrame, same: list[str], noted: Column) -> DataFrame:
    """Adds ``vigente`` (the last noted wording of the same unit, else the last) and ``anterior``, a counter of superseded ones."""
    best = W.partitionBy(*same).orderBy(noted.desc(), F.col("pos").desc())
    marked = units.withColumn("vigente", F.row_number().over(best) == 1)
    count = F.sum((~F.col("vigente")).cast("int")).over(W.partitionBy("doc_id").orderBy("pos"))
    return marked.withColumn("anterior", F.when(~F.col("vigente"), count))


def unit_id(slug: Column, part: Column, anterior: Column) -> Column:
    return F.concat(slug, F.lit("--"), part, F.when(anterior.isNotNull(), F.format_string("--anterior-%03d", anterior)).otherwise(""))


def with_subunits(df: DataFrame, text: Column) -> DataFrame:
    """Adds ``caput`` and ``units``, the array of ``(level, label, content)`` of a unit's text.

    Levels: paragraph, inciso, letter, number. Each step is a projection of its own, so no line is matched twice.
    """
    kinds = ((f"(?iu){D.PARAGRAPH}", 1), (D.ROMAN, 2), (D.LETTER, 3), (D.NUMBERED, 4))

    def told(x: Column) -> Column:
        row = lambda p, n: F.struct(F.lit(n).alias("level"), strip(F.regexp_extract(x, p, 1)).alias("label"), strip(F.regexp_extract(x, p, 2)).alias("t"))
        out = F.when(x.rlike(kinds[0][0]), row(*kinds[0]))
        for p, n in kinds[1:]:
            out = out.when(x.rlike(p), row(p, n))
        none = F.lit(None)
        return out.otherwise(F.struct(none.cast("int").alias("level"), none.cast("string").alias("label"), x.alias("t")))

    said = df.withColumn("_s", F.filter(F.transform(F.split(text, "\n", -1), strip), lambda x: x != ""))
    lines = said.withColumn("_l", F.transform("_s", told))
    at = lines.withColumn("_at", F.filter(F.transform("_l", lambda x, i: F.when(x["level"].isNotNull(), i)), lambda i: i.isNotNull()))
    until = at.withColumn("_n", F.size("_l")).withColumn("_to", F.transform("_at", lambda _, i: F.coalesce(F.get("_at", i + 1), F.col("_n"))))
    texts = lambda start, n: F.array_join(F.transform(F.slice("_l", start, n), lambda x: x["t"]), " ")

    def unit(s: Column, i: Column) -> Column:
        return F.struct(F.get("_l", s)["level"].alias("level"), F.get("_l", s)["label"].alias("label"), strip(texts(s + 1, F.get("_to", i) - s)).alias("content"))

    caput = strip(texts(F.lit(1), F.coalesce(F.get("_at", F.lit(0)), F.col("_n"))))
    return until.withColumn("caput", caput).withColumn("units", F.transform("_at", unit)).drop("_s", "_l", "_at", "_n", "_to")


def body_text(caput: Column, units: Column) -> Column:
    def line(u: Column) -> Column:
        mark = F.when(u["level"] >= 3, ")").when(u["level"] == 2, " –").when(u["label"].startswith("§"), "").otherwise(".")
        return strip(F.concat(u["label"], mark, F.lit(" "), u["content"]))

    return strip(F.array_join(F.concat(F.filter(F.array(caput), lambda x: x != ""), F.transform(units, line)), "\n"))


def body_markdown(caput: Column, units: Column) -> Column:
    def line(u: Column) -> Column:
        bold = F.concat(F.lit("\n**"), u["label"], F.when(u["label"].startswith("§"), "**").otherwise(".**"), F.lit(" "), u["content"])
        indent = F.repeat(F.lit("  "), u["level"] - 1)
        mark = F.when(u["level"] == 2, " – ").otherwise(") ")
        return F.when(u["level"] == 1, F.regexp_replace(bold, f"{D.S}+$", "")).otherwise(F.concat(indent, F.lit("- "), u["label"], mark, u["content"]))

    return strip(F.array_join(F.concat(F.filter(F.array(caput), lambda x: x != ""), F.transform(units, line)), "\n"))


#: Kinds of items, letters and the like with their patterns, in the order in which they are tried; the places of
#: appendix, number and text in each.
ACCOUNTING_RULES = (
    (f"(?iu){D.APPENDIX}", "appendix", 1, 0, 2), (D.ITEM_APPENDIX_DEEP, "item", 1, 2, 3), (D.ITEM_APPENDIX, "item", 1, 2, 3),
    (D.ITEM_DEEP, "item", 0, 1, 2), (D.ITEM, "item", 0, 1, 2), (D.ITEM_P, "item", 0, 1, 2), (D.ALINEA, "alinea", 0, 1, 2),
    (D.SUBITEM, "subitem", 0, 1, 2),
)


def classify_accounting(line: Column, known: Column) -> Column:
    """``(kind, number, appendix, text)`` of a line, the first that fits of an ordered list; ``known``: it names a known section."""
    none = F.lit(None).cast("string")
    row = lambda kind, number, appendix, text: F.struct(F.lit(kind).alias("kind"), number.alias("number"), appendix.alias("appendix"), strip(text).alias("text"))

    def fitting(rule: tuple[str, str, int, int, int]) -> Column:
        pattern, kind, letter, number, text = rule
        part = lambda i: F.regexp_extract(line, pattern, i)
        shown = none if not number else F.concat(part(letter), part(number)) if letter else part(number)
        return row(kind, shown, part(letter) if letter else none, part(text))

    caps = line.rlike(D.SECTION) & F.length(line).between(3, 100)
    out = F.when(line == "", row("blank", none, none, F.lit("")))
    for rule in ACCOUNTING_RULES:
        out = out.when(line.rlike(rule[0]), fitting(rule))
    out = out.when(caps | (known & F.length(line).between(3, 80)), row("section", none, none, line))
    return out.otherwise(row("text", none, none, line))


def accounting_lines(lines: DataFrame, sections: DataFrame) -> DataFrame:
    """``(doc_id, line_no, kind, number, appendix, text)``; ``sections`` lists known section names (column ``name``)."""
    names = sections.where(F.col("name").isNotNull()).select(F.lower("name").alias("_name")).distinct()
    marked = lines.join(names, F.lower("line") == F.col("_name"), "left")
    told = marked.select("doc_id", "line_no", classify_accounting(F.col("line"), F.col("_name").isNotNull()).alias("c"))
    return told.select("doc_id", "line_no", "c.*")


def accounting_state(lines: DataFrame, sections: DataFrame) -> DataFrame:
    """Adds to the told lines the section they stand in (``secao``), the letter of their appendix and the item they belong to.

    A section that is no appendix ends the appendix before it; lines before the first section stand in the first one's default.
    """
    told = accounting_lines(lines, sections)
    kind = F.col("kind")
    label = F.concat(F.lit("APÊNDICE "), F.col("appendix"), F.when(F.col("text") != "", F.concat(F.lit(" – "), F.col("text"))).otherwise(""))
    section = in_order(F.last(F.when(kind == "section", F.col("text")).when(kind == "appendix", label), ignorenulls=True))
    ends = ~F.upper("text").startswith("APÊNDICE") & ~F.upper("text").startswith("APENDICE")
    letter = in_order(F.last(F.when(kind == "appendix", F.col("appendix")).when((kind == "section") & ends, ""), ignorenulls=True))
    return told.select(
        "*",
        F.coalesce(section, F.lit(D.FIRST_SECTION)).alias("secao"),
        letter.alias("_letter"),
        in_order(F.sum((kind == "item").cast("int"))).alias("pos"),
        in_order(F.last(F.when(kind == "item", 1).when(kind.isin("section", "appendix"), 0), ignorenulls=True)).alias("open"),
    )


def accounting_sections(lines: DataFrame, sections: DataFrame) -> DataFrame:
    """``(doc_id, secao, at)``: the sections and appendices of each document, by their first line, with or without items."""
    heads = accounting_state(lines, sections).where(F.col("kind").isin("section", "appendix"))
    return heads.groupBy("doc_id", "secao").agg(F.min("line_no").alias("at"))


def accounting_counts(units: DataFrame, heads: DataFrame) -> DataFrame:
    """Counts of each document: of appendix items and letters only those that hold; sections also without an item."""
    holds = F.col("vigente")
    counted = units.groupBy("doc_id").agg(
        F.count("*").alias("n_itens"), F.count_if(holds).alias("n_itens_vigentes"),
        F.count_if(holds & F.col("apendice").isNotNull()).alias("n_itens_apendice"), F.count_if(~holds).alias("n_redacoes_anteriores"),
        F.coalesce(F.sum(F.when(holds, F.size("alineas"))), F.lit(0)).cast("bigint").alias("n_alineas"),
    )
    listed = heads.groupBy("doc_id").agg(F.count("*").alias("n_secoes"), F.array_sort(F.collect_list(F.struct("at", "secao"))).alias("s"))
    named = listed.select("doc_id", "n_secoes", F.transform("s", lambda x: x["secao"]).alias("secoes"))
    both = counted.join(named, "doc_id", "left")
    return both.withColumn("n_secoes", F.coalesce("n_secoes", F.lit(0))).withColumn("secoes", F.coalesce("secoes", F.array().cast("array<string>")))


def item_ref(number: Column) -> Column:
    return F.concat(F.lit("item-"), F.lower(number))


def item_lines(texto: Column, alineas: Column, subitens: Column, letter: str, roman: str) -> Column:
    """Text of an item, then its letters and its roman numbers, each on a line of its own form."""
    shown = lambda c, form: F.transform(c, lambda x: F.format_string(form, x["label"], x["text"]))
    return strip(F.array_join(F.concat(F.array(strip(texto)), shown(alineas, letter), shown(subitens, roman)), "\n"))


def item_text(texto: Column, alineas: Column, subitens: Column) -> Column:
    return item_lines(texto, alineas, subitens, "(%s) %s", "(%s) %s")


def item_markdown(texto: Column, alineas: Column, subitens: Column) -> Column:
    return item_lines(texto, alineas, subitens, "  - **(%s)** %s", "    - **(%s)** %s")


def accounting_units(lines: DataFrame, sections: DataFrame) -> DataFrame:
    """``(doc_id, pos, numero, secao, apendice, texto, alineas, subitens, notas, refs, vigente, anterior)`` per item.

    Of several wordings of an item, some are
    superseded only if one carries a mark of revision: the last marked one is then current.
    """
    state = accounting_state(lines, sections)
    kind = F.col("kind")
    held = state.where((F.col("open") == 1) & ~kind.isin("section", "appendix"))
    head = kind == "item"
    part = lambda k: F.array_sort(F.collect_list(F.when(kind == k, F.struct("line_no", F.col("number").alias("label"), "text"))))
    units = held.groupBy("doc_id", "pos").agg(
        F.max(F.when(head, F.struct("number", "secao", F.coalesce("appendix", F.expr("nullif(_letter, '')")).alias("apendice")))).alias("h"),
        F.array_sort(F.collect_list(F.when(kind.isin("item", "text", "blank"), F.struct("line_no", "text")))).alias("l"),
        part("alinea").alias("alineas"),
        part("subitem").alias("subitens"),
    )
    bare = lambda c: F.transform(c, lambda x: F.struct(x["label"].alias("label"), x["text"].alias("text")))
    texto = strip(F.array_join(F.transform("l", lambda x: x["text"]), "\n"))
    full = units.select("doc_id", "pos", F.col("h.number").alias("numero"), "h.secao", "h.apendice", texto.alias("texto"), bare("alineas").alias("alineas"), bare("subitens").alias("subitens"))
    named = F.regexp_extract_all("texto", F.lit(f"(?iu){D.ITEM_REF}"), F.lit(1))
    own = F.array_sort(F.array_distinct(F.filter(named, lambda r: r != F.col("numero"))))
    items = F.transform(own, item_ref)
    full = full.select("*", notes(F.col("texto"), D.ACCOUNTING_NOTE).alias("notas"), items.alias("refs"))
    revised = ci(F.col("texto"), D.REVISED)
    same = W.partitionBy("doc_id", "numero", "apendice")
    best = same.orderBy(F.col("_rev").desc(), F.col("pos").desc())
    ranked = full.withColumn("_rev", revised.cast("int")).select("*", F.max("_rev").over(same).alias("_any"), F.row_number().over(best).alias("_rank"))
    current = ranked.withColumn("vigente", (F.col("_any") == 0) | (F.col("_rank") == 1)).drop("_rev", "_any", "_rank")
    count = F.sum((~F.col("vigente")).cast("int")).over(W.partitionBy("doc_id").orderBy("pos"))
    return current.withColumn("anterior", F.when(~F.col("vigente"), count))
