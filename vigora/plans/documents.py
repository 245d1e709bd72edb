"""Queries of the document pipeline over the test tables, each with the SQL it is checked against.

Documents are put together in ``inputs``; pages of the table ``documents`` are cleaned as they are. The SQL states its
patterns and lists by itself and takes none from the operators. Long results are compared by their MD5.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigora.operators import annexes as A
from vigora.operators import dialect as D
from vigora.operators import lines as L
from vigora.operators import metadata as M
from vigora.operators import render as R
from vigora.operators import structure as S
from vigora.operators import validation as V
from vigora.operators.retrieval import last_delivered
from vigora.plans import inputs as I
from vigora.sources.tables import table


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("norma").alias("doc_id"), F.col("doc_id").alias("page_no"), "text")


def _law_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.clean_lines(I.law_pages(spark, d), D.LAW)


def _law_units(spark: SparkSession, d: str) -> DataFrame:
    return S.law_units(_law_lines(spark, d))


def _item_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.clean_lines(I.accounting_pages(spark, d), D.ACCOUNTING)


def _items(spark: SparkSession, d: str) -> DataFrame:
    return S.accounting_units(_item_lines(spark, d), _sections(spark, d))


def _counts(spark: SparkSession, d: str) -> DataFrame:
    lines, known = _item_lines(spark, d), _sections(spark, d)
    return S.accounting_counts(S.accounting_units(lines, known), S.accounting_sections(lines, known))


def _sections(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "norm_meta").select(F.explode("secoes").alias("name"))


def _annexes(spark: SparkSession, d: str) -> DataFrame:
    return A.distinct_rows(table(spark, d, "annex_cell"))


def s2_needs_ocr(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).where("text IS NOT NULL").select("doc_id", L.needs_ocr(F.col("text")).alias("needs"))


def s4_ocr_choice(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.md5(L.choose_text(F.col("text"), F.col("url"))).alias("chosen"))


def l1_repeated_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.repeated_lines(_pages(spark, d))


def l2_noise_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = S.numbered_lines(_texts(spark, d)).where("line <> ''")
    law, accounting = L.is_noise(F.col("line"), D.LAW_NOISE), L.is_noise(F.col("line"), D.ACCOUNTING_NOISE)
    return lines.groupBy("doc_id").agg(F.count_if(law).alias("law"), F.count_if(accounting).alias("accounting"))


def l3_kept_lines(spark: SparkSession, d: str) -> DataFrame:
    kept = L.kept_lines(_pages(spark, d).where("doc_id IS NOT NULL AND text IS NOT NULL"), D.LAW)
    return kept.select("doc_id", "page_no", F.size("lines").cast("bigint").alias("n"), F.md5(F.array_join("lines", "\n")).alias("kept"))


def l4_dehyphenated(spark: SparkSession, d: str) -> DataFrame:
    text = F.array_join(L.split_lines("text"), "\n")
    return _texts(spark, d).where("text IS NOT NULL").select("doc_id", F.md5(L.dehyphenate(text)).alias("text"))


def l5_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    text = F.array_join(L.split_lines("text"), "\n")
    return _texts(spark, d).where("text IS NOT NULL").select("doc_id", F.md5(L.rejoin(text, D.LAW)).alias("text"))


def l6_tidied(spark: SparkSession, d: str) -> DataFrame:
    text = F.array_join(L.split_lines("text"), "\n")
    return _texts(spark, d).where("text IS NOT NULL").select("doc_id", F.md5(L.tidy(text)).alias("text"))


def l7_orphans_merged(spark: SparkSession, d: str) -> DataFrame:
    text = F.array_join(L.split_lines("text"), "\n")
    return _texts(spark, d).where("text IS NOT NULL").select("doc_id", F.md5(L.merge_orphans(text)).alias("text"))


def l8_titles_merged(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).where("text IS NOT NULL").select("doc_id", F.md5(L.merge_titles(L.split_lines("text"))).alias("text"))


def l9_clean_law(spark: SparkSession, d: str) -> DataFrame:
    return L.clean_lines(_pages(spark, d), D.LAW)


def l9_clean_accounting(spark: SparkSession, d: str) -> DataFrame:
    return L.clean_lines(_pages(spark, d), D.ACCOUNTING)


def e1_epigraphs(spark: SparkSession, d: str) -> DataFrame:
    found = I.law_heads(spark, d).select("slug", M.epigraph(F.col("text")).alias("e")).where("e IS NOT NULL")
    return found.select("slug", "e.tipo", "e.numero", "e.ano")


def e3_identities(spark: SparkSession, d: str) -> DataFrame:
    found = _texts(spark, d).where("text IS NOT NULL").select("doc_id", M.fallback(F.col("text")).alias("e"))
    return found.select("doc_id", "e.tipo", "e.numero", "e.ano")


def e4_summaries(spark: SparkSession, d: str) -> DataFrame:
    return I.law_heads(spark, d).select("slug", M.summary(F.col("text")).alias("ementa"))


def e5_page_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Summaries of pages: few state one, most have their first long plain line."""
    return _texts(spark, d).where("text IS NOT NULL").select("doc_id", F.md5(M.summary(F.col("text"))).alias("ementa"))


def e6_norm_ids(spark: SparkSession, d: str) -> DataFrame:
    ids = M.norm_id(F.col("tipo"), F.col("numero"), F.col("ano"), F.regexp_replace("fonte_arquivo", r"\.[^.]*$", ""))
    return table(spark, d, "norm_meta").select("identificador", ids.alias("made")).distinct()


def e7_slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "norm_meta").select("identificador", M.slug(F.col("identificador")).alias("slug")).distinct()


def e8_accounting_headers(spark: SparkSession, d: str) -> DataFrame:
    found = I.accounting_openings(spark, d).select("slug", M.accounting_header(F.col("text")).alias("h"))
    return found.select("slug", "h.tipo", "h.numero", "h.revisao")


def e9_correlations(spark: SparkSession, d: str) -> DataFrame:
    return I.accounting_openings(spark, d).select("slug", M.ifrs(F.col("text")).alias("ifrs")).where("ifrs IS NOT NULL")


def e10_titles(spark: SparkSession, d: str) -> DataFrame:
    return I.accounting_openings(spark, d).select("slug", M.title(F.col("text")).alias("titulo")).where("titulo IS NOT NULL")


def e11_accounting_summaries(spark: SparkSession, d: str) -> DataFrame:
    return I.accounting_openings(spark, d).select("slug", M.accounting_summary(F.col("text")).alias("ementa")).where("ementa IS NOT NULL")


def e12_objectives(spark: SparkSession, d: str) -> DataFrame:
    return I.accounting_openings(spark, d).select("slug", M.objective(F.col("text")).alias("objetivo")).where("objetivo IS NOT NULL")


def e13_title_case(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tax_catalog").select("codigo", M.title_case(F.col("titulo")).alias("titulo")).where("codigo IS NOT NULL").distinct()


def e14_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).where("text IS NOT NULL").select("doc_id", M.fingerprint(F.col("text")).alias("sha256_16"))


def e15_accounting_slugs(spark: SparkSession, d: str) -> DataFrame:
    found = I.accounting_openings(spark, d).select("slug", M.accounting_slugs(M.accounting_header(F.col("text"))).alias("s"))
    return found.select("slug", "s.dir_slug", "s.id_slug")


def law_line_kinds(spark: SparkSession, d: str) -> DataFrame:
    kinds = S.classify_law(_law_lines(spark, d))
    return kinds.groupBy("doc_id", "kind").agg(F.count("*").alias("n"), F.sum("line_no").alias("places"))


def law_units(spark: SparkSession, d: str) -> DataFrame:
    return _law_units(spark, d).select(
        "doc_id", "pos", "numero", "breadcrumb", F.md5("texto").alias("texto"), F.array_join("notas", "|").alias("notas"),
        F.array_join("refs", "|").alias("refs"), "vigente", "anterior",
    )


def law_chunks(spark: SparkSession, d: str) -> DataFrame:
    return law_chunk_records(spark, d).select("id", "path", "vigente")


def law_chunk_records(spark: SparkSession, d: str) -> DataFrame:
    records = R.law_records(_law_units(spark, d), I.norms(spark, d), table(spark, d, "annex_cell"))
    listed = {c: F.array_join(c, "|") for c in ("notas_vigencia", "refs", "anexos")}
    return records.withColumns(listed | {"texto": F.md5("texto")})


def law_counts(spark: SparkSession, d: str) -> DataFrame:
    return _law_units(spark, d).groupBy("doc_id").agg(F.count("*").alias("n_artigos"), F.count_if("vigente").alias("n_vigentes"), F.count_if(~F.col("vigente")).alias("n_anteriores"))


def law_meta_records(spark: SparkSession, d: str) -> DataFrame:
    heads = I.law_heads(spark, d).withColumnRenamed("slug", "doc_id")
    return R.law_meta(I.law_pages(spark, d), heads, _law_units(spark, d), table(spark, d, "annex_cell"))


def law_subunits(spark: SparkSession, d: str) -> DataFrame:
    parts = S.with_subunits(_law_units(spark, d).select("doc_id", "pos", "texto"), F.col("texto"))
    each = parts.select("doc_id", "pos", F.md5("caput").alias("caput"), F.posexplode_outer("units").alias("n", "u")).where("n IS NOT NULL")
    return each.select("doc_id", "pos", "caput", F.col("n").cast("bigint").alias("n"), F.col("u.level").cast("bigint").alias("level"), "u.label", F.md5("u.content").alias("content"))


def law_bodies(spark: SparkSession, d: str) -> DataFrame:
    parts = S.with_subunits(_law_units(spark, d).select("doc_id", "pos", "texto"), F.col("texto"))
    both = (F.col("caput"), F.col("units"))
    return parts.select("doc_id", "pos", F.md5(S.body_text(*both)).alias("text"), F.md5(S.body_markdown(*both)).alias("markdown"))


def law_notes_refs(spark: SparkSession, d: str) -> DataFrame:
    texts = last_delivered(table(spark, d, "chunk").select("id", "texto", "artigo", "loaded_at")).where("texto IS NOT NULL")
    own = F.coalesce(S.plain_number(F.col("artigo")), F.lit(""))
    return texts.select("id", F.array_join(S.notes(F.col("texto")), "|").alias("notas"), F.array_join(S.refs(F.col("texto"), own), "|").alias("refs"))


def accounting_line_kinds(spark: SparkSession, d: str) -> DataFrame:
    lines = S.accounting_lines(_item_lines(spark, d), _sections(spark, d))
    return lines.groupBy("doc_id", "kind").agg(F.count("*").alias("n"))


def _listed(c: str) -> object:
    return F.array_join(F.transform(c, lambda x: F.concat(x["label"], F.lit(") "), x["text"])), "\n")


def accounting_units(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).select(
        "doc_id", "pos", "numero", "secao", "apendice", F.md5("texto").alias("texto"), F.md5(_listed("alineas")).alias("alineas"), F.md5(_listed("subitens")).alias("subitens"),
        F.array_join("notas", "|").alias("notas"), F.array_join("refs", "|").alias("refs"), "vigente", "anterior",
    )


def accounting_counts(spark: SparkSession, d: str) -> DataFrame:
    return _counts(spark, d).withColumn("secoes", F.array_join("secoes", "|"))


def accounting_bodies(spark: SparkSession, d: str) -> DataFrame:
    parts = (F.col("texto"), F.col("alineas"), F.col("subitens"))
    return _items(spark, d).select("doc_id", "pos", F.md5(S.item_text(*parts)).alias("text"), F.md5(S.item_markdown(*parts)).alias("markdown"))


def accounting_chunk_records(spark: SparkSession, d: str) -> DataFrame:
    records = R.accounting_records(_items(spark, d), I.norms(spark, d), table(spark, d, "annex_cell"))
    listed = {c: F.array_join(c, "|") for c in ("notas_vigencia", "refs", "anexos")}
    return records.withColumns(listed | {"texto": F.md5("texto")})


def accounting_meta_records(spark: SparkSession, d: str) -> DataFrame:
    heads = I.accounting_openings(spark, d).withColumnRenamed("slug", "doc_id")
    metas = R.accounting_meta(I.accounting_pages(spark, d), heads, _counts(spark, d), table(spark, d, "annex_cell"))
    return metas.withColumn("secoes", F.array_join("secoes", "|"))


def render_front_matter(spark: SparkSession, d: str) -> DataFrame:
    metas = table(spark, d, "norm_meta").where("identificador IS NOT NULL")
    return metas.select("identificador", R.front_matter(metas).alias("front")).distinct()


def render_headings(spark: SparkSession, d: str) -> DataFrame:
    return R.headings(_law_units(spark, d)).where("headings <> ''").select("doc_id", "pos", "headings")


def render_sections(spark: SparkSession, d: str) -> DataFrame:
    return R.section_changes(_items(spark, d)).where("heading IS NOT NULL").select("doc_id", "pos", "heading")


def law_documents(spark: SparkSession, d: str) -> DataFrame:
    metas = I.norms(spark, d).where("tipo <> 'CPC'")
    rows = R.document_rows(metas, R.unit_markdown(_law_units(spark, d)), _annexes(spark, d))
    return rows.withColumn("markdown", F.md5("markdown"))


def accounting_documents(spark: SparkSession, d: str) -> DataFrame:
    metas = I.norms(spark, d).where("tipo = 'CPC'")
    rows = R.document_rows(metas, R.items_markdown(_items(spark, d)), _annexes(spark, d), R.ACCOUNTING_KEYS)
    return rows.withColumn("markdown", F.md5("markdown"))


def v5_front_matter(spark: SparkSession, d: str) -> DataFrame:
    """Norms whose front matter, rendered from what the head of their text declares, names another identifier than their metadata."""
    metas = law_meta_records(spark, d).withColumnRenamed("doc_id", "slug")
    return V.front_matter_differs(metas.select("slug", R.front_matter(metas, ("identificador", "tipo", "numero", "ano")).alias("markdown")), table(spark, d, "norm_meta"))


def v7_annex_leaks(spark: SparkSession, d: str) -> DataFrame:
    lines = _law_lines(spark, d)
    return V.annex_leaks(S.classify_law(lines), S.law_units(lines))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        s2_needs_ocr, s4_ocr_choice, l1_repeated_lines, l2_noise_lines, l3_kept_lines, l4_dehyphenated, l5_paragraphs, l6_tidied,
        l7_orphans_merged, l8_titles_merged, l9_clean_law, l9_clean_accounting, e1_epigraphs, e3_identities, e4_summaries, e5_page_summaries, e6_norm_ids,
        e7_slugs, e8_accounting_headers, e9_correlations, e10_titles, e11_accounting_summaries, e12_objectives, e13_title_case, e14_fingerprints,
        e15_accounting_slugs, law_line_kinds, law_units, law_chunks, law_chunk_records, law_counts, law_meta_records, law_subunits, law_bodies, law_notes_refs,
        accounting_line_kinds, accounting_units, accounting_counts, accounting_bodies, accounting_chunk_records, accounting_meta_records, render_front_matter,
        render_headings, render_sections, law_documents, accounting_documents, v5_front_matter, v7_annex_leaks,
    )
}

# SQL, with patterns of its own: \s and \S stand for the white space below, ~s for its inside within a class.
_INSIDE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _rx(pattern: str) -> str:
    return "'" + pattern.replace(r"\s", f"[{_INSIDE}]").replace(r"\S", f"[^{_INSIDE}]").replace("~s", _INSIDE) + "'"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, {_rx('^\\s+')}, ''), {_rx('\\s+$')}, '')"


def _is(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {_rx(pattern)})"


def _get(x: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract({x}, {_rx(pattern)}, {group})"


_BREAK = r"'\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]'"
_UPPER = "A-ZÁÉÍÓÚÂÊÔÃÕÇ"


def _arr(text: str) -> str:
    split = f"regexp_split_to_array({text}, {_BREAK})"
    return f"CASE WHEN list_last({split}) = '' THEN {split}[1:-2] ELSE {split} END"


_NOISE = {
    "law": r"(?i)^(p[áa]gina\s+\d+\s*(de\s+\d+)?|fls?\.?\s*\d+|\d{1,4}|di[áa]rio\s+oficial.*|imprensa\s+nacional.*|este\s+texto\s+n[ãa]o\s+substitui.*|www\.\S+)$",
    "accounting": r"(?i)^(p[áa]gina\s+\d+\s*(de\s+\d+)?|\d{1,4}|www\.\S+|comit[êe]\s+de\s+pronunciamentos?\s+cont[áa]beis?|cpc\s+\d+.*p[áa]gina.*\d+.*)$",
}
_START = {
    "law": r"(?i)^(livro|t[íi]tulo|cap[íi]tulo|se[çc][ãa]o|subse[çc][ãa]o|art\.?\s*\d|artigo\s*\d|§\s*\d|par[áa]grafo\s+[úu]nico|[ivxlcdm]{1,6}\s*[-–—]\s|[a-z]\)\s|\d{1,2}\)\s)",
    "accounting": rf"^([{_UPPER}][{_UPPER}~s\-]{{3,}}$|AP[ÊE]NDICE\s+[A-Z]|\d+[A-Z]?\.\s|[A-Z]\d+[A-Z]?\.\s|\([a-z]\)\s)",
}
_IS_ORPHAN = r"^(\d+[A-Z]?\.|\d+(\.\d+)+[A-Z]?|[A-Z]\.?\d+(\.\d+)*[A-Z]?\.?)$"
_IS_TITLE = rf"^[{_UPPER}][{_UPPER}0-9~s\-]{{2,79}}$"
_IS_SPACED = rf"^([{_UPPER}]\s+){{2,}}[{_UPPER}]$"
_WIN = "WINDOW w AS (PARTITION BY doc_id ORDER BY spot)"


def _runs(source: str, name: str, goes_on: str, piece: str) -> str:
    """Rows of ``source`` that go on are appended to the row before them."""
    return f"""{name}_a AS (SELECT *, coalesce({goes_on}, false) AS on_ FROM {source} {_WIN}),
{name}_b AS (SELECT *, sum((NOT on_)::INT) OVER w AS run, lead(on_, 1, false) OVER w AS next_on FROM {name}_a {_WIN}),
{name} AS (SELECT doc_id, run AS spot, string_agg({piece}, '' ORDER BY spot) AS line FROM {name}_b GROUP BY 1, 2)"""


_HYPHENS = lambda source, name: _runs(source, name, f"{_is('lag(line) OVER w', r'[\p{L}\p{N}_]-$')} AND {_is('line', r'^[\p{L}\p{N}_]')}", "CASE WHEN next_on THEN left(line, length(line) - 1) ELSE line END")
_ORPHANS = lambda source, name: f"""{name}_s AS (SELECT *, {_strip('line')} AS s FROM {source}),
{name}_n AS (SELECT *, s <> '' AS said, s <> '' AND length(s) <= 12 AND {_is('s', _IS_ORPHAN)} AS number FROM {name}_s),
{name}_k AS (SELECT *, sum(said::INT) OVER w AS k, sum(said::INT) OVER (PARTITION BY doc_id) AS every FROM {name}_n {_WIN}),
{name}_r AS (SELECT *, k - coalesce(last_value(CASE WHEN said AND NOT number THEN k END IGNORE NULLS) OVER w, 0) AS nth FROM {name}_k {_WIN}),
{name}_h AS (SELECT *, number AND nth % 2 = 1 AND k < every AS head FROM {name}_r),
{name}_t AS (SELECT *, last_value(CASE WHEN said THEN head END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY spot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS taken FROM {name}_h),
{_runs(f'{name}_t', name, 'taken', "CASE WHEN head THEN s WHEN on_ AND NOT said THEN '' WHEN on_ THEN ' ' || s ELSE line END")}"""  # noqa: E731
_TITLES = lambda source, name: f"""{name}_s AS (SELECT *, {_strip('line')} AS s FROM {source}),
{name}_i AS (SELECT *, {_is('s', _IS_TITLE)} AS title FROM {name}_s),
{_runs(f'{name}_i', name, 'title AND lag(title) OVER w', f"CASE WHEN on_ THEN ' ' || s WHEN {_is('s', _IS_SPACED)} THEN regexp_replace(s, {_rx('\\s+')}, '', 'g') WHEN next_on THEN s ELSE line END")}"""  # noqa: E731


def _PARAGRAPHS(source: str, name: str, how: str) -> str:
    goes_on = f"lag(line) OVER w <> '' AND line <> '' AND right(lag(line) OVER w, 1) NOT IN ('.', ':', ';') AND NOT {_is('line', _START[how])}"
    return f"{name}_s AS (SELECT doc_id, spot, {_strip('line')} AS line FROM {source}),\n{_runs(f'{name}_s', name, goes_on, chr(67) + 'ASE WHEN on_ THEN chr(32) || line ELSE line END')}"


_REPEATED = f"""paged AS (SELECT doc_id, page_no, {_arr('text')} AS arr FROM pages WHERE doc_id IS NOT NULL),
bands AS (SELECT doc_id, unnest(list_concat(l[1:3], l[greatest(len(l) - 2, 1):])) AS line FROM (
  SELECT doc_id, list_filter(list_transform(arr, lambda x: {_strip('x')}), lambda x: x <> '') AS l FROM paged WHERE arr IS NOT NULL) WHERE len(l) > 0),
total AS (SELECT doc_id, count(*) AS pages FROM paged GROUP BY 1),
again AS (SELECT doc_id, line, count(*) AS n FROM bands WHERE length(line) BETWEEN 3 AND 120 GROUP BY 1, 2),
repeated AS (SELECT a.* FROM again a JOIN total t USING (doc_id) WHERE n >= 2 AND n / pages >= 0.5)"""


def _kept(how: str) -> str:
    return f"""{_REPEATED}, raw AS (SELECT doc_id, page_no, unnest(arr) AS raw, generate_subscripts(arr, 1) AS i FROM paged WHERE arr IS NOT NULL),
stripped AS (SELECT *, {_strip('raw')} AS s, regexp_replace(raw, {_rx('\\s+$')}, '') AS r FROM raw),
kept AS (SELECT l.doc_id, page_no, i, CASE WHEN s = '' THEN '' ELSE r END AS line FROM stripped l LEFT JOIN repeated x ON x.doc_id = l.doc_id AND x.line = l.s
  WHERE s = '' OR (x.line IS NULL AND NOT {_is('s', _NOISE[how])}))"""


def _clean(how: str) -> str:
    """Cleaned lines ``ln (doc_id, line_no, line)`` of ``pages``."""
    steps = [_kept(how), "k0 AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY page_no, i) AS spot, line FROM kept)", _HYPHENS("k0", "k1")]
    steps += [_ORPHANS("k1", "k2"), _TITLES("k2", "k3")] if how == "accounting" else ["k3 AS (SELECT * FROM k1)"]
    steps += [_PARAGRAPHS("k3", "k4", how), r"k5 AS (SELECT doc_id, spot, regexp_replace(line, '[ \t]+', ' ', 'g') AS line FROM k4)"]
    steps += [f"k6 AS (SELECT *, lag(line, 1, '') OVER w AS before, max(CASE WHEN line <> '' THEN spot END) OVER (PARTITION BY doc_id) AS last FROM k5 {_WIN})"]
    return ",\n".join(steps) + ",\nln AS (SELECT doc_id, spot AS line_no, line FROM k6 WHERE line <> '' OR (before <> '' AND spot < last))"


_LATEST = "latest AS (SELECT * FROM chunk WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1)"
_SLUGGED = r"regexp_replace(lower(trim(regexp_replace(replace(strip_accents(x), '/', '-'), '[^A-Za-z0-9_\s-]', '', 'g'))), '[\s_]+', '-', 'g')"
_NORMS = f"norms AS (SELECT DISTINCT ON (identificador) *, {_SLUGGED.replace('(x)', '(identificador)')} AS slug FROM norm_meta WHERE identificador IS NOT NULL ORDER BY identificador, n_artigos DESC NULLS LAST)"
_ROWS = f"""table_rows AS (SELECT slug, csv, row_no, r.header AS header, r.cells AS cells FROM (SELECT slug, csv, row_no, max(struct_pack(
  header := list_transform(coalesce(header, []), lambda c: {_strip("coalesce(c, '')")}), cells := list_transform(coalesce(cells, []), lambda c: {_strip("coalesce(c, '')")}))) AS r
  FROM annex_cell WHERE slug IS NOT NULL AND csv IS NOT NULL AND row_no IS NOT NULL GROUP BY 1, 2, 3))"""
_LAW_HEADS = r"""law_heads AS (SELECT slug, (CASE tipo WHEN 'LC' THEN 'LEI COMPLEMENTAR' WHEN 'IN RFB' THEN 'INSTRUÇÃO NORMATIVA RFB' WHEN 'SC Cosit' THEN 'SOLUÇÃO DE CONSULTA COSIT' ELSE upper(tipo) END)
  || ' Nº ' || regexp_replace(numero, '^([0-9]+)([0-9]{3})$', '\1.\2') || ', DE 1º DE MARÇO DE ' || ano || chr(10) || chr(10) || coalesce(ementa, '') AS text
  FROM norms WHERE tipo <> 'CPC' AND numero IS NOT NULL AND ano IS NOT NULL)"""
_PLACE = lambda kind: rf"""SELECT *, split_part(id, '--', 1) AS doc_id, regexp_extract(id, '--{kind}-([0-9]+)(?:-?([a-z]))?(?:--anterior-([0-9]+))?$', ['n', 'letter', 'earlier']) AS p FROM latest"""
_AT = "p.n::BIGINT * 1000000000 + CASE WHEN p.letter <> '' THEN ascii(p.letter) - 96 ELSE 0 END * 10000000 + coalesce(nullif(p.earlier, '')::BIGINT, 9999999)"
_LAW_PAGES = f"""{_LATEST}, {_NORMS}, {_ROWS}, {_LAW_HEADS},
pages AS (
  SELECT slug AS doc_id, 0::BIGINT AS page_no, text FROM law_heads
  UNION ALL SELECT doc_id, {_AT}, concat_ws(chr(10), nullif(array_to_string(string_split(coalesce(path, ''), ' > ')[1:-2], chr(10)), ''), texto) FROM ({_PLACE('art')}) WHERE p.n <> ''
  UNION ALL SELECT slug, regexp_extract(csv, '[0-9]+')::BIGINT * 10000000000 + 999999999, 'ANEXO ' || regexp_extract(csv, '[0-9]+')::BIGINT || chr(10) || string_agg(array_to_string(cells, ' '), chr(10) ORDER BY row_no)
    FROM table_rows WHERE slug NOT LIKE 'cpc-%' AND regexp_matches(csv, '[0-9]') GROUP BY slug, csv)"""
_ITEM_HEADS = r"""item_heads AS (SELECT slug, CASE WHEN numero::BIGINT % 3 = 0 THEN 'NBC TG ' || numero || ' – ' || upper(titulo) || chr(10) || 'Aprova a NBC TG ' || numero || ', que ' || regexp_replace(ementa, '^Dispõe', 'dispõe')
  ELSE concat_ws(chr(10), 'PRONUNCIAMENTO TÉCNICO ' || identificador, CASE WHEN numero::BIGINT % 2 = 0 THEN titulo ELSE upper(titulo) END, 'Correlação às Normas Internacionais de Contabilidade – ' || correlacao_ifrs) END AS text
  FROM norms WHERE tipo = 'CPC' AND numero IS NOT NULL)"""
_ITEM_PAGES = f"""{_LATEST}, {_NORMS}, {_ROWS}, {_ITEM_HEADS},
pages AS (
  SELECT slug AS doc_id, 0::BIGINT AS page_no, text FROM item_heads
  UNION ALL SELECT doc_id, coalesce(ascii(apendice), 0) * 1000000000000000 + {_AT}, concat_ws(chr(10) || chr(10), secao, 'APÊNDICE ' || apendice,
    CASE WHEN apendice IS NOT NULL AND p.n::BIGINT % 2 = 1 THEN apendice || texto ELSE texto END || CASE WHEN p.earlier = '' AND revisao LIKE 'R%' THEN ' (Alterado pela Revisão CPC ' || revisao || ')' ELSE '' END)
    FROM ({_PLACE('item')}) WHERE p.n <> '')"""
_OPENINGS = f"""{_LATEST}, {_NORMS}, {_ITEM_HEADS},
firsts AS (SELECT doc_id AS slug, string_agg(texto, chr(10) ORDER BY {_AT}, texto) AS items FROM ({_PLACE('item')}) WHERE p.n IN ('1', '2') AND p.earlier = '' AND apendice IS NULL AND texto IS NOT NULL GROUP BY 1),
openings AS (SELECT slug, concat_ws(chr(10), text, 'OBJETIVO', items) AS text FROM item_heads LEFT JOIN firsts USING (slug))"""

_DIVISION = r"(?i)^(livro|t[íi]tulo|cap[íi]tulo|se[çc][ãa]o|subse[çc][ãa]o)([^\p{L}\p{N}_].*)?$"
_ARTICLE = r"^(?:Art\.|Artigo)\s*(\d+[ºo]?(?:-[A-Z])?)\s*[.\-–—]?\s*(.*)$"
_NUMBER = lambda x: _strip(f"regexp_replace({x}, '[ºo]', '', 'g')")
_CLASSIFIED = f"""seen AS (SELECT *, {_is('line', r'(?i)^anexo([^\p{L}\p{N}_]|$)')} AS annex, {_is('line', _DIVISION)} AS division, {_is('line', _ARTICLE)} AS header, {_strip(_get('line', _ARTICLE, 2))} AS rest FROM ln),
moded AS (SELECT *, last_value(CASE WHEN annex THEN 1 WHEN division OR header THEN 0 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS mode FROM seen),
kinds AS (SELECT *, CASE WHEN annex THEN 'annex' WHEN coalesce(mode, 0) = 1 THEN 'skipped' WHEN line = '' THEN 'blank'
  WHEN division AND length(line) < 120 THEN 'division' WHEN header AND NOT regexp_matches(rest, '^[a-zà-ú]') THEN 'article' ELSE 'body' END AS kind FROM moded)"""
_LEVEL_OF = lambda word: f"CASE WHEN {word} = 'LIVRO' THEN 1 WHEN {word} IN ('TÍTULO', 'TITULO') THEN 2 WHEN {word} IN ('CAPÍTULO', 'CAPITULO') THEN 3 WHEN {word} IN ('SEÇÃO', 'SECAO', 'SEÇAO') THEN 4 WHEN {word} IN ('SUBSEÇÃO', 'SUBSECAO') THEN 5 ELSE 3 END"
_CRUMB = ", ".join(
    f"CASE WHEN c{k}.spot > " + ("greatest(" + ", ".join(f"coalesce(c{j}.spot, -1)" for j in range(1, k)) + ", -1)" if k > 1 else "-1") + f" THEN c{k}.t END"
    for k in range(1, 6)
)
_NOTED = r"\((?:Reda[çc][ãa]o|Revogad|Inclu[íi]d|Vide|Vigência)[^)]*\)"
_REFERS = r"(?i)art(?:igo|\.)?\s*(\d+[ºo]?(?:-[A-Z])?)"
_REFS = lambda text, own: f"list_sort(list_distinct(list_filter(list_transform(regexp_extract_all({text}, {_rx(_REFERS)}, 1), lambda r: 'art-' || {_NUMBER('r')}), lambda r: r <> 'art-' || {own})))"
_LAW_UNITS = f"""{_LAW_PAGES}, {_clean('law')}, {_CLASSIFIED},
leveled AS (SELECT *, CASE WHEN kind = 'division' THEN {_LEVEL_OF(f"upper({_get('line', _DIVISION, 1)})")} END AS level FROM kinds),
state AS (SELECT *, sum((kind = 'article')::INT) OVER w AS pos,
  last_value(CASE WHEN kind = 'article' THEN 1 WHEN kind IN ('division', 'annex') THEN 0 END IGNORE NULLS) OVER w AS opened,
  {', '.join(f"last_value(CASE WHEN level = {k} THEN struct_pack(spot := line_no, t := line) END IGNORE NULLS) OVER w AS c{k}" for k in range(1, 6))}
  FROM leveled WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
held AS (SELECT *, CASE WHEN kind = 'article' THEN rest ELSE line END AS t, CASE WHEN kind = 'article' THEN concat_ws(' > ', {_CRUMB}) END AS crumb,
  CASE WHEN kind = 'article' THEN {_NUMBER(_get('line', _ARTICLE, 1))} END AS num
  FROM state WHERE opened = 1 AND kind IN ('article', 'body', 'blank')),
joined AS (SELECT doc_id, pos, max(num) AS numero, max(crumb) AS breadcrumb, {_strip("string_agg(t, chr(10) ORDER BY line_no)")} AS texto FROM held GROUP BY 1, 2),
noted AS (SELECT *, regexp_extract_all(texto, {_rx(_NOTED)}) AS notas, {_REFS('texto', 'numero')} AS refs FROM joined),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, numero ORDER BY (len(notas) > 0)::INT DESC, pos DESC) = 1 AS vigente FROM noted),
units AS (SELECT *, CASE WHEN NOT vigente THEN sum((NOT vigente)::INT) OVER (PARTITION BY doc_id ORDER BY pos) END AS anterior FROM ranked)"""
_SHOWN = "CASE WHEN regexp_matches(numero, '^[0-9]+(-[A-Z])?$') THEN regexp_extract(numero, '^([0-9]+)', 1) || CASE WHEN regexp_extract(numero, '^([0-9]+)', 1)::BIGINT <= 9 THEN 'º' ELSE '' END || regexp_extract(numero, '(-[A-Z])$', 1) ELSE numero END"
_EARLIER = "CASE WHEN anterior IS NOT NULL THEN printf('--anterior-%03d', anterior::BIGINT) ELSE '' END"
_SUB = ((r"(?i)^(§\s*\d+[ºo]?|par[áa]grafo\s+[úu]nico)\.?\s*(.*)$", 1), (r"^([IVXLCDM]{1,6})\s*[-–—]\s*(.*)$", 2), (r"^([a-z])\)\s*(.*)$", 3), (r"^(\d{1,2})\)\s*(.*)$", 4))
_PICK = lambda g: "CASE " + " ".join(f"WHEN {_is('s', p)} THEN " + (str(n) if g is None else _strip(_get('s', p, g))) for p, n in _SUB) + " END"
_PARTS = f"""{_LAW_UNITS},
broken AS (SELECT doc_id, pos, unnest(string_split(texto, chr(10))) AS raw, generate_subscripts(string_split(texto, chr(10)), 1) AS i FROM units),
bare AS (SELECT doc_id, pos, i, {_strip('raw')} AS s FROM broken),
told AS (SELECT *, {_PICK(None)} AS level FROM bare WHERE s <> ''),
grouped AS (SELECT *, sum((level IS NOT NULL)::INT) OVER (PARTITION BY doc_id, pos ORDER BY i) AS g FROM told),
caputs AS (SELECT doc_id, pos, {_strip("string_agg(s, ' ' ORDER BY i)")} AS caput FROM grouped WHERE g = 0 GROUP BY 1, 2),
parts AS (SELECT doc_id, pos, g, max(level) AS level, max(CASE WHEN level IS NOT NULL THEN {_PICK(1)} END) AS label,
  {_strip(f"string_agg(CASE WHEN level IS NOT NULL THEN {_PICK(2)} ELSE s END, ' ' ORDER BY i)")} AS content FROM grouped WHERE g > 0 GROUP BY 1, 2, 3),
shown AS (SELECT *, {_strip("label || CASE WHEN level >= 3 THEN ')' WHEN level = 2 THEN ' –' WHEN label LIKE '§%' THEN '' ELSE '.' END || ' ' || content")} AS t,
  CASE WHEN level = 1 THEN regexp_replace(chr(10) || '**' || label || CASE WHEN label LIKE '§%' THEN '** ' ELSE '.** ' END || content, {_rx('\\s+$')}, '')
    ELSE repeat('  ', level - 1) || '- ' || label || CASE WHEN level = 2 THEN ' – ' ELSE ') ' END || content END AS m FROM parts),
bodies AS (SELECT u.doc_id, u.pos, {_strip("concat_ws(chr(10), nullif(max(c.caput), ''), string_agg(t, chr(10) ORDER BY g))")} AS body,
  {_strip("concat_ws(chr(10), nullif(max(c.caput), ''), string_agg(m, chr(10) ORDER BY g))")} AS md
  FROM units u LEFT JOIN caputs c ON c.doc_id = u.doc_id AND c.pos = u.pos LEFT JOIN shown s ON s.doc_id = u.doc_id AND s.pos = u.pos GROUP BY 1, 2)"""
_HEADINGS = f"""crumbs AS (SELECT doc_id, pos, list_filter(string_split(breadcrumb, ' > '), lambda p: p <> '') AS p FROM units),
before AS (SELECT *, coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY pos), []) AS q FROM crumbs),
shared AS (SELECT *, coalesce(list_position(list_transform(p, lambda x, i: coalesce(x = q[i], false)), false), len(p) + 1) AS first FROM before),
headed AS (SELECT doc_id, pos, array_to_string(list_transform(p[first:], lambda x: repeat('#', least({_LEVEL_OF("upper(regexp_extract(x, '^\\s*(\\S+)', 1))")} + 1, 6)) || ' ' || x), chr(10)) AS headings FROM shared)"""
_FRONT = lambda keys: "concat_ws(chr(10), '---', " + ", ".join(f"CASE WHEN {k} <> '' THEN '{k}: ' || to_json({k})::VARCHAR END" for k in keys) + ", '---')"
_LAW_FRONT = ("identificador", "tipo", "numero", "ano", "fonte_arquivo", "sha256_16", "ementa")
_ITEM_FRONT = ("identificador", "tipo", "numero", "revisao", "titulo", "correlacao_ifrs", "fonte_arquivo", "sha256_16", "ementa")
_HELD = "annexed AS (SELECT slug, list_sort(list_distinct(list(csv))) AS anexos FROM annex_cell WHERE csv IS NOT NULL GROUP BY 1)"


def _document(metas: str, top: str, units: str) -> str:
    return f"""routes AS (SELECT slug, csv, count(*) AS n, arg_min(header, row_no) AS header, count(*) >= 8 OR (max(greatest(len(header), len(cells))) >= 3 AND count(*) >= 4) AS to_csv FROM table_rows
    WHERE slug IN (SELECT slug FROM norms WHERE {metas}) GROUP BY 1, 2),
  small AS (SELECT r.slug, r.csv, any_value(t.header) AS header, string_agg('| ' || array_to_string(list_concat(r.cells, list_transform(r.header, lambda h: ''))[1:len(r.header)], ' | ') || ' |', chr(10) ORDER BY row_no) AS body
    FROM table_rows r JOIN routes t ON t.slug = r.slug AND t.csv = r.csv WHERE NOT to_csv GROUP BY 1, 2),
  doc AS (SELECT slug AS doc_id, 0 AS part, '0' AS place, {top} AS markdown FROM norms WHERE {metas}
    UNION ALL SELECT DISTINCT slug, 1, '', '## Anexos e tabelas' || chr(10) FROM routes WHERE to_csv
    UNION ALL SELECT slug, 1, csv, '- **Anexo ' || regexp_extract(csv, '([^_]*)\\.csv$', 1) || '** (' || n || ' linhas) → `anexos/' || csv || '`  ' || chr(10) || '  Colunas: ' || CASE WHEN len(header) > 0 THEN array_to_string(header[1:6], ', ') ELSE '—' END FROM routes WHERE to_csv
    UNION ALL SELECT doc_id, 2, printf('%012d', pos::BIGINT), {units} AND doc_id IN (SELECT slug FROM norms WHERE {metas})
    UNION ALL SELECT slug, 3, csv, chr(10) || '> Tabela:' || chr(10) || chr(10) || '| ' || array_to_string(header, ' | ') || ' |' || chr(10) || '| ' || array_to_string(list_transform(header, lambda h: '---'), ' | ') || ' |' || chr(10) || body FROM small)
  SELECT doc_id, part, place, md5(markdown) AS markdown FROM doc"""


_DOCS = f"docs AS (SELECT doc_id, {_arr('text')} AS arr FROM documents WHERE text IS NOT NULL)"
_DOC_LINES = f"""{_DOCS}, raw AS (SELECT doc_id, unnest(arr) AS raw, generate_subscripts(arr, 1) - 1 AS line_no FROM docs),
ln AS (SELECT doc_id, line_no, {_strip('raw')} AS line FROM raw)"""
_BY_PAGE = f"{_DOCS}, k0 AS (SELECT doc_id, unnest(arr) AS line, generate_subscripts(arr, 1) AS spot FROM docs)"
_WHOLE = lambda name: f"SELECT d.doc_id, md5(coalesce(t, '')) AS text FROM docs d LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY spot) AS t FROM {name} GROUP BY 1) w ON w.doc_id = d.doc_id"
_PAGES = "pages AS (SELECT norma AS doc_id, doc_id AS page_no, text FROM documents)"
_TYPES = (("LEI COMPLEMENTAR", "LC"), ("EMENDA CONSTITUCIONAL", "EC"), ("MEDIDA PROVISÓRIA", "MP"), ("INSTRUÇÃO NORMATIVA", "IN"), ("LEI", "Lei"), ("DECRETO-LEI", "Decreto-Lei"), ("DECRETO", "Decreto"),
          ("PORTARIA", "Portaria"), ("RESOLUÇÃO", "Resolução"), ("CONSTITUIÇÃO", "Constituição"), ("ATO CONJUNTO", "Ato Conjunto"), ("ATO DECLARATÓRIO", "Ato Declaratório"))
_DECLARES = (
    r"(?i)^\s*(lei complementar|emenda constitucional|medida provis[óo]ria|instru[çc][ãa]o normativa|ato conjunto|ato declarat[óo]rio|decreto-lei|decreto|lei|portaria|resolu[çc][ãa]o)"
    r"(\s+[\p{L}\p{N}_/]+)*\s+n[º°o]?\.?\s*([\d.]+)\s*,?\s*de\s+(.*?[^\p{L}\p{N}_])?((19|20)\d{2})([^\p{L}\p{N}_]|$)"
)
_VERB = r"(?i)^(institui|disp[õo]e|altera|regulamenta|estabelece|cria|aprova|define|reduz|concede|autoriza|fixa|revoga|acresce|consolida)"
_STOPS = r"(?i)^(resolvem|o presidente|o secret[áa]rio)"
_NAVIGATES = (
    r"(?i)^(presid[êe]ncia|casa civil|secretaria|subchefia|mensagem de veto|produ[çc][ãa]o de efeitos|texto compilado|vig[êe]ncia|\(promulga[çc][ãa]o|\(vide|lei complementar|lei |decreto|medida provis|ato conjunto"
    r"|ato declarat|di[áa]rio oficial|publicado em:|[óo]rg[ãa]o:|minist[ée]rio)"
)


def _summaries(source: str, key: str) -> str:
    """``ementa`` by ``key`` of the texts of ``source``."""
    return f"""said AS (SELECT {key}, unnest({_arr('text')}) AS raw, generate_subscripts({_arr('text')}, 1) AS i FROM {source} WHERE text IS NOT NULL),
  bare AS (SELECT {key}, i, {_strip('raw')} AS s FROM said), opened AS (SELECT {key}, min(i) AS spot FROM bare WHERE {_is('s', _VERB)} AND length(s) > 20 GROUP BY 1),
  tails AS (SELECT b.{key}, i, s, spot, CASE WHEN i > spot AND (s = '' OR {_is('s', _STOPS)} OR {_is('s', _NAVIGATES)} OR {_is('s', _START['law'])}) THEN i END AS stop, CASE WHEN i > spot AND s LIKE '%.' THEN i END AS ended
    FROM bare b JOIN opened o ON o.{key} = b.{key} WHERE i BETWEEN spot AND spot + 14),
  ends AS (SELECT {key}, least(coalesce(min(stop) - 1, 999999999), coalesce(min(ended), 999999999)) AS e FROM tails GROUP BY 1),
  stated AS (SELECT t.{key}, string_agg(s, ' ' ORDER BY i) AS ementa FROM tails t JOIN ends e ON e.{key} = t.{key} WHERE i <= e GROUP BY 1),
  plain AS (SELECT {key}, arg_min(s, i) AS ementa FROM bare WHERE length(s) > 60 AND NOT {_is('s', _NAVIGATES)} AND NOT {_is('s', _START['law'])} AND NOT (upper(s) = s AND lower(s) <> s) GROUP BY 1),
  told_ AS (SELECT d.{key}, coalesce(s.ementa, p.ementa) AS ementa FROM {source} d LEFT JOIN stated s ON s.{key} = d.{key} LEFT JOIN plain p ON p.{key} = d.{key} WHERE d.text IS NOT NULL)"""


_CPC_HEADER, _NBC_HEADER = r"(?i)pronunciamento\s+t[ée]cnico\s+cpc\s+(\d+)(\s*\(r(\d+)\))?", r"(?i)nbc\s+tg\s+(\d+)(\s*\(r(\d+)\))?"
_HEADERS = f"""headers AS (SELECT slug, text, CASE WHEN {_is('text', _CPC_HEADER)} THEN 'CPC' WHEN {_is('text', _NBC_HEADER)} THEN 'NBC TG' END AS tipo,
  CASE WHEN {_is('text', _CPC_HEADER)} THEN {_get('text', _CPC_HEADER, 1)} ELSE {_get('text', _NBC_HEADER, 1)} END AS numero,
  coalesce('R' || nullif(CASE WHEN {_is('text', _CPC_HEADER)} THEN {_get('text', _CPC_HEADER, 3)} ELSE {_get('text', _NBC_HEADER, 3)} END, ''), 'Original') AS revisao FROM openings)"""
_STANDARD = r"(?is)correla[çc][ãa]o\s+[àa]s?\s+normas.*?(ias|ifrs|ifric|sic)\s+(\d+)"
_LOWER_WORDS = "('a', 'à', 'as', 'às', 'ao', 'aos', 'com', 'da', 'das', 'de', 'do', 'dos', 'e', 'em', 'na', 'nas', 'no', 'nos', 'o', 'os', 'ou', 'para', 'por', 'que', 'sem', 'sob', 'sobre')"


def _cased(x: str) -> str:
    words = f"list_filter(regexp_split_to_array(regexp_replace({_strip(x)}, {_rx('^(.{4,}\\S)\\s+[a-z0-9]$')}, '\\1'), {_rx('\\s+')}), lambda w: w <> '')"
    return f"array_to_string(list_transform({words}, lambda w, i: CASE WHEN i > 1 AND lower(w) IN {_LOWER_WORDS} THEN lower(w) ELSE upper(left(lower(w), 1)) || substr(lower(w), 2) END), ' ')"


_NO_TITLE = (
    r"^(Correla|IFRS|IAS|COMIT|Este material|Termos|Os pronunc|Pronunciamentos|República|Federativa|Notice|Reproduced|CPC/CPC|Committee|Support|Foundation|Accounting|Pronounc|\* |de outras partes|deverá ser"
    r"|são emitidos|não devem ser|não foram|contém material|in respect|This material|Todos esses|organismo)"
)
_BEHIND = lambda header: _get("text", header.replace("(?i)", "(?is)") + "(.{0,800})", 4)
_TITLED = f"""behind AS (SELECT *, list_filter(list_transform({_arr(f"CASE WHEN tipo = 'CPC' THEN {_BEHIND(_CPC_HEADER)} ELSE {_BEHIND(_NBC_HEADER)} END")}, lambda x: {_strip('x')}), lambda x: x <> '') AS l FROM headers),
cut AS (SELECT *, l[1:coalesce(nullif(list_position(list_transform(l, lambda x: length(x) > 40), true), 0), len(l))] AS top, list_filter(l, lambda x: NOT {_is('x', _NO_TITLE)}) AS free,
  {_strip(f"regexp_extract(text, 'NBC[{_INSIDE}]+TG[{_INSIDE}]+' || numero || '[{_INSIDE}]*[–\\-—][{_INSIDE}]*([{_UPPER}][{_UPPER} ,]{{5,100}})', 1)")} AS nbc FROM behind),
steps AS (SELECT *, list_filter(top, lambda x: upper(x) = x AND lower(x) <> x AND length(x) BETWEEN 5 AND 150 AND NOT regexp_matches(x, 'CORRELA|IFRS|IAS'))[1] AS caps,
  regexp_replace(list_filter(free, lambda x: length(x) BETWEEN 3 AND 130 AND regexp_matches(x, '^\\p{{Lu}}') AND NOT regexp_matches(x, '[.,]$'))[1], {_rx('(?s)\\s+Correla[çc][ãa]o.*$')}, '') AS short,
  list_filter(free, lambda x: length(x) > 15 AND len(list_filter(regexp_split_to_array(x, {_rx('\\s+')}), lambda w: w <> '')) >= 3
    AND len(list_filter(regexp_split_to_array(x, {_rx('\\s+')}), lambda w: regexp_matches(w, '^\\p{{Lu}}'))) >= 0.6 * len(list_filter(regexp_split_to_array(x, {_rx('\\s+')}), lambda w: w <> '')))[1] AS long FROM cut),
titles AS (SELECT slug, tipo, CASE WHEN tipo = 'NBC TG' AND nbc <> '' THEN {_cased("regexp_replace(nbc, ',+$', '')")} WHEN caps IS NOT NULL THEN {_cased('caps')} WHEN short IS NOT NULL THEN {_cased('short')} ELSE long END AS titulo FROM steps)"""
_OBJECTIVES = f"""aims AS (SELECT slug, tipo, text, {_get(f"left({_get('text', '(?ms)^\\s*OBJETIVO\\s*$(.*)', 1)}, 2000)", r'(?ms)^\s*1\.\s+(.+?)^\s*(?:2\.|[A-Z]{4,})\s', 1)} AS stated,
  {_get('text', rf'(?ms)^\s*1\.\s+(.{{40,600}}?)\n\s*(?:2\.|\(a\)|[A-Z][a-záéíóúãõç]+\s*$|[{_UPPER} ]{{3,}}$)', 1)} AS first FROM headers),
objectives AS (SELECT slug, tipo, text, left(regexp_replace({_strip("coalesce(nullif(stated, ''), nullif(first, ''))")}, {_rx('\\s+')}, ' ', 'g'), 500) AS objetivo FROM aims),
summaries AS (SELECT *, coalesce(CASE WHEN tipo = 'NBC TG' THEN nullif(regexp_replace({_strip(_get('text', r'(?i)aprova\s+a\s+nbc\s+tg\s+\d+,?\s*(?:que\s+)?(disp[õo]e\s+sobre[^.]+\.)', 1))}, {_rx('\\s+')}, ' ', 'g'), '') END, objetivo) AS ementa FROM objectives)"""
_ACCOUNT_SLUG = lambda x: f"regexp_replace(lower(trim(regexp_replace(replace({x}, '/', '-'), '[^A-Za-z0-9_ -]', '', 'g'))), '[ _]+', '-', 'g')"

_SAID_SECTIONS = "sections AS (SELECT DISTINCT lower(x) AS name FROM (SELECT unnest(secoes) AS x FROM norm_meta) WHERE x IS NOT NULL)"
_RULES = (
    (r"(?i)^ap[êe]ndice\s+([A-Z])(?:\s*[–\-—]\s*(.+))?", "appendix"), (r"^([A-Z])\.?(\d+(?:\.\d+)+[A-Z]?)\s+(.+)$", "item"), (r"^([A-Z])(\d+[A-Z]?)\.\s+(.+)$", "item"), (r"^(\d+(?:\.\d+)+[A-Z]?)\s+(.+)$", "item"),
    (r"^(\d+[A-Z]?)\.\s+(.+)$", "item"), (r"^(P\d+[A-Z]?)\s+(.+)$", "item"), (r"^\(([a-z])\)\s+(.+)$", "alinea"), (r"^\(([ivxlcdm]+)\)\s+(.+)$", "subitem"),
)
_PART = lambda i, g: _get("line", _RULES[i][0], g)
_ITEM_STATE = f"""{_ITEM_PAGES}, {_clean('accounting')}, {_SAID_SECTIONS},
told AS (SELECT *, CASE WHEN line = '' THEN 'blank' {' '.join(f"WHEN {_is('line', p)} THEN '{k}'" for p, k in _RULES)}
    WHEN ({_is('line', rf'^[{_UPPER}][{_UPPER}~s\-]{{2,}}$')} AND length(line) BETWEEN 3 AND 100) OR (length(line) BETWEEN 3 AND 80 AND lower(line) IN (SELECT name FROM sections)) THEN 'section' ELSE 'text' END AS kind,
  CASE {' '.join(f"WHEN {_is('line', p)} THEN {i}" for i, (p, _) in enumerate(_RULES))} END AS rule FROM ln),
parts AS (SELECT *, CASE rule WHEN 1 THEN {_PART(1, 1)} || {_PART(1, 2)} WHEN 2 THEN {_PART(2, 1)} || {_PART(2, 2)} {' '.join(f'WHEN {i} THEN {_PART(i, 1)}' for i in range(3, 8))} END AS number,
  CASE rule WHEN 0 THEN {_PART(0, 1)} WHEN 1 THEN {_PART(1, 1)} WHEN 2 THEN {_PART(2, 1)} END AS appendix,
  {_strip(f"CASE WHEN kind IN ('section', 'text', 'blank') THEN line ELSE CASE rule WHEN 0 THEN {_PART(0, 2)} WHEN 1 THEN {_PART(1, 3)} WHEN 2 THEN {_PART(2, 3)} {' '.join(f'WHEN {i} THEN {_PART(i, 2)}' for i in range(3, 8))} END END")} AS text FROM told),
labeled AS (SELECT *, CASE WHEN kind = 'section' THEN text WHEN kind = 'appendix' THEN 'APÊNDICE ' || appendix || CASE WHEN text <> '' THEN ' – ' || text ELSE '' END END AS label FROM parts),
state AS (SELECT *, coalesce(last_value(label IGNORE NULLS) OVER w, 'OBJETIVO') AS secao,
  last_value(CASE WHEN kind = 'appendix' THEN appendix WHEN kind = 'section' AND NOT starts_with(upper(text), 'APÊNDICE') AND NOT starts_with(upper(text), 'APENDICE') THEN '' END IGNORE NULLS) OVER w AS letter,
  sum((kind = 'item')::INT) OVER w AS pos, last_value(CASE WHEN kind = 'item' THEN 1 WHEN kind IN ('section', 'appendix') THEN 0 END IGNORE NULLS) OVER w AS opened
  FROM labeled WINDOW w AS (PARTITION BY doc_id ORDER BY line_no))"""
_ITEM_UNITS = f"""{_ITEM_STATE},
items AS (SELECT doc_id, pos, max(number) FILTER (kind = 'item') AS numero, max(secao) FILTER (kind = 'item') AS secao, max(coalesce(appendix, nullif(letter, ''))) FILTER (kind = 'item') AS apendice,
  {_strip("string_agg(text, chr(10) ORDER BY line_no) FILTER (kind IN ('item', 'text', 'blank'))")} AS texto,
  coalesce(string_agg(number || ') ' || text, chr(10) ORDER BY line_no) FILTER (kind = 'alinea'), '') AS alineas, coalesce(string_agg(number || ') ' || text, chr(10) ORDER BY line_no) FILTER (kind = 'subitem'), '') AS subitens,
  string_agg('(' || number || ') ' || text, chr(10) ORDER BY line_no) FILTER (kind = 'alinea') AS ta, string_agg('(' || number || ') ' || text, chr(10) ORDER BY line_no) FILTER (kind = 'subitem') AS ts,
  string_agg('  - **(' || number || ')** ' || text, chr(10) ORDER BY line_no) FILTER (kind = 'alinea') AS ma, string_agg('    - **(' || number || ')** ' || text, chr(10) ORDER BY line_no) FILTER (kind = 'subitem') AS ms,
  count(*) FILTER (kind = 'alinea') AS n_alineas FROM state WHERE opened = 1 AND kind NOT IN ('section', 'appendix') GROUP BY 1, 2),
marked AS (SELECT *, {_is('texto', r'(?i)\((?:alterad|revis[ãa]o|substitu[íi]d|nova\s+reda)')}::INT AS rev FROM items),
ranked AS (SELECT *, max(rev) OVER (PARTITION BY doc_id, numero, apendice) = 0 OR row_number() OVER (PARTITION BY doc_id, numero, apendice ORDER BY rev DESC, pos DESC) = 1 AS vigente FROM marked),
units AS (SELECT *, CASE WHEN NOT vigente THEN sum((NOT vigente)::INT) OVER (PARTITION BY doc_id ORDER BY pos) END AS anterior, {_strip("concat_ws(chr(10), texto, ta, ts)")} AS body, {_strip("concat_ws(chr(10), texto, ma, ms)")} AS md,
  regexp_extract_all(texto, {_rx(r'\((?:Reda[çc][ãa]o|Revogad|Inclu[íi]d|Vide|Vig[êe]ncia)[^)]*\)')}) AS notas,
  list_transform(list_sort(list_distinct(list_filter(regexp_extract_all(texto, {_rx(r'(?i)(?:^|[^\p{L}\p{N}_])item\s+(\d+[A-Z]?)')}, 1), lambda r: r <> numero))), lambda r: 'item-' || lower(r)) AS refs FROM ranked)"""
_ITEM_COUNTS = """heads AS (SELECT doc_id, label AS secao, min(line_no) AS spot FROM labeled WHERE label IS NOT NULL GROUP BY 1, 2),
listed AS (SELECT doc_id, count(*) AS n_secoes, string_agg(secao, '|' ORDER BY spot) AS secoes FROM heads GROUP BY 1),
counted AS (SELECT doc_id, count(*) AS n_itens, count(*) FILTER (vigente) AS n_itens_vigentes, count(*) FILTER (vigente AND apendice IS NOT NULL) AS n_itens_apendice, count(*) FILTER (NOT vigente) AS n_redacoes_anteriores,
  coalesce(sum(n_alineas) FILTER (vigente), 0)::BIGINT AS n_alineas FROM units GROUP BY 1),
counts AS (SELECT c.*, coalesce(n_secoes, 0) AS n_secoes, coalesce(secoes, '') AS secoes FROM counted c LEFT JOIN listed l USING (doc_id))"""
_COUNTED = "paged_ AS (SELECT doc_id, count(*) AS n_paginas FROM pages GROUP BY 1), csvs AS (SELECT slug AS doc_id, count(DISTINCT csv) AS n_anexos_csv FROM annex_cell WHERE csv IS NOT NULL GROUP BY 1)"
_FIRST_LINE = f"declared AS (SELECT slug, list_filter(list_transform({_arr('text')}[1:60], lambda x: {_strip('x')}), lambda x: {_is('x', _DECLARES)})[1] AS line, upper(array_to_string({_arr('text')}[1:15], chr(10))) AS head, text FROM law_heads)"
_TYPE_OF = lambda x: "CASE " + " ".join(f"WHEN {x} = '{k}' THEN '{v}'" for k, v in _TYPES) + " END"
_HELD_TYPE = lambda x: "CASE " + " ".join(f"WHEN contains({x}, '{k}') THEN '{v}'" for k, v in _TYPES) + " END"
_NTH, _IN_YEAR = r"(?i)n[º°o]?\.?\s*(\d[\d.]*)", r"(^|[^\p{L}\p{N}_])((?:19|20)\d{2})([^\p{L}\p{N}_]|$)"
_LAW_META = f"""{_FIRST_LINE},
declares AS (SELECT slug, {_TYPE_OF(f"upper({_get('line', _DECLARES, 1)})")} AS tipo, replace({_get('line', _DECLARES, 3)}, '.', '') AS numero, {_get('line', _DECLARES, 5)} AS ano,
  {_HELD_TYPE('head')} AS f_tipo, nullif(replace({_get('head', _NTH, 1)}, '.', ''), '') AS f_numero, nullif({_get('left(text, 1200)', _IN_YEAR, 2)}, '') AS f_ano FROM declared),
named AS (SELECT slug, coalesce(tipo, f_tipo) AS tipo, coalesce(numero, f_numero) AS numero, coalesce(ano, f_ano) AS ano FROM declares),
{_summaries('law_heads', 'slug')},
n_units AS (SELECT doc_id, count(*) AS n_artigos, count(*) FILTER (vigente) AS n_artigos_vigentes, count(*) FILTER (NOT vigente) AS n_redacoes_anteriores FROM units GROUP BY 1), {_COUNTED},
metas AS (SELECT p.doc_id, tipo, numero, ano, CASE WHEN tipo <> '' AND numero <> '' THEN tipo || ' ' || numero || CASE WHEN ano <> '' THEN '/' || ano ELSE '' END ELSE p.doc_id END AS identificador, ementa,
  coalesce(n_artigos, 0) AS n_artigos, coalesce(n_artigos_vigentes, 0) AS n_artigos_vigentes, coalesce(n_redacoes_anteriores, 0) AS n_redacoes_anteriores, coalesce(n_anexos_csv, 0) AS n_anexos_csv, n_paginas
  FROM paged_ p LEFT JOIN named n ON n.slug = p.doc_id LEFT JOIN told_ e ON e.slug = p.doc_id LEFT JOIN n_units u ON u.doc_id = p.doc_id LEFT JOIN csvs c ON c.doc_id = p.doc_id)"""
_QUOTE = lambda c, lead="": f"CASE WHEN {c} <> '' THEN '> {lead}' || {c} || chr(10) END"

ORACLE: dict[str, str] = {
    "s2_needs_ocr": f"SELECT doc_id, length({_strip('text')}) < 40 AS needs FROM documents WHERE text IS NOT NULL",
    "s4_ocr_choice": f"SELECT doc_id, md5(CASE WHEN coalesce(length({_strip('text')}) < 40, true) AND coalesce(length(url) > coalesce(length(text), 0), false) THEN url ELSE text END) AS chosen FROM documents",
    "l1_repeated_lines": f"WITH {_PAGES}, {_REPEATED} SELECT doc_id, line, n FROM repeated",
    "l2_noise_lines": f"WITH {_DOC_LINES} SELECT doc_id, count(*) FILTER ({_is('line', _NOISE['law'])}) AS law, count(*) FILTER ({_is('line', _NOISE['accounting'])}) AS accounting FROM ln WHERE line <> '' GROUP BY 1",
    "l3_kept_lines": f"""WITH {_PAGES}, {_kept('law')}, agg AS (SELECT doc_id, page_no, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t FROM kept GROUP BY 1, 2)
        SELECT p.doc_id, p.page_no, coalesce(n, 0) AS n, md5(coalesce(t, '')) AS kept FROM paged p LEFT JOIN agg a ON a.doc_id = p.doc_id AND a.page_no = p.page_no WHERE p.arr IS NOT NULL""",
    "l4_dehyphenated": rf"WITH {_DOCS} SELECT doc_id, md5(regexp_replace(array_to_string(arr, chr(10)), '([\p{{L}}\p{{N}}_])-\n([\p{{L}}\p{{N}}_])', '\1\2', 'g')) AS text FROM docs",
    "l5_paragraphs": f"WITH {_BY_PAGE}, {_PARAGRAPHS('k0', 'k1', 'law')} {_WHOLE('k1')}",
    "l6_tidied": rf"WITH {_DOCS} SELECT doc_id, md5({_strip(rf'''regexp_replace(regexp_replace(array_to_string(arr, chr(10)), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')''')}) AS text FROM docs",
    "l7_orphans_merged": f"WITH {_BY_PAGE}, {_ORPHANS('k0', 'k1')} {_WHOLE('k1')}",
    "l8_titles_merged": f"WITH {_BY_PAGE}, {_TITLES('k0', 'k1')} {_WHOLE('k1')}",
    "l9_clean_law": f"WITH {_PAGES}, {_clean('law')} SELECT doc_id, line_no, line FROM ln",
    "l9_clean_accounting": f"WITH {_PAGES}, {_clean('accounting')} SELECT doc_id, line_no, line FROM ln",
    "e1_epigraphs": f"WITH {_NORMS}, {_LAW_HEADS}, {_FIRST_LINE} SELECT slug, {_TYPE_OF(f'''upper({_get('line', _DECLARES, 1)})''')} AS tipo, replace({_get('line', _DECLARES, 3)}, '.', '') AS numero, {_get('line', _DECLARES, 5)} AS ano FROM declared WHERE line IS NOT NULL",
    "e3_identities": f"WITH heads AS (SELECT doc_id, text, upper(array_to_string({_arr('text')}[1:15], chr(10))) AS head FROM documents WHERE text IS NOT NULL) SELECT doc_id, {_HELD_TYPE('head')} AS tipo, nullif(replace({_get('head', _NTH, 1)}, '.', ''), '') AS numero, nullif({_get('left(text, 1200)', _IN_YEAR, 2)}, '') AS ano FROM heads",
    "e4_summaries": f"WITH {_NORMS}, {_LAW_HEADS}, {_summaries('law_heads', 'slug')} SELECT slug, ementa FROM told_",
    "e5_page_summaries": f"WITH {_summaries('documents', 'doc_id')} SELECT doc_id, md5(ementa) AS ementa FROM told_",
    "e6_norm_ids": r"SELECT DISTINCT identificador, CASE WHEN tipo <> '' AND numero <> '' THEN tipo || ' ' || numero || CASE WHEN ano <> '' THEN '/' || ano ELSE '' END ELSE regexp_replace(fonte_arquivo, '\.[^.]*$', '') END AS made FROM norm_meta",
    "e7_slugs": f"SELECT DISTINCT identificador, {_SLUGGED.replace('(x)', '(identificador)')} AS slug FROM norm_meta",
    "e8_accounting_headers": f"WITH {_OPENINGS}, {_HEADERS} SELECT slug, tipo, numero, revisao FROM headers",
    "e9_correlations": f"WITH {_OPENINGS} SELECT slug, upper({_get('left(text, 2000)', _STANDARD, 1)}) || ' ' || {_get('left(text, 2000)', _STANDARD, 2)} AS ifrs FROM openings WHERE {_is('left(text, 2000)', _STANDARD)}",
    "e10_titles": f"WITH {_OPENINGS}, {_HEADERS}, {_TITLED} SELECT slug, titulo FROM titles WHERE titulo IS NOT NULL",
    "e11_accounting_summaries": f"WITH {_OPENINGS}, {_HEADERS}, {_OBJECTIVES} SELECT slug, ementa FROM summaries WHERE ementa IS NOT NULL",
    "e12_objectives": f"WITH {_OPENINGS}, {_HEADERS}, {_OBJECTIVES} SELECT slug, objetivo FROM objectives WHERE objetivo IS NOT NULL",
    "e13_title_case": f"SELECT DISTINCT codigo, {_cased('titulo')} AS titulo FROM tax_catalog WHERE codigo IS NOT NULL",
    "e14_fingerprints": "SELECT doc_id, left(sha256(text), 16) AS sha256_16 FROM documents WHERE text IS NOT NULL",
    "e15_accounting_slugs": f"WITH {_OPENINGS}, {_HEADERS} SELECT slug, {_ACCOUNT_SLUG('''tipo || ' ' || numero''')} AS dir_slug, {_ACCOUNT_SLUG('''tipo || ' ' || numero || CASE WHEN revisao <> 'Original' THEN ' ' || revisao ELSE '' END''')} AS id_slug FROM headers",
    "law_line_kinds": f"WITH {_LAW_PAGES}, {_clean('law')}, {_CLASSIFIED} SELECT doc_id, kind, count(*) AS n, sum(line_no)::BIGINT AS places FROM kinds GROUP BY 1, 2",
    "law_units": f"WITH {_LAW_UNITS} SELECT doc_id, pos, numero, breadcrumb, md5(texto) AS texto, array_to_string(notas, '|') AS notas, array_to_string(refs, '|') AS refs, vigente, anterior FROM units",
    "law_chunks": f"WITH {_LAW_UNITS} SELECT doc_id || '--art-' || numero || {_EARLIER} AS id, CASE WHEN breadcrumb <> '' THEN breadcrumb || ' > ' ELSE '' END || 'Art. ' || {_SHOWN} AS path, vigente FROM units",
    "law_chunk_records": f"""WITH {_PARTS}, {_HELD} SELECT u.doc_id || '--art-' || u.numero || {_EARLIER} AS id, n.identificador AS norma, n.tipo, CASE WHEN breadcrumb <> '' THEN breadcrumb || ' > ' ELSE '' END || 'Art. ' || {_SHOWN.replace('numero', 'u.numero')} AS path,
        u.numero AS artigo, vigente, md5({_strip(f"'Art. ' || {_SHOWN.replace('numero', 'u.numero')} || '. ' || body")}) AS texto, array_to_string(notas, '|') AS notas_vigencia, array_to_string(refs, '|') AS refs,
        coalesce(array_to_string(a.anexos, '|'), '') AS anexos, n.fonte_arquivo AS fonte
        FROM units u JOIN bodies b ON b.doc_id = u.doc_id AND b.pos = u.pos LEFT JOIN norms n ON n.slug = u.doc_id LEFT JOIN annexed a ON a.slug = n.slug""",
    "law_counts": f"WITH {_LAW_UNITS} SELECT doc_id, count(*) AS n_artigos, count(*) FILTER (vigente) AS n_vigentes, count(*) FILTER (NOT vigente) AS n_anteriores FROM units GROUP BY 1",
    "law_meta_records": f"WITH {_LAW_UNITS}, {_LAW_META} SELECT * FROM metas",
    "law_subunits": f"WITH {_PARTS} SELECT p.doc_id, p.pos, md5(coalesce(caput, '')) AS caput, (g - 1)::BIGINT AS n, level::BIGINT AS level, label, md5(content) AS content FROM parts p LEFT JOIN caputs c ON c.doc_id = p.doc_id AND c.pos = p.pos",
    "law_bodies": f"WITH {_PARTS} SELECT doc_id, pos, md5(body) AS text, md5(md) AS markdown FROM bodies",
    "law_notes_refs": f"WITH {_LATEST} SELECT id, array_to_string(regexp_extract_all(texto, {_rx(_NOTED)}), '|') AS notas, array_to_string({_REFS('texto', f'''coalesce({_NUMBER('artigo')}, '')''')}, '|') AS refs FROM latest WHERE texto IS NOT NULL",
    "accounting_line_kinds": f"WITH {_ITEM_STATE} SELECT doc_id, kind, count(*) AS n FROM parts GROUP BY 1, 2",
    "accounting_units": f"""WITH {_ITEM_UNITS} SELECT doc_id, pos, numero, secao, apendice, md5(texto) AS texto, md5(alineas) AS alineas, md5(subitens) AS subitens, array_to_string(notas, '|') AS notas, array_to_string(refs, '|') AS refs, vigente, anterior FROM units""",
    "accounting_counts": f"WITH {_ITEM_UNITS}, {_ITEM_COUNTS} SELECT * FROM counts",
    "accounting_bodies": f"WITH {_ITEM_UNITS} SELECT doc_id, pos, md5(body) AS text, md5(md) AS markdown FROM units",
    "accounting_chunk_records": f"""WITH {_ITEM_UNITS}, {_HELD} SELECT doc_id || '--item-' || lower(u.numero) || {_EARLIER} AS id, doc_id, pos, n.identificador AS norma, n.tipo, n.numero AS numero_norma, n.revisao, n.correlacao_ifrs, secao || ' > Item ' || u.numero AS path, secao,
        u.numero AS item, apendice, vigente, md5({_strip("'Item ' || u.numero || '. ' || body")}) AS texto, array_to_string(notas, '|') AS notas_vigencia, array_to_string(refs, '|') AS refs, coalesce(array_to_string(a.anexos, '|'), '') AS anexos, n.fonte_arquivo AS fonte
        FROM units u LEFT JOIN norms n ON n.slug = u.doc_id LEFT JOIN annexed a ON a.slug = n.slug""",
    "accounting_meta_records": f"""WITH {_ITEM_UNITS}, {_ITEM_COUNTS}, {_COUNTED}, {_OPENINGS.split('firsts AS', 1)[1].join(['firsts AS', ''])}, {_HEADERS}, {_TITLED}, {_OBJECTIVES}
        SELECT p.doc_id, h.tipo, h.numero, CASE WHEN h.slug IS NOT NULL THEN h.revisao END AS revisao, t.titulo, CASE WHEN {_is('left(h.text, 2000)', _STANDARD)} THEN upper({_get('left(h.text, 2000)', _STANDARD, 1)}) || ' ' || {_get('left(h.text, 2000)', _STANDARD, 2)} END AS correlacao_ifrs,
        coalesce(h.tipo || ' ' || h.numero || CASE WHEN h.revisao <> 'Original' THEN ' (' || h.revisao || ')' ELSE '' END, p.doc_id) AS identificador, s.ementa, {_ACCOUNT_SLUG('''h.tipo || ' ' || h.numero''')} AS dir_slug,
        {_ACCOUNT_SLUG('''h.tipo || ' ' || h.numero || CASE WHEN h.revisao <> 'Original' THEN ' ' || h.revisao ELSE '' END''')} AS id_slug, coalesce(n_itens, 0) AS n_itens, coalesce(n_itens_vigentes, 0) AS n_itens_vigentes, coalesce(n_itens_apendice, 0) AS n_itens_apendice,
        coalesce(n_redacoes_anteriores, 0) AS n_redacoes_anteriores, coalesce(n_alineas, 0) AS n_alineas, coalesce(n_secoes, 0) AS n_secoes, secoes, coalesce(n_anexos_csv, 0) AS n_anexos_csv, n_paginas
        FROM paged_ p LEFT JOIN headers h ON h.slug = p.doc_id LEFT JOIN titles t ON t.slug = p.doc_id LEFT JOIN summaries s ON s.slug = p.doc_id LEFT JOIN counts c ON c.doc_id = p.doc_id LEFT JOIN csvs v ON v.doc_id = p.doc_id""",
    "render_front_matter": f"SELECT DISTINCT identificador, {_FRONT(_LAW_FRONT)} AS front FROM norm_meta WHERE identificador IS NOT NULL",
    "render_headings": f"WITH {_LAW_UNITS}, {_HEADINGS} SELECT doc_id, pos, headings FROM headed WHERE headings <> ''",
    "render_sections": f"WITH {_ITEM_UNITS}, changed AS (SELECT doc_id, pos, secao AS heading, lag(secao) OVER (PARTITION BY doc_id ORDER BY pos) AS was FROM units) SELECT doc_id, pos, heading FROM changed WHERE heading IS DISTINCT FROM was",
    "law_documents": f"WITH {_PARTS}, {_HEADINGS}, " + _document("tipo <> 'CPC'", f"concat_ws(chr(10), {_FRONT(_LAW_FRONT)} || chr(10), '# ' || identificador || chr(10), {_QUOTE('ementa')})",
        f"""CASE WHEN headings <> '' THEN chr(10) || headings || chr(10) ELSE '' END || chr(10) || '<a id="art-' || numero || {_EARLIER} || '"></a>' || chr(10) || trim(CASE WHEN vigente THEN '**Art. ' || {_SHOWN} || '.** ' || md
            ELSE '> _(Art. ' || {_SHOWN} || ' — redação anterior, superada)_  ' || chr(10) || '> ' || md END) FROM (SELECT u.*, b.md, h.headings FROM units u JOIN bodies b ON b.doc_id = u.doc_id AND b.pos = u.pos JOIN headed h ON h.doc_id = u.doc_id AND h.pos = u.pos) WHERE true"""),
    "accounting_documents": f"WITH {_ITEM_UNITS}, " + _document("tipo = 'CPC'", f"concat_ws(chr(10), {_FRONT(_ITEM_FRONT)} || chr(10), '# ' || identificador || ' — ' || coalesce(titulo, identificador) || chr(10), {_QUOTE('correlacao_ifrs', '**Correlação:** ')}, {_QUOTE('ementa')})",
        f"""CASE WHEN secao IS DISTINCT FROM was THEN chr(10) || '## ' || secao || chr(10) || chr(10) ELSE '' END || chr(10) || '<a id="item-' || lower(numero) || {_EARLIER} || '"></a>' || chr(10) || {_strip("CASE WHEN vigente THEN '**' || numero || '.** ' || md ELSE '> _(Item ' || numero || ' — redação anterior, superada por revisão)_  ' || chr(10) || '> ' || md END")}
            FROM (SELECT *, lag(secao) OVER (PARTITION BY doc_id ORDER BY pos) AS was FROM units) WHERE true"""),
    "v7_annex_leaks": f"WITH {_LAW_UNITS}, skipped AS (SELECT DISTINCT doc_id, line FROM kinds WHERE kind = 'skipped' AND length(line) >= 20), said AS (SELECT DISTINCT doc_id, unnest(string_split(texto, chr(10))) AS line FROM units) SELECT k.doc_id, count(*) AS annex_lines, count(s.line) AS leaked FROM skipped k LEFT JOIN said s ON s.doc_id = k.doc_id AND s.line = k.line GROUP BY 1",
    "v5_front_matter": f"WITH {_LAW_UNITS}, {_LAW_META} SELECT m.doc_id AS slug, m.identificador AS said, n.identificador FROM metas m JOIN norms n ON n.slug = m.doc_id WHERE m.identificador <> n.identificador",
}
