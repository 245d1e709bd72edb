"""Queries of annexes, manifest, catalogs, retrieval and validation, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigora.operators import annexes as A
from vigora.operators import catalogs as C
from vigora.operators import dialect as D
from vigora.operators import render as R
from vigora.operators import retrieval as X
from vigora.operators import validation as V
from vigora.operators.lines import needs_ocr
from vigora.plans.problems import _P1
from vigora.sources.tables import table


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return A.distinct_rows(table(spark, d, "annex_cell"))


def _catalog(spark: SparkSession, d: str) -> DataFrame:
    return C.distinct_entries(table(spark, d, "tax_catalog"))


def _chunks(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(spark, d, "chunk").select("id", "loaded_at", *columns)


def t1_cells(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).select("slug", "csv", "row_no", F.array_join("header", "|").alias("header"), F.array_join("cells", "|").alias("cells"))


def t2_routing(spark: SparkSession, d: str) -> DataFrame:
    return A.routing(_rows(spark, d))


def t3_headers(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).select("slug", "csv", F.array_join(A.fill_header(F.col("header")), "|").alias("header")).distinct()


def t4_numbering(spark: SparkSession, d: str) -> DataFrame:
    return A.numbering(A.routing(_rows(spark, d)))


def t5_without_contents(spark: SparkSession, d: str) -> DataFrame:
    page = F.regexp_extract("csv", r"(\d+)", 1).cast("int")
    return A.without_contents(_rows(spark, d).withColumn("page", page)).groupBy("slug", "csv").agg(F.count("*").alias("n"))


def t6_markdown(spark: SparkSession, d: str) -> DataFrame:
    return A.markdown_rows(_rows(spark, d))


def t7_stitched(spark: SparkSession, d: str) -> DataFrame:
    return A.stitch(_rows(spark, d))


def t8_code_lookup(spark: SparkSession, d: str) -> DataFrame:
    return A.code_lookup(_rows(spark, d))


def m1_manifest(spark: SparkSession, d: str) -> DataFrame:
    return C.manifest_entries(table(spark, d, "norm_meta"), table(spark, d, "annex_cell"), table(spark, d, "chunk"))


def m4_manifest_head(spark: SparkSession, d: str) -> DataFrame:
    return C.manifest_head(m1_manifest(spark, d), "2025-12-31")


def c1_code_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "norm_meta").select("identificador", C.code_key(F.col("identificador")).alias("key")).distinct()


TARGETS = ("lc 19999/2023", "Lei 20016/1994", "IN RFB  20055/2013", "Decreto 99999/1900")


def c2_flip(spark: SparkSession, d: str) -> DataFrame:
    return C.flip(_catalog(spark, d), TARGETS)


def c2_flipped(spark: SparkSession, d: str) -> DataFrame:
    entries = _catalog(spark, d)
    return C.apply_flip(entries, C.flip(entries, TARGETS)).select("codigo", "no_repo")


def c3_status(spark: SparkSession, d: str) -> DataFrame:
    return _catalog(spark, d).select("codigo", C.status(F.col("situacao"), F.col("no_repo")).alias("status"))


def c4_by_subject(spark: SparkSession, d: str) -> DataFrame:
    return C.by_subject(_catalog(spark, d))


def c5_first_subject(spark: SparkSession, d: str) -> DataFrame:
    return C.first_subject(_catalog(spark, d))


def c6_leftovers(spark: SparkSession, d: str) -> DataFrame:
    return C.first_subject(_catalog(spark, d)).where("section = 0").select("codigo")


def c7_chronological(spark: SparkSession, d: str) -> DataFrame:
    return C.chronological(_catalog(spark, d))


def c8_coverage(spark: SparkSession, d: str) -> DataFrame:
    return C.coverage(_catalog(spark, d))


def c9_by_family(spark: SparkSession, d: str) -> DataFrame:
    return C.by_family(_catalog(spark, d), ("LC", "Lei", "Decreto"))


def c10_pronouncements(spark: SparkSession, d: str) -> DataFrame:
    return C.distinct_norms(table(spark, d, "norm_meta")).where(F.col("identificador").startswith("CPC")).select("identificador", "titulo", "revisao").orderBy("identificador")


def c11_blocks(spark: SparkSession, d: str) -> DataFrame:
    codes = table(spark, d, "norm_meta").select(F.regexp_extract("identificador", r"^(\D+\d+)", 1).alias("codigo")).distinct()
    return C.numeric_blocks(codes, ((19_000, 20_019), (20_020, 20_049), (20_050, 99_999)))


def c12_exceptions(spark: SparkSession, d: str) -> DataFrame:
    """Codes of a family, one code moved out of it into another group."""
    return _catalog(spark, d).select("codigo", C.regrouped(F.col("codigo"), F.col("familia"), {"LC 19999/2023": "apart"}).alias("group"))


def c9_accounting_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Accounting norms as entries of a catalog: every fourth number an audit norm, every fifth an interpretation, the rest NBC TG."""
    norms = C.distinct_norms(table(spark, d, "norm_meta")).where("tipo = 'CPC' AND numero IS NOT NULL")
    n = F.col("numero").cast("bigint")
    family = F.when(n % 4 == 0, "NBC TA").when(n % 5 == 0, "ITG").otherwise("NBC TG")
    code = F.concat(family, F.lit(" "), F.when(n % 4 == 0, 200 + n % 700).otherwise(n))
    held = norms.select(code.alias("codigo"), "titulo", family.alias("familia"), F.when(n % 7 == 0, "revogada").otherwise("vigente").alias("situacao"), (n % 2 == 0).alias("no_repo"),
                        F.when(n % 14 == 0, "NBC TG 1").alias("revogada_por"), F.col("identificador").alias("correspondencia_cpc"))
    return C.accounting_lines(held)


def r2_annex_index(spark: SparkSession, d: str) -> DataFrame:
    return R.annex_index(_rows(spark, d))


def r7_table_lines(spark: SparkSession, d: str) -> DataFrame:
    return C.table_lines(_catalog(spark, d)).select("codigo", "line")


def x1_norm_units(spark: SparkSession, d: str) -> DataFrame:
    """Manifest lookup by text, then the units of the norms found: the lookup prunes what is joined."""
    wanted = m1_manifest(spark, d).where(F.col("identificador").startswith("Lei ")).select("slug")
    units = X.last_delivered(_chunks(spark, d, "path")).withColumn("slug", F.substring_index("id", "--", 1))
    return units.join(wanted, "slug", "left_semi").select("slug", "id", "path")


def x2_current(spark: SparkSession, d: str) -> DataFrame:
    return X.current(table(spark, d, "chunk")).select("id", "norma").distinct()


def x3_citation(spark: SparkSession, d: str) -> DataFrame:
    ids = ("lc-19999-2023--art-8", "lc-19999-2023--art-8--anterior-001")
    return X.cite(table(spark, d, "chunk"), ids).select("id", "path", "texto").distinct()


def x4_wordings(spark: SparkSession, d: str) -> DataFrame:
    return X.wordings(table(spark, d, "chunk"))


def x5_follow_refs(spark: SparkSession, d: str) -> DataFrame:
    return X.follow(_chunks(spark, d, "refs", "path", "vigente"))


def x6_correspondence(spark: SparkSession, d: str) -> DataFrame:
    """Catalog entries with their norm's correlation; an entry at hand comes first."""
    norms = C.distinct_norms(table(spark, d, "norm_meta")).select(F.col("identificador").alias("codigo"), "correlacao_ifrs")
    both = _catalog(spark, d).select("codigo", "titulo", C.status(F.col("situacao"), F.col("no_repo")).alias("status"), "no_repo")
    return both.join(norms, "codigo", "left").orderBy(F.col("no_repo").desc_nulls_last(), "codigo").select("codigo", "titulo", "status", "correlacao_ifrs")


def x7_chains(spark: SparkSession, d: str) -> DataFrame:
    """What each current unit reaches along references within its norm."""
    edges = X.follow(_chunks(spark, d, "refs", "path", "vigente")).where("path IS NOT NULL").select(F.col("id").alias("src"), F.col("target").alias("dst"))
    reached = X.chain(edges)
    return reached.groupBy("start").agg(F.count("*").alias("reached"), F.max("depth").alias("deepest"))


def x8_prefixes(spark: SparkSession, d: str) -> DataFrame:
    """Full codes with the part whose key, padded to four digits, is their heading."""
    codes = A.code_lookup(_rows(spark, d)).select("code").distinct()
    parts = table(spark, d, "part").select("p_partkey", "p_name")
    return X.prefix_join(codes, parts, "code", "p_partkey", 4).select("code", "p_partkey", "p_name")


def x9_articles(spark: SparkSession, d: str) -> DataFrame:
    """References written in texts joined with the unit they number, within the norm."""
    units = X.last_delivered(_chunks(spark, d, "texto", "path")).where("texto IS NOT NULL")
    said = units.select("id", F.explode(F.regexp_extract_all("texto", F.lit(r"art\. (\d+) desta norma"), F.lit(1))).alias("n")).distinct()
    target = said.withColumn("target", F.concat(F.substring_index("id", "--", 1), F.lit("--art-"), "n"))
    return target.join(units.select(F.col("id").alias("target"), "path"), "target").select("id", "target", "path")


def x10_valid_on(spark: SparkSession, d: str) -> DataFrame:
    """State of removals at a date: a unit is out from its removal until its next arrival, open if there is none."""
    gone = table(spark, d, "chunk_removal").where("id IS NOT NULL").groupBy("id").agg(F.max("removed_at").alias("out_at"))
    back = _chunks(spark, d).join(gone, "id").where("loaded_at > out_at").groupBy("id").agg(F.min("loaded_at").alias("in_at"))
    return X.valid_on(gone.join(back, "id", "left"), "out_at", "in_at", "2024-01-01 00:00:00").select("id")


def x11_snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    snaps = table(spark, d, "chunk_snapshot")
    at = lambda day: snaps.where(F.col("snapshot_date") == F.lit(day).cast("date"))
    return X.diff(at("2025-05-01"), at("2025-06-01"), ["id"], F.coalesce(F.lower(F.trim("artigo")), F.lit("")))


def x12_search(spark: SparkSession, d: str) -> DataFrame:
    return X.rank_terms(table(spark, d, "documents"), "doc_id", "text", ("crédito presumido", "regime especial", "ração animal"), 20)


def x19_router(spark: SparkSession, d: str) -> DataFrame:
    triggers = table(spark, d, "tax_catalog").select(F.explode(F.array_distinct("assunto")).alias("assunto")).where("assunto <> ''").distinct()
    listed = triggers.select(F.col("assunto").alias("skill"), F.regexp_replace(F.substring_index("assunto", "-", 1), "io$", "").alias("trigger"), F.length("assunto").alias("priority"))
    return X.route(table(spark, d, "documents"), "doc_id", "text", listed)


def x20_subjects(spark: SparkSession, d: str) -> DataFrame:
    return X.tagged(_catalog(spark, d), "assunto", ("irpf", "agrario")).select("codigo")


def x21_state_at(spark: SparkSession, d: str) -> DataFrame:
    from vigora.operators.history import ATTRS, as_of, unit_log

    return as_of(unit_log(table(spark, d, "chunk_snapshot")), "id", ATTRS, "2025-09-01").groupBy("vigente").agg(F.count("*").alias("n"))


def v1_counts(spark: SparkSession, d: str) -> DataFrame:
    return V.counts_against_meta(_chunks(spark, d, "vigente"), table(spark, d, "norm_meta"))


def v2_repeated_ids(spark: SparkSession, d: str) -> DataFrame:
    return V.repeated_ids(table(spark, d, "chunk"))


def v4_broken_json(spark: SparkSession, d: str) -> DataFrame:
    return V.broken_json(table(spark, d, "raw_record")).select("rec_id", "feed", "file_no")


def v6_missing_annexes(spark: SparkSession, d: str) -> DataFrame:
    return V.missing_annexes(table(spark, d, "chunk"), table(spark, d, "annex_cell"))


def v7_sanity(spark: SparkSession, d: str) -> DataFrame:
    return V.sanity(table(spark, d, "norm_meta"))


def v7_mojibake(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.where(V.mojibake(F.col("text"))).select("doc_id", needs_ocr(F.col("text")).alias("short"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        t1_cells, t2_routing, t3_headers, t4_numbering, t5_without_contents, t6_markdown, t7_stitched, t8_code_lookup, m1_manifest, m4_manifest_head,
        c1_code_keys, c2_flip, c2_flipped, c3_status, c4_by_subject, c5_first_subject, c6_leftovers, c7_chronological, c8_coverage, c9_by_family,
        c10_pronouncements, c11_blocks, c12_exceptions, c9_accounting_catalog, r2_annex_index, r7_table_lines, x1_norm_units, x2_current, x3_citation, x4_wordings, x5_follow_refs,
        x6_correspondence, x7_chains, x8_prefixes, x9_articles, x10_valid_on, x11_snapshot_diff, x12_search, x19_router, x20_subjects, x21_state_at,
        v1_counts, v2_repeated_ids, v4_broken_json, v6_missing_annexes, v7_sanity, v7_mojibake,
    )
}

_S = D.S
_STRIP = lambda x: f"regexp_replace(regexp_replace({x}, '^{_S}+', ''), '{_S}+$', '')"
_CLEAN = lambda c: f"list_transform(coalesce({c}, []), lambda c: {_STRIP('coalesce(c, chr(32))')})"
_ROWS = f"""rows_ AS (SELECT slug, csv, row_no, max(struct_pack(header := {_CLEAN('header')}, cells := {_CLEAN('cells')})) AS r
  FROM annex_cell WHERE slug IS NOT NULL AND csv IS NOT NULL AND row_no IS NOT NULL GROUP BY 1, 2, 3),
cells_ AS (SELECT slug, csv, row_no, r.header AS header, r.cells AS cells FROM rows_)"""
_ROUTED = f"""{_ROWS}, routed AS (SELECT slug, csv, count(*) AS body, max(greatest(len(header), len(cells))) AS cols FROM cells_ GROUP BY 1, 2),
routes AS (SELECT *, body >= 8 OR (cols >= 3 AND body >= 4) AS to_csv FROM routed)"""
_CATALOG = "cat AS (SELECT DISTINCT ON (codigo) * FROM tax_catalog WHERE codigo IS NOT NULL ORDER BY codigo)"
_SLUG = r"regexp_replace(lower(trim(regexp_replace(replace(strip_accents(identificador), '/', '-'), '[^A-Za-z0-9_\s-]', '', 'g'))), '[\s_]+', '-', 'g')"
_NORMS = f"norms AS (SELECT DISTINCT ON (identificador) *, {_SLUG} AS slug FROM norm_meta WHERE identificador IS NOT NULL ORDER BY identificador, n_artigos DESC NULLS LAST)"
_MANIFEST = f"""{_NORMS}, csvs AS (SELECT slug, count(DISTINCT csv) AS n FROM annex_cell WHERE csv IS NOT NULL GROUP BY 1),
held AS (SELECT DISTINCT split_part(id, '--', 1) AS slug FROM chunk WHERE id IS NOT NULL),
entries AS (SELECT n.identificador, n.slug, n.tipo, n.numero, n.ano, n.ementa, n.fonte_versao, n.atualizado_em,
  coalesce(n_artigos_vigentes, n_artigos)::BIGINT AS n_artigos_vigentes, coalesce(n_redacoes_anteriores, 0)::BIGINT AS n_redacoes_anteriores, coalesce(c.n, 0) AS n_anexos, n.sha256_16,
  CASE WHEN h.slug IS NOT NULL THEN n.slug || '/' || n.slug || '.md' END AS markdown, CASE WHEN h.slug IS NOT NULL THEN n.slug || '/' || n.slug || '.chunks.jsonl' END AS chunks, n.slug || '/' || n.slug || '.meta.json' AS meta, CASE WHEN c.n > 0 THEN n.slug || '/anexos/' END AS anexos_dir
  FROM norms n LEFT JOIN csvs c ON c.slug = n.slug LEFT JOIN held h ON h.slug = n.slug)"""
_LATEST = "latest AS (SELECT * FROM chunk WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1)"
_KEY = lambda c: rf"regexp_replace(regexp_replace(upper({_STRIP(c)}), '{_S}*\(R[0-9]+\){_S}*', '', 'g'), '{_S}+', ' ', 'g')"
_STATUS = "CASE WHEN lower(situacao) = 'revogada' THEN '[REV]' WHEN no_repo THEN '[OK]' ELSE '[  ]' END"
_SUBJECTS = "[" + ", ".join(f"'{s}'" for s in C.SUBJECTS) + "]"
_FIRST = f"{_CATALOG}, ranked AS (SELECT codigo, nullif(list_position({_SUBJECTS}, a), 0) AS r FROM (SELECT codigo, unnest(CASE WHEN len(assunto) > 0 THEN assunto ELSE [NULL] END) AS a FROM cat)), first_ AS (SELECT codigo, coalesce(min(r), 0)::INT AS section FROM ranked GROUP BY 1)"
_BARE = rf"lower(regexp_replace(r, '[\s\x{{00a0}}º]+', '', 'g'))"
_FOLLOW = f"{_LATEST}, said AS (SELECT DISTINCT id, {_BARE} AS ref FROM (SELECT id, unnest(refs) AS r FROM latest WHERE vigente)), named AS (SELECT id, ref, split_part(id, '--', 1) || '--' || ref AS target FROM said WHERE ref <> ''), followed AS (SELECT n.*, l.path FROM named n LEFT JOIN latest l ON l.id = n.target)"
_TARGETS = ", ".join(f"('{t}')" for t in TARGETS)
_FLIP = f"{_CATALOG}, wanted AS (SELECT t AS target, {_KEY('t')} AS key FROM (VALUES {_TARGETS}) v(t)), keyed AS (SELECT min(struct_pack(codigo := codigo, no_repo := coalesce(no_repo, false))) AS e, {_KEY('codigo')} AS key FROM cat GROUP BY 2), flips AS (SELECT target, e.codigo AS codigo, CASE WHEN e IS NULL THEN 'missing' WHEN e.no_repo THEN 'already' ELSE 'found' END AS outcome FROM wanted LEFT JOIN keyed USING (key))"
_TERMS = ("crédito presumido", "regime especial", "ração animal")
_HELD = " + ".join(f"contains(t, '{x}')::INT" for x in _TERMS)
_OFTEN = " + ".join(f"(length(t) - length(replace(t, '{x}', ''))) / {len(x)}" for x in _TERMS)

ORACLE: dict[str, str] = {
    "t1_cells": f"WITH {_ROWS} SELECT slug, csv, row_no, array_to_string(header, '|') AS header, array_to_string(cells, '|') AS cells FROM cells_",
    "t2_routing": f"WITH {_ROUTED} SELECT * FROM routes",
    "t3_headers": f"WITH {_ROWS} SELECT DISTINCT slug, csv, array_to_string(list_transform(header, lambda h, i: CASE WHEN h = '' THEN 'col' || (i - 1) ELSE h END), '|') AS header FROM cells_",
    "t4_numbering": f"WITH {_ROUTED} SELECT slug, csv, printf('anexo_%02d.csv', row_number() OVER (PARTITION BY slug ORDER BY csv)) AS arquivo FROM routes WHERE to_csv",
    "t5_without_contents": f"""WITH {_ROWS}, toc AS (SELECT slug, csv, bool_or(regexp_extract(csv, '([0-9]+)', 1)::INT <= 2 AND (len(list_filter(cells, lambda c: regexp_matches(c, 'Item|Sum'))) > 0 OR len(list_filter(header, lambda c: regexp_matches(c, 'Item|Sum'))) > 0)) AS toc, count(*) AS n FROM cells_ GROUP BY 1, 2)
        SELECT slug, csv, n FROM toc WHERE NOT toc""",
    "t6_markdown": f"WITH {_ROWS} SELECT slug, csv, row_no, '| ' || array_to_string(list_concat(cells, list_transform(header, lambda h: ''))[1:len(header)], ' | ') || ' |' AS line FROM cells_",
    "t7_stitched": rf"""WITH {_ROWS}, tables AS (SELECT slug, csv, arg_min(header, row_no) AS header FROM cells_ GROUP BY 1, 2),
        marked AS (SELECT *, coalesce(header = lag(header) OVER w OR (len(header) = len(lag(header) OVER w) AND len(list_filter(header, lambda h: regexp_matches(h, '^[0-9]|[0-9]{{4}}|^col[0-9]+$|^$'))) > 0), false) AS goes_on FROM tables WINDOW w AS (PARTITION BY slug ORDER BY csv))
        SELECT slug, csv, sum((NOT goes_on)::INT) OVER (PARTITION BY slug ORDER BY csv) AS table_no FROM marked""",
    "t8_code_lookup": rf"WITH {_ROWS} SELECT DISTINCT unnest(regexp_extract_all(cell, '[0-9]{{4}}\.[0-9]{{2}}\.[0-9]{{2}}')) AS code, slug, csv, row_no FROM (SELECT slug, csv, row_no, unnest(cells) AS cell FROM cells_)",
    "m1_manifest": f"WITH {_MANIFEST} SELECT * FROM entries",
    "m4_manifest_head": f"WITH {_MANIFEST} SELECT '1.0' AS schema_version, 'Base de legislacao contabil/tributaria para consulta.' AS descricao, '2025-12-31' AS gerado_em, count(*) AS total_normas, sum(n_artigos_vigentes)::BIGINT AS vigentes, sum(n_anexos)::BIGINT AS anexos FROM entries",
    "c1_code_keys": f"SELECT DISTINCT identificador, {_KEY('identificador')} AS key FROM norm_meta",
    "c2_flip": f"WITH {_FLIP} SELECT target, codigo, outcome FROM flips",
    "c2_flipped": f"WITH {_FLIP} SELECT c.codigo, CASE WHEN f.codigo IS NOT NULL THEN true ELSE no_repo END AS no_repo FROM cat c LEFT JOIN (SELECT DISTINCT codigo FROM flips WHERE outcome = 'found') f ON f.codigo = c.codigo",
    "c3_status": f"WITH {_CATALOG} SELECT codigo, {_STATUS} AS status FROM cat",
    "c4_by_subject": f"WITH {_CATALOG} SELECT DISTINCT a AS assunto, codigo FROM (SELECT codigo, unnest(coalesce(assunto, ['outros'])) AS a FROM cat) WHERE a <> ''",
    "c5_first_subject": f"WITH {_FIRST} SELECT codigo, section FROM first_",
    "c6_leftovers": f"WITH {_FIRST} SELECT codigo FROM first_ WHERE section = 0",
    "c7_chronological": f"WITH {_CATALOG} SELECT coalesce(data, '0000') AS order_key, codigo, data FROM cat ORDER BY 1, 2",
    "c8_coverage": f"WITH {_CATALOG} SELECT count(*) AS total, count(*) FILTER (no_repo) AS indexed, count(*) FILTER (lower(situacao) = 'revogada') AS revoked, count(*) - count(*) FILTER (no_repo) - count(*) FILTER (lower(situacao) = 'revogada') AS pending FROM cat",
    "c9_by_family": f"WITH {_CATALOG} SELECT coalesce(nullif(list_position(['LC', 'Lei', 'Decreto'], familia), 0), 4)::INT AS section, familia, count(*) AS n FROM cat GROUP BY 2",
    "c10_pronouncements": f"WITH {_NORMS} SELECT identificador, titulo, revisao FROM norms WHERE identificador LIKE 'CPC%'",
    "c11_blocks": r"""WITH codes AS (SELECT DISTINCT regexp_extract(identificador, '^([^0-9]+[0-9]+)', 1) AS codigo FROM norm_meta), n AS (SELECT codigo, try_cast(regexp_extract(codigo, ' ([0-9]+)$', 1) AS BIGINT) AS k FROM codes)
        SELECT codigo, low, high FROM n JOIN (VALUES (19000, 20019), (20020, 20049), (20050, 99999)) b(low, high) ON k BETWEEN low AND high""",
    "c12_exceptions": f"""WITH {_CATALOG} SELECT codigo, CASE WHEN codigo = 'LC 19999/2023' THEN 'apart' ELSE familia END AS "group" FROM cat""",
    "c9_accounting_catalog": r"""WITH n AS (SELECT DISTINCT ON (identificador) *, numero::BIGINT AS k FROM norm_meta WHERE tipo = 'CPC' AND numero IS NOT NULL ORDER BY identificador),
        e AS (SELECT *, CASE WHEN k % 4 = 0 THEN 'NBC TA' WHEN k % 5 = 0 THEN 'ITG' ELSE 'NBC TG' END AS f, CASE WHEN k % 7 = 0 THEN CASE WHEN k % 14 = 0 THEN '[REV] (rev. NBC TG 1)' ELSE '[REV]' END WHEN k % 2 = 0 THEN '[OK]' ELSE '[  ]' END AS mark FROM n),
        c AS (SELECT *, f || ' ' || CASE WHEN f = 'NBC TA' THEN 200 + k % 700 ELSE k END AS codigo, CASE f WHEN 'NBC TG' THEN 1 WHEN 'ITG' THEN 3 ELSE 8 END AS section, 200 + k % 700 AS a FROM e),
        p AS (SELECT *, CASE section WHEN 1 THEN 1 WHEN 3 THEN 3 ELSE CASE WHEN a < 300 THEN 1 WHEN a < 500 THEN 2 WHEN a < 600 THEN 3 WHEN a < 700 THEN 4 WHEN a < 800 THEN 5 ELSE 6 END END AS part FROM c)
        SELECT section, part, codigo AS place, '| ' || codigo || CASE WHEN section = 1 THEN ' | ' || identificador ELSE '' END || ' | ' || coalesce(titulo, '') || ' | ' || mark || ' |' AS line FROM p""",
    "r2_annex_index": rf"""WITH {_ROWS}, tables AS (SELECT slug, csv, count(*) AS n, arg_min(header, row_no) AS h FROM cells_ GROUP BY 1, 2)
        SELECT slug, csv, '- **Anexo ' || regexp_extract(csv, '([^_]*)\.csv$', 1) || '** (' || n || ' linhas) → `anexos/' || csv || '`  ' || chr(10) || '  Colunas: ' || CASE WHEN len(h) > 0 THEN array_to_string(h[1:6], ', ') ELSE '—' END AS line FROM tables""",
    "r7_table_lines": f"WITH {_CATALOG} SELECT codigo, '| ' || concat_ws(' | ', codigo, coalesce(titulo, ''), coalesce(data, ''), CASE WHEN pasta_repo IS NULL THEN '—' ELSE '[`' || pasta_repo || '`](../' || pasta_repo || '/)' END, {_STATUS}) || ' |' AS line FROM cat",
    "x1_norm_units": f"WITH {_MANIFEST}, {_LATEST} SELECT split_part(id, '--', 1) AS slug, id, path FROM latest WHERE split_part(id, '--', 1) IN (SELECT slug FROM entries WHERE identificador LIKE 'Lei %')",
    "x2_current": "SELECT DISTINCT id, norma FROM chunk WHERE vigente",
    "x3_citation": "SELECT DISTINCT id, path, texto FROM chunk WHERE id IN ('lc-19999-2023--art-8', 'lc-19999-2023--art-8--anterior-001')",
    "x4_wordings": r"""WITH keyed AS (SELECT DISTINCT split_part(id, '--', 1) AS slug, lower(regexp_replace(artigo, '[\s\x{00a0}º]+', '', 'g')) AS artigo, id, vigente FROM chunk WHERE artigo IS NOT NULL)
        SELECT slug, artigo, id, vigente, row_number() OVER (PARTITION BY slug, artigo ORDER BY vigente ASC NULLS FIRST, id) AS n FROM keyed QUALIFY count(*) OVER (PARTITION BY slug, artigo) > 1""",
    "x5_follow_refs": f"WITH {_FOLLOW} SELECT id, ref, target, path FROM followed",
    "x6_correspondence": f"WITH {_CATALOG}, {_NORMS} SELECT c.codigo, c.titulo, {_STATUS} AS status, n.correlacao_ifrs FROM cat c LEFT JOIN norms n ON n.identificador = c.codigo",
    "x7_chains": f"""WITH RECURSIVE {_FOLLOW}, edges AS (SELECT DISTINCT id AS src, target AS dst FROM followed WHERE path IS NOT NULL AND id <> target),
        reach(start, target, depth) USING KEY (start, target) AS (SELECT src, dst, 1 FROM edges
          UNION SELECT DISTINCT r.start, e.dst, r.depth + 1 FROM reach r JOIN edges e ON e.src = r.target LEFT JOIN recurring.reach k ON k.start = r.start AND k.target = e.dst WHERE k.start IS NULL AND e.dst <> r.start)
        SELECT start, count(*) AS reached, max(depth) AS deepest FROM reach GROUP BY 1""",
    "x8_prefixes": rf"WITH {_ROWS}, codes AS (SELECT DISTINCT unnest(regexp_extract_all(cell, '[0-9]{{4}}\.[0-9]{{2}}\.[0-9]{{2}}')) AS code FROM (SELECT unnest(cells) AS cell FROM cells_)) SELECT code, p_partkey, p_name FROM codes LEFT JOIN part ON left(code, 4) = lpad(p_partkey::VARCHAR, 4, '0') AND length(p_partkey::VARCHAR) <= 4",
    "x9_articles": rf"WITH {_LATEST}, said AS (SELECT DISTINCT id, unnest(regexp_extract_all(texto, 'art\. ([0-9]+) desta norma', 1)) AS n FROM latest) SELECT s.id, l.id AS target, l.path FROM said s JOIN latest l ON l.id = split_part(s.id, '--', 1) || '--art-' || s.n WHERE l.texto IS NOT NULL",
    "x10_valid_on": """WITH gone AS (SELECT id, max(removed_at) AS out_at FROM chunk_removal WHERE id IS NOT NULL GROUP BY 1), back AS (SELECT c.id, min(loaded_at) AS in_at FROM chunk c JOIN gone g ON g.id = c.id AND c.loaded_at > g.out_at GROUP BY 1)
        SELECT g.id FROM gone g LEFT JOIN back b ON b.id = g.id WHERE out_at <= '2024-01-01' AND (in_at IS NULL OR in_at > '2024-01-01')""",
    "x12_search": f"WITH low AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents), scored AS (SELECT doc_id, {_HELD} AS held, ({_OFTEN})::BIGINT AS often FROM low) SELECT * FROM scored WHERE held > 0 ORDER BY held DESC, often DESC, doc_id LIMIT 20",
    "x20_subjects": f"WITH {_CATALOG} SELECT codigo FROM cat WHERE list_has_any(assunto, ['irpf', 'agrario'])",
    "v2_repeated_ids": "SELECT id, count(*) AS n FROM chunk WHERE id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "v4_broken_json": "SELECT rec_id, feed, file_no FROM raw_record WHERE body IS NULL OR NOT json_valid(body)",
    "v6_missing_annexes": "SELECT DISTINCT split_part(id, '--', 1) AS slug, x AS csv FROM (SELECT id, unnest(anexos) AS x FROM chunk) WHERE x <> '' AND (split_part(id, '--', 1), x) NOT IN (SELECT slug, csv FROM annex_cell)",
    "v7_mojibake": rf"SELECT doc_id, length({_STRIP('text')}) < 40 AS short FROM documents WHERE regexp_matches(text, '[ÃÂ][\x{{80}}-\x{{bf}}]')",
}

_UNITS = f"{_LATEST}, counted AS (SELECT split_part(id, '--', 1) AS slug, count(*) AS units, count(*) FILTER (vigente) AS current FROM latest GROUP BY 1)"
ORACLE |= {
    "x11_snapshot_diff": """
        WITH a AS (SELECT id, max(coalesce(lower(trim(artigo, ' ')), '')) AS v, count(DISTINCT coalesce(lower(trim(artigo, ' ')), '')) AS n FROM chunk_snapshot WHERE snapshot_date = '2025-05-01' GROUP BY 1),
        b AS (SELECT id, max(coalesce(lower(trim(artigo, ' ')), '')) AS v FROM chunk_snapshot WHERE snapshot_date = '2025-06-01' GROUP BY 1)
        SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'added' WHEN b.id IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM a FULL JOIN b ON a.id = b.id WHERE a.v IS DISTINCT FROM b.v""",
    "v1_counts": f"""WITH {_NORMS}, {_UNITS} SELECT c.slug, c.units, coalesce(n_artigos, n_itens)::BIGINT AS said, c.current, coalesce(n_artigos_vigentes, n_itens_vigentes)::BIGINT AS said_current
        FROM counted c JOIN norms n ON n.slug = c.slug WHERE c.units <> coalesce(n_artigos, n_itens) OR c.current <> coalesce(n_artigos_vigentes, n_itens_vigentes)""",
    "v7_sanity": f"""WITH {_NORMS} SELECT identificador, 'no number' AS problem FROM norms WHERE numero IS NULL UNION ALL SELECT identificador, 'no year' FROM norms WHERE ano IS NULL
        UNION ALL SELECT identificador, 'few units' FROM norms WHERE coalesce(n_artigos, n_itens) < 1""",
}
ORACLE["x21_state_at"] = _P1 + "SELECT vigente, count(*) AS n FROM history WHERE valid_from <= '2025-09-01' AND valid_to > '2025-09-01' GROUP BY 1"
ORACLE["x19_router"] = r"""WITH t AS (SELECT DISTINCT a AS skill, regexp_replace(split_part(a, '-', 1), 'io$', '') AS trigger, length(a) AS priority FROM (SELECT unnest(assunto) AS a FROM tax_catalog) WHERE a <> ''),
    s AS (SELECT doc_id, skill, priority, contains(lower(coalesce(text, '')), lower(trigger))::BIGINT AS hits FROM documents, t),
    b AS (SELECT doc_id, max(struct_pack(h := hits, o := -priority, s := skill)) AS b FROM s GROUP BY 1)
    SELECT doc_id, b.s AS skill, b.h AS hits FROM b WHERE b.h > 0"""
