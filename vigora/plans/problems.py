"""Queries of the general data problems, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigora.operators import drift, history, orphans, packed
from vigora.sources.tables import cut_lineage, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return history.unit_history(table(spark, d, "chunk_snapshot")).select("id", "valid_from", "valid_to")


def p1_versions(spark: SparkSession, d: str) -> DataFrame:
    full = history.unit_history(table(spark, d, "chunk_snapshot"))
    return full.select("id", "valid_from", "valid_to", "artigo", "vigente", F.array_join("notas", "|").alias("notas"))


def p1_log(spark: SparkSession, d: str) -> DataFrame:
    log = history.unit_log(table(spark, d, "chunk_snapshot"))
    return log.select("id", F.date_format("at", "yyyy-MM-dd").alias("at"), "kind", F.array_join("changed", ",").alias("changed"))


def p1_as_of(spark: SparkSession, d: str) -> DataFrame:
    state = history.as_of(history.unit_log(table(spark, d, "chunk_snapshot")), "id", history.ATTRS, "2025-06-15")
    return state.select("id", "valid_from", "artigo", "vigente")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(table(spark, d, "raw_record"))


def p2_table(spark: SparkSession, d: str) -> DataFrame:
    recs = drift.records(table(spark, d, "raw_record"))
    return drift.cells(recs, cut_lineage(drift.lineage(recs)))


def p2_schema(spark: SparkSession, d: str) -> DataFrame:
    return drift.union_schema(drift.lineage(drift.records(table(spark, d, "raw_record")))).select("feed", "name", "kind")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return packed.split_codes(table(spark, d, "annex_cell")).select("slug", "csv", "row_no", "pos", "code")


def p5_codes(spark: SparkSession, d: str) -> DataFrame:
    """Every code of the wanted columns, of cells with one code too, with the flags of its cell."""
    return packed.split_codes(table(spark, d, "annex_cell"), at_least=1)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphans(table(spark, d, "chunk"), table(spark, d, "chunk_removal"), table(spark, d, "annex_cell"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return p6_found(spark, d).groupBy("ref_table", "period", "kind").agg(F.count("*").alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_versions, p1_log, p1_as_of, p2_found, p2_table, p2_schema, p5_found, p5_codes, p6_found, p6_report)
}

_P1 = r"""
WITH placed AS (
  SELECT *, coalesce(lower(regexp_replace(norma, '[\s\x{00a0}.]+', '', 'g')), split_part(id, '--', 1)) AS scope,
    lower(regexp_replace(artigo, '[\s\x{00a0}º]+', '', 'g')) AS art,
    list_sort(list_distinct(list_filter(list_transform(coalesce(notas_vigencia, []),
      lambda x: trim(regexp_replace(x, '[\s\x{00a0}]+', ' ', 'g'))), lambda x: x IS NOT NULL AND x <> ''))) AS notas
  FROM chunk_snapshot WHERE id IS NOT NULL AND snapshot_date IS NOT NULL),
newest AS (
  SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY id, snapshot_date ORDER BY loaded_at DESC NULLS LAST) = 1),
calendar AS (
  SELECT scope, snapshot_date, lead(snapshot_date) OVER (PARTITION BY scope ORDER BY snapshot_date) AS next_at
  FROM (SELECT DISTINCT scope, snapshot_date FROM placed)),
filled AS (
  SELECT n.id, n.snapshot_date AS "at", c.next_at, n.notas,
    lead(n.snapshot_date) OVER w AS lead_at, lag(c.next_at) OVER w AS due,
    last_value(n.art IGNORE NULLS) OVER w AS artigo, last_value(n.vigente IGNORE NULLS) OVER w AS vigente
  FROM newest n JOIN calendar c ON n.scope = c.scope AND n.snapshot_date = c.snapshot_date
  WINDOW w AS (PARTITION BY n.id ORDER BY n.snapshot_date)),
marked AS (
  SELECT *, (due IS DISTINCT FROM "at")
      OR (lag(artigo) OVER w IS DISTINCT FROM artigo) OR (lag(vigente) OVER w IS DISTINCT FROM vigente)
      OR (lag(notas) OVER w IS DISTINCT FROM notas) AS fresh
  FROM filled WINDOW w AS (PARTITION BY id ORDER BY "at")),
grouped AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY id ORDER BY "at") AS v FROM marked),
versions AS (
  SELECT id, strftime(min("at"), '%Y-%m-%d') AS valid_from,
    coalesce(strftime(max(struct_pack(a := "at", n := next_at)).n, '%Y-%m-%d'), '9999-12-31') AS last_due,
    any_value(artigo) AS artigo, any_value(vigente) AS vigente, array_to_string(any_value(notas), '|') AS notas
  FROM grouped GROUP BY id, v),
history AS (SELECT id, valid_from, last_due AS valid_to, artigo, vigente, notas FROM versions)
"""

_P6 = r"""
WITH units AS (SELECT lower(id) AS target, min(loaded_at) AS first_at, max(loaded_at) AS last_at FROM chunk WHERE id IS NOT NULL GROUP BY 1),
gone AS (SELECT lower(id) AS target, max(removed_at) AS removed_at FROM chunk_removal GROUP BY 1),
state AS (SELECT u.*, coalesce(g.removed_at > u.last_at, false) AS deleted FROM units u LEFT JOIN gone g USING (target)),
said AS (
  SELECT DISTINCT id, 'chunk' AS ref_table, split_part(lower(id), '--', 1) || '--' || lower(regexp_replace(r, '[\s\x{00a0}º]+', '', 'g')) AS target
  FROM (SELECT id, unnest(refs) AS r FROM chunk) WHERE regexp_replace(r, '[\s\x{00a0}º]+', '', 'g') <> ''
  UNION ALL
  SELECT DISTINCT id, 'annex_cell', split_part(lower(id), '--', 1) || '/' || regexp_replace(r, '^[\s\x{00a0}]+|[\s\x{00a0}]+$', '', 'g')
  FROM (SELECT id, unnest(anexos) AS r FROM chunk) WHERE regexp_replace(r, '[\s\x{00a0}]+', '', 'g') <> ''),
found AS (
  SELECT s.ref_table, s.id, s.target, strftime(o.first_at, '%Y-%m') AS period,
    CASE WHEN s.ref_table = 'annex_cell' THEN CASE WHEN a.target IS NULL THEN 'missing' END
      WHEN t.target IS NULL THEN 'missing' WHEN t.deleted THEN 'deleted' WHEN t.first_at > o.first_at THEN 'late' END AS kind
  FROM said s JOIN state o ON o.target = lower(s.id) AND NOT o.deleted
  LEFT JOIN state t ON t.target = s.target AND s.ref_table = 'chunk'
  LEFT JOIN (SELECT DISTINCT slug || '/' || csv AS target FROM annex_cell) a ON a.target = s.target AND s.ref_table = 'annex_cell')
"""

ORACLE: dict[str, str] = {
    "p1_found": _P1 + "SELECT id, valid_from, valid_to FROM history",
    "p1_versions": _P1 + "SELECT id, valid_from, valid_to, artigo, vigente, notas FROM history",
    "p1_as_of": _P1 + "SELECT id, valid_from, artigo, vigente FROM history WHERE valid_from <= '2025-06-15' AND valid_to > '2025-06-15'",
    "p6_found": _P6 + "SELECT ref_table, id, target, kind, period FROM found WHERE kind IS NOT NULL",
    "p6_report": _P6 + "SELECT ref_table, period, kind, count(*) AS n FROM found WHERE kind IS NOT NULL GROUP BY 1, 2, 3",
}

_P2 = """
WITH valid AS (SELECT * FROM raw_record WHERE feed IS NOT NULL AND file_no IS NOT NULL AND json_valid(body) AND json_type(body) = 'OBJECT'),
flat AS (
  SELECT v.feed, v.file_no, v.delivered_at, v.line_no, v.rec_id, coalesce(v.body ->> '$.ITEM', v.body ->> '$.id') AS rec_key, e.key AS field,
    CASE e.type WHEN 'NULL' THEN NULL WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'object' ELSE 'number' END AS kind,
    json_extract_string(e.value, '$') AS value
  FROM valid v, json_each(v.body) e),
header AS (SELECT feed, file_no, field, mode(kind) AS kind FROM flat GROUP BY 1, 2, 3),
files AS (SELECT feed, file_no, lag(file_no) OVER w AS prev_no, lead(file_no) OVER w AS next_no
  FROM (SELECT DISTINCT feed, file_no FROM header) WINDOW w AS (PARTITION BY feed ORDER BY file_no)),
seen AS (SELECT h.*, f.prev_no, f.next_no, lag(h.file_no) OVER w AS before_no, lead(h.file_no) OVER w AS after_no
  FROM header h JOIN files f ON f.feed = h.feed AND f.file_no = h.file_no WINDOW w AS (PARTITION BY h.feed, h.field ORDER BY h.file_no)),
come AS (SELECT feed, file_no, prev_no, field FROM seen WHERE prev_no IS NOT NULL AND before_no IS DISTINCT FROM prev_no),
go AS (SELECT feed, next_no AS file_no, field AS old FROM seen WHERE next_no IS NOT NULL AND after_no IS DISTINCT FROM next_no),
last_ AS (SELECT * FROM flat WHERE rec_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY feed, file_no, field, rec_key ORDER BY delivered_at DESC, line_no DESC, rec_id DESC) = 1),
present AS (SELECT DISTINCT feed, file_no, rec_key FROM last_),
equal AS (
  SELECT c.feed, c.file_no, g.old, c.field, avg((o.kind IS NOT DISTINCT FROM n.kind AND o.value IS NOT DISTINCT FROM n.value)::INT) AS share
  FROM come c JOIN go g ON g.feed = c.feed AND g.file_no = c.file_no
  JOIN last_ o ON o.feed = c.feed AND o.file_no = c.prev_no AND o.field = g.old AND o.kind IS NOT NULL
  JOIN present p ON p.feed = c.feed AND p.file_no = c.file_no AND p.rec_key = o.rec_key
  LEFT JOIN last_ n ON n.feed = c.feed AND n.file_no = c.file_no AND n.field = c.field AND n.rec_key = o.rec_key
  GROUP BY 1, 2, 3, 4 HAVING avg((o.kind IS NOT DISTINCT FROM n.kind AND o.value IS NOT DISTINCT FROM n.value)::INT) >= 0.8),
renamed AS (SELECT * FROM equal
  QUALIFY row_number() OVER (PARTITION BY feed, file_no, old ORDER BY share DESC, field) = 1 AND row_number() OVER (PARTITION BY feed, file_no, field ORDER BY share DESC, old) = 1),
typed AS (SELECT feed, file_no, field, kind, lag(kind) OVER (PARTITION BY feed, field ORDER BY file_no) AS was FROM header WHERE kind IS NOT NULL)
SELECT feed, file_no, 'renamed' AS change, field FROM renamed
UNION ALL SELECT feed, file_no, 'added', field FROM come c WHERE NOT EXISTS (FROM renamed r WHERE r.feed = c.feed AND r.file_no = c.file_no AND r.field = c.field)
UNION ALL SELECT feed, file_no, 'removed', old FROM go g WHERE NOT EXISTS (FROM renamed r WHERE r.feed = g.feed AND r.file_no = g.file_no AND r.old = g.old)
UNION ALL SELECT feed, file_no, 'retyped', field FROM typed WHERE was <> kind
"""

_P5 = r"""
WITH heads AS (SELECT DISTINCT slug, csv, row_no, cells, unnest(header) AS head, generate_subscripts(header, 1) AS col FROM annex_cell),
wanted AS (SELECT DISTINCT slug, csv, row_no, col, cells[col] AS cell FROM heads WHERE regexp_matches(upper(head), 'NCM|NBS') AND cells[col] IS NOT NULL),
bare AS (SELECT *, regexp_extract_all(regexp_replace(cell, '\([^)]*\)|(?i:at[ée])\s*[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}', ' ', 'g'),
  '(?i)[0-9]+(?:\.[0-9]+)*(?:["”''’]?[\s\x{00a0},]*[-–]?[\s\x{00a0}]*ex\.?[\s\x{00a0}]*-?[\s\x{00a0}]*[0-9]{1,2})?') AS found FROM wanted),
codes AS (SELECT slug, csv, row_no, col, list_filter(found, lambda m: length(replace(regexp_extract(m, '^[0-9.]+'), '.', '')) >= 4) AS found FROM bare),
each AS (SELECT slug, csv, row_no, unnest(found) AS m, generate_subscripts(found, 1)::INT AS pos FROM codes WHERE len(found) >= 2)
SELECT slug, csv, row_no, pos, regexp_extract(m, '^[0-9.]+') || CASE WHEN regexp_matches(m, '(?i)ex') THEN printf(' Ex %02d', regexp_extract(m, '([0-9]+)$', 1)::INT) ELSE '' END AS code FROM each
"""

ORACLE |= {"p2_found": _P2, "p5_found": _P5}

_LOG = _P1.split("marked AS (")[0] + """ev AS (
  SELECT *, due IS DISTINCT FROM "at" AS fresh, lag(artigo) OVER w IS DISTINCT FROM artigo AS ca, lag(vigente) OVER w IS DISTINCT FROM vigente AS cv, lag(notas) OVER w IS DISTINCT FROM notas AS cn
  FROM filled WINDOW w AS (PARTITION BY id ORDER BY "at")),
lives AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY id ORDER BY "at") AS life, ca OR cv OR cn AS differs FROM ev),
nth AS (SELECT *, sum((NOT fresh AND differs)::INT) OVER (PARTITION BY id, life ORDER BY "at") AS n FROM lives),
entries AS (SELECT *, fresh OR n % 4 = 0 AS whole FROM nth WHERE fresh OR differs)
SELECT id, strftime("at", '%Y-%m-%d') AS "at", CASE WHEN whole THEN 'full' ELSE 'patch' END AS kind,
  CASE WHEN whole THEN 'artigo,vigente,notas' ELSE concat_ws(',', CASE WHEN ca THEN 'artigo' END, CASE WHEN cv THEN 'vigente' END, CASE WHEN cn THEN 'notas' END) END AS changed FROM entries
UNION ALL SELECT id, strftime(next_at, '%Y-%m-%d'), 'end', '' FROM filled WHERE next_at IS NOT NULL AND lead_at IS DISTINCT FROM next_at
"""
_SCALAR = lambda kind, text: f"""CASE {kind} WHEN 'NULL' THEN NULL WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object' WHEN 'DOUBLE' THEN 'decimal' WHEN 'ARRAY' THEN 'string' WHEN 'VARCHAR' THEN
  CASE WHEN regexp_matches({text}, '^[0-9]{{4}}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$') THEN 'date'
    WHEN regexp_matches({text}, '^[0-9]{{4}}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])[T ]([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\\.[0-9]{{1,6}})?)?$') THEN 'timestamp' ELSE 'string' END ELSE 'integer' END"""  # noqa: E731
_BOUND = lambda c: f"""CASE WHEN len({c}) = 0 THEN 'string' WHEN len({c}) = 1 THEN {c}[1] WHEN len(list_filter({c}, lambda x: x NOT IN ('integer', 'decimal', 'double'))) = 0 THEN CASE WHEN list_contains({c}, 'double') THEN 'double' ELSE 'decimal' END
  WHEN len(list_filter({c}, lambda x: x NOT IN ('date', 'timestamp'))) = 0 THEN 'timestamp' ELSE 'string' END"""  # noqa: E731
_TYPES = "list_distinct(list_filter(list_transform(json_extract(v, '$[*]'), lambda x: " + _SCALAR("json_type(x)", "json_extract_string(x, '$')") + "), lambda x: x IS NOT NULL))"
_LINEAGE = _P2.split("typed AS (")[0].replace("WITH valid", "WITH RECURSIVE valid") + f"""
each_ AS (SELECT v.rec_id, v.feed, v.file_no, v.line_no, coalesce(v.body ->> '$.ITEM', v.body ->> '$.id') AS rec_key, e.key AS field, e.type AS jt, e.value AS v FROM valid v, json_each(v.body) e),
lattice AS (SELECT *, CASE WHEN jt = 'ARRAY' THEN 'list<' || {_BOUND(_TYPES)} || '>' ELSE {_SCALAR('jt', "json_extract_string(v, '$')")} END AS type FROM each_),
types AS (SELECT feed, file_no, field, list_distinct(list(type) FILTER (type IS NOT NULL)) AS types FROM lattice GROUP BY 1, 2, 3),
known AS (SELECT h.feed, h.file_no, h.field, r.old, f.prev_no, lag(h.file_no) OVER (PARTITION BY h.feed, h.field ORDER BY h.file_no) AS last_no FROM header h JOIN files f ON f.feed = h.feed AND f.file_no = h.file_no
  LEFT JOIN renamed r ON r.feed = h.feed AND r.file_no = h.file_no AND r.field = h.field),
away AS (SELECT r.feed, f.prev_no AS last_no, r.old AS field FROM renamed r JOIN files f ON f.feed = r.feed AND f.file_no = r.file_no),
before AS (SELECT k.feed, k.file_no, k.field, CASE WHEN k.old IS NOT NULL THEN k.prev_no WHEN a.field IS NULL THEN k.last_no END AS pred_no, coalesce(k.old, k.field) AS pred_field
  FROM known k LEFT JOIN away a ON a.feed = k.feed AND a.last_no = k.last_no AND a.field = k.field),
line AS (SELECT feed, file_no, field, file_no || ':' || field AS lineage FROM before WHERE pred_no IS NULL
  UNION ALL SELECT b.feed, b.file_no, b.field, l.lineage FROM before b JOIN line l ON l.feed = b.feed AND l.file_no = b.pred_no AND l.field = b.pred_field),
bounds AS (SELECT l.feed, l.lineage, max(struct_pack(n := l.file_no, f := l.field)) AS last_, list_distinct(flatten(list(coalesce(t.types, [])))) AS ts FROM line l JOIN types t ON t.feed = l.feed AND t.file_no = l.file_no AND t.field = l.field GROUP BY 1, 2),
schema_ AS (SELECT feed, lineage, CASE WHEN row_number() OVER (PARTITION BY feed, last_.f ORDER BY last_.n DESC, lineage) = 1 THEN last_.f ELSE last_.f || '@' || lineage END AS name,
  CASE WHEN len(ts) > 0 AND len(list_filter(ts, lambda x: x NOT LIKE 'list<%')) = 0 THEN 'list<' || {_BOUND("list_distinct(list_transform(ts, lambda x: regexp_extract(x, '^list<(.*)>$', 1)))")} || '>' ELSE {_BOUND('ts')} END AS kind FROM bounds)
"""
ORACLE |= {
    "p1_log": _LOG,
    "p2_schema": _LINEAGE + "SELECT feed, name, kind FROM schema_",
    "p2_table": _LINEAGE + """SELECT e.rec_id, e.feed, e.file_no, e.line_no, e.rec_key, s.name, s.kind, CASE WHEN jt = 'NULL' THEN NULL WHEN (s.kind = 'string' AND jt = 'VARCHAR') OR s.kind IN ('date', 'timestamp') THEN json_extract_string(v, '$')
          WHEN jt = 'DOUBLE' THEN regexp_replace(regexp_replace(json(v)::VARCHAR, '(\\.[0-9]*[1-9])0+$', '\\1'), '\\.0+$', '')
          WHEN jt = 'OBJECT' THEN '{' || array_to_string(list_transform(list_sort(json_keys(v)), lambda k: to_json(k)::VARCHAR || ':' || json(json_extract(v, '$."' || k || '"'))::VARCHAR), ',') || '}' ELSE json(v)::VARCHAR END AS value
        FROM each_ e JOIN line l ON l.feed = e.feed AND l.file_no = e.file_no AND l.field = e.field JOIN schema_ s ON s.feed = l.feed AND s.lineage = l.lineage""",
}
