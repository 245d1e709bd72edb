"""Manifest of norms and catalogs of entries: lookups, updates, grouping by an ordered list of subjects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigora.operators import dialect as D
from vigora.operators.lines import strip
from vigora.operators.metadata import slug

# Subjects in their order of print, and the ranges of audit codes.
SUBJECTS = ("reforma-tributaria", "tributario-federal", "irpf", "previdenciario", "agrario", "trabalhista", "societario", "administrativo")
AUDIT_BLOCKS = ((200, 299), (300, 499), (500, 599), (600, 699), (700, 799), (800, 899))


def distinct_norms(metas: DataFrame) -> DataFrame:
    """One row per ``identificador``; of repeated rows with other content the greatest."""
    cols = [c for c in metas.columns if c != "identificador"]
    held = metas.where(F.col("identificador").isNotNull()).groupBy("identificador").agg(F.max(F.struct(*cols)).alias("m"))
    return held.select("identificador", "m.*")


def manifest_entries(metas: DataFrame, annexes: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row per norm, in order of slug, with its counts and the paths of the files it has.

    A norm with units has a text and a file of units, one with annexes a folder of them; what a norm lacks is null.
    """
    norms = distinct_norms(metas).withColumn("slug", slug(F.col("identificador")))
    csvs = annexes.where("csv IS NOT NULL").groupBy("slug").agg(F.count_distinct("csv").alias("n"))
    units = chunks.where("id IS NOT NULL").select(F.substring_index("id", "--", 1).alias("slug")).distinct().withColumn("has", F.lit(True))
    both = norms.join(csvs, "slug", "left").join(units, "slug", "left")
    path = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    s = F.col("slug")
    return both.select(
        "identificador", "slug", "tipo", "numero", "ano", "ementa", "fonte_versao", "atualizado_em",
        F.coalesce("n_artigos_vigentes", "n_artigos").cast("bigint").alias("n_artigos_vigentes"),
        F.coalesce("n_redacoes_anteriores", F.lit(0)).cast("bigint").alias("n_redacoes_anteriores"),
        F.coalesce("n", F.lit(0)).alias("n_anexos"), "sha256_16",
        F.when(F.col("has"), path(s, "/", s, ".md")).alias("markdown"), F.when(F.col("has"), path(s, "/", s, ".chunks.jsonl")).alias("chunks"),
        path(s, "/", s, ".meta.json").alias("meta"), F.when(F.col("n") > 0, path(s, "/anexos/")).alias("anexos_dir"),
    ).orderBy("slug")


#: What a manifest says of itself, if nothing else is given.
DESCRIPTION = "Base de legislacao contabil/tributaria para consulta."


def manifest_head(entries: DataFrame, made_on: str, description: str = DESCRIPTION) -> DataFrame:
    """One row ``(schema_version, descricao, gerado_em, total_normas, vigentes, anexos)``; the entries stay rows, whatever their number."""
    return entries.agg(
        F.lit("1.0").alias("schema_version"), F.lit(description).alias("descricao"), F.lit(made_on).alias("gerado_em"), F.count("*").alias("total_normas"),
        F.sum("n_artigos_vigentes").alias("vigentes"), F.sum("n_anexos").alias("anexos"),
    )


def manifest_records(entries: DataFrame) -> DataFrame:
    """Entries in the shape in which a manifest lists them: the paths nested under ``arquivos``."""
    paths = ("markdown", "chunks", "meta", "anexos_dir")
    return entries.select(*[c for c in entries.columns if c not in paths], F.struct(*paths).alias("arquivos"))


def code_key(code: Column) -> Column:
    """Upper case without revision mark, inner white space as one blank."""
    bare = F.regexp_replace(F.upper(strip(code)), rf"{D.S}*\(R\d+\){D.S}*", "")
    return F.regexp_replace(bare, rf"{D.S}+", " ")


def distinct_entries(entries: DataFrame, key: str = "codigo") -> DataFrame:
    """One row per key; of repeated rows with other content the greatest. Rows of a null key are left out."""
    cols = [c for c in entries.columns if c != key]
    return entries.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*cols)).alias("e")).select(key, "e.*")


def flip(entries: DataFrame, targets: Sequence[str], other: str | None = None, order: str = "codigo") -> DataFrame:
    """``(target, codigo, outcome)``: entries in order of ``order`` take the first target left that names their code, or ``other`` code.

    An entry takes one target, a target one entry. Outcomes: ``found`` (to be marked), ``already`` or ``missing``. Targets are
    given by the caller; of each key as many entries as there are targets are looked at, no others can be taken.
    """
    spark = entries.sparkSession
    asked = list(dict.fromkeys(targets))
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "i int, target string").withColumn("key", code_key(F.col("target")))
    names = F.array_distinct(F.array_compact(F.array(code_key(F.col("codigo")), *([code_key(F.col(other))] if other else []))))
    keyed = entries.select("codigo", F.col(order).alias("_order"), F.coalesce("no_repo", F.lit(False)).alias("no_repo"), F.explode(names).alias("key"))
    met = keyed.join(F.broadcast(wanted.select("key").distinct()), "key", "left_semi")
    first = W.partitionBy("key").orderBy("_order", "codigo")
    near = met.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= len(asked)).join(wanted, "key")
    rows = near.select("_order", "codigo", "no_repo", "i").distinct().orderBy("_order", "codigo", "i").collect()
    taken: dict[int, tuple[str, bool]] = {}
    used: set[str] = set()
    for r in rows:
        if r["codigo"] not in used and r["i"] not in taken:
            taken[r["i"]] = (r["codigo"], r["no_repo"])
            used.add(r["codigo"])
    told = [(t, taken[i][0], "already" if taken[i][1] else "found") if i in taken else (t, None, "missing") for i, t in enumerate(asked)]
    return spark.createDataFrame(told, "target string, codigo string, outcome string")


def flip_report(flips: DataFrame) -> DataFrame:
    """One row ``(found, already, missing)``: how many targets were marked, held before, and not found."""
    return flips.agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in ("found", "already", "missing")])


def apply_flip(entries: DataFrame, flips: DataFrame) -> DataFrame:
    hit = flips.where("outcome = 'found'").select("codigo", F.lit(True).alias("_hit")).distinct()
    return entries.join(hit, "codigo", "left").withColumn("no_repo", F.coalesce("_hit", "no_repo")).drop("_hit")


def status(situacao: Column, no_repo: Column, revoked_by: Column | None = None) -> Column:
    rev = F.lit("[REV]") if revoked_by is None else F.when(revoked_by.isNotNull(), F.concat(F.lit("[REV] (rev. "), revoked_by, F.lit(")"))).otherwise("[REV]")
    return F.when(F.lower(situacao) == "revogada", rev).when(no_repo, "[OK]").otherwise("[  ]")


def by_subject(entries: DataFrame) -> DataFrame:
    """``(assunto, codigo)``: one row per subject; a null array stands under ``outros``, an empty one nowhere."""
    held = F.coalesce("assunto", F.array(F.lit("outros")))
    return entries.select("codigo", F.explode(held).alias("assunto")).where("assunto IS NOT NULL AND assunto <> ''").select("assunto", "codigo").distinct()


def first_subject(entries: DataFrame, subjects: Sequence[str] = SUBJECTS) -> DataFrame:
    """``(codigo, section)``: each code under the earliest of its listed subjects, else under 0 (others)."""
    rank = F.array_position(F.array(*[F.lit(s) for s in subjects]), F.col("assunto"))
    each = entries.select("codigo", F.explode_outer("assunto").alias("assunto"))
    listed = each.groupBy("codigo").agg(F.min(F.when(rank > 0, rank)).alias("section"))
    return listed.select("codigo", F.coalesce("section", F.lit(0)).alias("section"))


def chronological(entries: DataFrame) -> DataFrame:
    """``(order_key, codigo, data)`` sorted by date as text, a missing one first, then by code (a range exchange)."""
    key = F.coalesce("data", F.lit("0000"))
    return entries.select(key.alias("order_key"), "codigo", "data").orderBy("order_key", "codigo")


def coverage(entries: DataFrame) -> DataFrame:
    return entries.agg(
        F.count("*").alias("total"),
        F.count_if(F.coalesce("no_repo", F.lit(False))).alias("indexed"),
        F.count_if(F.coalesce(F.lower("situacao") == "revogada", F.lit(False))).alias("revoked"),
    ).withColumn("pending", F.col("total") - F.col("indexed") - F.col("revoked"))


def by_family(entries: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """``(section, familia, n)``: the place of each family in the given order, unlisted ones behind all of them."""
    listed = F.array_position(F.array(*[F.lit(x) for x in order]).cast("array<string>"), F.col("familia"))
    counted = entries.groupBy("familia").agg(F.count("*").alias("n"))
    return counted.select(F.when(listed > 0, listed).otherwise(len(order) + 1).cast("int").alias("section"), "familia", "n")


def numeric_blocks(codes: DataFrame, blocks: Sequence[tuple[int, int]] = AUDIT_BLOCKS) -> DataFrame:
    """``(codigo, low, high)``: the block of a code's number (``codigo`` ends in digits only behind a blank)."""
    number = F.expr("try_cast(regexp_extract(codigo, ' ([0-9]+)$', 1) AS bigint)")
    made = F.when(F.lit(False), F.struct(F.lit(0).alias("low"), F.lit(0).alias("high")))
    for a, b in blocks:
        made = made.when(number.between(a, b), F.struct(F.lit(a).alias("low"), F.lit(b).alias("high")))
    return codes.withColumn("_b", made).where("_b IS NOT NULL").select("codigo", "_b.low", "_b.high")


def table_lines(entries: DataFrame) -> DataFrame:
    """``(order_key, codigo, line)``: the rows of a Markdown table, sorted by date; a missing folder is a dash."""
    folder = F.when(F.col("pasta_repo").isNull(), "—").otherwise(F.concat(F.lit("[`"), F.col("pasta_repo"), F.lit("`](../"), F.col("pasta_repo"), F.lit("/)")))
    cells = (F.col("codigo"), F.coalesce("titulo", F.lit("")), F.coalesce("data", F.lit("")), folder, status(F.col("situacao"), F.col("no_repo")))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    return entries.select(F.coalesce("data", F.lit("0000")).alias("order_key"), "codigo", line.alias("line")).orderBy("order_key", "codigo")


# Sections of the accounting catalog in order of print, with the families that they hold.
SECTIONS = (
    ("1. NBC TG - Tecnica Geral", ("NBC TG",)), ("2. PME e Microempresa", ("NBC TG PME",)), ("3. ITG - Interpretacoes Tecnicas Gerais", ("ITG",)),
    ("4. ICPC", ("ICPC",)), ("5. OCPC", ("OCPC",)), ("6. CTG", ("CTG",)), ("7. NBC TSP - Setor Publico", ("NBC TSP",)), ("8. NBC TA - Auditoria", ("NBC TA",)),
    ("9. NBC TR / TO / TSC", ("NBC TR", "NBC TO", "NBC TSC")), ("10. NBC TP / NBC PP - Pericia", ("NBC TP", "NBC PP")), ("11. NBC PG / NBC PA - Normas Profissionais", ("NBC PG", "NBC PA")),
)
BLOCK_TITLES = ("Principios Gerais", "Avaliacao de Riscos", "Evidencia", "Trabalho de Terceiros", "Relatorio", "Areas Especializadas")
#: A code that stands in another section than its family.
MOVED = {"ITG 1000": 2}


def regrouped(codigo: Column, familia: Column, moved: dict[str, str]) -> Column:
    """Group of an entry: the one its code is moved to, else its family."""
    out = F.when(F.lit(False), familia)
    for code, group in moved.items():
        out = out.when(codigo == code, group)
    return out.otherwise(familia)


def section_of(codigo: Column, familia: Column, moved: dict[str, int] | None = None) -> Column:
    """Number of the section of an entry: its code's own, else its family's; null for a family without section."""
    out = F.when(F.lit(False), F.lit(0))
    for code, n in (MOVED if moved is None else moved).items():
        out = out.when(codigo == code, n)
    for n, (_, families) in enumerate(SECTIONS, 1):
        out = out.when(familia.isin(*families), n)
    return out


def accounting_lines(entries: DataFrame, order: str = "codigo") -> DataFrame:
    """``(section, part, place, line)``: the accounting catalog as rows of Markdown in order of section, part and place.

    Audit norms are parted by the block of their number (a frame of their own first, numbers outside all blocks left out),
    professional norms by family. The first section shows the corresponding pronouncement, the ninth and tenth the family.
    """
    number = F.expr("try_cast(regexp_extract(codigo, ' ([0-9]+)$', 1) AS bigint)")
    block = F.when(F.col("codigo").contains("Estrutura"), 0)
    for n, (low, high) in enumerate(AUDIT_BLOCKS, 1):
        block = block.when(number.between(low, high), n)
    told = entries.withColumn("section", section_of(F.col("codigo"), F.col("familia"))).where("section IS NOT NULL")
    families = F.array(*[F.lit(f) for _, fs in SECTIONS for f in fs])
    part = F.when(F.col("section") == 8, block).when(F.col("section").isin(9, 10), 0).otherwise(F.array_position(families, F.col("familia")).cast("int"))
    mark = status(F.col("situacao"), F.col("no_repo"), F.col("revogada_por"))
    extra = F.when(F.col("section") == 1, F.coalesce("correspondencia_cpc", F.lit("—"))).when(F.col("section").isin(9, 10), F.col("familia"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", "codigo", extra, F.coalesce("titulo", F.lit("")), mark), F.lit(" |"))
    key = F.when(F.col("section") == 1, F.col("codigo").cast("string")).otherwise(F.col(order).cast("string"))
    return told.select("section", part.alias("part"), key.alias("place"), line.alias("line")).where("part IS NOT NULL").orderBy("section", "part", "place")
