"""Retrieval over units, catalogs and tables: current wording, citation, history, references, search, chains, diffs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigora.functions import text as T
from vigora.sources.tables import cut_lineage


def last_delivered(chunks: DataFrame) -> DataFrame:
    """One row per id: the last delivered; combined map-side."""
    cols = [c for c in chunks.columns if c not in ("id", "loaded_at")]
    best = chunks.where("id IS NOT NULL").groupBy("id").agg(F.max(F.struct("loaded_at", *cols)).alias("r"))
    return best.select("id", "r.*")


def current(chunks: DataFrame) -> DataFrame:
    """Units that hold; the filter reaches the scan."""
    return chunks.where("vigente")


def cite(chunks: DataFrame, ids: Sequence[str]) -> DataFrame:
    return chunks.where(F.col("id").isin(*ids))


def wordings(chunks: DataFrame) -> DataFrame:
    """``(slug, artigo, id, vigente, n)``: all wordings of each article that has several; the current one last."""
    unit = T.bare(F.col("artigo"))
    keyed = chunks.where(unit.isNotNull()).select(T.slug_of(F.col("id")).alias("slug"), unit.alias("artigo"), "id", "vigente").distinct()
    count = F.count("*").over(W.partitionBy("slug", "artigo"))
    order = W.partitionBy("slug", "artigo").orderBy(F.col("vigente").asc_nulls_first(), "id")
    return keyed.select("*", F.row_number().over(order).alias("n"), count.alias("_c")).where("_c > 1").drop("_c")


def follow(chunks: DataFrame) -> DataFrame:
    """``(id, ref, target, path)``: references of current units to units of the same norm; a null path dangles."""
    units = last_delivered(chunks)
    said = current(units).select("id", F.explode(F.array_distinct(F.transform(F.coalesce("refs", F.array().cast("array<string>")), T.bare))).alias("ref"))
    named = said.where("ref IS NOT NULL AND ref <> ''").withColumn("target", F.concat(T.slug_of(F.col("id")), F.lit("--"), F.col("ref")))
    return named.join(units.select(F.col("id").alias("target"), "path"), "target", "left").select("id", "ref", "target", "path")


def rank_terms(docs: DataFrame, key: str, text: str, terms: Sequence[str], limit: int) -> DataFrame:
    """Top ``limit`` rows by how many of the terms they hold, then how often, then by key."""
    low = F.lower(F.coalesce(text, F.lit("")))
    n = lambda t: (F.length(low) - F.length(F.replace(low, F.lit(t.lower()), F.lit("")))) / len(t)
    held = sum((F.contains(low, F.lit(t.lower())).cast("int") for t in terms), F.lit(0))
    often = sum((n(t) for t in terms), F.lit(0)).cast("bigint")
    return docs.select(key, held.alias("held"), often.alias("often")).where("held > 0").orderBy(F.desc("held"), F.desc("often"), key).limit(limit)


def chain(edges: DataFrame) -> DataFrame:
    """``(start, target, depth)``: everything reachable along ``(src, dst)``, with the least depth; cycles end.

    Semi-naive: each round joins the newly reached pairs only, and cuts their lineage.
    """
    step = edges.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").select("src", "dst").distinct()
    seen = cut_lineage(step.select(F.col("src").alias("start"), F.col("dst").alias("target"), F.lit(1).alias("depth")))
    fresh = seen
    for depth in count(2):
        nxt = fresh.join(step.withColumnRenamed("src", "target"), "target").select("start", F.col("dst").alias("target")).where("start <> target").distinct()
        fresh = cut_lineage(nxt.join(seen, ["start", "target"], "left_anti").withColumn("depth", F.lit(depth)))
        if fresh.isEmpty():
            break
        seen = cut_lineage(seen.unionByName(fresh))
    return seen


def prefix_join(codes: DataFrame, parents: DataFrame, code: str, parent: str, width: int) -> DataFrame:
    """Codes with the parent whose number, padded with zeros, is their prefix of ``width``; longer numbers are nobody's parent."""
    number = F.col(parent).cast("string")
    key = F.when(F.length(number) <= width, F.lpad(number, width, "0"))
    return codes.withColumn("_k", F.left(F.col(code), F.lit(width))).join(parents.withColumn("_k", key), "_k", "left").drop("_k")


def diff(old: DataFrame, new: DataFrame, key: Sequence[str], value: Column) -> DataFrame:
    """``(*key, change)``: added, removed or changed keys between two versions of a table; of repeated keys the greatest value."""
    mark = lambda d, n: d.groupBy(*key).agg(F.max(value).alias(n))
    both = mark(old, "_o").join(mark(new, "_n"), list(key), "full")
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(F.col("_o") != F.col("_n"), "changed")
    return both.select(*key, change.alias("change")).where("change IS NOT NULL")


def valid_on(rows: DataFrame, start: str, end: str, day: str) -> DataFrame:
    """Rows whose period holds on ``day``; a null end is open (not ended)."""
    return rows.where((F.col(start) <= F.lit(day)) & (F.col(end).isNull() | (F.lit(day) < F.col(end))))


def route(docs: DataFrame, key: str, text: str, triggers: DataFrame, size: int = 200) -> DataFrame:
    """``(key, skill, hits)``: the skill whose triggers a text names most; ties go to the lower priority number.

    ``triggers`` has ``skill, trigger, priority``. Up to ``size`` of them are tested within one projection of the text, without
    a join; a longer list is tested in as many passes as it takes, and the hits of a skill are added up.
    """
    listed = triggers.where("trigger IS NOT NULL").select("priority", "skill", "trigger").orderBy("priority", "skill", "trigger").collect()
    low = F.lower(F.coalesce(text, F.lit("")))

    def scored(part: list) -> Column:
        skills: dict[tuple[int, str], Column] = {}
        for r in part:
            hit = F.contains(low, F.lit(r["trigger"].lower())).cast("int")
            skills[(r["priority"], r["skill"])] = skills.get((r["priority"], r["skill"]), F.lit(0)) + hit
        return F.array(*[F.struct(n.alias("hits"), F.lit(-p).alias("order"), F.lit(s).alias("skill")) for (p, s), n in skills.items()])

    if len(listed) <= size:
        none = F.array().cast("array<struct<hits:int,order:int,skill:string>>")
        best = docs.select(key, F.array_max(scored(listed) if listed else none).alias("b"))
    else:
        passes = [docs.select(key, F.explode(F.filter(scored(listed[i : i + size]), lambda x: x["hits"] > 0)).alias("s")) for i in range(0, len(listed), size)]
        each = reduce(DataFrame.unionByName, passes)
        summed = each.groupBy(key, "s.skill", "s.order").agg(F.sum("s.hits").alias("hits"))
        best = summed.groupBy(key).agg(F.max(F.struct("hits", "order", "skill")).alias("b"))
    return best.where("b.hits > 0").select(key, "b.skill", F.col("b.hits").cast("bigint").alias("hits"))


def tagged(entries: DataFrame, column: str, wanted: Sequence[str]) -> DataFrame:
    return entries.where(F.arrays_overlap(F.col(column), F.array(*[F.lit(w) for w in wanted])))


def correspondence(entries: DataFrame, regime: str | None = None) -> DataFrame:
    """``(codigo, correspondencia_cpc, titulo, status, warning, rank)`` of accounting entries, those at hand first.

    ``regime`` keeps the entries whose ``aplicacao`` names it; a revoked entry carries a warning with its revoker.
    """
    held = entries if regime is None else entries.where(F.array_contains("aplicacao", regime))
    revoked = F.lower("situacao") == "revogada"
    warning = F.when(revoked, F.concat(F.lit("revogada"), F.coalesce(F.concat(F.lit(" por "), "revogada_por"), F.lit(""))))
    rank = F.when(revoked, 2).when(F.coalesce("no_repo", F.lit(False)), 0).otherwise(1)
    return held.select("codigo", "correspondencia_cpc", "titulo", "situacao", warning.alias("warning"), rank.alias("rank")).orderBy("rank", "codigo")


def revocations(entries: DataFrame) -> DataFrame:
    """Edges ``(src, dst)``: what each accounting entry revokes, from both ends (``revoga`` and ``revogada_por``)."""
    down = entries.select(F.col("codigo").alias("src"), F.explode("revoga").alias("dst"))
    up = entries.where("revogada_por IS NOT NULL").select(F.col("revogada_por").alias("src"), F.col("codigo").alias("dst"))
    return down.unionByName(up).where("src IS NOT NULL AND dst IS NOT NULL").distinct()


def state_on(events: DataFrame, key: Sequence[str], day: str) -> DataFrame:
    """``(*key, regime, evento, efeito, fim)``: of the events that take effect by ``day`` and are not cancelled the last, if it has not ended.

    ``events`` has ``evento, regime, data_evento, efeito, fim, cancelado``; ties of ``efeito`` go to the later event.
    """
    held = events.where(~F.coalesce("cancelado", F.lit(False)) & (F.col("efeito") <= F.lit(day)))
    last = held.groupBy(*key).agg(F.max(F.struct("efeito", "data_evento", "regime", "evento", "fim")).alias("e"))
    return last.where(F.col("e.fim").isNull() | (F.col("e.fim") > F.lit(day))).select(*key, "e.regime", "e.evento", "e.efeito", "e.fim")


def hierarchy(classes: DataFrame, subclasses: DataFrame, taxes: DataFrame) -> DataFrame:
    """Subclasses with their class and how they are taxed; a class without subclasses and a subclass without taxes stay.

    ``classes`` has ``classe``, ``subclasses`` has ``subclasse`` whose first five digits are its class, ``taxes`` has ``subclasse``.
    """
    digits = lambda c: F.left(F.regexp_replace(c, r"\D", ""), F.lit(5))
    left, right = classes.withColumn("_k", digits("classe")), subclasses.withColumn("_k", digits("subclasse"))
    return left.join(right, "_k", "left").join(taxes, "subclasse", "left").drop("_k")
