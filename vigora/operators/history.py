"""History of changing attributes, kept as checkpoints and patches.

``observe`` turns periodic snapshots into one clean row per key and date, ``encode`` stores what
changes (a full version every so often, else only the changed attributes), ``fold`` rebuilds validity
rows by folding the patches forward from the nearest checkpoint.

Defined results
---------------
* rows with a null key, date or scope key cannot be placed and are left out;
* several rows of a key and date: the last loaded counts; on equal times the greatest values;
  a null load time loses against any other;
* a null in a carried attribute means the value of the key's row before; before any value it is null;
* an empty input gives an empty history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigora.functions import text as T

OPEN_END = "9999-12-31"


def observe(
    snapshots: DataFrame,
    key: str,
    at: str,
    scope: str,
    attrs: Sequence[str],
    loaded: str,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``(key, at, next_at, lead_at, *attrs)``: the last loaded row of each key and date.

    ``scope`` groups keys that are delivered together; ``next_at`` is the next date at which the
    scope has any row, ``lead_at`` the next date at which the key itself has one. Dates are bounded
    by the calendar of snapshots, so the arrays per scope stay small whatever the number of rows.
    """
    placed = snapshots.where(F.col(key).isNotNull() & F.col(at).isNotNull() & F.col(scope).isNotNull())
    newest = placed.groupBy(key, at).agg(F.max(F.struct(loaded, scope, *attrs)).alias("_row"))
    rows = newest.select(key, at, F.col(f"_row.{scope}").alias(scope), *[F.col(f"_row.{a}").alias(a) for a in attrs])
    calendar = (
        placed.groupBy(scope)
        .agg(F.array_sort(F.collect_set(at)).alias("_dates"))
        .select(scope, "_dates", F.posexplode("_dates").alias("_i", at))
        .select(scope, at, F.get("_dates", F.col("_i") + 1).alias("next_at"))
    )
    by_key = W.partitionBy(key).orderBy(at)
    carried = [F.last(a, ignorenulls=True).over(by_key).alias(a) if a in carry else F.col(a) for a in attrs]
    return rows.join(calendar, [scope, at]).select(key, at, "next_at", F.lead(at).over(by_key).alias("lead_at"), *carried)


def encode(observed: DataFrame, key: str, at: str, attrs: Sequence[str], every: int = 4) -> DataFrame:
    """Checkpoint-delta log ``(key, at, kind, changed, *attrs)`` of observed rows.

    ``kind`` is ``full`` (a checkpoint with all attributes: at each appearance of the key and at every
    ``every``-th change after it), ``patch`` (only the attributes named in ``changed`` are set) or ``end``
    (the key is missing from the scope's snapshot of that date).
    """
    by_key = W.partitionBy(key).orderBy(at)
    appears = F.lag("next_at").over(by_key).eqNullSafe(F.col(at))
    differs = [~F.lag(a).over(by_key).eqNullSafe(F.col(a)) for a in attrs]
    marked = observed.select(
        "*",
        (~appears).alias("_new"),
        F.array_compact(F.array(*[F.when(d, F.lit(a)) for a, d in zip(attrs, differs, strict=True)])).alias("changed"),
        (F.col("next_at").isNotNull() & ~F.col("lead_at").eqNullSafe(F.col("next_at"))).alias("_gone"),
    )
    lives = marked.withColumn("_life", F.sum(F.col("_new").cast("int")).over(by_key))
    events = lives.withColumn(
        "_n", F.sum((~F.col("_new") & (F.size("changed") > 0)).cast("int")).over(W.partitionBy(key, "_life").orderBy(at))
    )
    full = F.col("_new") | ((F.size("changed") > 0) & (F.col("_n") % every == 0))
    kept = events.where(F.col("_new") | (F.size("changed") > 0) | F.col("_gone"))
    names = F.array(*[F.lit(a) for a in attrs])
    version = F.struct(
        F.col(at).alias("at"),
        F.when(full, F.lit("full")).otherwise(F.lit("patch")).alias("kind"),
        F.when(full, names).otherwise(F.col("changed")).alias("changed"),
        *[F.when(full | F.array_contains("changed", a), F.col(a)).alias(a) for a in attrs],
    )
    nothing = [F.when(F.lit(False), F.col(a)).alias(a) for a in attrs]
    end = F.struct(
        F.col("next_at").alias("at"), F.lit("end").alias("kind"), F.array().cast("array<string>").alias("changed"), *nothing
    )
    is_version = F.col("_new") | (F.size("changed") > 0)
    entries = F.array_compact(F.array(F.when(is_version, version), F.when(F.col("_gone"), end)))
    return kept.select(key, F.explode(entries).alias("e")).select(key, "e.*")


def fold(log: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Validity rows ``(key, valid_from, valid_to, *attrs)`` of a checkpoint-delta log.

    Each patch is folded forward from the nearest checkpoint at or before it; ``valid_to`` is the date
    of the key's next entry, else 9999-12-31.
    """
    by_key = W.partitionBy(key).orderBy("at")
    based = log.select(
        "*",
        F.sum((F.col("kind") == "full").cast("int")).over(by_key).alias("_base"),
        F.lead("at").over(by_key).alias("_until"),
    )
    since = W.partitionBy(key, "_base").orderBy("at")
    folded = [
        F.last(F.when(F.array_contains("changed", a), F.struct(F.col(a).alias("v"))), ignorenulls=True).over(since)["v"].alias(a)
        for a in attrs
    ]
    state = based.select(key, "at", "kind", "_until", *folded).where(F.col("kind") != "end")
    return state.select(
        key,
        F.date_format("at", "yyyy-MM-dd").alias("valid_from"),
        F.coalesce(F.date_format("_until", "yyyy-MM-dd"), F.lit(OPEN_END)).alias("valid_to"),
        *attrs,
    )


def as_of(log: DataFrame, key: str, attrs: Sequence[str], day: str) -> DataFrame:
    """``(key, valid_from, *attrs)``: the versions that hold on ``day`` (yyyy-mm-dd), rebuilt from a checkpoint-delta log.

    Of each key only the entries from its nearest checkpoint up to the day are folded, whatever the length of its history.
    """
    past = log.where(F.col("at") <= F.lit(day).cast("date"))
    base = F.max(F.when(F.col("kind") == "full", F.col("at"))).over(W.partitionBy(key))
    near = past.withColumn("_base", base).where(F.col("at") >= F.col("_base"))
    folded = [F.max_by(F.struct(F.col(a).alias("v")), F.when(F.array_contains("changed", a), F.col("at"))).alias(a) for a in attrs]
    state = near.groupBy(key).agg(F.max_by("kind", "at").alias("kind"), F.max("at").alias("at"), *folded).where("kind <> 'end'")
    return state.select(key, F.date_format("at", "yyyy-MM-dd").alias("valid_from"), *[F.col(a)["v"].alias(a) for a in attrs])


ATTRS = ("artigo", "vigente", "notas")


def unit_log(snapshots: DataFrame, every: int = 4) -> DataFrame:
    """Checkpoint-delta log of units: number, validity flag and set of notes, in compared form."""
    clean = snapshots.select(
        "id",
        "snapshot_date",
        F.coalesce(T.norm_key(F.col("norma")), T.slug_of(F.col("id"))).alias("scope"),
        T.bare(F.col("artigo")).alias("artigo"),
        "vigente",
        T.note_set(F.col("notas_vigencia")).alias("notas"),
        "loaded_at",
    )
    seen = observe(clean, "id", "snapshot_date", "scope", ATTRS, "loaded_at", carry=("artigo", "vigente"))
    return encode(seen, "id", "snapshot_date", ATTRS, every)


def unit_history(snapshots: DataFrame, every: int = 4) -> DataFrame:
    """One row per version of each unit of ``chunk_snapshot``, through its checkpoint-delta log."""
    return fold(unit_log(snapshots, every), "id", ATTRS)
