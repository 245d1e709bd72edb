"""References to records that do not exist, are deleted or arrive later.

Keys are dictionary-encoded as integers (key range and place within it), compressed bitmaps of the
referenced and of the available keys are built per key range and month, and *reference AND NOT parent*
leaves the suspects of each month; surviving bits are decoded, joined back to their references and told
apart by exact times.

Defined results
---------------
* references of a null id, null or empty elements: no reference; repeated ones count once;
* the month of a referring id with no arrival time is null, and it never has a ``late`` reference;
* a target without arrival times exists and is not late; removals of unknown ids say nothing;
* an empty table of units gives an empty result; without annexes every annex reference is missing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vigora.functions import text as T
from vigora.sources.tables import cut_lineage

#: Keys aimed at in one range; a bitmap of a range and month then holds 4 KB before compression.
RANGE_KEYS = 16_384


def references(chunks: DataFrame, removals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(refs, parents)``.

    refs: ``(id, target, ref_table, first_at, period)`` of ids that are not themselves deleted;
    parents: ``(target, ref_table, first_at, deleted)``, one row per unit. Arrivals are combined
    map-side, so an id delivered very often does not gather in one task.
    """
    placed = chunks.where(F.col("id").isNotNull())
    key = F.lower("id")
    arrivals = placed.groupBy(key.alias("target")).agg(F.min("loaded_at").alias("first_at"), F.max("loaded_at").alias("last_at"))
    gone = removals.where(F.col("id").isNotNull()).groupBy(key.alias("target")).agg(F.max("removed_at").alias("removed_at"))
    units = arrivals.join(gone, "target", "left").select(
        "target", "first_at", F.coalesce(F.col("removed_at") > F.col("last_at"), F.lit(False)).alias("deleted")
    )
    slug = T.slug_of(key)
    ref = F.transform(F.coalesce("refs", F.array().cast("array<string>")), T.bare)
    annex = F.transform(F.coalesce("anexos", F.array().cast("array<string>")), T.strip)
    named = F.concat(
        F.transform(ref, lambda x: F.when(x != "", F.struct(F.lit("chunk").alias("ref_table"), F.concat(slug, F.lit("--"), x).alias("target")))),
        F.transform(annex, lambda x: F.when(x != "", F.struct(F.lit("annex_cell").alias("ref_table"), F.concat(slug, F.lit("/"), x).alias("target")))),
    )
    said = placed.select("id", key.alias("_key"), F.explode(F.array_compact(named)).alias("r")).select("id", "_key", "r.*").distinct()
    refs = said.join(units.where(~F.col("deleted")).select(F.col("target").alias("_key"), "first_at"), "_key")
    month = F.date_format("first_at", "yyyy-MM").alias("period")
    parents = units.select("target", F.lit("chunk").alias("ref_table"), "first_at", "deleted")
    return refs.select("id", "target", "ref_table", "first_at", month), parents


def encode_keys(keys: DataFrame, ranges: int) -> DataFrame:
    """Dictionary ``(ref_table, target, key_range, code)``; the same keys in the same number of ranges get the same codes."""
    distinct = keys.select("ref_table", "target").distinct()
    ranged = distinct.withColumn("key_range", F.pmod(F.xxhash64("ref_table", "target"), F.lit(ranges)).cast("int"))
    order = W.partitionBy("key_range").orderBy("target", "ref_table")
    return ranged.withColumn("code", F.row_number().over(order))


def _bitmaps(frame: DataFrame, side: str) -> DataFrame:
    """One bitmap per key range, block of 32,768 codes and month; combined map-side."""
    block, bit = F.bitmap_bucket_number("code"), F.bitmap_bit_position("code")
    grouped = frame.groupBy("key_range", block.alias("block"), "period").agg(F.bitmap_construct_agg(bit).alias("bits"))
    return grouped.withColumn("side", F.lit(side))


SURVIVORS = "key_range int, block long, period string, code int"


def _and_not(table: pa.Table) -> pa.Table:
    """Reference AND NOT parent of one block, month by month; parents known before a month count in it."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("side", "period", "bits")), strict=True), key=lambda r: (r[1] is not None, r[1] or ""))
    pending = [(month, bits) for side, month, bits in rows if side == "parent"]
    known = np.zeros(4096, np.uint8)
    codes: list[np.ndarray] = []
    months: list[str | None] = []
    for side, month, bits in rows:
        if side != "ref":
            continue
        while pending and (pending[0][0] is None or (month is not None and pending[0][0] < month)):
            known |= np.frombuffer(zlib.decompress(pending.pop(0)[1]), np.uint8)
        left = np.frombuffer(zlib.decompress(bits), np.uint8) & ~known
        found = np.flatnonzero(np.unpackbits(left, bitorder="little"))
        codes.append(found)
        months.extend([month] * len(found))
    place = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    key_range, block = table.column("key_range")[0].as_py(), table.column("block")[0].as_py()
    made = {
        "key_range": pa.array(np.full(len(place), key_range, np.int32)),
        "block": pa.array(np.full(len(place), block, np.int64)),
        "period": pa.array(months, pa.string()),
        "code": pa.array((place + 1 + (block - 1) * 32_768).astype(np.int32)),
    }
    return pa.table(made)


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = pa.array([zlib.compress(b, 1) for b in batch.column("bits").to_pylist()], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("bits"), "bits", bits)


def suspects(refs: DataFrame, parents: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(ref_table, target, period)`` of references whose target is not known to be there before that month."""
    coded = lambda d: d.join(dictionary, ["ref_table", "target"])
    there = parents.where(~F.col("deleted")).select("ref_table", "target", F.date_format("first_at", "yyyy-MM").alias("period"))
    maps = _bitmaps(coded(refs.select("ref_table", "target", "period").distinct()), "ref").unionByName(_bitmaps(coded(there), "parent"))
    packed = maps.mapInArrow(_compress, maps.schema)
    left = packed.groupBy("key_range", "block").applyInArrow(_and_not, SURVIVORS)
    return dictionary.join(left.select("key_range", "code", "period"), ["key_range", "code"]).select("ref_table", "target", "period")


def _later(a: Column, b: Column) -> Column:
    return F.coalesce(a > b, F.lit(False))


def orphans(chunks: DataFrame, removals: DataFrame, annexes: DataFrame, range_keys: int = RANGE_KEYS) -> DataFrame:
    """``(ref_table, id, target, kind, period)``: one row per orphan reference."""
    refs, units = references(chunks, removals)
    refs = cut_lineage(refs)
    held = annexes.where(F.col("slug").isNotNull() & F.col("csv").isNotNull())
    tables = held.select(F.concat("slug", F.lit("/"), "csv").alias("target")).distinct().select(
        "target", F.lit("annex_cell").alias("ref_table"), F.lit(None).cast("timestamp").cast(units.schema["first_at"].dataType).alias("first_at"),
        F.lit(False).alias("deleted"),
    )
    parents = units.unionByName(tables)
    ranges = max(1, -(-refs.count() // range_keys))
    targets = refs.select("ref_table", "target").distinct()
    wanted = parents.join(targets, ["ref_table", "target"], "left_semi")
    dictionary = cut_lineage(encode_keys(targets, ranges))
    left = suspects(refs, wanted, dictionary)
    matched = refs.join(left.withColumnRenamed("period", "_period"), ["ref_table", "target"]).where(F.col("period").eqNullSafe(F.col("_period")))
    target = wanted.select("ref_table", "target", F.col("first_at").alias("_first"), "deleted", F.lit(True).alias("_there"))
    told = matched.join(target, ["ref_table", "target"], "left").withColumn(
        "kind",
        F.when(F.col("_there").isNull(), "missing").when(F.col("deleted"), "deleted").when(_later(F.col("_first"), F.col("first_at")), "late"),
    )
    return told.where(F.col("kind").isNotNull()).select("ref_table", "id", "target", "kind", "period")
