"""Mixing sources to target weights by a low-discrepancy schedule.

Each source gets a share of the total size by water-filling: shares follow the weights until a source
would need more than ``max_repeat`` uses of its documents; what it cannot take goes to the others in
proportion. The mix is a row of slots of equal size: golden-ratio points are mapped through the
cumulative shares to sources, the slots of a source are ranked, and its r-th slot takes the r-th block
of equal token size from its stream of documents, shuffled anew for every use.

Scale: ranks and running sums are made in two levels (within a chunk of slots or a bucket of hashed
documents, then over the chunk or bucket totals), so no source, however large, is sorted in one task.
Only the totals of the listed sources reach the driver.

Defined results
---------------
* the size of the mix is that of the eligible documents taken once: sources with a weight above 0 and at
  least one use (null: one), that have a document of at least one token;
* null, zero and negative weights and a ``max_repeat`` below 1 keep a source out; repeated targets of a
  source: the one with the greatest weight counts;
* documents of null or unlisted sources and empty texts take no part; repeated rows are further documents;
* a document is never cut: it belongs to the mix if its middle lies within its source's share;
* an empty table, or no eligible source, gives an empty mix and shares of zero.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigora.llm import tokens
from vigora.sources.tables import cut_lineage

GOLDEN = 0.6180339887498949
CHUNK = 65_536


@dataclass(frozen=True)
class Share:
    source: str
    weight: float
    size: int
    uses: int
    quota: float


def water_fill(wanted: list[tuple[str, float, int, int]], total: float) -> list[Share]:
    """Quotas of ``(source, weight, size, uses)`` that add up to ``total``, none above size x uses."""
    left, open_, quota = total, list(wanted), {}
    while open_:
        scale = left / sum(w for _, w, _, _ in open_)
        full = [x for x in open_ if x[2] * x[3] < x[1] * scale]
        if not full:
            quota |= {s: w * scale for s, w, _, _ in open_}
            break
        quota |= {s: float(n * k) for s, _, n, k in full}
        left -= sum(n * k for _, _, n, k in full)
        open_ = [x for x in open_ if x not in full]
    return [Share(s, w, n, k, quota[s]) for s, w, n, k in wanted]


def eligible(targets: DataFrame) -> DataFrame:
    """One row ``(source, weight, uses)`` per source that may take part."""
    uses = F.coalesce("max_repeat", F.lit(1))
    kept = targets.where(F.col("source").isNotNull() & (F.col("weight") > 0) & (uses >= 1))
    return kept.groupBy("source").agg(F.max(F.struct("weight", uses.alias("uses"))).alias("t")).select("source", "t.*")


def sized_documents(docs: DataFrame, targets: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, source, n_tokens)`` of the eligible documents."""
    wanted = docs.select("doc_id", "source", "text").join(eligible(targets).select("source"), "source", "left_semi")
    counted = tokens.count_tokens(wanted, "text", vocabulary)
    return cut_lineage(counted.where("n_tokens > 0").select("doc_id", "source", "n_tokens"))


def shares(sized: DataFrame, targets: DataFrame) -> list[Share]:
    """Quota of every source that takes part; as many rows as there are listed sources reach the driver."""
    sums = sized.groupBy("source").agg(F.sum("n_tokens").alias("size")).join(eligible(targets), "source").orderBy("source").collect()
    return water_fill([(r["source"], r["weight"], r["size"], r["uses"]) for r in sums], sum(r["size"] for r in sums))


def schedule(sized: DataFrame, quotas: list[Share], slots: int) -> DataFrame:
    """``(slot, source, rank)``: the source of each slot, and which of the source's slots it is, from 0."""
    total = sum(q.quota for q in quotas)
    edges, at = [], 0.0
    for q in quotas:
        at += q.quota / total
        edges.append(at)
    edges[-1] = 2.0
    point = (F.col("slot") * GOLDEN + 0.5) % 1.0
    index = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= point))
    source = F.get(F.array(*[F.lit(q.source) for q in quotas]), index)
    spark = sized.sparkSession
    row = spark.range(slots).select(F.col("id").alias("slot"), (F.col("id") / CHUNK).cast("long").alias("chunk"))
    row = row.withColumn("source", source)
    in_chunk = W.partitionBy("source", "chunk").orderBy("slot")
    before = W.partitionBy("source").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    counts = row.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    offsets = counts.select("source", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = row.select("slot", "chunk", "source", (F.row_number().over(in_chunk) - 1).alias("own")).join(offsets, ["source", "chunk"])
    return ranked.select("slot", "source", (F.col("own") + F.col("before")).alias("rank"))


def streams(sized: DataFrame, quotas: list[Share], seed: int, buckets: int) -> DataFrame:
    """``(doc_id, source, use, n_tokens, start)`` of the documents within their source's quota.

    ``start`` is the token at which the document begins in its source's stream, a new shuffle for each use.
    """
    spark = sized.sparkSession
    rows = [(q.source, float(q.size), q.quota, int(-(-q.quota // q.size))) for q in quotas]
    plan = F.broadcast(spark.createDataFrame(rows, "source string, size double, quota double, uses int"))
    used = sized.join(plan, "source").withColumn("use", F.explode(F.sequence(F.lit(0), F.greatest(F.col("uses") - 1, F.lit(0)))))
    order = F.xxhash64(F.lit(seed), F.col("use"), F.col("doc_id"))
    placed = used.withColumn("h", order).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    whole = W.partitionBy("source", "use").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("source", "use", "bucket").orderBy("h", "doc_id", "n_tokens").rowsBetween(W.unboundedPreceding, -1)
    sums = placed.groupBy("source", "use", "bucket").agg(F.sum("n_tokens").alias("n"))
    offsets = sums.select("source", "use", "bucket", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("before"))
    run = placed.select("*", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("own")).join(offsets, ["source", "use", "bucket"])
    start = F.col("use") * F.col("size") + F.col("before") + F.col("own")
    return run.withColumn("start", start).where(F.col("start") + F.col("n_tokens") / 2 < F.col("quota")).select("doc_id", "source", "use", "n_tokens", "start")


def mix(docs: DataFrame, targets: DataFrame, vocabulary: str = f"{tokens.VOCABULARIES}/{tokens.VOCABULARY}",
        block_tokens: int = 4_096, seed: int = 7, buckets: int = 1_024) -> DataFrame:
    """``(slot, start, doc_id, source, use, n_tokens)``: the mix in order of ``slot``, then ``start``."""
    sized = sized_documents(docs, targets, vocabulary)
    quotas = shares(sized, targets)
    if not quotas:
        zero = sized.select(F.lit(0).cast("long").alias("slot"), F.lit(0.0).alias("start"), "doc_id", "source", F.lit(0).alias("use"), "n_tokens")
        return zero.where(F.lit(False))
    total = sum(q.quota for q in quotas)
    slots = max(1, int(-(-total // block_tokens)))
    plan = cut_lineage(schedule(sized, quotas, slots))
    per_source = plan.groupBy("source").agg(F.count("*").alias("n"))
    spark = sized.sparkSession
    quota = spark.createDataFrame([(q.source, q.quota) for q in quotas], "source string, quota double")
    size = F.broadcast(quota.join(per_source, "source", "left").select("source", (F.col("quota") / F.coalesce("n", F.lit(1))).alias("block")))
    cut = streams(sized, quotas, seed, buckets).join(size, "source").withColumn("rank", (F.col("start") / F.col("block")).cast("long"))
    placed = cut.join(plan, ["source", "rank"], "left")
    return placed.select(F.coalesce("slot", F.lit(slots // 2)).alias("slot"), "start", "doc_id", "source", "use", "n_tokens")


def report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, weight, max_repeat, target_share, tokens, documents, uses, actual_share)`` per listed source."""
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"), (F.max("use") + 1).alias("uses"))
    listed = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max(F.struct("weight", "max_repeat")).alias("t")).select("source", "t.*")
    rows = listed.join(got, "source", "left").na.fill({"tokens": 0, "documents": 0, "uses": 0})
    everything = W.partitionBy()
    counts = (F.col("weight") > 0) & (F.coalesce("max_repeat", F.lit(1)) >= 1)
    weight = F.when(counts, F.col("weight")).otherwise(0.0)
    all_weight, all_tokens = F.sum(weight).over(everything), F.sum("tokens").over(everything)
    return rows.select(
        "source", "weight", "max_repeat", F.try_divide(weight, all_weight).alias("target_share"), "tokens", "documents", "uses",
        F.coalesce(F.try_divide(F.col("tokens").cast("double"), all_tokens), F.lit(0.0)).alias("actual_share"),
    )
