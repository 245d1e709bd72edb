from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from vigora.llm import mixing as X
from vigora.llm import tokens as K

pytestmark = pytest.mark.skipif(not os.path.exists(f"{K.VOCABULARIES}/{K.VOCABULARY}"), reason="no vocabulary file")
DOCS = "doc_id bigint, source string, text string, slot int, start int"
TARGETS = "source string, weight double, max_repeat int"


def test_water_filling():
    got = {s.source: s.quota for s in X.water_fill([("a", 1, 900, 1), ("b", 1, 50, 2), ("c", 2, 50, 20)], 1000)}
    assert got["b"] == 100 and abs(got["a"] - 300) < 1e-9 and abs(got["c"] - 600) < 1e-9
    full = X.water_fill([("a", 9, 10, 1), ("b", 1, 10, 1)], 20)
    assert [s.quota for s in full] == [10, 10]
    assert X.water_fill([], 0) == []


def test_mix_keeps_size_shares_and_caps(spark):
    rows = [(i, "big" if i % 3 else "small", "um texto comum " * (1 + i % 5), 0, 0) for i in range(1, 601)]
    rows += [(0, None, "x", 0, 0), (9_000, "big", None, 0, 0), (9_001, "big", "", 0, 0), (9_002, "out", "y " * 90, 0, 0), (9_003, "zero", "y " * 90, 0, 0)]
    targets = [("big", 1.0, 1), ("small", 3.0, 2), ("zero", 0.0, 4), ("null", None, None), ("never", 5.0, 2)]
    docs, wanted = spark.createDataFrame(rows, DOCS), spark.createDataFrame(targets, TARGETS)
    mixed = X.mix(docs, wanted, block_tokens=64).cache()
    sized = {r["doc_id"]: r["n_tokens"] for r in X.sized_documents(docs, wanted, f"{K.VOCABULARIES}/{K.VOCABULARY}").collect()}
    total = sum(sized.values())
    got = mixed.collect()
    assert abs(sum(r["n_tokens"] for r in got) - total) <= 40
    small = sum(n for i, n in sized.items() if not i % 3)
    shares = {r["source"]: r["actual_share"] for r in X.report(mixed, wanted).collect()}
    assert abs(shares["small"] - min(0.75, 2 * small / total)) < 0.02 and shares["never"] == 0
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    assert len({(r["doc_id"], r["use"]) for r in got}) == len(got)
    by_slot = {}
    for r in sorted(got, key=lambda r: r["slot"]):
        by_slot.setdefault(r["slot"] // 10, []).append(r["source"] == "small")
    assert all(0.2 < sum(v) / len(v) < 0.95 for k, v in by_slot.items() if len(v) > 30)


def test_schedule_is_spread_evenly(spark):
    sized = spark.createDataFrame([(1, "a", 1)], "doc_id bigint, source string, n_tokens bigint")
    plan = X.schedule(sized, [X.Share("a", 1, 1, 1, 700.0), X.Share("b", 1, 1, 1, 300.0)], 100_000).where("source = 'a'").orderBy("slot").collect()
    assert [r["rank"] for r in plan] == list(range(len(plan))) and abs(len(plan) - 70_000) < 10
    gaps = [y["slot"] - x["slot"] for x, y in zip(plan, plan[1:], strict=False)]
    assert max(gaps) <= 3


def test_nothing_to_mix(spark):
    empty = spark.createDataFrame([], DOCS)
    targets = spark.createDataFrame([("a", 1.0, 1)], TARGETS)
    assert X.mix(empty, targets).collect() == []
    assert [(r["tokens"], r["actual_share"]) for r in X.report(X.mix(empty, targets), targets).collect()] == [(0, 0.0)]
