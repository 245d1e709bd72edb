from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from vigora.llm import neardup as N


def jaccard(a, b, width):
    s = [{tuple(w[i : i + width]) for i in range(len(w) - width + 1)} for w in (N.WORD.findall(a.lower()), N.WORD.findall(b.lower()))]
    return len(s[0] & s[1]) / len(s[0] | s[1])


def corpus(rng, n=120):
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randint(60, 140))] for _ in range(n // 4)]
    texts = []
    for _ in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 12)):
            t[rng.randrange(len(t))] = rng.choice(words)
        if rng.random() < 0.2:
            k = rng.randrange(len(t))
            t = t[k:] + t[:k]
        texts.append(" ".join(t))
    return texts


def test_pairs_against_brute_force(spark):
    rng = random.Random(5)
    texts = corpus(rng)
    rows = [(f"n{i:03d}", t, "x", 1) for i, t in enumerate(texts)]
    rows += [("n000", texts[0], "y", 2), ("copy", texts[0], "x", 1), ("low", texts[3].upper(), "x", 1), ("null", None, "x", 1), (None, texts[0], "x", 1), ("short", "a b c", "x", 1)]
    df = spark.createDataFrame(rows, "id string, texto string, class string, a int")
    held = {(r[0], r[1]) for r in rows if r[0] and r[1] and len(N.WORD.findall(r[1])) >= 60}
    want = {(a, b) for a, x in held for b, y in held if a < b and jaccard(x, y, 3) >= 0.6}
    got = [tuple(r) for r in N.similar_pairs(df, "id", "texto", 0.6, 3, 60, 4).collect()]
    assert len(got) == len(set(got)) and set(got) == want and ("copy", "n000") in want and ("low", "n003") in want
    grouped = {r["id"]: r["group_id"] for r in N.similar_groups(df, "id", "texto", 0.6, 3, 60, 4).collect()}
    assert grouped.keys() == {i for i, _ in held}
    assert all(grouped[a] == grouped[b] for a, b in want)
    parent = {i: i for i in grouped}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in want:
        parent[root(a)] = root(b)
    assert len(set(grouped.values())) == len({root(i) for i in grouped})


def test_a_hot_key_is_paired_in_blocks(spark):
    shared = " ".join(f"s{i}" for i in range(200))
    rows = [(f"{i:04d}", f"{shared} e{i}") for i in range(521)]
    df = spark.createDataFrame(rows, "id string, texto string")
    for hot in (N.HOT, 1_000):  # through blocks, and paired at once
        assert N.similar_pairs(df, "id", "texto", 0.8, 5, 60, 2, hot).count() == len(rows) * (len(rows) - 1) // 2


def test_hot_keys_give_the_same_pairs(spark):
    texts = corpus(random.Random(11), 200)
    df = spark.createDataFrame([(f"n{i:03d}", t) for i, t in enumerate(texts)], "id string, texto string")
    plain, hot = ({tuple(r) for r in N.similar_pairs(df, "id", "texto", 0.6, 3, 60, 3, h).collect()} for h in (10_000, 1))
    assert plain == hot and plain


def test_many_classes_under_one_key_stay_single():
    """100,000 classes of one key: their rows grow with the classes, not with their pairs."""
    n = 100_000
    part = N.squeeze(np.full(n, 77, np.uint64), np.arange(n, dtype=np.uint64), np.full(n, 90, np.uint64))
    tracemalloc.start()
    out = N._pair(0.6, N.HOT)(pa.table({"payload": pa.array([part], pa.binary())}))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows == n and out["b"].null_count == n and len(set(out["a"].to_pylist())) == n
    assert peak < 200 * n, peak


def test_blocks_of_a_hot_key_in_bounded_memory(spark):
    """Classes of one key come out as pairs only where short sketches agree, whatever blocks they are in."""
    rng = np.random.default_rng(1)
    n = 6_000
    minis = rng.integers(0, 256, (n, N.MINI), dtype=np.uint8)
    minis[1::2] = minis[::2]
    single = spark.createDataFrame([(1, i, 100) for i in range(n)], "hot bigint, class bigint, size bigint")
    mini = spark.createDataFrame([(i, m.tobytes()) for i, m in enumerate(minis)], "class bigint, mini binary")
    got = {tuple(r) for r in N.hot_pairs(single, mini, 0.6, 700).collect()}
    assert got == {(i, i + 1) for i in range(0, n, 2)}


def test_bytes_do_not_grow_with_buckets():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4_000)]
    texts = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(1_000)]

    def size(buckets):
        rows = pa.RecordBatch.from_pydict({"class": list(range(len(texts))), "text": texts})
        return sum(len(p) for b in N._banded(3, 60, *N.bands(0.6), buckets)(iter([rows])) for p in b["payload"].to_pylist())

    few, many = size(12), size(1_200)
    assert many < 1.5 * few, (few, many)


def test_recall_at_other_thresholds(spark):
    """Recall follows from the threshold: at least 0.99 of the pairs of a brute force, and no other pair."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3_000)]
    texts = []
    for _ in range(120):
        t = [rng.choice(words) for _ in range(100)]
        texts.append(" ".join(t))
        for edits in (1, 3, 6, 10, 14):
            u = list(t)
            for k in rng.sample(range(100), edits):
                u[k] = rng.choice(words)
            texts.append(" ".join(u))
    df = spark.createDataFrame([(f"n{i:03d}", t) for i, t in enumerate(texts)], "id string, texto string")
    for threshold in (0.4, 0.6, 0.8):
        want = {(f"n{i:03d}", f"n{j:03d}") for i in range(len(texts)) for j in range(i + 1, i // 6 * 6 + 6) if jaccard(texts[i], texts[j], 3) >= threshold}
        got = {tuple(r) for r in N.similar_pairs(df, "id", "texto", threshold, 3, 60, 4).collect()}
        assert got <= want and len(got) >= 0.99 * len(want) > 100, (threshold, len(got), len(want))


def test_bands_follow_the_threshold():
    assert N.bands(0.6) == (111, 6)
    for threshold in (0.2, 0.4, 0.6, 0.8, 0.95):
        count, rows = N.bands(threshold)
        assert (1 - threshold**rows) ** count <= N.MISS and N.MINI <= count * rows <= N.BINS
    with pytest.raises(ValueError):
        N.bands(0.001)


def test_empty_and_long(spark):
    schema = "id string, texto string"
    assert N.similar_pairs(spark.createDataFrame([], schema), "id", "texto").collect() == []
    long = " ".join(f"w{i}" for i in range(60_000))
    df = spark.createDataFrame([("a", long), ("b", long + " mais")], schema)
    assert [tuple(r) for r in N.similar_pairs(df, "id", "texto", 0.8).collect()] == [("a", "b")]


def test_every_coordinate_fills_and_agreement_follows_similarity():
    rng = np.random.default_rng(0)
    one = N.sketch([np.array([7], np.uint64)], 64)
    assert (one != np.iinfo(np.uint64).max).all()
    values = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64))
    for share in (0.2, 0.6, 0.9):
        k = int(len(values) * share)
        rest = len(values) - k
        a, b = values[: k + rest // 2], np.concatenate((values[:k], values[k + rest // 2 :]))
        x, y = N.sketch([a, b], 1_024)
        assert abs((x == y).mean() - k / len(values)) < 0.06
